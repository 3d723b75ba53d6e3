"""Exact decimal helpers.

``round_ratio`` rounds a quotient half away from zero at a fixed scale using
integral division only, so the result is exact whatever the size of the counts
or sums (a plain decimal division first rounds the quotient to the division's
own scale, which can move a value that sits next to a half unit).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"  # staged amounts
AMOUNT = "decimal(18,2)"  # one derived amount per row
TOTAL = "decimal(38,2)"  # sums of amounts
PCT = "decimal(5,1)"  # percentages to one digit
SHARE = "decimal(18,1)"  # percentages of signed amounts: not bounded by 100
RATE = "decimal(3,2)"  # assumption rates

_WORK = "decimal(38,6)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_ratio(numerator: Column | str, denominator: Column | str, scale: int, factor: int = 1) -> Column:
    """``round(factor * numerator / denominator, scale)``, exact, as decimal(38, scale).

    Operands are integers or decimals with at most 6 fractional digits. Half
    way cases round away from zero. A zero or NULL denominator gives NULL.
    """
    if isinstance(numerator, str) and isinstance(denominator, str):
        return F.expr(_ratio_sql(numerator, denominator, scale, factor))
    n = _col(numerator).cast(_WORK)
    d = F.nullif(_col(denominator).cast(_WORK), F.lit(Decimal(0)).cast(_WORK))
    abs_d = F.abs(d)
    # units = floor((2·factor·10^scale·|n| + |d|) / (2·|d|))
    twice_scaled = F.lit(Decimal(2 * factor * 10**scale)) * F.abs(n)
    units = F.call_function("div", twice_scaled + abs_d, F.lit(Decimal(2)) * abs_d)
    signed = F.when((n < 0) != (d < 0), -units).otherwise(units)
    step = F.lit(Decimal(1).scaleb(-scale)) if scale > 0 else F.lit(Decimal(1))
    return (signed.cast("decimal(38,0)") * step).cast(f"decimal(38,{scale})")


def _ratio_sql(numerator: str, denominator: str, scale: int, factor: int) -> str:
    """The same as SQL text over column names (one expression to plan)."""
    n, d = f"cast({numerator} as {_WORK})", f"nullif(cast({denominator} as {_WORK}), cast(0 as {_WORK}))"
    units = f"((({2 * factor * 10**scale}BD * abs({n})) + abs({d})) div (2BD * abs({d})))"
    signed = f"case when ({n} < 0) <> ({d} < 0) then -{units} else {units} end"
    step = f"{Decimal(1).scaleb(-scale):f}BD" if scale > 0 else "1BD"
    return f"cast(cast({signed} as decimal(38,0)) * {step} as decimal(38,{scale}))"


def percent(part: Column | str, whole: Column | str, scale: int = 1) -> Column:
    """``round(100 * part / nullif(whole, 0), scale)`` as decimal(5+, scale)."""
    return round_ratio(part, whole, scale, factor=100).cast(f"decimal({4 + scale},{scale})")
