"""Typed staging: one projection per raw table (rename + cast, nothing else).

The projections are held as data, and their columns as SQL text: the same text
makes the DataFrames, the permanent views of a catalog (``plans.views``) and the
quarantine of rows that do not fit (``plans.quarantine``).

Casts run under the session's ANSI setting: malformed dates or amounts that do
not fit decimal(12,2) raise instead of turning into NULLs.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from remitlens.functions.numeric import MONEY
from remitlens.sources.raw import RawTables

#: Texts that are a date: year-month-day, with or without a time of day and zone.
_TIME = r"([01]?\d|2[0-3]):[0-5]?\d(:[0-5]?\d([.]\d+)?(Z|[+-]\d{1,2}(:\d{2})?)?)?"
ISO_DATE = rf"\s*\d{{4,}}-\d{{1,2}}-\d{{1,2}}([T ]{_TIME})?\s*"


@dataclass(frozen=True)
class Field:
    """A staged column: its name, the raw column, and what it is."""

    name: str
    source: str
    kind: str = "as is"  # or "date", "money"


def _fields(*specs: str) -> tuple[Field, ...]:
    """``name``, ``name:kind`` or ``name=source:kind`` each."""
    out = []
    for spec in specs:
        named, _, kind = spec.partition(":")
        name, _, source = named.partition("=")
        out.append(Field(name, source or name, kind or "as is"))
    return tuple(out)


# Staged table -> raw table and columns. The raw win rate and
# multiplier of the reason codes are left out on purpose: the economics come
# from the assumptions table.
PROJECTIONS: dict[str, tuple[str, tuple[Field, ...]]] = {
    "stg_patients": (
        "raw_patients",
        _fields("patient_id", "first_name", "last_name", "date_of_birth=dob:date", "gender", "zip_code=zip", "insurance_type"),
    ),
    "stg_encounters": (
        "raw_encounters",
        _fields(
            "encounter_id", "patient_id", "provider_id", "encounter_date:date", "procedure_code", "procedure_desc",
            "procedure_category", "diagnosis_code",
        ),
    ),
    "stg_claims": (
        "raw_claims",
        _fields(
            "claim_id", "encounter_id", "payer_id", "billed_amount:money", "allowed_amount:money", "paid_amount:money",
            "claim_status=status", "claim_date:date",
        ),
    ),
    "stg_denials": (
        "raw_denials",
        _fields("denial_id", "claim_id", "carc_code", "rarc_code", "denial_date:date", "appeal_status"),
    ),
    "stg_reason_codes": ("dim_carc_codes", _fields("carc_code", "carc_description=description", "carc_category=category")),
    "stg_providers": ("dim_providers", _fields("provider_id", "provider_name", "specialty", "npi", "region")),
    "stg_payers": ("dim_payers", _fields("payer_id", "payer_name", "payer_type")),
}


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def looks_like(field: Field, raw_type: str) -> str | None:
    """SQL condition that a raw value must meet before its cast; None: none."""
    if field.kind == "date" and raw_type == "string":
        c = quoted(field.source)
        # yyyy-mm-dd needs no pattern: the cast checks its digits
        plain = f"length({c}) = 10 and substring({c}, 5, 1) = '-' and substring({c}, 8, 1) = '-' and substring({c}, 10, 1) between '0' and '9'"
        return f"(({plain}) or {c} rlike r'^{ISO_DATE}$')"
    return None


def cast_sql(field: Field, raw_type: str, lenient: bool = False) -> str:
    """SQL of a staged column, without its name. ``lenient`` gives NULL where
    the value does not fit; otherwise that is an error."""
    c = quoted(field.source)
    cast = "try_cast" if lenient else "cast"
    if field.kind == "date":
        if raw_type != "string":
            return f"{cast}({c} as date)"
        fits = looks_like(field, raw_type)
        if lenient:
            return f"try_cast(case when {fits} then {c} end as date)"
        wrong = f"raise_error(concat('{field.source} is not a date: ', {c}))"
        return f"cast(case when {c} is null or {fits} then {c} else {wrong} end as date)"
    if field.kind == "money":
        if raw_type in ("double", "float"):
            # cents' precision: a binary fraction is rounded as the product by
            # 100, so 1.005 (just below it in binary) gives 1.00
            cents = f"{cast}(round(cast({c} as double) * 100.0D) as decimal(20,0))"
            return f"{cast}({cents} * 0.01BD as {MONEY})"
        return f"{cast}({c} as {MONEY})"
    return c


def stage_sql(table: str, raw_types: dict[str, str]) -> list[str]:
    """The select list of a staged table over raw columns of these types."""
    return [f"{cast_sql(f, raw_types[f.source])} as {quoted(f.name)}" for f in PROJECTIONS[table][1]]


def stage_table(table: str, raw: DataFrame) -> DataFrame:
    """The staged table ``table`` of its raw table."""
    return raw.selectExpr(*stage_sql(table, dict(raw.dtypes)))


class Staged:
    """The seven staged tables; each is made when it is first asked for.
    ``given`` replaces some by other frames of the same columns."""

    def __init__(self, raw: RawTables, **given: DataFrame):
        self._raw = raw
        self.__dict__.update(given)

    def _staged(self, table: str) -> DataFrame:
        return stage_table(table, self._raw.table(PROJECTIONS[table][0]))

    def table(self, name: str) -> DataFrame:
        """A staged table by its name ``stg_...``."""
        return getattr(self, name.removeprefix("stg_"))

    def replaced(self, **given: DataFrame) -> "Staged":
        own = {k: v for k, v in self.__dict__.items() if k != "_raw"}
        return Staged(self._raw, **(own | given))

    @cached_property
    def patients(self) -> DataFrame:
        return self._staged("stg_patients")

    @cached_property
    def encounters(self) -> DataFrame:
        return self._staged("stg_encounters")

    @cached_property
    def claims(self) -> DataFrame:
        return self._staged("stg_claims")

    @cached_property
    def denials(self) -> DataFrame:
        return self._staged("stg_denials")

    @cached_property
    def reason_codes(self) -> DataFrame:
        return self._staged("stg_reason_codes")

    @cached_property
    def providers(self) -> DataFrame:
        return self._staged("stg_providers")

    @cached_property
    def payers(self) -> DataFrame:
        return self._staged("stg_payers")


def stage(raw: RawTables) -> Staged:
    return Staged(raw)
