"""Join operators.

``anti_join``: rows of the left side without a partner, written as a
``left_anti`` join (a left join plus ``IS NULL`` filter is not rewritten by the
optimizer and carries the whole right side through the join).

Fact-to-dimension joins carry no hint: the planner broadcasts a dimension whose
size in bytes is within the session's threshold, known before or measured at
run time, and sort-merges a larger one, splitting a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def anti_join(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left rows whose key has no match on the right.

    A NULL key never matches, so left rows with a NULL key are returned.
    """
    keys = [on] if isinstance(on, str) else list(on)
    return left.join(right.select(*keys), keys, "left_anti")
