"""Surrogate key: md5 over the dash-joined text of the fields, NULL-safe."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: text that stands for a NULL field inside the hashed string.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def _as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*fields: Column | str) -> Column:
    """Lower-case hex md5 of ``text(f1) || '-' || text(f2) ...``.

    Each field is cast to text and a NULL becomes ``NULL_TOKEN``, so the key is
    never NULL. The separator is not escaped: ``('a-b', 'c')`` and
    ``('a', 'b-c')`` give the same key; this is kept so keys stay stable. Text
    casts agree across engines for string, integer, date and decimal fields;
    avoid double and timestamp fields.
    """
    if not fields:
        raise ValueError("surrogate_key needs at least one field")
    if all(isinstance(f, str) for f in fields):
        texts = [f"coalesce(cast(`{f}` as string), '{NULL_TOKEN}')" for f in fields]
        return F.expr(f"md5(concat({f", '{SEPARATOR}', ".join(texts)}))")
    parts: list[Column] = []
    for i, f in enumerate(fields):
        if i:
            parts.append(F.lit(SEPARATOR))
        parts.append(F.coalesce(_as_column(f).cast("string"), F.lit(NULL_TOKEN)))
    return F.md5(F.concat(*parts))
