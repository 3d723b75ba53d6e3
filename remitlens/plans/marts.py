"""Result tables over the denial fact: patterns, pool, opportunities, fixes.

All of them aggregate first and join afterwards, so any join they do is
between two small aggregates, and partial aggregation before each shuffle
absorbs hot payers, specialties or categories.

``mart_rollup`` computes every aggregate that the marts and the appealable
share need in one pass of the fact: the rows of a level (``level_rows``) take
the place of the level's own aggregation. The build stores it once and makes
four results of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.functions.keys import surrogate_key
from remitlens.functions.numeric import PCT, SHARE, TOTAL, round_ratio
from remitlens.operators.metrics import scored_top_k, segment_rate, share_of_total

SEGMENT = ["payer_type", "specialty"]

#: The aggregation levels over the fact: name -> columns. ``total`` is one row.
LEVELS: dict[str, tuple[str, ...]] = {
    "pattern": ("payer_type", "specialty", "carc_category"),
    "category": ("carc_category", "is_high_appeal_value"),
    "flag": ("is_high_appeal_value",),
    "opportunity": ("payer_type", "specialty", "carc_code", "carc_description", "carc_category"),
    "total": (),
}
#: Every column of a level, and the rates that are constant within a category.
KEYS = ("payer_type", "specialty", "carc_code", "carc_description", "carc_category", "is_high_appeal_value")
RATES = ("appeal_win_rate", "category_multiplier")


def _measures() -> list[Column]:
    return [
        F.count(F.lit(1)).cast("bigint").alias("denial_count"),
        F.sum("billed_amount").cast(TOTAL).alias("total_denied_billed"),
        F.sum("recoverable_amount").cast(TOTAL).alias("total_recoverable"),
        *[F.min(r).alias(r) for r in RATES],
    ]


def mart_rollup(fact: DataFrame) -> DataFrame:
    """All levels of LEVELS in one pass of the fact, told apart by ``level``.

    The fact is aggregated once at the finest grain (map-side combined, one
    shuffle); the grouping sets then run over those few rows. Columns outside a
    level are NULL in its rows. ``distinct_carc_codes`` counts the different
    non-NULL codes of a group. An empty fact gives no rows.
    """
    finest = fact.groupBy(*KEYS).agg(*_measures())
    sets = [[F.col(c) for c in columns] for columns in LEVELS.values()]
    # bit i of the grouping id, from the left, is 1 where KEYS[i] is left out
    ids = {sum(1 << (len(KEYS) - 1 - i) for i, c in enumerate(KEYS) if c not in columns): name for name, columns in LEVELS.items()}
    level = F.element_at(F.create_map(*[x for g, name in ids.items() for x in (F.lit(g), F.lit(name))]), F.grouping_id().cast("int"))
    return finest.groupingSets(sets, *[F.col(c) for c in KEYS]).agg(
        level.alias("level"),
        F.sum("denial_count").cast("bigint").alias("denial_count"),
        # of the finest rows, those of one code may differ in description or flag
        F.count_distinct(F.col("carc_code")).cast("bigint").alias("distinct_carc_codes"),
        F.sum("total_denied_billed").cast(TOTAL).alias("total_denied_billed"),
        F.sum("total_recoverable").cast(TOTAL).alias("total_recoverable"),
        *[F.min(r).alias(r) for r in RATES],
    )


def level_rows(rollup: DataFrame, level: str) -> DataFrame:
    """The rows of one level of a rollup, with that level's columns."""
    return rollup.where(F.col("level") == level).select(
        *LEVELS[level], "denial_count", "distinct_carc_codes", "total_denied_billed", "total_recoverable", *RATES
    )


def segment_claims(visits: DataFrame, payers: DataFrame, providers: DataFrame) -> DataFrame:
    """Total and denied claims per payer type x specialty (the rate denominator).

    'Denied' here is the claim status text (the fact uses the presence of a
    denial row instead); the grain check reports where the two disagree.

    ``visits`` needs payer_id, provider_id and claim_status. Claims are counted
    per (payer, provider) first, combined map-side, and only those counts meet
    the dimensions: one row per pair instead of one per claim, so a payer that
    carries a third of all claims is a few rows, not a hot partition.
    """
    denied = F.col("claim_status") == "denied"
    per_pair = segment_rate(visits, ["payer_id", "provider_id"], denied, "n", "n_denied")
    base = per_pair.join(payers.select("payer_id", "payer_type"), "payer_id", "inner").join(
        providers.select("provider_id", "specialty"), "provider_id", "inner"
    )
    return base.groupBy(*SEGMENT).agg(
        F.sum("n").cast("bigint").alias("total_claims"),
        F.sum("n_denied").cast("bigint").alias("denied_claims"),
    )


def pattern_rows(fact: DataFrame) -> DataFrame:
    return fact.groupBy(*LEVELS["pattern"]).agg(*_measures(), F.count_distinct("carc_code").alias("distinct_carc_codes"))


def denial_patterns(patterns: DataFrame, segments: DataFrame) -> DataFrame:
    """One row per payer type x specialty x reason category. ``patterns`` are
    the fact's ``pattern_rows`` or the rollup's level ``pattern``."""
    joined = patterns.join(segments, SEGMENT, "inner")
    return joined.select(
        surrogate_key("payer_type", "specialty", "carc_category").alias("pattern_key"),
        "payer_type",
        "specialty",
        "carc_category",
        F.col("denial_count").cast("bigint").alias("denial_count"),
        F.col("distinct_carc_codes").cast("bigint").alias("distinct_carc_codes"),
        F.col("total_claims").cast("bigint").alias("total_claims"),
        F.col("denied_claims").cast("bigint").alias("denied_claims"),
        round_ratio("denied_claims", "total_claims", 1, factor=100).cast(PCT).alias("segment_denial_rate_pct"),
        F.round("total_denied_billed", 2).cast(TOTAL).alias("total_denied_billed"),
        F.round("total_recoverable", 2).cast(TOTAL).alias("total_recoverable"),
        round_ratio("total_recoverable", "denial_count", 2).cast(TOTAL).alias("recoverable_per_denial"),
    )


def category_rows(fact: DataFrame) -> DataFrame:
    """Measures per category and flag; the rates are constant within a
    category, and min() surfaces them."""
    return fact.groupBy(*LEVELS["category"]).agg(*_measures())


def recoverable_pool(categories: DataFrame) -> DataFrame:
    """Recoverable dollars per reason category and its share of the pool."""
    shared = share_of_total(categories, "total_recoverable", "pct_of_total_recoverable", scale=1)
    return shared.select(
        "carc_category",
        "is_high_appeal_value",
        "denial_count",
        "appeal_win_rate",
        "category_multiplier",
        F.round("total_denied_billed", 2).cast(TOTAL).alias("total_denied_billed"),
        F.round("total_recoverable", 2).cast(TOTAL).alias("total_recoverable"),
        F.col("pct_of_total_recoverable").cast(SHARE).alias("pct_of_total_recoverable"),
    ).orderBy(F.col("total_recoverable").desc_nulls_last())


def flag_rows(fact: DataFrame) -> DataFrame:
    return fact.groupBy(*LEVELS["flag"]).agg(*_measures())


def appealable_share(flags: DataFrame) -> DataFrame:
    """Recoverable pool split by the high-appeal-value flag."""
    by_flag = flags.select("is_high_appeal_value", "denial_count", F.col("total_recoverable").cast(TOTAL).alias("total_recoverable"))
    return share_of_total(by_flag, "total_recoverable", "pct_of_total_recoverable").withColumn(
        "pct_of_total_recoverable", F.col("pct_of_total_recoverable").cast(SHARE)
    )


def opportunity_rows(fact: DataFrame) -> DataFrame:
    return fact.groupBy(*LEVELS["opportunity"]).agg(*_measures())


def opportunities(rows: DataFrame) -> DataFrame:
    """Denials and dollars per payer type x specialty x reason code."""
    return rows.select(*LEVELS["opportunity"], "denial_count", "total_denied_billed", "total_recoverable")


def fix_recommendations(opps: DataFrame, fixes: DataFrame, k: int = 5) -> DataFrame:
    """Top ``k`` opportunities by recoverable dollars x fix probability.

    Ranked on the unrounded score, shown rounded; ties by payer type,
    specialty, reason code. Fewer than ``k`` opportunities give fewer rows.
    ``fixes`` maps carc_category to fix_probability and recommended_action.
    """
    scored = opps.join(fixes, "carc_category", "left")
    score = F.col("total_recoverable") * F.col("fix_probability")
    top = scored_top_k(scored, score, k, tiebreak=["payer_type", "specialty", "carc_code"], rank_name="priority_rank")
    return top.select(
        "priority_rank",
        "payer_type",
        "specialty",
        "carc_code",
        "carc_description",
        "carc_category",
        "denial_count",
        F.round("total_denied_billed", 2).cast(TOTAL).alias("total_denied_billed"),
        F.round("total_recoverable", 2).cast(TOTAL).alias("total_recoverable"),
        "fix_probability",
        F.round(score, 2).cast(TOTAL).alias("priority_score"),
        "recommended_action",
    ).orderBy("priority_rank")
