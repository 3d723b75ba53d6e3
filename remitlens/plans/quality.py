"""The declared check suite over staging and marts, plus row rules, grain
reconciliation and the orphan count.

52 declared checks: 23 not_null, 15 unique, 8 accepted_values, 6
relationships. Accepted-value lists are arguments (``Domains``) because a
deployment's payer types and specialties are its own.

Every check of a single row (not_null, accepted_values, row rules) is a
``RowCheck`` with a condition that failing rows meet. The same conditions count
failures in a pass over a table, are watched while the build writes it
(``watches``, ``settled``), and pick the failing rows (``plans.rejects``).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.functions.numeric import AMOUNT
from remitlens.operators.checks import column_checks, literal_checks, row_rule_checks, union_checks
from remitlens.operators.fingerprint import same_values
from remitlens.operators.joins import anti_join
from remitlens.operators.observed import Watch
from remitlens.operators.references import Relation, unmatched_counts
from remitlens.operators.uniqueness import repeated_values
from remitlens.plans.models import Models
from remitlens.plans.staging import PROJECTIONS


@dataclass(frozen=True)
class Domains:
    insurance_types: tuple[str, ...]
    genders: tuple[str, ...]
    specialties: tuple[str, ...]
    payer_types: tuple[str, ...]
    carc_categories: tuple[str, ...]
    claim_statuses: tuple[str, ...]
    appeal_statuses: tuple[str, ...]


# The accepted lists of a clinic deployment.
CLINIC_DOMAINS = Domains(
    insurance_types=("commercial", "medicare", "medicaid"),
    genders=("M", "F"),
    specialties=(
        "Cardiology", "Orthopedics", "Radiology", "Primary Care",
        "Emergency Medicine", "Oncology", "Dermatology", "Gastroenterology",
    ),
    payer_types=("commercial", "medicare", "medicaid"),
    carc_categories=("technical", "coding", "coverage", "medical_necessity"),
    claim_statuses=("paid", "denied", "pending"),
    appeal_statuses=("not_appealed", "appeal_pending", "appeal_won", "appeal_lost"),
)

# Table -> columns that must be non-NULL (23).
NOT_NULL: dict[str, tuple[str, ...]] = {
    "stg_patients": ("patient_id",),
    "stg_providers": ("provider_id",),
    "stg_payers": ("payer_id",),
    "stg_reason_codes": ("carc_code",),
    "stg_encounters": ("encounter_id",),
    "stg_claims": ("claim_id", "encounter_id"),
    "stg_denials": ("denial_id", "claim_id", "carc_code"),
    "denial_fact": ("denial_key", "denial_id", "claim_id", "carc_code", "billed_amount", "recoverable_amount"),
    "denial_patterns": ("pattern_key", "total_recoverable"),
    "recoverable_pool": ("carc_category", "total_recoverable"),
    "fix_recommendations": ("priority_rank", "recommended_action", "priority_score"),
}

# Table -> columns that must be unique (15).
UNIQUE: dict[str, tuple[str, ...]] = {
    "stg_patients": ("patient_id",),
    "stg_providers": ("provider_id",),
    "stg_payers": ("payer_id",),
    "stg_reason_codes": ("carc_code",),
    "stg_encounters": ("encounter_id",),
    "stg_claims": ("claim_id", "encounter_id"),
    "stg_denials": ("denial_id", "claim_id"),
    "denial_fact": ("denial_key", "denial_id", "claim_id"),
    "denial_patterns": ("pattern_key",),
    "recoverable_pool": ("carc_category",),
    "fix_recommendations": ("priority_rank",),
}

# Fixed values: (child table, column, parent table, parent column) (6).
RELATIONSHIPS: tuple[tuple[str, str, str, str], ...] = (
    ("stg_encounters", "patient_id", "stg_patients", "patient_id"),
    ("stg_encounters", "provider_id", "stg_providers", "provider_id"),
    ("stg_claims", "encounter_id", "stg_encounters", "encounter_id"),
    ("stg_claims", "payer_id", "stg_payers", "payer_id"),
    ("stg_denials", "claim_id", "stg_claims", "claim_id"),
    ("stg_denials", "carc_code", "stg_reason_codes", "carc_code"),
)

#: table -> column that names a row in a report of failing rows.
ROW_KEY: dict[str, str] = {
    "stg_patients": "patient_id",
    "stg_providers": "provider_id",
    "stg_payers": "payer_id",
    "stg_reason_codes": "carc_code",
    "stg_encounters": "encounter_id",
    "stg_claims": "claim_id",
    "stg_denials": "denial_id",
    "claims_with_denials": "claim_id",
    "denial_fact": "denial_id",
    "denial_patterns": "pattern_key",
    "recoverable_pool": "carc_category",
    "fix_recommendations": "priority_rank",
}

CHECK_KINDS = ("not_null", "accepted_values", "unique", "relationships", "row_rules", "grain")


def accepted_values(domains: Domains) -> dict[str, dict[str, tuple[str, ...]]]:
    """table -> column -> accepted list (8)."""
    return {
        "stg_patients": {"insurance_type": domains.insurance_types, "gender": domains.genders},
        "stg_providers": {"specialty": domains.specialties},
        "stg_payers": {"payer_type": domains.payer_types},
        "stg_reason_codes": {"carc_category": domains.carc_categories},
        "stg_claims": {"claim_status": domains.claim_statuses},
        "stg_denials": {"appeal_status": domains.appeal_statuses},
        "denial_fact": {"carc_category": domains.carc_categories},
    }


def row_rule_conditions() -> dict[str, dict[str, tuple[str, Column]]]:
    """table -> rule -> (column, condition that good rows meet).

    * recoverable_amount equals the rounded product billed x rate x multiplier;
    * paid_amount equals allowed_amount on paid claims and 0 otherwise;
    * a claim is dated on its encounter's date.
    """
    expected = F.round(F.col("billed_amount") * F.col("appeal_win_rate") * F.col("category_multiplier"), 2)
    paid_expected = F.when(F.col("claim_status") == "paid", F.col("allowed_amount")).otherwise(F.lit(0))
    return {
        "denial_fact": {
            "recoverable_rule": ("recoverable_amount", F.col("recoverable_amount").eqNullSafe(expected.cast(AMOUNT)))
        },
        "stg_claims": {"paid_amount_rule": ("paid_amount", F.col("paid_amount") == paid_expected)},
        "claims_with_denials": {
            "claim_date_is_encounter_date": ("claim_date", F.col("claim_date") == F.col("encounter_date"))
        },
    }


@dataclass(frozen=True)
class RowCheck:
    check: str
    table: str
    column: str
    failing: Column

    @property
    def name(self) -> str:
        return f"{self.check}.{self.column}"


def row_checks(domains: Domains) -> dict[str, list[RowCheck]]:
    """table -> its checks of single rows: 23 not_null, 8 accepted_values, 3 rules."""
    out: dict[str, list[RowCheck]] = {}
    for table, columns in NOT_NULL.items():
        out.setdefault(table, []).extend(RowCheck("not_null", table, c, F.col(c).isNull()) for c in columns)
    for table, lists in accepted_values(domains).items():
        out.setdefault(table, []).extend(
            RowCheck("accepted_values", table, c, ~F.col(c).isin(list(values))) for c, values in lists.items()
        )
    for table, rules in row_rule_conditions().items():
        out.setdefault(table, []).extend(
            RowCheck(rule, table, c, ~F.coalesce(good, F.lit(False))) for rule, (c, good) in rules.items()
        )
    return out


def watches(domains: Domains) -> dict[str, Watch]:
    """A watch of each table that has checks of single rows."""
    return {table: Watch({c.name: c.failing for c in checks}) for table, checks in row_checks(domains).items()}


def _counted(m: Models, domains: Domains, wanted: Mapping[str, Iterable[str]]) -> list[DataFrame]:
    """The named checks of each table, counted in passes over it."""
    accepted, rules = accepted_values(domains), row_rule_conditions()
    parts = []
    for table, names in wanted.items():
        names, df = set(names), m.model(table)
        nn = [c for c in NOT_NULL.get(table, ()) if f"not_null.{c}" in names]
        av = {c: v for c, v in accepted.get(table, {}).items() if f"accepted_values.{c}" in names}
        rr = {r: x for r, x in rules.get(table, {}).items() if f"{r}.{x[0]}" in names}
        if nn or av:
            parts.append(column_checks(df, table, nn, av))
        if rr:
            parts.append(row_rule_checks(df, table, rr))
    return parts


def settled(m: Models, domains: Domains, watched: Mapping[str, Watch]) -> DataFrame:
    """All checks of single rows, after the watched tables are written.

    A check that its watch saw pass is a row with 0; only the others are
    counted, over the tables of ``m``. The results equal those of a full pass.
    """
    done, wanted = [], {}
    for table, checks in row_checks(domains).items():
        passed = watched[table].passed() if table in watched else set()
        done += [(c.check, table, c.column, 0) for c in checks if c.name in passed]
        open_checks = [c.name for c in checks if c.name not in passed]
        if open_checks:
            wanted[table] = open_checks
    return union_checks(m.spark, [literal_checks(m.spark, done), *_counted(m, domains, wanted)])


def column_suite(
    m: Models, domains: Domains, include_not_null: bool = True, include_accepted: bool = True
) -> DataFrame:
    """not_null and accepted_values checks, one fused pass per table."""
    kinds = ("not_null",) * include_not_null + ("accepted_values",) * include_accepted
    wanted = {t: [c.name for c in checks if c.check in kinds] for t, checks in row_checks(domains).items()}
    return union_checks(m.spark, _counted(m, domains, wanted))


def not_null_suite(m: Models) -> DataFrame:
    return column_suite(m, CLINIC_DOMAINS, include_not_null=True, include_accepted=False)


def accepted_values_suite(m: Models, domains: Domains) -> DataFrame:
    return column_suite(m, domains, include_not_null=False, include_accepted=True)


def repeated_keys(m: Models) -> dict[tuple[str, str], DataFrame | None]:
    """(table, column) -> repeated values, or None where there are none."""
    return repeated_values(m.spark, {t: (m.model(t), cols) for t, cols in UNIQUE.items()})


def unique_suite(m: Models) -> DataFrame:
    """The 15 unique checks: one job over packed hashes of all columns, and an
    exact count of those columns only that have suspects."""
    found = repeated_keys(m)
    done = [("unique", t, c, 0) for (t, c), df in found.items() if df is None]
    parts = [literal_checks(m.spark, done)]
    for (t, c), df in found.items():
        if df is not None:
            parts.append(
                df.agg(F.count(F.lit(1)).alias("failures")).select(
                    F.lit("unique").alias("check_name"), F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), "failures"
                )
            )
    return union_checks(m.spark, parts)


def relations(m: Models) -> list[Relation]:
    return [Relation(m.model(t), c, m.model(pt), pc, pt) for t, c, pt, pc in RELATIONSHIPS]


def _relationship_rows(counts: DataFrame) -> DataFrame:
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit("relationships").alias("check_name"),
                        F.lit(t).alias("table_name"),
                        F.lit(c).alias("column_name"),
                        F.col(f"n_{i}").alias("failures"),
                    )
                    for i, (t, c, _, _) in enumerate(RELATIONSHIPS)
                ]
            )
        )
    )


def relationships_suite(m: Models) -> DataFrame:
    """The 6 relationships, by one shuffle of all their keys."""
    return _relationship_rows(unmatched_counts(relations(m)))


def declared_suite(m: Models, domains: Domains) -> DataFrame:
    """All 52 declared checks."""
    return union_checks(
        m.spark,
        [column_suite(m, domains), unique_suite(m), relationships_suite(m)],
    )


def row_rules(m: Models) -> DataFrame:
    """The documented row invariants (``row_rule_conditions``)."""
    wanted = {t: [f"{r}.{c}" for r, (c, _) in rules.items()] for t, rules in row_rule_conditions().items()}
    return union_checks(m.spark, _counted(m, CLINIC_DOMAINS, wanted))


def _denial_reconciliation(m: Models) -> tuple[Column, Column, Column]:
    """Staged denials that the fact lacks, fact rows whose denial is not staged,
    denial ids that the fact has more than once: scalars.

    If the two columns are the same multiset (fingerprints, one row a task) the
    first two are 0 and nothing is joined; the third then is whatever the staged
    ids have. Otherwise anti joins count.
    """
    fact, denials = m.denial_fact.select("denial_id"), m.staged.denials.select("denial_id")
    count = lambda df: df.agg(F.count(F.lit(1))).scalar()
    same = same_values(denials, fact, "denial_id")
    ids = denials if same else fact
    repeated = repeated_values(m.spark, {"ids": (ids, ("denial_id",))})["ids", "denial_id"]
    nothing = F.lit(0).cast("bigint")
    twice = nothing if repeated is None else count(repeated)
    # a NULL id that repeats is one repeated id as well
    null_twice = F.when(ids.where(F.col("denial_id").isNull()).agg(F.count(F.lit(1))).scalar() > 1, 1).otherwise(0)
    if same:
        null_lost = count(denials.where(F.col("denial_id").isNull()))  # a NULL id matches nothing
        return null_lost, null_lost, twice + null_twice
    return count(anti_join(denials, fact, "denial_id")), count(anti_join(fact, denials, "denial_id")), twice + null_twice


def grain_checks(m: Models) -> DataFrame:
    """Row-count reconciliation across the joins.

    * claims_preserved: staged claim rows minus distinct claim ids of the
      claim grain (claims dropped for want of an encounter);
    * one_row_per_claim: claim-grain rows minus distinct claim ids (fan-out);
    * one_fact_row_per_denial: staged denials that the fact lacks (no claim, no
      encounter, or an unknown provider, payer or reason code);
    * fact_denial_known: fact rows whose denial is not staged;
    * fact_denial_once: denial ids that the fact has more than once. The three
      are counted apart, so they cannot cancel;
    * denial_flag_matches_status: rows whose denial-row flag disagrees with
      the 'denied' status text.
    """
    cwd = m.claims_with_denials
    status_denied = F.coalesce(F.col("claim_status") == "denied", F.lit(False))
    stats = cwd.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("claim_id").alias("claims"),
        F.count_if(F.col("is_denied") != status_denied).alias("flag_mismatch"),
    )
    n_claims = m.staged.claims.agg(F.count(F.lit(1))).scalar()
    lost, unknown, repeated = _denial_reconciliation(m)
    rows = stats.select(
        (n_claims - F.col("claims")).alias("claims_preserved"),
        (F.col("rows") - F.col("claims")).alias("one_row_per_claim"),
        lost.alias("one_fact_row_per_denial"),
        unknown.alias("fact_denial_known"),
        repeated.alias("fact_denial_once"),
        F.col("flag_mismatch").alias("denial_flag_matches_status"),
    )
    entries = [
        ("claims_preserved", "claims_with_denials", "claim_id"),
        ("one_row_per_claim", "claims_with_denials", "claim_id"),
        ("one_fact_row_per_denial", "denial_fact", "denial_id"),
        ("fact_denial_known", "denial_fact", "denial_id"),
        ("fact_denial_once", "denial_fact", "denial_id"),
        ("denial_flag_matches_status", "claims_with_denials", "is_denied"),
    ]
    return rows.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("check_name"),
                        F.lit(table).alias("table_name"),
                        F.lit(col).alias("column_name"),
                        F.col(name).cast("bigint").alias("failures"),
                    )
                    for name, table, col in entries
                ]
            )
        ).alias("c")
    ).select("c.*")


def _orphans(claims: DataFrame, encounters: DataFrame) -> Relation:
    return Relation(claims, "encounter_id", encounters, "encounter_id", "stg_encounters", null_is_unmatched=True)


def orphan_claims(claims: DataFrame, encounters: DataFrame) -> DataFrame:
    """Claims with no encounter (a NULL encounter id counts as orphan): one
    row, ``orphan_claims``. Claims and encounters are grouped once by their id."""
    return unmatched_counts([_orphans(claims, encounters)]).withColumnRenamed("n_0", "orphan_claims")


def references_and_orphans(m: Models) -> tuple[DataFrame, DataFrame]:
    """The relationship checks and the orphan count from one grouping, whose
    counts are one row, kept as literals."""
    row = unmatched_counts([*relations(m), _orphans(m.staged.claims, m.staged.encounters)]).first()
    checks = literal_checks(m.spark, [("relationships", t, c, row[f"n_{i}"]) for i, (t, c, _, _) in enumerate(RELATIONSHIPS)])
    return checks, m.spark.range(1).select(F.lit(row[f"n_{len(RELATIONSHIPS)}"]).cast("bigint").alias("orphan_claims"))


def checks_of_kind(m: Models, kind: str, domains: Domains) -> DataFrame:
    """One group of checks: a name of CHECK_KINDS, or the name of a table, whose
    checks of single rows are run."""
    if kind in PROJECTIONS or kind in ROW_KEY:
        return union_checks(m.spark, _counted(m, domains, {kind: [c.name for c in row_checks(domains).get(kind, [])]}))
    suites = {
        "not_null": lambda: column_suite(m, domains, True, False),
        "accepted_values": lambda: column_suite(m, domains, False, True),
        "unique": lambda: unique_suite(m),
        "relationships": lambda: relationships_suite(m),
        "row_rules": lambda: row_rules(m),
        "grain": lambda: grain_checks(m),
    }
    if kind not in suites:
        raise ValueError(f"unknown checks: {kind}; one of {', '.join((*CHECK_KINDS, *ROW_KEY))}")
    return suites[kind]()

