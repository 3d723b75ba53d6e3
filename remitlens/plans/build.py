"""Full-refresh build of the result tables (the batch run).

Order of work:
1. the claim grain (claims x encounters, left join denials) is written once,
   partitioned by ``is_denied``, and read back: the denial fact (which reads
   only the denied partition) and the segment denominators both read it, so the
   fact-to-fact joins run once;
2. the denial fact is written from it and read back;
3. the rollup of the fact is written: one pass of the fact for every aggregate,
   and the marts are written from the rollup;
4. every check of a single row (not_null, accepted values, row rules) is
   counted while these tables and the staged tables in them are written
   (``operators.observed``): no scan of its own unless one fails. The keyed
   checks follow, and all checks are written as ``checks``, the failing rows
   (a bounded number of each failing check) as ``failing_rows``;
5. the run is published (``sources.publish``): a reader sees all tables of the
   old run or all of the new one, and a run that fails is discarded.

``target`` is a folder on shared storage (or a catalog database when
``as_tables=True``, whose names become views over the published run); without
one, a fresh folder under the session's checkpoint folder
(``spark.checkpoint.dir``) is used.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from remitlens.operators.observed import Watch
from remitlens.plans import facts, quality
from remitlens.plans.models import Models
from remitlens.plans.quarantine import stage_with_quarantine
from remitlens.plans.rejects import SAMPLE, failing_rows
from remitlens.session import ensure_checkpoint_dir
from remitlens.sources.publish import database_folder, discard, new_run, publish, publish_views
from remitlens.sources.raw import RawTables
from remitlens.sources.sinks import materialize, scalar_value

MARTS = ("denial_patterns", "recoverable_pool", "fix_recommendations", "appealable_share")
#: Staged tables that the claim grain and the fact read whole while written.
WATCHED_IN_GRAIN = ("stg_claims", "stg_encounters", "stg_denials")
WATCHED_IN_FACT = ("stg_providers", "stg_payers", "stg_reason_codes")


@dataclass(frozen=True)
class BuildOutput:
    target: str
    tables: dict[str, DataFrame]
    checks: DataFrame | None
    orphan_claims: int
    run: str
    failing_rows: DataFrame | None = None
    rejects: DataFrame | None = None


def write_models(
    models: Models, run: str, watched: dict[str, Watch], fact_partition_by: Sequence[str] = ()
) -> tuple[Models, dict[str, DataFrame]]:
    """Write claim grain, fact, rollup and marts into the folder ``run``, with
    the given watches on them and on the staged tables that they read. Returns
    the models over the written tables, and the tables."""
    spark = models.spark

    def store(name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        df = watched[name].on(df) if name in watched else df
        return materialize(spark, df, os.path.join(run, name), partition_by=partition_by)

    def seen(tables: Sequence[str]) -> dict[str, DataFrame]:
        return {t: watched[t].on(models.staged.table(t)) if t in watched else models.staged.table(t) for t in tables}

    grain = seen(WATCHED_IN_GRAIN)
    # partitioned by the denial flag: the fact reads only the denied part
    cwd = store(
        "claims_with_denials",
        facts.claims_with_denials(grain["stg_claims"], grain["stg_encounters"], grain["stg_denials"]),
        ["is_denied"],
    )
    dims = models.with_tables(**seen(WATCHED_IN_FACT))
    fact = store(
        "denial_fact",
        facts.denial_fact(cwd, dims.staged.providers, dims.staged.payers, dims.reason_economics),
        fact_partition_by,
    )
    stored = models.with_tables(claims_with_denials=cwd, denial_fact=fact)
    rollup = store("mart_rollup", stored.mart_rollup)
    stored = models.with_tables(claims_with_denials=cwd, denial_fact=fact, mart_rollup=rollup)
    tables = {"claims_with_denials": cwd, "denial_fact": fact, "mart_rollup": rollup}
    for name in MARTS:
        tables[name] = store(name, stored.model(name))
    return models.with_tables(**tables), tables


def run_build(
    spark: SparkSession,
    raw: RawTables,
    target: str | None = None,
    assumptions: DataFrame | None = None,
    domains: quality.Domains = quality.CLINIC_DOMAINS,
    as_tables: bool = False,
    with_checks: bool = True,
    fact_partition_by: Sequence[str] = (),
    top_k: int = 5,
    quarantine: bool = False,
    reject_sample: int = SAMPLE,
) -> BuildOutput:
    """Run the full refresh; ``fact_partition_by`` lays the stored fact out
    by the given columns (e.g. a month column) for pruning by later readers.
    With ``quarantine`` raw rows that do not cast are set aside as ``rejects``
    and the others load; otherwise such a row fails the run."""
    if target is None:
        if as_tables:
            raise ValueError("as_tables needs a target database name")
        target = os.path.join(ensure_checkpoint_dir(spark), f"remitlens-build-{uuid.uuid4().hex}")
    root = database_folder(spark, target) if as_tables else target
    run = new_run(root)
    try:
        out = _run(spark, raw, target, run, assumptions, domains, with_checks, fact_partition_by, top_k, quarantine, reject_sample)
    except BaseException:
        discard(spark, run)
        raise
    extra = {"checks": out.checks, "failing_rows": out.failing_rows, "rejects": out.rejects}
    stored = out.tables | {name: df for name, df in extra.items() if df is not None}
    publish(spark, root, run, stored)
    if as_tables:
        publish_views(spark, target, run, stored)
    return out


def _run(spark, raw, target, run, assumptions, domains, with_checks, fact_partition_by, top_k, quarantine, reject_sample) -> BuildOutput:
    models = Models(spark, raw, assumptions, top_k)
    rejects = None
    if quarantine:
        staged, bad = stage_with_quarantine(spark, raw, os.path.join(run, "staged"))
        models = models.with_tables(**{f"stg_{k}": v for k, v in staged.__dict__.items() if not k.startswith("_")})
        rejects = materialize(spark, bad, os.path.join(run, "rejects"))
    watched = quality.watches(domains) if with_checks else {}
    stored, tables = write_models(models, run, watched, fact_partition_by)
    if not with_checks:
        s = models.staged
        return BuildOutput(target, tables, None, int(scalar_value(quality.orphan_claims(s.claims, s.encounters))), run, None, rejects)
    references, orphans = quality.references_and_orphans(stored)
    suite = quality.settled(stored, domains, watched)
    for part in (quality.unique_suite(stored), references, quality.grain_checks(stored)):
        suite = suite.unionByName(part)
    checks = materialize(spark, suite, os.path.join(run, "checks"))
    # one row a check: small by construction
    failed = [(r["check_name"], r["table_name"], r["column_name"]) for r in checks.where("failures <> 0").collect()]
    bad_rows = materialize(spark, failing_rows(stored, domains, reject_sample, failed), os.path.join(run, "failing_rows"))
    return BuildOutput(target, tables, checks, int(scalar_value(orphans)), run, bad_rows, rejects)


def checks_in_write(models: Models, domains: quality.Domains) -> DataFrame:
    """All checks of single rows as the build gets them: the tables are written
    into a scratch folder of the checkpoint folder, the checks are counted on
    the way, and the folder is deleted. One row a check."""
    spark = models.spark
    scratch = os.path.join(ensure_checkpoint_dir(spark), f"remitlens-checks-{uuid.uuid4().hex}")
    try:
        watched = quality.watches(domains)
        stored, _ = write_models(models, scratch, watched)
        rows = quality.settled(stored, domains, watched).collect()
    finally:
        discard(spark, scratch)
    return quality.literal_checks(spark, [tuple(r) for r in rows])


def stored_failing_rows(models: Models, domains: quality.Domains, sample: int | None = SAMPLE) -> DataFrame:
    """The failing rows of all checks, over tables that are written once.

    Every check of a table reads it again, and the staged facts and the marts
    are joins of their own. So encounters, denials and the models are written
    into a scratch folder of the checkpoint folder, the checks read the files,
    and the folder is deleted once the failing rows are kept.
    """
    spark = models.spark
    scratch = os.path.join(ensure_checkpoint_dir(spark), f"remitlens-rejects-{uuid.uuid4().hex}")
    try:
        joined = {t: materialize(spark, models.model(t), os.path.join(scratch, t)) for t in ("stg_encounters", "stg_denials")}
        stored, _ = write_models(models.with_tables(**joined), scratch, {})
        return failing_rows(stored, domains, sample).checkpoint()
    finally:
        discard(spark, scratch)
