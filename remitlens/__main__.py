"""Command line: ``python -m remitlens {load,build,run,check,views} ...``.

* ``load``: register the seven raw parquet tables as catalog tables (full
  refresh) and report rows per table and the orphan-claim count.
* ``build``: full refresh of claim grain, fact, marts, checks and failing rows
  into a target folder (or catalog database with ``--tables``), published at
  once at the end; reports rows per stored table and every failing check.
* ``run``: one model, with only what it needs, shown or written.
* ``check``: one group of checks (or the row checks of one table).
* ``views``: staging and economics as permanent views of a catalog database.

The appeal assumptions, the accepted values of the checks and the number of
recommended fixes are parameters: ``--assumptions`` and ``--domains`` name JSON
files, ``--top-k`` is a number.

Under ``spark-submit`` the cluster's session is used as configured; with
``--master`` a session is built with this package's defaults.
"""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import fields, replace
from decimal import Decimal

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

#: Rows of a model that ``run`` shows.
SHOWN = 20


def _session(master: str | None) -> SparkSession:
    if master:
        from remitlens.session import build_session

        return build_session(master=master)
    spark = SparkSession.builder.appName("remitlens").getOrCreate()
    if spark.conf.get("spark.sql.ansi.enabled").lower() != "true":
        raise SystemExit("set spark.sql.ansi.enabled=true: without it bad casts become NULL unnoticed")
    return spark


def _count(df) -> int:
    from remitlens.sources.sinks import scalar_value

    return int(scalar_value(df.agg(F.count(F.lit(1)))))


def read_assumptions(path: str | None):
    """The default assumptions, or those of a JSON file: a list of objects with
    the fields of ``CategoryAssumption``, numbers as numbers or text."""
    from remitlens.plans.economics import DEFAULT_ASSUMPTIONS, CategoryAssumption

    if path is None:
        return DEFAULT_ASSUMPTIONS
    rates = ("appeal_win_rate", "category_multiplier", "fix_probability")
    with open(path, encoding="utf-8") as f:
        rows = json.load(f, parse_float=Decimal)
    known = {f.name for f in fields(CategoryAssumption)}
    out = []
    for row in rows:
        if set(row) != known:
            raise SystemExit(f"an assumption needs exactly {sorted(known)}, got {sorted(row)}")
        out.append(CategoryAssumption(**{k: Decimal(str(v)) if k in rates else v for k, v in row.items()}))
    return tuple(out)


def read_domains(path: str | None):
    """The accepted values: those of a clinic, with the lists of a JSON object
    (field of ``Domains`` -> list) in their place."""
    from remitlens.plans.quality import CLINIC_DOMAINS, Domains

    if path is None:
        return CLINIC_DOMAINS
    with open(path, encoding="utf-8") as f:
        given = json.load(f)
    unknown = set(given) - {f.name for f in fields(Domains)}
    if unknown:
        raise SystemExit(f"unknown accepted-value lists: {sorted(unknown)}")
    return replace(CLINIC_DOMAINS, **{k: tuple(v) for k, v in given.items()})


def _raw(spark: SparkSession, args: argparse.Namespace):
    from remitlens.sources.raw import read_catalog_tables, read_raw_tables

    if bool(args.raw) == bool(args.database):
        raise SystemExit("give exactly one of --raw or --database")
    return read_raw_tables(spark, args.raw) if args.raw else read_catalog_tables(spark, args.database)


def _models(spark: SparkSession, args: argparse.Namespace):
    from remitlens.plans.economics import assumptions_frame
    from remitlens.plans.models import Models

    return Models(spark, _raw(spark, args), assumptions_frame(spark, read_assumptions(args.assumptions)), args.top_k)


def cmd_load(args: argparse.Namespace) -> dict:
    from remitlens.plans.quality import orphan_claims
    from remitlens.plans.staging import stage
    from remitlens.sources.raw import read_catalog_tables, read_raw_tables
    from remitlens.sources.sinks import load_raw_tables, scalar_value

    spark = _session(args.master)
    load_raw_tables(spark, read_raw_tables(spark, args.raw), args.database, args.buckets, args.location)
    loaded = read_catalog_tables(spark, args.database)
    rows = {name: _count(df) for name, df in loaded.items()}
    s = stage(loaded)
    return {"rows": rows, "orphan_claims": int(scalar_value(orphan_claims(s.claims, s.encounters)))}


def cmd_build(args: argparse.Namespace) -> dict:
    from remitlens.plans.build import run_build
    from remitlens.plans.economics import assumptions_frame

    spark = _session(args.master)
    assumptions = read_assumptions(args.assumptions)
    out = run_build(
        spark,
        _raw(spark, args),
        args.target,
        assumptions=assumptions_frame(spark, assumptions),
        domains=read_domains(args.domains),
        as_tables=args.tables,
        with_checks=not args.no_checks,
        top_k=args.top_k,
        quarantine=args.quarantine,
        reject_sample=args.reject_sample,
    )
    report = {
        "target": out.target,
        "run": out.run,
        "rows": {name: _count(df) for name, df in out.tables.items()},
        "orphan_claims": out.orphan_claims,
    }
    if args.tables and args.database:
        from remitlens.plans.views import create_views

        report["views"] = create_views(spark, args.target, args.database, assumptions)
    if out.rejects is not None:
        report["rejects"] = _count(out.rejects)
    if out.checks is not None:
        # the check table has one row per declared check: small by construction
        failing = out.checks.filter(F.col("failures") != 0).collect()
        report["checks"] = _count(out.checks)
        report["failing_checks"] = [r.asDict() for r in failing]
        report["failing_rows"] = _count(out.failing_rows)
    return report


def cmd_run(args: argparse.Namespace) -> dict:
    from remitlens.sources.sinks import write_parquet

    df = _models(_session(args.master), args).model(args.model)
    if args.output:
        write_parquet(df, args.output)
        return {"model": args.model, "output": args.output}
    rows = df.limit(args.rows).collect()
    return {"model": args.model, "rows": [r.asDict() for r in rows]}


def cmd_check(args: argparse.Namespace) -> dict:
    from remitlens.plans.quality import checks_of_kind

    rows = checks_of_kind(_models(_session(args.master), args), args.kind, read_domains(args.domains)).collect()
    return {"checks": len(rows), "failing_checks": [r.asDict() for r in rows if r["failures"]]}


def cmd_views(args: argparse.Namespace) -> dict:
    from remitlens.plans.views import create_views

    return {"views": create_views(_session(args.master), args.target, args.database, read_assumptions(args.assumptions))}


def _sources(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--raw", help="folder holding <table>.parquet for the seven raw tables")
    parser.add_argument("--database", help="read the raw tables from this catalog database instead")


def _parameters(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--assumptions", default=None, help="JSON file of the appeal assumptions per category")
    parser.add_argument("--domains", default=None, help="JSON file of accepted-value lists for the checks")
    parser.add_argument("--top-k", type=int, default=5, help="number of recommended fixes")


def main(argv: list[str] | None = None) -> dict:
    parser = argparse.ArgumentParser(prog="python -m remitlens")
    parser.add_argument("--master", default=None, help="build a session with this master (default: use spark-submit's)")
    sub = parser.add_subparsers(dest="command", required=True)

    p_load = sub.add_parser("load", help="register raw parquet tables as catalog tables")
    p_load.add_argument("--raw", required=True, help="folder holding <table>.parquet for the seven raw tables")
    p_load.add_argument("--database", default="raw", help="catalog database to (re)create the tables in")
    p_load.add_argument("--buckets", type=int, default=None, help="bucket the fact tables on their join keys")
    p_load.add_argument("--location", default=None, help="store external tables under this folder")
    p_load.set_defaults(func=cmd_load)

    p_build = sub.add_parser("build", help="full refresh of fact, marts and checks")
    _sources(p_build)
    _parameters(p_build)
    p_build.add_argument("--target", default=None, help="output folder (default: under spark.checkpoint.dir)")
    p_build.add_argument("--tables", action="store_true", help="publish as views of the catalog database TARGET")
    p_build.add_argument("--no-checks", action="store_true", help="skip the check suite")
    p_build.add_argument("--quarantine", action="store_true", help="set rows that do not cast aside instead of failing")
    p_build.add_argument("--reject-sample", type=int, default=100, help="failing rows kept of each check")
    p_build.set_defaults(func=cmd_build)

    p_run = sub.add_parser("run", help="one model, with only what it needs")
    p_run.add_argument("model")
    _sources(p_run)
    _parameters(p_run)
    p_run.add_argument("--output", default=None, help="parquet folder to write (default: show the first rows)")
    p_run.add_argument("--rows", type=int, default=SHOWN, help="rows to show")
    p_run.set_defaults(func=cmd_run)

    p_check = sub.add_parser("check", help="one group of checks, or the row checks of a table")
    p_check.add_argument("kind")
    _sources(p_check)
    _parameters(p_check)
    p_check.set_defaults(func=cmd_check)

    p_views = sub.add_parser("views", help="staging and economics as permanent views")
    p_views.add_argument("--database", required=True, help="catalog database of the raw tables")
    p_views.add_argument("--target", required=True, help="catalog database of the views")
    p_views.add_argument("--assumptions", default=None, help="JSON file of the appeal assumptions per category")
    p_views.set_defaults(func=cmd_views)

    args = parser.parse_args(argv)
    report = args.func(args)
    print(json.dumps(report, default=str))
    return report


if __name__ == "__main__":
    # a failing check fails the run
    sys.exit(1 if main(sys.argv[1:]).get("failing_checks") else 0)
