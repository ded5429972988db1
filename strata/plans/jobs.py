"""Command-line jobs: the same steps as the library, one process per call.

    python -m strata.plans.jobs seed    --csv-root R --jdbc-url U [--tables ...]
    python -m strata.plans.jobs extract --jdbc-url U --raw-root R [--tables ...]
    python -m strata.plans.jobs stage   --raw-root R --namespace staged --root W [--table T] [--keys k1,k2]
    python -m strata.plans.jobs curate  --staged staged --curated curated --root W [--table T]
    python -m strata.plans.jobs run     --raw-root R --root W [--staged S] [--curated C] [--results-root R]
    python -m strata.plans.jobs quality --curated curated [--results-root R] [--fail-on any] [--as-of D]
    python -m strata.plans.jobs sql     --query "SELECT ..." [--catalog-alias A] [--limit N]

Database credentials come from ``--jdbc-user`` / ``--jdbc-password`` or the
``JDBC_USER`` / ``JDBC_PASSWORD`` environment variables, never from code.
Master, memory and the shared ``spark.checkpoint.dir`` come from
``spark-submit`` / ``spark-defaults.conf``.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
from dataclasses import replace

from strata.plans import hospital as H
from strata.plans import workflow as W
from strata.session import build_session


def _jdbc_props(args) -> dict[str, str]:
    props = {}
    user = args.jdbc_user or os.environ.get("JDBC_USER")
    password = args.jdbc_password or os.environ.get("JDBC_PASSWORD")
    if user:
        props["user"] = user
    if password:
        props["password"] = password
    if args.jdbc_driver:
        props["driver"] = args.jdbc_driver
    return props


def cmd_seed(spark, args) -> dict:
    from strata.sources.files import read_csv
    from strata.sources.jdbc import write_jdbc

    tables = args.tables or list(H.STAGING_SPECS)
    for t in tables:
        df = read_csv(spark, f"{args.csv_root.rstrip('/')}/{t}.csv")
        write_jdbc(df, args.jdbc_url, f"{args.schema}.{t}" if args.schema else t, _jdbc_props(args))
    return {"seeded": tables}


def cmd_extract(spark, args) -> dict:
    from strata.sources.jdbc import extract_to_parquet

    tables = args.tables or list(H.STAGING_SPECS)
    names = [f"{args.schema}.{t}" if args.schema else t for t in tables]
    # read by ranges of the key where it is one column, over several connections
    columns = {
        n: H.STAGING_SPECS[t].key[0]
        for t, n in zip(tables, names)
        if t in H.STAGING_SPECS and len(H.STAGING_SPECS[t].key) == 1 and args.connections > 1
    }
    return extract_to_parquet(
        spark, args.jdbc_url, names, args.raw_root, _jdbc_props(args), columns, args.connections
    )


def cmd_stage(spark, args) -> dict:
    tables = [args.table] if args.table else list(H.STAGING_SPECS)
    specs = dict(H.STAGING_SPECS)
    if args.keys:
        if not args.table:
            raise SystemExit("--keys needs --table")
        specs[args.table] = replace(specs[args.table], key=tuple(k.strip() for k in args.keys.split(",")))
    return W.run_staging(
        spark, args.namespace, args.root, raw_root=args.raw_root, tables=tables, buckets=args.buckets, specs=specs
    )


def cmd_curate(spark, args) -> dict:
    options = {"assume_unique_dims": args.assume_unique_dims}
    if args.dedupe_admissions:
        options["dedupe_admissions"] = args.dedupe_admissions
    return W.run_curation(
        spark, args.staged, args.curated, args.root, tables=[args.table] if args.table else None, **options
    )


def cmd_run(spark, args) -> dict:
    """Staging, curation and rules, each after all of the one before."""
    outcomes = W.run_all(
        spark, args.root, raw_root=args.raw_root, staged_namespace=args.staged, curated_namespace=args.curated,
        results_root=args.results_root, fail_on=args.fail_on, buckets=args.buckets,
    )
    return {"rules": outcomes.count(), "failed": outcomes.filter("outcome = 'Failed'").count()}


def cmd_quality(spark, args) -> dict:
    outcomes = W.run_quality(spark, args.curated, args.results_root, args.fail_on, args.as_of)
    rows = [r.asDict() for r in outcomes.collect()]  # one row per rule (83 for the shipped rulesets)
    return {"rules": len(rows), "failed": [f"{r['table']}: {r['rule']}" for r in rows if r["outcome"] == "Failed"]}


def cmd_sql(spark, args) -> dict:
    from strata.operators.sqlsurface import respond

    return respond(spark, args.query, limit=args.limit, result_root=args.result_root,
                   catalog_alias=args.catalog_alias, read_only=not args.allow_commands)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="strata-jobs")
    sub = p.add_subparsers(dest="command", required=True)

    def jdbc(sp):
        sp.add_argument("--jdbc-url", required=True)
        sp.add_argument("--jdbc-user")
        sp.add_argument("--jdbc-password")
        sp.add_argument("--jdbc-driver")
        sp.add_argument("--schema", default="")
        sp.add_argument("--tables", nargs="*")

    s = sub.add_parser("seed")
    s.add_argument("--csv-root", required=True)
    jdbc(s)
    s = sub.add_parser("extract")
    s.add_argument("--raw-root", required=True)
    s.add_argument("--connections", type=int, default=8)
    jdbc(s)
    s = sub.add_parser("stage")
    s.add_argument("--raw-root", required=True)
    s.add_argument("--namespace", default="staged")
    s.add_argument("--root", required=True, help="shared folder holding the table versions")
    s.add_argument("--table")
    s.add_argument("--keys", help="key columns, comma separated (default: the spec's)")
    s.add_argument("--buckets", type=int)
    s = sub.add_parser("curate")
    s.add_argument("--staged", default="staged")
    s.add_argument("--curated", default="curated")
    s.add_argument("--root", required=True)
    s.add_argument("--table", help="build this curated table only")
    s.add_argument("--assume-unique-dims", action="store_true")
    s.add_argument("--dedupe-admissions", choices=["latest"])
    s = sub.add_parser("run")
    s.add_argument("--raw-root", required=True)
    s.add_argument("--root", required=True)
    s.add_argument("--staged", default="staged")
    s.add_argument("--curated", default="curated")
    s.add_argument("--results-root")
    s.add_argument("--fail-on", default="never", choices=["never", "any"])
    s.add_argument("--buckets", type=int)
    s = sub.add_parser("quality")
    s.add_argument("--curated", default="curated")
    s.add_argument("--results-root")
    s.add_argument("--fail-on", default="never", choices=["never", "any"])
    s.add_argument("--as-of", help="date bound to current_date in the rules (default: today)")
    s = sub.add_parser("sql")
    s.add_argument("--query", required=True)
    s.add_argument("--catalog-alias")
    s.add_argument("--limit", type=int, default=10_000)
    s.add_argument("--result-root", help="also store the whole result as CSV under this folder")
    s.add_argument("--allow-commands", action="store_true")
    return p


COMMANDS = {"seed": cmd_seed, "extract": cmd_extract, "stage": cmd_stage, "curate": cmd_curate,
            "run": cmd_run, "quality": cmd_quality, "sql": cmd_sql}


def main(argv: list[str] | None = None, spark=None) -> dict:
    args = parser().parse_args(argv)
    spark = spark or build_session(app_name=f"strata-{args.command}")
    result = COMMANDS[args.command](spark, args)
    print(json.dumps(result, default=str))
    return result


if __name__ == "__main__":
    main(sys.argv[1:])
