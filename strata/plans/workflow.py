"""Raw -> staged -> curated -> quality, with a barrier between layers.

The seven staging loads are independent Spark jobs submitted from a thread
pool (each in its own scheduler pool, so FAIR scheduling can share the
cluster); the curated builds start only when every load succeeded, and the
rules run after all curated tables are written. Failed rules are reported,
never raised, unless ``fail_on='any'``. With a run id, finished steps are
entered in a ledger: a run started again under the same id does only what is
left, and no layer is built on an unfinished one.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from strata.operators import quality as Q
from strata.operators.rejects import quarantine
from strata.operators.staging import stage
from strata.operators.upsert import replace_table, upsert_table
from strata.plans import hospital as H
from strata.plans.ledger import Ledger
from strata.sources import catalog as C
from strata.sources.files import read_parquet_dir
from strata.sources.sinks import publish_outcomes


def _in_pool(spark: SparkSession, pool: str, fn: Callable, *args):
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", pool)
    try:
        return fn(*args)
    finally:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)


def parallel(spark: SparkSession, jobs: dict[str, Callable[[], object]], workers: int) -> dict[str, object]:
    with ThreadPoolExecutor(max_workers=max(1, min(workers, len(jobs)))) as pool:  # others end even if one fails
        futures = {name: pool.submit(_in_pool, spark, name, fn) for name, fn in jobs.items()}
        return {name: f.result() for name, f in futures.items()}  # re-raises the first failure


def stage_table(
    spark: SparkSession,
    table: str,
    raw: DataFrame,
    namespace: str,
    root: str,
    specs: dict = H.STAGING_SPECS,
    buckets: int | None = None,
) -> str:
    """Stage one raw frame and upsert it into ``namespace.table``; ``buckets``
    (or the spec's) hash-buckets the staged table by its key."""
    if table not in specs:
        raise ValueError(f"no staging spec for {table!r}; known: {sorted(specs)}")
    spec = specs[table]
    staged = stage(raw, spec)
    path = upsert_table(
        spark,
        staged,
        f"{namespace}.{table}",
        spec.key,
        f"{root.rstrip('/')}/{namespace}/{table}",
        buckets=buckets or spec.buckets,
    )
    if spec.description or spec.column_comments:
        C.comment_table(spark, f"{namespace}.{table}", f"{spec.description} Key: {spec.key_csv}.".strip(),
                        spec.column_comments)
    return path


def run_staging(
    spark: SparkSession,
    namespace: str,
    root: str,
    raw: dict[str, DataFrame] | None = None,
    raw_root: str | None = None,
    tables: list[str] | None = None,
    workers: int = 7,
    buckets: int | None = None,
    specs: dict = H.STAGING_SPECS,
    ledger: Ledger | None = None,
    rejects_root: str | None = None,
) -> dict[str, str]:
    """All staging loads in parallel; raw frames given or read from
    ``raw_root/<table>/``. With ``rejects_root`` the raw rows whose values do
    not fit are kept in ``rejects_root/<table>`` as well."""
    C.create_namespace(spark, namespace)
    names = tables or list(H.STAGING_SPECS)
    frames = raw if raw is not None else {t: read_parquet_dir(spark, raw_root, t) for t in names}

    def load(t: str) -> str:
        if rejects_root:
            quarantine(frames[t], specs[t], f"{rejects_root.rstrip('/')}/{t}")
        return stage_table(spark, t, frames[t], namespace, root, specs, buckets)

    return _run(spark, {t: (lambda t=t: load(t)) for t in names}, workers, ledger, "staged")


def _run(spark: SparkSession, jobs: dict, workers: int, ledger: Ledger | None, layer: str) -> dict[str, str]:
    done, left = ledger.jobs(layer, jobs) if ledger else ({}, jobs)
    return done | (parallel(spark, left, workers) if left else {})


def read_staged(spark: SparkSession, namespace: str) -> dict[str, DataFrame]:
    return {t: spark.table(f"{namespace}.{t}") for t in H.STAGING_SPECS}


def write_curated_table(spark: SparkSession, name: str, df: DataFrame, namespace: str, root: str) -> str:
    """Full refresh of one curated table, by position, as a new version that
    replaces the old one only once written (a lost job leaves the previous
    version in place)."""
    table = f"{namespace}.{name}"
    replace_table(spark, df, table, f"{root.rstrip('/')}/{namespace}/{name}", H.CURATED_DESCRIPTIONS.get(name))
    return table


def run_curation(
    spark: SparkSession,
    staged_namespace: str,
    curated_namespace: str,
    root: str,
    workers: int = 4,
    tables: list[str] | None = None,
    ledger: Ledger | None = None,
    **options,
) -> dict[str, str]:
    """All curated tables, or those named; an unknown name is refused."""
    unknown = sorted(set(tables or ()) - set(H.CURATED_TABLES))
    if unknown:
        raise ValueError(f"no curated table {unknown}; known: {sorted(H.CURATED_TABLES)}")
    if ledger:
        ledger.require("staged", H.STAGING_SPECS)
    C.create_namespace(spark, curated_namespace)
    curated = H.curate(read_staged(spark, staged_namespace), **options)
    jobs = {
        name: (lambda name=name: write_curated_table(spark, name, curated[name], curated_namespace, root))
        for name in curated
        if tables is None or name in tables
    }
    return _run(spark, jobs, workers, ledger, "curated")


def run_quality(
    spark: SparkSession,
    curated_namespace: str,
    results_root: str | None = None,
    fail_on: str = "never",
    as_of=None,
) -> DataFrame:
    """Outcomes of all rules, evaluated once: they are collected (one row a
    rule) and what is published, asserted and returned are these rows. Rules
    on a table that does not exist fail with that reason."""
    there = [t for t in H.CURATED_TABLES if spark.catalog.tableExists(f"{curated_namespace}.{t}")]
    if not there:
        raise ValueError(f"no curated table in {curated_namespace}")
    tables = {t: spark.table(f"{curated_namespace}.{t}") for t in there}
    rows = Q.evaluate_all(tables, H.rulesets(), H.CONTEXT_PREFIX, as_of).collect()
    outcomes = spark.createDataFrame(rows, Q.OUTCOME_SCHEMA)
    if results_root:
        publish_outcomes(outcomes, results_root)
    Q.assert_passed(outcomes, fail_on)
    return outcomes


def run_all(
    spark: SparkSession,
    root: str,
    raw: dict[str, DataFrame] | None = None,
    raw_root: str | None = None,
    staged_namespace: str = "staged",
    curated_namespace: str = "curated",
    results_root: str | None = None,
    fail_on: str = "never",
    buckets: int | None = None,
    run_id: str | None = None,
    rejects_root: str | None = None,
) -> DataFrame:
    ledger = Ledger(spark, root, run_id) if run_id else None
    run_staging(
        spark, staged_namespace, root, raw=raw, raw_root=raw_root, buckets=buckets, ledger=ledger, rejects_root=rejects_root
    )
    run_curation(spark, staged_namespace, curated_namespace, root, ledger=ledger)
    return run_quality(spark, curated_namespace, results_root, fail_on)
