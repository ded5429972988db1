"""Keyed upsert (MERGE) without a row-level table format.

``merged(target, source, keys)`` is the MERGE result as a plan:
source rows replace target rows with the same key (all columns updated),
new source keys are inserted, other target rows are kept:

    source  UNION ALL  (target LEFT ANTI JOIN source ON keys)

Both sides are shuffled once on the key columns (or not at all for a side
already partitioned on them); AQE splits a skewed key partition of the
preserved target side. NULL keys follow SQL equality by default (a NULL key
never matches, so such rows are inserted again on every run);
``null_keys='match'`` uses null-safe equality and ``'reject'`` refuses them.

``upsert_table`` writes the merged rows as a new version directory of a
Parquet table and then points the table at it, so a reader never sees a half
written table and the version being read is never overwritten.
"""

from __future__ import annotations

import re
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_REPORTED_KEYS = 20


class DuplicateKeyError(ValueError):
    pass


class ConflictError(RuntimeError):
    """Another writer swapped the table while this one was writing."""


def parse_keys(keys: str | list[str] | tuple[str, ...]) -> list[str]:
    """Accept ``"k1,k2"`` as well as a list."""
    if isinstance(keys, str):
        keys = keys.split(",")
    out = [k.strip() for k in keys if k.strip()]
    if not out:
        raise ValueError("at least one key column is needed")
    return out


def _has_null(keys: list[str]):
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def duplicate_keys(
    source: DataFrame, keys: list[str], limit: int = MAX_REPORTED_KEYS, null_keys: str = "insert"
) -> list[tuple]:
    """Up to ``limit`` keys occurring more than once (a bounded collect). A
    NULL key equals another only if NULL keys are to match."""
    rows = source if null_keys == "match" else source.filter(~_has_null(keys))
    dup = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > 1)
    return [tuple(r[k] for k in keys) for r in dup.limit(limit).collect()]


def check_source(source: DataFrame, keys: list[str], null_keys: str = "insert") -> None:
    """Raise when the source could make the MERGE ambiguous."""
    dups = duplicate_keys(source, keys, null_keys=null_keys)
    if dups:
        raise DuplicateKeyError(f"source has duplicate keys {keys}: {dups}")
    if null_keys == "reject":
        if source.filter(_has_null(keys)).limit(1).count():
            raise ValueError(f"source has NULL values in key columns {keys}")


def latest_by(source: DataFrame, keys: str | list[str], order: str | list[str]) -> DataFrame:
    """One row per key: the one that comes last by ``order`` (NULLs first,
    equal ones by all columns). Rows with a NULL in the key are all kept.
    The grouped maximum combines map-side, so a hot key is one row a task."""
    keys = parse_keys(keys)
    last = [F.col(c) for c in parse_keys(order)]
    whole = F.struct(*[F.col(f"`{c}`") for c in source.columns])
    known = source.filter(~_has_null(keys)).groupBy(*keys).agg(F.max(F.struct(*last, whole.alias("__row"))).alias("__m"))
    return known.select("__m.__row.*").select(*source.columns).unionByName(source.filter(_has_null(keys)))


def _aligned(source: DataFrame, target: DataFrame) -> DataFrame:
    missing = [c for c in target.columns if c not in source.columns]
    extra = [c for c in source.columns if c not in target.columns]
    if missing or extra:
        raise ValueError(f"source and target columns differ: missing {missing}, extra {extra}")
    types = dict(target.dtypes)
    return source.select(*[F.col(c).cast(types[c]).alias(c) for c in target.columns])


def merged(
    target: DataFrame,
    source: DataFrame,
    keys: str | list[str],
    null_keys: str = "insert",
) -> DataFrame:
    """MERGE result of ``source`` into ``target`` (lazy, no checks)."""
    keys = parse_keys(keys)
    if null_keys not in ("insert", "match", "reject"):
        raise ValueError("null_keys must be 'insert', 'match' or 'reject'")
    src = _aligned(source, target)
    if null_keys == "match":
        t, s = target.alias("t"), src.select(*keys).alias("s")
        cond = reduce(lambda a, b: a & b, [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys])
        kept = t.join(s, cond, "left_anti")
    else:
        kept = target.join(src.select(*keys), keys, "left_anti")
    return src.unionByName(kept.select(*target.columns))


# ------------------------------------------------------------- tables ---
_VERSION = re.compile(r"/v(\d{6})-[0-9a-f]{8}/?$")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def table_location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").collect()
    if not rows:
        raise ValueError(f"{name} has no location")
    return rows[0]["data_type"]


def _next_version(root: str, current: str | None) -> str:
    n = 0
    if current:
        m = _VERSION.search(current)
        n = int(m.group(1)) + 1 if m else 1
    return f"{root.rstrip('/')}/v{n:06d}-{uuid.uuid4().hex[:8]}"


def write_version(df: DataFrame, path: str, compression: str = "zstd") -> None:
    df.write.mode("errorifexists").option("compression", compression).parquet(path)


def _write_bucketed(spark: SparkSession, df: DataFrame, table: str, path: str, keys: list[str], buckets: int) -> None:
    """Write ``df`` at ``path`` hash-bucketed and sorted by ``keys``; the files
    carry bucket ids, so a table declared with the same bucket spec reads
    them already partitioned by key."""
    (
        df.write.mode("errorifexists")
        .option("path", path)
        .option("compression", "zstd")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .saveAsTable(table)
    )


def _swap(spark: SparkSession, table: str, read_from: str, path: str) -> None:
    """Point ``table`` at ``path``, unless it no longer lies where the new
    version was derived from."""
    now = table_location(spark, table)
    if now.rstrip("/") != read_from.rstrip("/"):
        raise ConflictError(f"{table} moved from {read_from} to {now} while {path} was written")
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.sql(f"REFRESH TABLE {table}")


def row_level(spark: SparkSession, table: str) -> bool:
    """True when the table's format has row-level MERGE of its own."""
    info = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Provider'").collect()
    return bool(info) and info[0]["data_type"].lower() in ("iceberg", "delta", "hudi", "paimon")


def merge_into(spark: SparkSession, source: DataFrame, table: str, keys: list[str], null_keys: str) -> None:
    """The catalog's own MERGE: only touched files are rewritten, and the
    table format resolves concurrent writers."""
    rows = _aligned(source, spark.table(table)).alias("s")
    cond = [(F.col(f"{table}.{k}"), F.col(f"s.{k}")) for k in keys]
    cond = [a.eqNullSafe(b) if null_keys == "match" else a == b for a, b in cond]
    merge = rows.mergeInto(table, reduce(lambda a, b: a & b, cond))
    merge.whenMatched().updateAll().whenNotMatched().insertAll().merge()


def upsert_table(
    spark: SparkSession,
    source: DataFrame,
    table: str,
    keys: str | list[str],
    root: str,
    null_keys: str = "insert",
    check: bool = True,
    buckets: int | None = None,
    order_by: str | list[str] | None = None,
    attempts: int = 3,
) -> str:
    """Upsert ``source`` into catalog table ``table`` (created when absent).

    ``root`` is the table's folder in shared storage; every run writes
    ``root/vNNNNNN-xxxxxxxx`` and swaps the table to it. Returns the new
    location.

    With ``buckets`` the table is hash-bucketed and sorted by the key: the
    merge then reads the target already partitioned by key and shuffles only
    the source into the same buckets, and later joins on the key (for
    example the fact derivation's join on the consultation id) skip the
    table's shuffle too. ``buckets`` is fixed when the table is created.

    A writer that finds the table moved meanwhile derives its version again
    from the new one, ``attempts`` times, then raises ``ConflictError``; the
    check and the swap are two catalog calls, so writers in different drivers
    should still be ordered by their scheduler. The first load inserts every
    row, repeated keys too, as a MERGE into an empty table does; later ones
    refuse a source with repeated keys. ``order_by`` keeps the last
    row of each key of the source instead of refusing repeated keys. Tables
    of a row-level format are merged by their catalog.
    """
    from strata.sources.catalog import create_table_at

    keys = parse_keys(keys)
    exists = table_exists(spark, table)
    if order_by:
        source = latest_by(source, keys, order_by)
    elif check and (exists or null_keys == "reject"):
        check_source(source, keys, null_keys)
    if not exists:
        path = _next_version(root, None)
        if buckets:
            _write_bucketed(spark, source, table, path, keys, buckets)
        else:
            write_version(source, path)
            create_table_at(spark, table, source.schema, path)
        return path
    if row_level(spark, table):
        merge_into(spark, source, table, keys, null_keys)
        return table_location(spark, table)
    for attempt in range(attempts):
        current = table_location(spark, table)
        # read by path: the version this writer saw, whatever the table points at later
        target = spark.read.schema(spark.table(table).schema).parquet(current)
        spec = bucket_spec(spark, table)
        if spec:
            target = spark.table(table)
        path = _next_version(root, current)
        rows = merged(target, source, keys, null_keys)
        if spec:
            scratch = f"{table}__{path.rsplit('/', 1)[-1].replace('-', '_')}"
            _write_bucketed(spark, rows, scratch, path, spec[1], spec[0])
            spark.sql(f"DROP TABLE {scratch}")  # external: drops the name, keeps the files
        else:
            write_version(rows, path)
        try:
            _swap(spark, table, current, path)
            return path
        except ConflictError:
            if attempt + 1 == attempts:
                raise
            spark.sql(f"REFRESH TABLE {table}")
    raise ValueError("attempts must be 1 or more")


def bucket_spec(spark: SparkSession, table: str) -> tuple[int, list[str]] | None:
    """(bucket count, bucket columns) of a catalog table, or None."""
    info = {
        r["col_name"]: r["data_type"]
        for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
        if r["col_name"] in ("Num Buckets", "Bucket Columns")
    }
    if "Num Buckets" not in info:
        return None
    cols = [c.strip().strip("`") for c in info["Bucket Columns"].strip("[]").split(",")]
    return int(info["Num Buckets"]), cols


def replace_table(spark: SparkSession, df: DataFrame, table: str, root: str, comment: str | None = None) -> str:
    """Full refresh that survives a failed job: ``df`` is written as a new
    version folder under ``root`` and the table is then pointed at it (the
    old version stays readable until the swap). Columns are matched by
    position, as ``INSERT OVERWRITE t SELECT *`` does; a different column
    count raises."""
    from strata.sources.catalog import comment_table, create_table_at

    if not table_exists(spark, table):
        path = _next_version(root, None)
        write_version(df, path)
        create_table_at(spark, table, df.schema, path)
        if comment:
            comment_table(spark, table, comment)
        return path
    target = spark.table(table)
    if len(target.columns) != len(df.columns):
        raise ValueError(f"{table} has {len(target.columns)} columns, the new rows {len(df.columns)}")
    aligned = df.select(
        *[F.col(f"`{src}`").cast(t).alias(name) for src, (name, t) in zip(df.columns, target.dtypes)]
    )
    current = table_location(spark, table)
    path = _next_version(root, current)
    write_version(aligned, path)
    _swap(spark, table, current, path)
    return path
