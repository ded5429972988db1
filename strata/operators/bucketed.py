"""Keyed upsert that rewrites only the buckets a batch touches.

A table is a Parquet table partitioned by ``__bucket``, a hash of its key. A
batch is written once, its buckets are listed (at most as many as the table
has), the rows of those buckets alone are read and merged, and Spark's dynamic
partition overwrite replaces those partitions; other files are neither read
nor written. So the cost of a batch follows the buckets it touches, not the
table.

Replacing several partitions is not one atomic step. The merged rows are
therefore written beside the table first (``<root>__pending``) and named in a
table property until the overwrite has ended; a writer that finds the property
completes that overwrite before its own, so a job that died half way leaves
nothing lost and nothing twice. A table has one writer at a time (a scheduler's
job or one stream), as the versioned ``upsert_table`` is the form for several.
Nothing older than the last batch stays behind, so storage follows the table.

NULL keys never match (``insert``): their rows are spread over the buckets by
all their columns, so many of them crowd no bucket. With ``match`` they are a
key like any other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.upsert import _aligned, check_source, latest_by, merged, parse_keys, table_exists, table_location
from strata.sources.catalog import quote

BUCKET = "__bucket"
BUCKETS = 64
_PENDING, _KEYS, _COUNT, _NULLS = (f"strata.upsert.{x}" for x in ("pending", "keys", "buckets", "null_keys"))


def bucket_of(columns: list[str], keys: list[str], buckets: int, null_keys: str) -> Column:
    by_key = F.xxhash64(*[F.col(f"`{k}`") for k in keys])
    if null_keys != "match":
        unknown = reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in keys])
        by_key = F.when(unknown, F.xxhash64(*[F.col(f"`{c}`") for c in columns])).otherwise(by_key)
    return F.pmod(by_key, F.lit(buckets)).cast("int")


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {quote(table)}").collect()}


def _set(spark: SparkSession, table: str, **properties: str) -> None:
    pairs = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
    spark.sql(f"ALTER TABLE {quote(table)} SET TBLPROPERTIES ({pairs})")


def read_bucketed(spark: SparkSession, table: str) -> DataFrame:
    """The table's rows without the bucket column."""
    return spark.table(table).drop(BUCKET)


def _overwrite(spark: SparkSession, table: str, path: str) -> None:
    """Replace the partitions that the rows at ``path`` lie in; may be repeated."""
    rows = spark.read.schema(spark.table(table).schema).parquet(path)
    even = rows.hint("rebalance", BUCKET)  # a large bucket is split over tasks
    even.select(*spark.table(table).columns).write.option("partitionOverwriteMode", "dynamic").insertInto(table, overwrite=True)


def complete_pending(spark: SparkSession, table: str) -> bool:
    """Finish the overwrite that a former writer began, if there is one."""
    pending = _properties(spark, table).get(_PENDING)
    if not pending:
        return False
    _overwrite(spark, table, pending)
    spark.sql(f"ALTER TABLE {quote(table)} UNSET TBLPROPERTIES ('{_PENDING}')")
    return True


def upsert_buckets(
    spark: SparkSession,
    source: DataFrame,
    table: str,
    keys: str | list[str],
    root: str,
    buckets: int = BUCKETS,
    null_keys: str = "insert",
    check: bool = True,
    order_by: str | list[str] | None = None,
) -> list[int]:
    """Upsert ``source`` into ``table`` (created under ``root`` when absent,
    with every row of the first load). Returns the buckets rewritten.

    Keys, ``buckets`` and ``null_keys`` are fixed with the table. Repeated keys
    of a later source are refused, or the last by ``order_by`` is kept.
    """
    keys = parse_keys(keys)
    if null_keys not in ("insert", "match", "reject"):
        raise ValueError("null_keys must be 'insert', 'match' or 'reject'")
    root = root.rstrip("/")
    exists = table_exists(spark, table)
    if order_by:
        source = latest_by(source, keys, order_by)
    elif check and (exists or null_keys == "reject"):
        check_source(source, keys, null_keys)
    if not exists:
        placed = source.withColumn(BUCKET, bucket_of(source.columns, keys, buckets, null_keys))
        writer = placed.hint("rebalance", BUCKET).write.partitionBy(BUCKET).option("compression", "zstd")
        writer.option("path", root).saveAsTable(table)
        _set(spark, table, **{_KEYS: ",".join(keys), _COUNT: str(buckets), _NULLS: null_keys})
        return sorted(r[0] for r in spark.table(table).select(BUCKET).distinct().collect())
    told = _properties(spark, table)
    if _COUNT not in told:
        raise ValueError(f"{table} at {table_location(spark, table)} is not kept in buckets")
    if (told[_KEYS], told[_NULLS]) != (",".join(keys), null_keys):
        raise ValueError(f"{table} is kept by {told[_KEYS]} with NULL keys '{told[_NULLS]}'")
    buckets = int(told[_COUNT])
    complete_pending(spark, table)
    plain = read_bucketed(spark, table)
    batch = _aligned(source, plain)
    batch = batch.withColumn(BUCKET, bucket_of(batch.columns, keys, buckets, null_keys))
    batch.write.mode("overwrite").parquet(f"{root}__pending/batch")  # a source is computed once
    batch = spark.read.schema(spark.table(table).schema).parquet(f"{root}__pending/batch")
    touched = sorted(r[0] for r in batch.select(BUCKET).distinct().collect())
    if not touched:
        return []
    held = spark.table(table).filter(F.col(BUCKET).isin(touched))  # other partitions are not read
    rows = merged(held, batch, keys, null_keys)
    rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{root}__pending/rows")
    _set(spark, table, **{_PENDING: f"{root}__pending/rows"})
    complete_pending(spark, table)
    return touched
