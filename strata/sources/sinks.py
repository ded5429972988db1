"""Sinks: table overwrite, query result files and rule outcome publishing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def overwrite_table(spark: SparkSession, df: DataFrame, table: str) -> None:
    """In-place full refresh of an existing table, columns matched by
    position (``INSERT OVERWRITE t SELECT * FROM df``). Spark refuses when
    ``df`` reads the table being overwritten, and on arity or unsafe casts.
    The old files are removed before the write; where a failed job must
    leave the old rows readable use ``strata.operators.upsert.replace_table``
    (what the curated build does)."""
    target = spark.table(table)
    if len(target.columns) != len(df.columns):
        raise ValueError(f"{table} has {len(target.columns)} columns, the new rows {len(df.columns)}")
    # a full refresh whatever the session's mode: partitions without new rows go too
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "static")
    try:
        df.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(mode, before)


def write_result_files(df: DataFrame, root: str, run_id: str, fmt: str = "csv") -> str:
    """Store a query result under ``root/run_id`` (header CSV by default)."""
    path = f"{root.rstrip('/')}/{run_id}"
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)
    return path


def publish_outcomes(outcomes: DataFrame, root: str) -> None:
    """Append rule outcomes as JSON, one folder per evaluation context."""
    outcomes.write.mode("append").partitionBy("context").json(root)


def write_quarantine(bad: DataFrame, root: str, run_id: str) -> int:
    """Keep the lines that did not parse (``files.read_checked``) under
    ``root/run_id``, for a person to look at, and return how many they are.
    A repeated run replaces its own folder."""
    path = f"{root.rstrip('/')}/{run_id}"
    bad.write.mode("overwrite").parquet(path)
    return bad.sparkSession.read.schema(bad.schema).parquet(path).count()
