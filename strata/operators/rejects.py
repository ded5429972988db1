"""Raw values that a staging cast cannot take: counted, and kept aside.

Staging turns a value that does not fit its column's type into NULL and goes
on. Here such a value is a failure: the raw column holds something and the
staged one does not. ``cast_failures`` counts them per column in one aggregate
pass; ``quarantine`` writes the raw rows concerned, with the names of the
columns that failed, and takes the counts from metrics observed in that same
write. Both are one narrow scan of the raw rows, without a shuffle of rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from strata.operators.staging import StagingSpec, _q, _typed_sql

FAILED = "failed_columns"


def failing(df: DataFrame, spec: StagingSpec) -> dict[str, str]:
    """SQL condition per staged column: a raw value is there and is lost."""
    return {c.name: f"({_q(c.name)} IS NOT NULL AND ({_typed_sql(df, c)}) IS NULL)" for c in spec.columns if c.name in df.columns}


def cast_failures(df: DataFrame, spec: StagingSpec) -> DataFrame:
    """(table, column, rows, failures), a row per staged column."""
    lost = failing(df, spec)
    counts = [F.expr(f"count_if({cond})").alias(f"__f{i}") for i, cond in enumerate(lost.values())]
    one = df.agg(F.count(F.lit(1)).alias("__rows"), *counts)
    rows = [
        F.struct(F.lit(spec.table).alias("table"), F.lit(name).alias("column"), F.col("__rows").alias("rows"), F.col(f"__f{i}").alias("failures"))
        for i, name in enumerate(lost)
    ]
    return one.select(F.inline(F.array(*rows)))


def rejected_rows(df: DataFrame, spec: StagingSpec) -> DataFrame:
    """The raw rows with a failure, and which columns failed."""
    lost = failing(df, spec)
    names = F.array_compact(F.array(*[F.expr(f"IF({cond}, '{name}', NULL)") for name, cond in lost.items()]))
    return df.withColumn(FAILED, names).filter(F.size(FAILED) > 0)


def quarantine(df: DataFrame, spec: StagingSpec, path: str) -> dict[str, int]:
    """Write the rejected rows of ``df`` under ``path`` (Parquet, overwritten)
    and return the number of failures per column and of all rows
    (``"rows"``), observed while writing."""
    seen = Observation(f"rejects-{uuid.uuid4().hex}")
    lost = failing(df, spec)
    counts = [F.expr(f"count_if({cond})").alias(name) for name, cond in lost.items()]
    counted = df.observe(seen, F.count(F.lit(1)).alias("__rows"), *counts)
    rejected_rows(counted, spec).write.mode("overwrite").parquet(path)
    got = seen.get
    return {"rows": got["__rows"]} | {name: got[name] for name in lost}
