"""Top-k rows per group without gathering a whole group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(
    df: DataFrame,
    group: list[str],
    order: list[Column],
    k: int,
    rank_col: str = "rank",
    buckets: int = 64,
    bucket_key: str | None = None,
) -> DataFrame:
    """The ``k`` first rows of each group by ``order`` (a strict order: add a
    unique tie-breaker), numbered 1..k in ``rank_col``.

    Spark plans the ``row_number() <= k`` filter with a partial
    ``WindowGroupLimit`` before the shuffle, so each input partition already
    sends at most ``k`` rows per group. When the input is not spread over
    partitions (a huge group arriving in few partitions), ``bucket_key`` adds
    a first ranking inside ``(group, hash(bucket_key) % buckets)`` sub-groups,
    so the final ranking sees at most ``buckets * k`` rows per group.
    """
    if bucket_key is not None and buckets > 1:
        sub = Window.partitionBy(*group, F.pmod(F.xxhash64(bucket_key), F.lit(buckets))).orderBy(*order)
        df = df.withColumn("__sub_rank", F.row_number().over(sub)).filter(F.col("__sub_rank") <= k).drop(
            "__sub_rank"
        )
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)
