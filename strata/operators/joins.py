"""Left joins whose right side repeats keys, without gathering a hot key.

``left_join_counted`` joins on ``on`` and brings ``value``: the right side is
first reduced to (key, value, number of rows) by an aggregate that combines
map-side, so a patient with a million admissions to one hospital is one row.
The join is a plain left join, whose preserved side adaptive execution can
split, and every result row is then repeated by its count. The result equals
the plain left join as a bag.

``times_in`` is the same for a right side that adds no column: only keys that
occur more than once there change anything, and there are none in a sound
dimension. That list is counted before the join is planned: up to
``broadcast_rows`` keys (two numbers each) it is broadcast, and the left side
is not shuffled at all; beyond, it is an ordinary shuffled join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000
_N = "__times"


def repeated(df: DataFrame, times: str = _N) -> DataFrame:
    """Every row as often as ``times`` says (NULL: once), without that column."""
    n = F.coalesce(F.col(times), F.lit(1)).cast("int")
    one_more = F.explode(F.sequence(F.lit(1), n)).alias("__i")
    return df.select(*[c for c in df.columns if c != times], one_more).drop("__i")


def left_join_counted(left: DataFrame, right: DataFrame, on: str, value: str) -> DataFrame:
    """``left`` left-joined to ``right`` on ``on``; of ``right`` only ``value``
    is kept. NULL keys match nothing."""
    counted = right.filter(F.col(on).isNotNull()).groupBy(on, value).agg(F.count(F.lit(1)).alias(_N))
    return repeated(left.join(counted, on, "left"))


def times_in(left: DataFrame, right: DataFrame, on: str, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``left`` left-joined to ``right`` on ``on``, keeping only the columns of
    ``left``: rows whose key occurs n > 1 times in ``right`` appear n times."""
    many = right.filter(F.col(on).isNotNull()).groupBy(on).agg(F.count(F.lit(1)).alias(_N)).filter(F.col(_N) > 1)
    found = many.limit(broadcast_rows + 1).count() if broadcast_rows else None
    if found == 0:
        return left
    if found is not None and found <= broadcast_rows:
        many = F.broadcast(many)
    return repeated(left.join(many, on, "left")).select(*left.columns)
