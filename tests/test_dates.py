import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from strata.functions.dates import as_of_date, month_bucket, parse_date

D = dt.date
# (input, cast mode, legacy mode)
CASES = [
    ("2024-01-05", D(2024, 1, 5), D(2024, 1, 5)),
    ("2024-1-5", D(2024, 1, 5), D(2024, 1, 5)),
    ("2024-01-05 10:00:00", D(2024, 1, 5), D(2024, 1, 5)),
    ("2024-01-05junk", None, D(2024, 1, 5)),
    ("24-1-5", None, D(24, 1, 5)),
    ("2024", D(2024, 1, 1), None),
    ("2024-02-30", None, None),
    ("2024-13-40", None, None),
    ("junk", None, None),
    ("", None, None),
    (None, None, None),
    (" 2024-01-05", D(2024, 1, 5), D(2024, 1, 5)),
    ("2023-02-29", None, None),
    ("2024-02-29", D(2024, 2, 29), D(2024, 2, 29)),
]


def test_parse_date_modes(spark):
    df = spark.createDataFrame([(c[0],) for c in CASES], "s string")
    rows = df.select(
        "s",
        parse_date("s", "cast", StringType()).alias("c"),
        parse_date("s", "legacy", StringType()).alias("l"),
    ).collect()
    got = {r.s: (r.c, r.l) for r in rows}
    for s, c, l in CASES:
        assert got[s] == (c, l), s


def test_legacy_matches_spark_legacy_parser(spark):
    """The expression form equals Spark's own LEGACY parser on every case."""
    spark.conf.set("spark.sql.legacy.timeParserPolicy", "LEGACY")
    try:
        df = spark.createDataFrame([(c[0],) for c in CASES if c[0] is not None], "s string")
        bad = df.filter(
            ~F.expr("try_to_date(s, 'yyyy-MM-dd')").eqNullSafe(parse_date("s", "legacy", StringType()))
        ).collect()
        assert bad == []
    finally:
        spark.conf.unset("spark.sql.legacy.timeParserPolicy")


def test_date_inputs_pass_through(spark):
    df = spark.createDataFrame([(D(2024, 1, 5), dt.datetime(2024, 1, 5, 23, 0))], "d date, t timestamp")
    r = df.select(
        parse_date("d", "legacy", df.schema["d"].dataType).alias("a"),
        parse_date("t", "cast", df.schema["t"].dataType).alias("b"),
        month_bucket("d").alias("m"),
        as_of_date("2024-01-06").alias("asof"),
    ).first()
    assert (r.a, r.b, r.m, r.asof) == (D(2024, 1, 5), D(2024, 1, 5), "2024-01", D(2024, 1, 6))


def test_unknown_mode(spark):
    import pytest

    with pytest.raises(ValueError):
        parse_date("x", "strict")
