"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E
from strata.plans import registry
from strata.plans.standins import TABLES
from tests.conftest import SF_SMALL


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v  # exact: both sides round where engines differ
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) - set(registry.ORACLE) == set()


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(E.oracle_sql()[name])
    want = canon([d[0] for d in res.description], res.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["hospital", "cidade", "total_custos"]
    assert df.count() >= 0


@pytest.mark.parametrize("name", ["parse_date_modes", "stg_internacoes", "events_by_month"])
def test_results_do_not_depend_on_session_time_zone(spark, duck, name):
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")  # has a DST gap at midnight
    df = E.queries()[name](other, SF_SMALL)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(E.oracle_sql()[name])
    assert got == canon([d[0] for d in res.description], res.fetchall())
