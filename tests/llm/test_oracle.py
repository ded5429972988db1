"""Queries with SQL against DuckDB; all queries on empty tables."""

import duckdb
import pytest

from strata.llm import registry
from tests.conftest import SF_SMALL
from tests.llm.conftest import tricky_rows


def same(spark, con, name, folder):
    df = registry.QUERIES[name](spark, folder)
    res = con.execute(registry.ORACLE[name])
    columns = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(columns)
    got = sorted(map(repr, (tuple(r[c] for c in columns) for r in df.collect())))
    assert got == sorted(map(repr, res.fetchall()))


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_given_tables(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    same(spark, con, name, SF_SMALL)


def test_rules_on_tricky_rows(spark, folder):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", tricky_rows())
    same(spark, con, "op3_quality_rules", folder)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_empty_tables(spark, empty_folder, name):
    rows = registry.QUERIES[name](spark, empty_folder).collect()
    assert len(rows) == (1 if name.startswith("op4") else 0)


def test_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 14))
