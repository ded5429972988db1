"""Cases where earlier versions lost rows, raised or ran too much."""

import pytest

from strata.operators import quality as Q
from strata.operators.retrieval import kb_search, label_centroids
from strata.operators.sqlsurface import respond, sql_run, to_rows_json
from strata.operators.upsert import (
    ConflictError,
    DuplicateKeyError,
    check_source,
    latest_by,
    merged,
    table_location,
    upsert_table,
)
from strata.sources.catalog import discover
from strata.sources.sinks import overwrite_table

KV = "k int, v string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_null_keys_are_inserted(spark, scratch):
    spark.sql("CREATE NAMESPACE IF NOT EXISTS nullns")
    upsert_table(spark, spark.createDataFrame([(1, "a")], KV), "nullns.t", "k", scratch)
    batch = spark.createDataFrame([(None, "x"), (None, "y"), (1, "b")], KV)
    upsert_table(spark, batch, "nullns.t", "k", scratch)
    assert rows(spark.table("nullns.t")) == [(1, "b"), (None, "x"), (None, "y")]
    with pytest.raises(DuplicateKeyError):
        check_source(batch, ["k"], "match")
    with pytest.raises(ValueError):
        check_source(batch, ["k"], "reject")


def test_interleaved_upserts_keep_both(spark, scratch, monkeypatch):
    """A second writer swaps the table while the first one writes."""
    from strata.operators import upsert as U

    spark.sql("CREATE NAMESPACE IF NOT EXISTS racens")
    upsert_table(spark, spark.createDataFrame([(1, "a")], KV), "racens.t", "k", scratch)
    write, nested = U.write_version, []

    def slow(df, path, **kw):
        write(df, path, **kw)
        if not nested:
            nested.append(path)
            upsert_table(spark, spark.createDataFrame([(3, "c")], KV), "racens.t", "k", scratch)

    monkeypatch.setattr(U, "write_version", slow)
    upsert_table(spark, spark.createDataFrame([(2, "b")], KV), "racens.t", "k", scratch)
    assert rows(spark.table("racens.t")) == [(1, "a"), (2, "b"), (3, "c")]
    nested.clear()
    with pytest.raises(ConflictError):
        upsert_table(spark, spark.createDataFrame([(4, "d")], KV), "racens.t", "k", scratch, attempts=1)
    assert table_location(spark, "racens.t")


def test_last_version_of_a_key(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (1, "c", 2), (None, "x", 1), (None, "y", 1)], KV + ", at int")
    assert rows(latest_by(df, "k", "at")) == [(1, "b", 3), (None, "x", 1), (None, "y", 1)]
    target = spark.createDataFrame([(1, "z", 0)], KV + ", at int")
    assert rows(merged(target, latest_by(df, "k", "at"), "k"))[0] == (1, "b", 3)


def test_rules_do_not_run_commands(spark):
    spark.sql("CREATE NAMESPACE IF NOT EXISTS rulens")
    spark.createDataFrame([(1, "a")], KV).write.mode("overwrite").saveAsTable("rulens.t")
    bad = Q.load_rules('Rules = [ \n CustomSql "DROP TABLE rulens.t",\n CustomSql "SELECT nope FROM primary" ]', "t")
    out = Q.evaluate(spark.table("rulens.t"), bad).collect()
    assert [r["outcome"] for r in out] == ["Failed", "Failed"] and "not a query" in out[0]["reason"]
    assert spark.catalog.tableExists("rulens.t")


def test_rules_of_a_missing_table_fail_with_a_reason(spark):
    rules = {n: Q.load_rules("Rules = [ RowCount > 0 ]", n) for n in ("here", "gone")}
    out = Q.evaluate_all({"here": spark.range(3).toDF("a")}, rules).collect()
    assert [(r["table"], r["outcome"], r["reason"]) for r in out] == [
        ("here", "Passed", None),
        ("gone", "Failed", "table gone not found"),
    ]


@pytest.mark.parametrize("sql", ["SELECT 1 / 0 AS x", "SELECT CAST('a' AS INT) AS x", "SELECT element_at(array(1), 5)"])
def test_run_time_errors_are_answers(spark, sql, scratch):
    out = respond(spark, sql)
    assert out["status"] == 400 and out["details"] and out["suggestions"]
    assert respond(spark, sql, result_root=scratch)["status"] == 400


def test_repeated_column_names(spark):
    df = spark.sql("SELECT 1 AS a, 'x\"y' AS a, CAST(NULL AS INT) AS `b c`")
    assert to_rows_json(df).first()[0] == '{"a":1,"a":"x\\"y","b c":null}'
    assert respond(spark, "SELECT 1 AS a, 2 AS a")["rows"] == [{"a": 2}]


def test_namespace_and_truncation(spark):
    spark.sql("CREATE NAMESPACE IF NOT EXISTS plainns")
    spark.range(12).write.mode("overwrite").saveAsTable("plainns.only_here")
    before = spark.catalog.currentDatabase()
    assert sql_run(spark, "SELECT count(*) AS n FROM only_here", namespace="plainns").fetch() == [{"n": 12}]
    assert spark.catalog.currentDatabase() == before
    out = respond(spark, "SELECT * FROM plainns.only_here", limit=5)
    assert len(out["rows"]) == 5 and out["truncated"]
    assert not respond(spark, "SELECT * FROM plainns.only_here", limit=12)["truncated"]


def test_discovery_lists_folders_and_partitions(spark, scratch):
    spark.range(10).selectExpr("id", "id % 2 AS part").write.partitionBy("part").parquet(f"{scratch}/parted")
    spark.range(4).write.parquet(f"{scratch}/flat")
    found = discover(spark, "discns", scratch)
    assert sorted(found) == ["flat", "parted"]
    assert found["parted"].count() == 10 and found["flat"].count() == 4


def test_full_refresh_removes_old_partitions(spark):
    spark.sql("CREATE NAMESPACE IF NOT EXISTS refns")
    df = spark.range(6).selectExpr("id", "id % 3 AS part")
    df.write.mode("overwrite").partitionBy("part").saveAsTable("refns.t")
    overwrite_table(spark, spark.createDataFrame([(9, 1)], "id long, part long"), "refns.t")
    assert rows(spark.table("refns.t")) == [(9, 1)]
    with pytest.raises(ValueError):
        overwrite_table(spark, spark.range(1).toDF("id"), "refns.t")


def test_search_over_many_query_blocks(spark, monkeypatch):
    from strata.operators import retrieval as R

    docs = spark.createDataFrame([(i, f"red w{i} w{i % 4} blue") for i in range(40)] + [(99, None)], "doc_id int, text string")
    queries = spark.createDataFrame([(i, f"w{i} w{i % 4}") for i in range(12)] + [(50, "nothing here")], "qid int, text string")
    whole = rows(kb_search(queries, docs, k=3))
    monkeypatch.setattr(R, "QUERY_ROWS", 5)
    monkeypatch.setattr(R, "_CELLS", 7)
    assert rows(kb_search(queries, docs, k=3)) == whole
    assert [r for r in whole if r[0] == 50][0][1:4] == (None, None, None)


def test_centroids_need_one_dimension(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0, 3.0])], "label int, embedding array<double>")
    with pytest.raises(ValueError):
        label_centroids(df)


def test_filter_rules_are_counted_in_one_pass(spark):
    df = spark.createDataFrame([(1, -2.0), (2, None), (3, 5.0), (3, -1.0)], "k int, x double")
    text = """Rules = [
      RowCount > 0,
      CustomSql "SELECT x FROM primary WHERE x < 0",
      CustomSql "SELECT k, x FROM primary WHERE x > 100",
      CustomSql "SELECT nope FROM primary WHERE x < 0",
      CustomSql "SELECT k FROM primary GROUP BY k HAVING COUNT(*) > 1"
    ]"""
    out = {r["rule"]: r for r in Q.evaluate(df, Q.load_rules(text, "t")).collect()}
    got = [(r["outcome"], r["violations"]) for r in out.values()]
    assert sorted(got, key=repr) == sorted(
        [("Passed", None), ("Failed", 2), ("Passed", 0), ("Failed", None), ("Failed", 1)], key=repr
    )
    plan = Q.evaluate(df, Q.load_rules(text, "t"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") <= 3
    assert Q.filter_condition(df, "SELECT x FROM primary WHERE x < (SELECT max(k) FROM primary)") is None
