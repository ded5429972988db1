import datetime as dt

import pytest

from strata.operators.sqlsurface import QueryError, replace_catalog_alias, respond, sql_run


@pytest.fixture(scope="module")
def layer(spark):
    spark.sql("CREATE NAMESPACE IF NOT EXISTS sqlns")
    df = spark.createDataFrame(
        [(1, "a", dt.date(2024, 1, 5), 1.5), (2, None, None, None)], "id int, name string, d date, x double"
    )
    df.write.mode("overwrite").saveAsTable("sqlns.t")
    return "sqlns"


def test_valid_select_rows_json(spark, layer):
    res = sql_run(spark, "SELECT * FROM sqlns.t ORDER BY id;")
    rows = res.fetch()
    assert rows == [{"id": 1, "name": "a", "d": "2024-01-05", "x": 1.5},
                    {"id": 2, "name": None, "d": None, "x": None}]
    assert res.columns == ["id", "name", "d", "x"]


def test_zero_rows_and_cte(spark, layer):
    assert sql_run(spark, "SELECT * FROM sqlns.t WHERE id > 5").fetch() == []
    assert sql_run(spark, "WITH a AS (SELECT id FROM sqlns.t) SELECT count(*) AS n FROM a").fetch() == [{"n": 2}]


def test_errors(spark, layer):
    with pytest.raises(QueryError) as e:
        sql_run(spark, "SELECT * FROM sqlns.nope")
    assert e.value.kind == "query" and e.value.status == 400 and e.value.suggestions
    with pytest.raises(QueryError) as e:
        sql_run(spark, "SELEC * FRM x")
    assert e.value.kind == "query"
    with pytest.raises(QueryError) as e:
        sql_run(spark, "SELECT 1", namespace="does_not_exist")
    assert e.value.kind == "catalog" and e.value.status == 500


@pytest.mark.parametrize("stmt", [
    "DROP TABLE sqlns.t",
    "CREATE TABLE sqlns.u (a int) USING parquet",
    "INSERT INTO sqlns.t VALUES (3, 'c', NULL, NULL)",
    "SET spark.sql.shuffle.partitions = 3",
])
def test_non_queries_refused_and_not_run(spark, layer, stmt):
    with pytest.raises(QueryError) as e:
        sql_run(spark, stmt)
    assert e.value.kind == "refused"
    assert spark.table("sqlns.t").count() == 2
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"


def test_read_only_opt_out(spark, layer):
    sql_run(spark, "CREATE TABLE IF NOT EXISTS sqlns.u (a int) USING parquet", read_only=False)
    assert spark.catalog.tableExists("sqlns.u")


def test_three_part_names(spark, layer):
    text = "SELECT 's3_tables_db.x' AS lit, id FROM s3_tables_db.sqlns.t WHERE id = 1"
    assert replace_catalog_alias(text, "s3_tables_db").count("spark_catalog.") == 1
    rows = sql_run(spark, text, catalog_alias="s3_tables_db").fetch()
    assert rows == [{"lit": "s3_tables_db.x", "id": 1}]


def test_respond_contract(spark, layer):
    ok = respond(spark, "SELECT id FROM sqlns.t ORDER BY id")
    assert ok["status"] == 200 and ok["rows"] == [{"id": 1}, {"id": 2}]
    bad = respond(spark, "SELECT * FROM nowhere")
    assert bad["status"] == 400 and bad["error"] == "The query cannot be answered" and "suggestions" in bad


def test_respond_stores_result_files(spark, layer, scratch):
    res = respond(spark, "SELECT id, name FROM sqlns.t ORDER BY id", limit=1, result_root=f"{scratch}/out",
                  run_id="q1")
    assert res["status"] == 200 and res["output_location"].endswith("/q1") and len(res["rows"]) == 1
    assert spark.read.csv(res["output_location"], header=True).count() == 2
