"""End to end on the sf0.001 stand-ins: raw Parquet -> staged (upsert) ->
curated -> rules -> SQL with three-part names."""

import pytest

from strata.operators.sqlsurface import sql_run
from strata.plans import published as P
from strata.plans import standins as S
from strata.plans import workflow as W
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    raw_root = f"{root}/raw"
    for name, df in S.raw_tables(spark, SF_SMALL).items():
        df.write.parquet(f"{raw_root}/{name}")
    outcomes = W.run_all(spark, f"{root}/tables", raw_root=raw_root, results_root=f"{root}/dq")
    return root, outcomes


def test_layers_written(spark, lake):
    _, outcomes = lake
    expected = S.curated_tables(spark, SF_SMALL)
    for name, df in expected.items():
        stored = spark.table(f"curated.{name}")
        assert stored.columns == df.columns
        assert stored.exceptAll(df).count() == 0 and df.exceptAll(stored).count() == 0
    assert outcomes.count() == 83
    failed = {(r.table, r.rule) for r in outcomes.filter("outcome = 'Failed'").collect()}
    assert ("fato_consultas_procedimentos", 'IsComplete "id_profissional"') in failed
    assert ("fato_consultas_procedimentos", 'IsComplete "procedimento"') in failed


def test_rerun_is_stable(spark, lake):
    root, _ = lake
    before = spark.table("staged.consultas").count()
    W.run_staging(spark, "staged", f"{root}/tables", raw_root=f"{root}/raw", tables=["consultas"])
    assert spark.table("staged.consultas").count() == before


def test_published_sql_over_catalog(spark, lake):
    res = sql_run(spark, P.SQL["cost_by_hospital"].format(ns="s3_tables_db.curated"), catalog_alias="s3_tables_db")
    df_api = P.cost_by_hospital(spark.table("curated.fato_consultas_procedimentos"), spark.table("curated.dim_hospital"))
    assert sorted(map(tuple, res.df.collect())) == sorted(map(tuple, df_api.collect()))
    assert spark.read.json(f"{lake[0]}/dq").count() == 83


def test_unknown_table_dispatch(spark, lake):
    with pytest.raises(ValueError, match="known"):
        W.stage_table(spark, "pacientes", spark.range(1), "staged", lake[0])


def test_bucketed_staging(spark, lake):
    from strata.operators.upsert import bucket_spec

    root, _ = lake
    W.run_staging(spark, "staged_b", f"{root}/tables_b", raw_root=f"{root}/raw", tables=["consultas"], buckets=4)
    assert bucket_spec(spark, "staged_b.consultas") == (4, ["id_consulta"])
    assert spark.table("staged_b.consultas").exceptAll(spark.table("staged.consultas")).count() == 0


def test_layers_are_documented(spark, lake):
    from strata.sources.catalog import describe_layer

    staged = {r.table: r for r in describe_layer(spark, "staged").collect()}
    assert staged["consultas"].description.endswith("Key: id_consulta.")
    curated = {r.table: r for r in describe_layer(spark, "curated").collect()}
    assert "n rows per event" in curated["fato_exames_receitas"].description


def test_totals_of_a_fact_group_by_the_bare_key(spark):
    from strata.plans.layers import fact_totals

    schema = "id_evento int, custo double, note string"
    rows = [(1, 2.5, "a"), (1, None, "b"), (2, 1.0, None), (None, 4.0, "c"), (None, None, "d"), (3, None, "e")]
    totals = fact_totals(spark.createDataFrame(rows, schema), "fato", "id_evento", "custo")
    assert [tuple(r) for r in totals.collect()] == [("fato", 6, 3, 7.5)]
    plan = totals._jdf.queryExecution().sparkPlan().toString()
    assert "keys=[id_evento#" in plan and "keys=[table#" not in plan
    empty = fact_totals(spark.createDataFrame([], schema), "fato", "id_evento", "custo")
    assert [tuple(r) for r in empty.collect()] == [("fato", 0, 0, None)]
