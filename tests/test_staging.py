import datetime as dt

import pytest

from strata.operators.staging import stage
from strata.plans.hospital import STAGING_SPECS

RAW_HOSP = [("7", "A", "c", "e", "x1"), ("x", "B", "c", "e", "x2"), (None, "C", "c", "e", "x3")]


def test_select_mode_drops_extras_and_casts(spark):
    raw = spark.createDataFrame(RAW_HOSP, "id_hospital string, nome string, cidade string, estado string, extra string")
    out = stage(raw, STAGING_SPECS["hospitais"])
    assert out.columns == ["id_hospital", "nome", "cidade", "estado"]
    assert dict(out.dtypes)["id_hospital"] == "int"
    assert sorted([r.id_hospital for r in out.collect()], key=lambda v: (v is None, v)) == [7, None, None]


def test_keep_mode_keeps_extras_in_place(spark):
    raw = spark.createDataFrame(
        [("1", "9", "aspirin", "10 mg", "extra", "2024-1-5", "2024-01-05junk"),
         ("x", "9", "aspirin", "10 mg", "extra", "2024-02-30", "")],
        "id_receita string, id_consulta string, medicamento string, dosagem string, obs string, "
        "inicio string, fim string",
    )
    out = stage(raw, STAGING_SPECS["receitas"])
    assert out.columns == ["id_receita", "id_consulta", "medicamento", "dosagem", "obs", "inicio", "fim"]
    rows = sorted(out.collect(), key=lambda r: (r.id_receita is None, r.id_receita))
    assert rows[0].inicio == dt.date(2024, 1, 5) and rows[0].fim == dt.date(2024, 1, 5)
    assert rows[1].id_receita is None and rows[1].inicio is None and rows[1].fim is None
    assert rows[0].obs == "extra"


def test_cast_mode_dates(spark):
    raw = spark.createDataFrame(
        [("1", "1", "1", "2024-01-05", "m", "d"), ("2", "1", "1", "2024-01-05junk", "m", "d"),
         ("3", "1", "1", "2024", "m", "d")],
        "id_consulta string, id_paciente string, id_profissional string, data_consulta string, "
        "motivo string, diagnostico string",
    )
    got = {r.id_consulta: r.data_consulta for r in stage(raw, STAGING_SPECS["consultas"]).collect()}
    assert got == {1: dt.date(2024, 1, 5), 2: None, 3: dt.date(2024, 1, 1)}


def test_missing_column_raises(spark):
    raw = spark.createDataFrame([("1",)], "id_hospital string")
    with pytest.raises(ValueError, match="lacks columns"):
        stage(raw, STAGING_SPECS["hospitais"])


def test_cast_helpers(spark):
    from strata.functions import cast_to, typed_null

    df = spark.createDataFrame([("7",), ("x",), (None,)], "s string")
    out = df.select(cast_to("s", "int").alias("i"), typed_null("double").alias("n"))
    assert dict(out.dtypes) == {"i": "int", "n": "double"}
    assert [r.i for r in out.collect()] == [7, None, None]
