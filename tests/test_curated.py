import datetime as dt
import random

from strata.operators.joins import left_join_counted, times_in
from strata.plans import hospital as H

D = dt.date(2024, 1, 5)


def frames(spark):
    exames = spark.createDataFrame(
        [(1, 10, "sangue", "ok", D), (2, 10, "imagem", "ok", D), (3, 11, "Sangue", "ok", D),
         (4, 12, None, "ok", D), (5, 99, "sangue", "ok", D), (6, 13, "x", "ok", D)],
        "id_exame int, id_consulta int, tipo string, resultado string, data date",
    )
    receitas = spark.createDataFrame(
        [(1, 10, "med", "1 mg", D, D, "extra")],
        "id_receita int, id_consulta int, medicamento string, dosagem string, inicio date, fim date, obs string",
    )
    consultas = spark.createDataFrame(
        [(10, 100, 7, D, "m", "d"), (11, 101, 8, D, "m", "d"), (12, 102, 9, D, "m", "d"),
         (13, None, 7, D, "m", "d")],
        "id_consulta int, id_paciente int, id_profissional int, data_consulta date, motivo string, diagnostico string",
    )
    # patient 100: 3 admissions, 101: 1, 102: none
    internacoes = spark.createDataFrame(
        [(1, 100, 1, "a", D, D), (2, 100, 2, "b", D, D), (3, 100, 1, "c", D, D), (4, 101, 2, "d", D, D)],
        "id_internacao int, id_paciente int, id_hospital int, motivo string, data_entrada date, data_saida date",
    )
    prof = spark.createDataFrame([(7, "p", "e", "1234", 1), (8, "q", "e", "12", 2)],
                                 "id_profissional int, nome string, especialidade string, crm string, hospital_id int")
    hosp = spark.createDataFrame([(1, "h1", "c", "e"), (2, "h2", "c", "e")],
                                 "id_hospital int, nome string, cidade string, estado string")
    procs = spark.createDataFrame([(10, 100, "raio", D, 1)],
                                  "id_procedimento int, id_paciente int, tipo string, data_procedimento date, hospital_id int")
    return exames, receitas, consultas, internacoes, prof, hosp, procs


def test_fato_exames_receitas_fanout_and_costs(spark):
    exames, receitas, consultas, internacoes, prof, hosp, _ = frames(spark)
    out = H.fato_exames_receitas(exames, receitas, consultas, internacoes, prof, hosp)
    assert out.columns == ["id_evento", "id_consulta", "id_paciente", "id_profissional", "id_hospital",
                           "tipo_evento", "descricao", "data", "custo"]
    rows = out.collect()
    by_event = {}
    for r in rows:
        by_event.setdefault((r.tipo_evento, r.id_evento), []).append(r)
    # exam 1 and 2: patient 100 with 3 admissions -> 3 rows each
    assert len(by_event[("sangue", 1)]) == 3 and len(by_event[("imagem", 2)]) == 3
    assert {r.custo for r in by_event[("sangue", 1)]} == {100.0}
    assert {r.custo for r in by_event[("imagem", 2)]} == {300.0}
    assert by_event[("Sangue", 3)][0].custo == 150.0 and by_event[("Sangue", 3)][0].id_hospital == 2
    assert by_event[(None, 4)][0].custo == 150.0 and by_event[(None, 4)][0].id_hospital is None
    # consult absent: one row, NULL patient
    assert by_event[("sangue", 5)][0].id_paciente is None
    # consult with NULL patient
    assert by_event[("x", 6)][0].id_paciente is None and by_event[("x", 6)][0].custo == 150.0
    # prescription: cost 50, fans out too
    assert len(by_event[("med", 1)]) == 3 and {r.custo for r in by_event[("med", 1)]} == {50.0}
    assert len(rows) == 3 + 3 + 1 + 1 + 1 + 1 + 3


def test_fanout_variants_agree(spark):
    exames, receitas, consultas, internacoes, prof, hosp, _ = frames(spark)
    base = H.fato_exames_receitas(exames, receitas, consultas, internacoes, prof, hosp)
    salted = H.fato_exames_receitas(exames, receitas, consultas, internacoes, prof, hosp, broadcast_rows=0)
    unique = H.fato_exames_receitas(exames, receitas, consultas, internacoes, prof, hosp, assume_unique_dims=True)
    for other in (salted, unique):
        assert base.exceptAll(other).count() == 0 and other.exceptAll(base).count() == 0
    latest = H.fato_exames_receitas(exames, receitas, consultas, internacoes, prof, hosp, dedupe_admissions="latest")
    assert latest.count() == exames.count() + receitas.count()


def test_fato_consultas_procedimentos_types(spark):
    _, _, consultas, _, _, _, procs = frames(spark)
    out = H.fato_consultas_procedimentos(consultas, procs)
    assert dict(out.dtypes) == {
        "id_fato": "int", "id_paciente": "int", "id_profissional": "string", "data_evento": "date",
        "tipo_evento": "string", "diagnostico": "string", "procedimento": "string",
        "custo_estimado": "double", "id_hospital": "string",
    }
    assert out.count() == consultas.count() + procs.count()
    assert out.filter("custo_estimado IS NOT NULL").count() == 0


def test_dims(spark):
    _, _, _, _, prof, hosp, _ = frames(spark)
    assert H.dim_profissional(prof).columns == ["id_profissional", "nome", "especialidade", "crm"]
    assert H.dim_hospital(hosp).columns == ["id_hospital", "nome", "cidade", "estado"]


def test_counted_left_join_matches_plain_join_randomised(spark):
    rnd = random.Random(7)
    left = [(i, rnd.choice([1, 2, 3, 4, None])) for i in range(300)]
    right = [(rnd.choice([1, 1, 1, 2, 5]), rnd.choice([7, 7, 8, None])) for _ in range(200)] + [(None, 999)]
    lf = spark.createDataFrame(left, "lid int, k int")
    rf = spark.createDataFrame(right, "k int, rid int")
    plain = lf.join(rf, "k", "left")
    counted = left_join_counted(lf, rf, "k", "rid").select(plain.columns)
    assert counted.exceptAll(plain).count() == 0 and plain.exceptAll(counted).count() == 0
    for rows in (0, 1, 1000):
        out = times_in(lf, rf, "k", broadcast_rows=rows)
        want = plain.select("lid", "k")
        assert out.exceptAll(want).count() == 0 and want.exceptAll(out).count() == 0


def test_hot_patient_is_one_row_before_the_join(spark):
    """Most admissions are of one patient in one hospital: they reach the join
    as one counted row, and the events of that patient stay spread."""
    adm = spark.range(20_000).selectExpr("IF(id % 10 = 0, id, 1) AS k", "IF(id % 10 = 0, id, 5) AS rid")
    events = spark.range(40).selectExpr("id AS lid", "CAST(1 AS BIGINT) AS k")
    out = left_join_counted(events, adm, "k", "rid")
    assert out.count() == 40 * 18_000
    plan = out._jdf.queryExecution().executedPlan().toString()
    # admissions are counted, map-side first, below the join
    assert plan.index("Join") < plan.index("partial_count")
