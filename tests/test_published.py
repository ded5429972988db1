"""Published filters and aggregates on hand-made tutorial / curated rows."""

import datetime as dt

from strata.plans import published as P

CUSTOMERS = "Cust_Id int, Customer string, Balance int, Past_Due int, Vip string"
PROCEDURES = ("Procedure_Id string, Procedure string, Category string, Price int, Duration int, "
              "Insurance string, Customer_Id int")


def test_tutorial_filters(spark):
    customers = spark.createDataFrame(
        [(1, "a", -1, 0, "yes"), (2, "b", 0, 0, "no"), (3, "c", 200, 0, "yes"), (4, "d", 201, 0, "yes"),
         (5, "e", None, 0, "yes"), (6, "f", 500, 0, "no")],
        CUSTOMERS,
    )
    procedures = spark.createDataFrame(
        [("P1", "x", "imagem", 1, 1, "yes", 1), ("P2", "x", "imagem", 1, 1, "no", 1),
         ("P3", "x", "imagem", 1, 1, "Yes", 1), ("P4", "x", "imagem", 1, 1, None, 1),
         ("P5", "x", "sangue", 1, 1, "yes", 1)],
        PROCEDURES,
    )
    assert sorted(r.Cust_Id for r in P.balance(customers).collect()) == [2, 3, 4, 6]
    assert [r.Cust_Id for r in P.vip_balance(customers).collect()] == [4]
    assert sorted(r.Procedure_Id for r in P.insured(procedures).collect()) == ["P1", "P2", "P5"]  # "Yes" and NULL are neither
    assert [r.Procedure_Id for r in P.insured_category(procedures, "imagem").collect()] == ["P1"]


def test_curated_reports(spark):
    d = dt.date(2024, 3, 9)
    fato_cp = spark.createDataFrame(
        [(1, 1, "7", d, "Consulta", "x", None, None, None),
         (2, 1, None, d, "Procedimento", None, "raio", None, "1"),
         (3, 1, None, d, "Procedimento", None, "raio", None, "x")],
        "id_fato int, id_paciente int, id_profissional string, data_evento date, tipo_evento string, "
        "diagnostico string, procedimento string, custo_estimado double, id_hospital string",
    )
    dim = spark.createDataFrame([(1, "H", "Rio", "RJ")], "id_hospital int, nome string, cidade string, estado string")
    rows = P.cost_by_hospital(fato_cp, dim).collect()
    assert [(r.hospital, r.cidade, r.total_custos) for r in rows] == [("H", "Rio", None)]
    by_proc = {r.procedimento: (r.total_procedimentos, r.custo_medio) for r in P.cost_by_procedure(fato_cp).collect()}
    assert by_proc == {None: (1, None), "raio": (2, None)}
    fato_er = spark.createDataFrame(
        [(1, d, "sangue"), (2, d, "sangue"), (3, None, "med")], "id_evento int, data date, tipo_evento string"
    )
    months = [(r.mes, r.tipo_evento, r.total_eventos) for r in P.events_by_month(fato_er).collect()]
    assert months == [("2024-03", "sangue", 2), (None, "med", 1)]
