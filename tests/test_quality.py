import datetime as dt

import pytest

from strata.operators import quality as Q
from strata.plans.hospital import RULESET_TEXT, rulesets

TODAY = dt.date.today()
SCHEMA = "id int, custo double, data date, crm string"


def outcomes(df, rules):
    rs = Q.Ruleset("t", tuple(rules))
    return {r.rule: r for r in Q.evaluate(df, rs, "ctx").collect()}


def test_rulesets_load():
    rs = rulesets()
    assert {k: len(v.rules) for k, v in rs.items()} == {
        "fato_consultas_procedimentos": 27, "fato_exames_receitas": 28, "dim_hospital": 14, "dim_profissional": 14,
    }
    assert all(r.text for v in rs.values() for r in v.rules)
    with pytest.raises(ValueError):
        Q.load_rules('Rules = [ Uniqueness "x" > 0.9 ]', "t")


def test_rule_outcomes_on_edge_rows(spark):
    df = spark.createDataFrame(
        [(1, 10.0, TODAY, "1234"), (1, -5.0, TODAY + dt.timedelta(days=1), "123"),
         (None, None, None, None), (2, 0.0, TODAY, "12345")],
        SCHEMA,
    )
    rules = [
        Q.column_exists("id"), Q.column_exists("nope"),
        Q.is_complete("id"), Q.is_complete("nope"),
        Q.column_type("id", "int"), Q.column_type("custo", "string"), Q.column_type("nope", "int"),
        Q.row_count(">", 0), Q.row_count(">=", 5),
        Q.custom_sql("SELECT id FROM primary GROUP BY id HAVING COUNT(*) > 1"),
        Q.custom_sql("SELECT custo FROM primary WHERE custo < 0"),
        Q.custom_sql("SELECT data FROM primary WHERE data > current_date"),
        Q.custom_sql("SELECT crm FROM primary WHERE LENGTH(crm) < 4"),
        Q.custom_sql("SELECT missing_col FROM primary"),
    ]
    out = outcomes(df, rules)
    assert out['ColumnExists "id"'].outcome == "Passed"
    assert out['ColumnExists "nope"'].outcome == "Failed"
    c = out['IsComplete "id"']
    assert (c.outcome, c.violations, c.actual) == ("Failed", 1, 0.75)
    assert out['IsComplete "nope"'].reason == "column nope not found"
    assert out['ColumnDataType "id" = "int"'].outcome == "Passed"
    assert out['ColumnDataType "custo" = "string"'].reason == "type is double, expected string"
    assert out["RowCount > 0"].outcome == "Passed" and out["RowCount > 0"].actual == 4.0
    assert out["RowCount >= 5"].outcome == "Failed"
    # duplicate key 1; NULL keys group together but only once here
    assert out['CustomSql "SELECT id FROM primary GROUP BY id HAVING COUNT(*) > 1"'].violations == 1
    assert out['CustomSql "SELECT custo FROM primary WHERE custo < 0"'].violations == 1
    # one day after today fails, today passes
    assert out['CustomSql "SELECT data FROM primary WHERE data > current_date"'].violations == 1
    # length 3 selected, 4 and NULL not
    assert out['CustomSql "SELECT crm FROM primary WHERE LENGTH(crm) < 4"'].violations == 1
    bad = out['CustomSql "SELECT missing_col FROM primary"']
    assert bad.outcome == "Failed" and bad.reason.startswith("statement failed")


def test_empty_table_fails_row_count(spark):
    df = spark.createDataFrame([], SCHEMA)
    out = outcomes(df, [Q.row_count(">", 0), Q.is_complete("id")])
    assert out["RowCount > 0"].outcome == "Failed"
    assert out['IsComplete "id"'].outcome == "Passed" and out['IsComplete "id"'].actual is None


def test_violations_counts_equal_brute_force(spark):
    data = [(i % 7, float(i - 10), TODAY, str(i)) for i in range(40)]
    df = spark.createDataFrame(data, SCHEMA)
    out = outcomes(df, [Q.custom_sql("SELECT id FROM primary GROUP BY id HAVING COUNT(*) > 1"),
                        Q.custom_sql("SELECT custo FROM primary WHERE custo < 0")])
    ids = [d[0] for d in data]
    assert out['CustomSql "SELECT id FROM primary GROUP BY id HAVING COUNT(*) > 1"'].violations == len(
        {i for i in ids if ids.count(i) > 1})
    assert out['CustomSql "SELECT custo FROM primary WHERE custo < 0"'].violations == sum(d[1] < 0 for d in data)


def test_fail_on(spark):
    df = spark.createDataFrame([(None, 1.0, TODAY, "x")], SCHEMA)
    res = Q.evaluate(df, Q.Ruleset("t", (Q.is_complete("id"),)))
    Q.assert_passed(res)  # default: never raises
    with pytest.raises(AssertionError):
        Q.assert_passed(res, "any")


def test_completeness(spark):
    df = spark.createDataFrame([(None, 1.0, TODAY, "x"), (1, None, None, None)], SCHEMA)
    got = {r.column: r.nulls for r in Q.completeness(df, "t").collect()}
    assert got == {"id": 1, "custo": 1, "data": 1, "crm": 1}


def test_ruleset_text_has_four_tables():
    assert set(RULESET_TEXT) == {"fato_consultas_procedimentos", "fato_exames_receitas", "dim_hospital",
                                 "dim_profissional"}


def test_as_of_binds_current_date(spark):
    as_of = dt.date(2024, 1, 5)
    df = spark.createDataFrame(
        [(1, 1.0, as_of, "1234"), (2, 1.0, as_of + dt.timedelta(days=1), "1234")], SCHEMA
    )
    rule = Q.custom_sql("SELECT data FROM primary WHERE data > current_date")
    out = Q.evaluate(df, Q.Ruleset("t", (rule,)), "ctx", as_of=as_of).first()
    assert (out.outcome, out.violations) == ("Failed", 1)  # the day after as_of fails, as_of itself passes
    assert Q.with_as_of("x > CURRENT_DATE() AND y < current_date", "2024-01-05") == (
        "x > DATE'2024-01-05' AND y < DATE'2024-01-05'"
    )


def test_callers_primary_view_is_kept(spark):
    mine = spark.createDataFrame([(42,)], "x int")
    mine.createOrReplaceTempView("primary")
    try:
        df = spark.createDataFrame([(1, 1.0, TODAY, "1")], SCHEMA)
        assert Q.violations(df, "SELECT id FROM primary").count() == 1
        assert [r.x for r in spark.table("primary").collect()] == [42]
    finally:
        spark.catalog.dropTempView("primary")
