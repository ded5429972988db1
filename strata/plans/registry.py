"""Registered checks: one DataFrame query per operator group, each with the
DuckDB SQL that must give the same bag of rows on the same driver tables.

Every query reads whole driver tables (or frames Spark derives from them);
none is capped, sampled or filtered by id to keep it cheap.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.dates import parse_date
from strata.plans import oracle as O
from strata.plans import published as P
from strata.plans import standins as S
from strata.plans.hospital import STAGING_SPECS, exam_cost_sql

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return wrap


# --------------------------------------------------------------- staging ---
def _staged_query(table: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return S.staged_tables(spark, sf_dir)[table]

    return run


_STAGED_COLUMNS = {name: ", ".join(c.name for c in spec.columns) for name, spec in STAGING_SPECS.items()}
for _t in STAGING_SPECS:
    _cols = _STAGED_COLUMNS[_t] + (", origem" if _t == "receitas" else "")
    register(f"stg_{_t}", O.with_staged(f"SELECT {_cols} FROM {_t}"))(_staged_query(_t))


@register(
    "parse_date_modes",
    r"""
WITH raw AS (
  SELECT o_orderkey AS id,
         CASE o_orderkey % 6
           WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
           WHEN 1 THEN strftime(o_orderdate, '%Y-%-m-%-d')
           WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
           WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%d') || 'junk'
           WHEN 4 THEN strftime(o_orderdate, '%Y')
           ELSE strftime(o_orderdate, '%Y-%m-') || CAST(day(o_orderdate) + 28 AS VARCHAR)
         END AS raw_text
  FROM orders),
parts AS (
  SELECT id, raw_text,
         TRY_CAST(regexp_extract(raw_text, '^\s*([0-9]+)-([0-9]+)-([0-9]+)', 1) AS INTEGER) AS ly,
         TRY_CAST(regexp_extract(raw_text, '^\s*([0-9]+)-([0-9]+)-([0-9]+)', 2) AS INTEGER) AS lm,
         TRY_CAST(regexp_extract(raw_text, '^\s*([0-9]+)-([0-9]+)-([0-9]+)', 3) AS INTEGER) AS ld,
         TRY_CAST(regexp_extract(raw_text, '^([0-9]{4})(-([0-9]{1,2})(-([0-9]{1,2})([ T].*)?)?)?$', 1) AS INTEGER) AS cy,
         TRY_CAST(regexp_extract(raw_text, '^([0-9]{4})(-([0-9]{1,2})(-([0-9]{1,2})([ T].*)?)?)?$', 3) AS INTEGER) AS cm,
         TRY_CAST(regexp_extract(raw_text, '^([0-9]{4})(-([0-9]{1,2})(-([0-9]{1,2})([ T].*)?)?)?$', 5) AS INTEGER) AS cd
  FROM raw)
SELECT id, raw_text,
       TRY_CAST(printf('%04d-%02d-%02d', cy, coalesce(cm, 1), coalesce(cd, 1)) AS DATE) AS as_cast,
       CASE WHEN ly >= 1 THEN TRY_CAST(printf('%04d-%02d-%02d', ly, lm, ld) AS DATE) END AS as_legacy
FROM parts""",
)
def parse_date_modes(spark, sf_dir):
    o = S.table(spark, sf_dir, "orders")
    # Texts are built from the date (to_date) or from the zone-free timestamp
    # text, so no session time zone can shift them (date_format on a
    # timestamp without zone goes through the session zone).
    day = F.to_date("o_orderdate")
    variant = F.pmod(F.col("o_orderkey"), F.lit(6))
    raw_text = (
        F.when(variant == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(variant == 1, F.date_format(day, "yyyy-M-d"))
        .when(variant == 2, F.substring(F.col("o_orderdate").cast("timestamp_ntz").cast("string"), 1, 19))
        .when(variant == 3, F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("junk")))
        .when(variant == 4, F.date_format(day, "yyyy"))
        .otherwise(F.concat(F.date_format(day, "yyyy-MM-"), (F.dayofmonth(day) + 28).cast("string")))
    )
    raw = o.select(F.col("o_orderkey").alias("id"), raw_text.alias("raw_text"))
    return raw.select(
        "id",
        "raw_text",
        parse_date("raw_text", "cast").alias("as_cast"),
        parse_date("raw_text", "legacy").alias("as_legacy"),
    )


@register(
    "case_cost",
    O.with_staged(
        "SELECT id_exame, tipo, CAST(CASE WHEN tipo = 'sangue' THEN 100.0 WHEN tipo = 'imagem' THEN 300.0 "
        "ELSE 150.0 END AS DOUBLE) AS custo FROM exames"
    ),
)
def case_cost(spark, sf_dir):
    ex = S.staged_tables(spark, sf_dir)["exames"]
    return ex.selectExpr("id_exame", "tipo", f"{exam_cost_sql('tipo')} AS custo")


# --------------------------------------------------------------- curated ---
def _curated_query(table: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return S.curated_tables(spark, sf_dir)[table]

    return run


for _t in ("dim_hospital", "dim_profissional", "fato_consultas_procedimentos", "fato_exames_receitas"):
    register(_t, O.with_curated(f"SELECT * FROM {_t}"))(_curated_query(_t))


@register("fato_exames_receitas_salted", O.with_curated("SELECT * FROM fato_exames_receitas"))
def fato_exames_receitas_salted(spark, sf_dir):
    """The same fact with the duplicated dimension keys joined by shuffle, as
    when they are too many to broadcast."""
    return S.curated_tables(spark, sf_dir, broadcast_rows=0)["fato_exames_receitas"]


@register(
    "fato_exames_receitas_unique_dims",
    O.with_curated(
        "SELECT e.id_exame AS id_evento, e.id_consulta, c.id_paciente, c.id_profissional, i.id_hospital, "
        "e.tipo AS tipo_evento, e.resultado AS descricao, e.data, "
        "CAST(CASE WHEN e.tipo = 'sangue' THEN 100.0 WHEN e.tipo = 'imagem' THEN 300.0 ELSE 150.0 END AS DOUBLE) AS custo "
        "FROM exames e LEFT JOIN consultas c ON e.id_consulta = c.id_consulta "
        "LEFT JOIN internacoes i ON c.id_paciente = i.id_paciente "
        "UNION ALL "
        "SELECT r.id_receita, r.id_consulta, c.id_paciente, c.id_profissional, i.id_hospital, r.medicamento, "
        "r.dosagem, r.inicio, CAST(50.0 AS DOUBLE) FROM receitas r "
        "LEFT JOIN consultas c ON r.id_consulta = c.id_consulta "
        "LEFT JOIN internacoes i ON c.id_paciente = i.id_paciente"
    ),
)
def fato_exames_receitas_unique_dims(spark, sf_dir):
    return S.curated_tables(spark, sf_dir, assume_unique_dims=True)["fato_exames_receitas"]


@register(
    "fato_exames_receitas_latest_admission",
    O.with_curated(
        """, adm AS (
  SELECT id_paciente, arg_max(id_hospital, (data_entrada, id_internacao)) AS id_hospital
  FROM internacoes GROUP BY id_paciente),
ev AS (
  SELECT id_exame AS id_evento, id_consulta, tipo AS tipo_evento, resultado AS descricao, data,
         CAST(CASE WHEN tipo = 'sangue' THEN 100.0 WHEN tipo = 'imagem' THEN 300.0 ELSE 150.0 END AS DOUBLE) AS custo
  FROM exames
  UNION ALL
  SELECT id_receita, id_consulta, medicamento, dosagem, inicio, CAST(50.0 AS DOUBLE) FROM receitas)
SELECT ev.id_evento, ev.id_consulta, c.id_paciente, c.id_profissional, a.id_hospital,
       ev.tipo_evento, ev.descricao, ev.data, ev.custo
FROM ev LEFT JOIN consultas c ON ev.id_consulta = c.id_consulta
LEFT JOIN adm a ON c.id_paciente = a.id_paciente"""
    ),
)
def fato_exames_receitas_latest_admission(spark, sf_dir):
    return S.curated_tables(spark, sf_dir, dedupe_admissions="latest", assume_unique_dims=True)[
        "fato_exames_receitas"
    ]


# ------------------------------------------------------- published SQL ---
# The published queries, rules and ad-hoc SQL read the curated layer as
# stored once per session (``stored_curated_table``), not a re-derivation.
@register(
    "cost_by_hospital",
    O.with_curated(
        "SELECT h.nome AS hospital, h.cidade, SUM(f.custo_estimado) AS total_custos "
        "FROM fato_consultas_procedimentos f JOIN dim_hospital h "
        "ON TRY_CAST(f.id_hospital AS INTEGER) = h.id_hospital GROUP BY h.nome, h.cidade"
    ),
)
def cost_by_hospital(spark, sf_dir):
    return P.cost_by_hospital(
        S.stored_curated_table(spark, sf_dir, "fato_consultas_procedimentos"),
        S.stored_curated_table(spark, sf_dir, "dim_hospital"),
    )


@register(
    "events_by_month",
    O.with_curated(
        "SELECT strftime(data, '%Y-%m') AS mes, tipo_evento, COUNT(*) AS total_eventos "
        "FROM fato_exames_receitas GROUP BY strftime(data, '%Y-%m'), tipo_evento"
    ),
)
def events_by_month(spark, sf_dir):
    return P.events_by_month(S.stored_curated_table(spark, sf_dir, "fato_exames_receitas"))


@register(
    "cost_by_procedure",
    O.with_curated(
        "SELECT procedimento, COUNT(*) AS total_procedimentos, AVG(custo_estimado) AS custo_medio "
        "FROM fato_consultas_procedimentos GROUP BY procedimento"
    ),
)
def cost_by_procedure(spark, sf_dir):
    return P.cost_by_procedure(S.stored_curated_table(spark, sf_dir, "fato_consultas_procedimentos"))


# Category used for the "insured procedures of one category" example on the
# part-derived stand-in (its categories are the part types).
TUTORIAL_CATEGORY = "STANDARD"


@register("insured", O.with_tutorial("SELECT * FROM procedures WHERE Insurance = 'yes' OR Insurance = 'no'"))
def insured(spark, sf_dir):
    return P.insured(S.raw_procedures(spark, sf_dir))


@register("balance", O.with_tutorial("SELECT * FROM customers WHERE Balance >= 0"))
def balance(spark, sf_dir):
    return P.balance(S.raw_customers(spark, sf_dir))


@register(
    "insured_category",
    O.with_tutorial(f"SELECT * FROM procedures WHERE Category = '{TUTORIAL_CATEGORY}' AND Insurance = 'yes'"),
)
def insured_category(spark, sf_dir):
    return P.insured_category(S.raw_procedures(spark, sf_dir), TUTORIAL_CATEGORY)


@register("vip_balance", O.with_tutorial("SELECT * FROM customers WHERE Vip = 'yes' AND Balance > 200"))
def vip_balance(spark, sf_dir):
    return P.vip_balance(S.raw_customers(spark, sf_dir), 200)


# ---------------------------------------------------------- data quality ---
from strata.operators import quality as Q  # noqa: E402
from strata.plans.hospital import CONTEXT_PREFIX, CURATED_TABLES, rulesets  # noqa: E402

_CURATED_COLUMNS = {
    "dim_hospital": ["id_hospital", "nome", "cidade", "estado"],
    "dim_profissional": ["id_profissional", "nome", "especialidade", "crm"],
    "fato_consultas_procedimentos": [
        "id_fato", "id_paciente", "id_profissional", "data_evento", "tipo_evento",
        "diagnostico", "procedimento", "custo_estimado", "id_hospital",
    ],
    "fato_exames_receitas": [
        "id_evento", "id_consulta", "id_paciente", "id_profissional", "id_hospital",
        "tipo_evento", "descricao", "data", "custo",
    ],
}


@register("dq_outcomes", O.dq_outcomes_sql(rulesets(), CONTEXT_PREFIX))
def dq_outcomes(spark, sf_dir):
    """All 83 rules on the four curated tables: one row per rule."""
    return Q.evaluate_all(S.checkpointed_curated(spark, sf_dir), rulesets(), CONTEXT_PREFIX)


@register("dq_completeness", O.completeness_sql(_CURATED_COLUMNS))
def dq_completeness(spark, sf_dir):
    cur = S.checkpointed_curated(spark, sf_dir)
    frames = [Q.completeness(cur[t], t) for t in CURATED_TABLES]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _rule_rows(table: str, sql: str) -> Query:
    def run(spark, sf_dir):
        return Q.violations(S.stored_curated_table(spark, sf_dir, table), sql)

    return run


def _rule_sql(table: str, part: str) -> str:
    """The statement of the ruleset of ``table`` that contains ``part``."""
    (found,) = {r.sql for r in rulesets()[table].rules if r.kind == "CustomSql" and part in r.sql}
    return found


_RULE_QUERIES = {
    name: (table, _rule_sql(table, part))
    for name, table, part in (
        ("dq_duplicate_events", "fato_exames_receitas", "GROUP BY id_evento"),
        ("dq_duplicate_facts", "fato_consultas_procedimentos", "GROUP BY id_fato"),
        ("dq_negative_cost", "fato_exames_receitas", "custo < 0"),
        ("dq_future_dates", "fato_consultas_procedimentos", "current_date"),
        ("dq_short_codes", "dim_profissional", "LENGTH(crm)"),
    )
}
for _name, (_t, _sql) in _RULE_QUERIES.items():
    register(_name, O.with_curated(_sql.replace("FROM primary", f"FROM {_t}")))(_rule_rows(_t, _sql))


# The shipped cost and date columns make some rules and sums empty; these run
# the same operators over columns that have values.
@register(
    "event_cost_by_hospital",
    O.with_curated(
        "SELECT h.nome AS hospital, h.cidade, SUM(f.custo) AS total_custos FROM fato_exames_receitas f "
        "JOIN dim_hospital h ON TRY_CAST(f.id_hospital AS INTEGER) = h.id_hospital GROUP BY h.nome, h.cidade"
    ),
)
def event_cost_by_hospital(spark, sf_dir):
    fact = S.stored_curated_table(spark, sf_dir, "fato_exames_receitas").withColumnRenamed("custo", "custo_estimado")
    fact = fact.withColumn("id_hospital", F.col("id_hospital").cast("string"))
    return P.cost_by_hospital(fact, S.stored_curated_table(spark, sf_dir, "dim_hospital"))


@register(
    "event_cost_by_type",
    O.with_curated(
        "SELECT *, CAST(row_number() OVER (ORDER BY custo_medio DESC NULLS LAST, procedimento NULLS LAST) AS INTEGER) "
        "AS place FROM (SELECT tipo_evento AS procedimento, COUNT(*) AS total_procedimentos, "
        "AVG(custo) AS custo_medio FROM fato_exames_receitas GROUP BY tipo_evento)"
    ),
)
def event_cost_by_type(spark, sf_dir):
    """Mean cost per event type, with its place in the order (one row a type)."""
    from pyspark.sql import Window

    fact = S.stored_curated_table(spark, sf_dir, "fato_exames_receitas").selectExpr(
        "tipo_evento AS procedimento", "custo AS custo_estimado"
    )
    order = Window.orderBy(F.col("custo_medio").desc_nulls_last(), F.col("procedimento").asc_nulls_last())
    return P.cost_by_procedure(fact).withColumn("place", F.row_number().over(order))


AS_OF = "1996-06-15"


@register("dq_negative_balance", O.with_tutorial("SELECT Balance FROM customers WHERE Balance < 0"))
def dq_negative_balance(spark, sf_dir):
    return Q.violations(S.raw_customers(spark, sf_dir), "SELECT Balance FROM primary WHERE Balance < 0")


@register(
    "dq_future_as_of",
    O.with_curated(f"SELECT data FROM fato_exames_receitas WHERE data > DATE '{AS_OF}'"),
)
def dq_future_as_of(spark, sf_dir):
    fact = S.stored_curated_table(spark, sf_dir, "fato_exames_receitas")
    return Q.violations(fact, Q.with_as_of("SELECT data FROM primary WHERE data > current_date", AS_OF))


# ------------------------------------------------------------- retrieval ---
import uuid  # noqa: E402

from strata.operators import retrieval as R  # noqa: E402
from strata.operators.vectorcells import build_cells, search_cells  # noqa: E402
from strata.session import checkpoint_dir  # noqa: E402

KB_TOP_K = 3
VEC_TOP_K = 5


@register("kb_search", O.kb_search_sql(KB_TOP_K, R.NOT_FOUND_MESSAGE))
def kb_search(spark, sf_dir):
    """Benchmark passages as requests against the whole document collection."""
    return R.kb_search(
        S.table(spark, sf_dir, "benchmark"),
        S.table(spark, sf_dir, "documents"),
        k=KB_TOP_K,
        qid="item_id",
    )


@register("kb_search_vec", O.kb_search_vec_sql(VEC_TOP_K, R.NOT_FOUND_MESSAGE))
def kb_search_vec(spark, sf_dir):
    """Label centroids as query vectors against every embedding."""
    emb = S.table(spark, sf_dir, "embeddings")
    return R.kb_search_vec(R.label_centroids(emb), emb, k=VEC_TOP_K)


@register("kb_search_indexed", O.kb_search_sql(KB_TOP_K, R.NOT_FOUND_MESSAGE))
def kb_search_indexed(spark, sf_dir):
    """The same requests, answered from an inverted index of all documents."""
    path = f"{checkpoint_dir(spark)}/strata-index-{uuid.uuid4().hex}"
    R.build_index(S.table(spark, sf_dir, "documents"), path)
    return R.search_index(spark, path, S.table(spark, sf_dir, "benchmark"), k=KB_TOP_K, qid="item_id")


@register("kb_search_vec_cells", O.kb_search_vec_sql(VEC_TOP_K, R.NOT_FOUND_MESSAGE))
def kb_search_vec_cells(spark, sf_dir):
    """The same query vectors, answered from the cells that matter."""
    emb = S.table(spark, sf_dir, "embeddings")
    path = f"{checkpoint_dir(spark)}/strata-cells-{uuid.uuid4().hex}"
    build_cells(emb, path)
    return search_cells(spark, path, R.label_centroids(emb), k=VEC_TOP_K)


# ---------------------------------------------------------------- upsert ---
from strata.operators.upsert import merged  # noqa: E402


def _consultas_batch(cons: DataFrame) -> DataFrame:
    """An upsert batch: status 'P' consults with a new reason (updates) and
    status 'O' consults under new negative ids (inserts)."""
    changed = cons.filter(F.col("diagnostico") == "P").withColumn("motivo", F.lit("revisado"))
    new = cons.filter(F.col("diagnostico") == "O").withColumn("id_consulta", -(F.col("id_consulta") + 1))
    return changed.unionByName(new)


@register(
    "upsert_merge",
    O.with_staged(
        """, src AS (
  SELECT id_consulta, id_paciente, id_profissional, data_consulta, 'revisado' AS motivo, diagnostico
  FROM consultas WHERE diagnostico = 'P'
  UNION ALL
  SELECT -(id_consulta + 1), id_paciente, id_profissional, data_consulta, motivo, diagnostico
  FROM consultas WHERE diagnostico = 'O')
SELECT * FROM src
UNION ALL
SELECT * FROM consultas t WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.id_consulta = t.id_consulta)"""
    ),
)
def upsert_merge(spark, sf_dir):
    cons = S.staged_tables(spark, sf_dir)["consultas"]
    return merged(cons, _consultas_batch(cons), "id_consulta")


@register(
    "upsert_composite_key",
    O.with_staged(
        """, src AS (
  SELECT id_consulta, id_paciente, id_profissional, data_consulta, 'revisado' AS motivo, diagnostico
  FROM consultas WHERE diagnostico = 'P'
  UNION ALL
  SELECT id_consulta, -(id_paciente + 1), id_profissional, data_consulta, motivo, diagnostico
  FROM consultas WHERE diagnostico = 'O')
SELECT * FROM src
UNION ALL
SELECT * FROM consultas t WHERE NOT EXISTS (
  SELECT 1 FROM src s WHERE s.id_consulta = t.id_consulta AND s.id_paciente = t.id_paciente)"""
    ),
)
def upsert_composite_key(spark, sf_dir):
    cons = S.staged_tables(spark, sf_dir)["consultas"]
    changed = cons.filter(F.col("diagnostico") == "P").withColumn("motivo", F.lit("revisado"))
    new = cons.filter(F.col("diagnostico") == "O").withColumn("id_paciente", -(F.col("id_paciente") + 1))
    return merged(cons, changed.unionByName(new), "id_consulta,id_paciente")


# ----------------------------------------------------------- SQL surface ---
from strata.operators.sqlsurface import sql_run, to_rows_json  # noqa: E402


def _global_views(spark, sf_dir) -> str:
    for name, df in S.checkpointed_curated(spark, sf_dir).items():
        df.createOrReplaceGlobalTempView(name)
    return "global_temp"


def _sql_query(name: str) -> Query:
    def run(spark, sf_dir):
        ns = _global_views(spark, sf_dir)
        return sql_run(spark, P.SQL[name].format(ns=ns)).df

    return run


for _name in ("cost_by_hospital", "events_by_month", "cost_by_procedure"):
    register(f"sql_{_name}", ORACLE[_name])(_sql_query(_name))


@register(
    "sql_json_rows",
    O.with_curated(
        "SELECT to_json(struct_pack(id_evento, id_consulta, id_paciente, id_profissional, id_hospital, "
        "tipo_evento, descricao, data, custo))::VARCHAR AS row FROM fato_exames_receitas"
    ),
)
def sql_json_rows(spark, sf_dir):
    """Rows of an ad-hoc query as JSON objects (NULLs kept, ISO dates)."""
    ns = _global_views(spark, sf_dir)
    return to_rows_json(sql_run(spark, f"SELECT * FROM {ns}.fato_exames_receitas").df)


def _tutorial_views(spark, sf_dir) -> str:
    S.raw_customers(spark, sf_dir).createOrReplaceGlobalTempView("customers")
    S.raw_procedures(spark, sf_dir).createOrReplaceGlobalTempView("procedures")
    return "global_temp"


def _tutorial_sql_query(name: str) -> Query:
    def run(spark, sf_dir):
        ns = _tutorial_views(spark, sf_dir)
        return sql_run(spark, P.SQL[name].format(ns=ns, category=TUTORIAL_CATEGORY, above=200)).df

    return run


for _name in ("insured", "balance", "insured_category", "vip_balance"):
    register(f"sql_{_name}", ORACLE[_name])(_tutorial_sql_query(_name))


# ------------------------------------------- sources, sinks and pipeline ---
from strata.plans import layers as L  # noqa: E402

QUERIES.update(L.QUERIES)
ORACLE.update(L.ORACLE)
