"""Checks of sources, sinks, catalog and pipeline on whole driver tables.

Each query writes its table somewhere under the shared folder, goes through
the operator under test and returns what it reads back. Folders and table
names are new for every call, so calls do not meet.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.bucketed import read_bucketed, upsert_buckets
from strata.operators.rejects import FAILED, cast_failures, quarantine
from strata.operators.upsert import latest_by, replace_table, upsert_table
from strata.plans import oracle as O
from strata.plans import published as P
from strata.plans import standins as S
from strata.plans.hospital import STAGING_SPECS
from strata.session import checkpoint_dir
from strata.sources import catalog as C
from strata.sources.files import create_text_table, read_checked, read_csv, read_delimited, read_parquet_dir
from strata.sources.sinks import overwrite_table, publish_outcomes, write_quarantine, write_result_files

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str):
    def wrap(fn):
        QUERIES[name] = fn
        ORACLE[name] = oracle
        return fn

    return wrap


def _place(spark: SparkSession) -> tuple[str, str]:
    """A new folder under the shared one, and a new namespace."""
    tag = uuid.uuid4().hex[:12]
    C.create_namespace(spark, f"check_{tag}")
    return f"{checkpoint_dir(spark).rstrip('/')}/check-{tag}", f"check_{tag}"


def _typed(df: DataFrame, like: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{n}`").cast(t).alias(n) for n, t in like.dtypes])


@register("src_csv", "SELECT * FROM customer")
def src_csv(spark, sf_dir):
    """Header CSV, types inferred."""
    root, _ = _place(spark)
    table = S.table(spark, sf_dir, "customer")
    table.write.option("header", True).csv(f"{root}/customer")
    return _typed(read_csv(spark, f"{root}/customer"), table)


@register("src_delimited", "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem")
def src_delimited(spark, sf_dir):
    """Delimited text with a declared schema, as a table over the files."""
    root, ns = _place(spark)
    rows = S.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    rows.write.option("sep", "|").csv(f"{root}/lines")
    schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes)
    assert read_delimited(spark, f"{root}/lines", schema, sep="|").dtypes == rows.dtypes
    return create_text_table(spark, f"{ns}.lines", schema, f"{root}/lines", sep="|")


@register("src_parquet_folder", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def src_parquet_folder(spark, sf_dir):
    root, _ = _place(spark)
    rows = S.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    rows.write.parquet(f"{root}/raw/orders")
    return read_parquet_dir(spark, f"{root}/raw", "orders")


@register("cat_create_from_frame", "SELECT * FROM part")
def cat_create_from_frame(spark, sf_dir):
    """DDL from the frame, rows inserted twice over by full refresh."""
    root, ns = _place(spark)
    rows = S.table(spark, sf_dir, "part")
    C.create_table_from_df(spark, rows, f"{ns}.part", location=f"{root}/part")
    overwrite_table(spark, rows.withColumn("p_name", F.lower("p_brand")), f"{ns}.part")  # what the refresh replaces
    overwrite_table(spark, rows, f"{ns}.part")
    return spark.table(f"{ns}.part")


@register(
    "cat_discover",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_linestatus, l_returnflag FROM lineitem",
)
def cat_discover(spark, sf_dir):
    """Partitioned folders found and registered by listing."""
    root, ns = _place(spark)
    rows = S.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_linestatus", "l_returnflag"
    )
    rows.write.partitionBy("l_linestatus", "l_returnflag").parquet(f"{root}/found/lines")
    return C.discover(spark, ns, f"{root}/found")["lines"].select(*rows.columns)


@register(
    "cat_describe",
    "SELECT 'orders' AS \"table\", 'all orders' AS description, 'o_orderkey bigint, o_orderstatus string' AS columns, "
    "count(*) AS \"rows\" FROM orders",
)
def cat_describe(spark, sf_dir):
    root, ns = _place(spark)
    rows = S.table(spark, sf_dir, "orders").selectExpr("CAST(o_orderkey AS BIGINT) AS o_orderkey", "o_orderstatus")
    replace_table(spark, rows, f"{ns}.orders", f"{root}/orders", comment="all orders")
    return C.describe_layer(spark, ns).withColumn("rows", F.lit(spark.table(f"{ns}.orders").count()).cast("long"))


@register("snk_overwrite", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'")
def snk_overwrite(spark, sf_dir):
    """A full refresh leaves no partition of the old rows."""
    root, ns = _place(spark)
    rows = S.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    rows.write.partitionBy("o_orderstatus").option("path", f"{root}/orders").saveAsTable(f"{ns}.orders")
    overwrite_table(spark, rows.filter("o_orderstatus <> 'P'"), f"{ns}.orders")
    return spark.table(f"{ns}.orders")


@register("snk_result_files", "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment")
def snk_result_files(spark, sf_dir):
    root, _ = _place(spark)
    answer = S.table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    path = write_result_files(answer, f"{root}/results", "run")
    return _typed(read_csv(spark, path), answer)


@register(
    "snk_dq_results",
    O.with_tutorial(
        "SELECT 'customers' AS \"table\", CASE WHEN count(*) FILTER (WHERE Balance < 0) = 0 THEN 'Passed' ELSE 'Failed' "
        "END AS outcome, count(*) FILTER (WHERE Balance < 0) AS violations FROM customers"
    ),
)
def snk_dq_results(spark, sf_dir):
    from strata.operators import quality as Q

    root, _ = _place(spark)
    rules = Q.load_rules('Rules = [ CustomSql "SELECT Balance FROM primary WHERE Balance < 0" ]', "customers")
    publish_outcomes(Q.evaluate(S.raw_customers(spark, sf_dir), rules, "check"), f"{root}/dq")
    return spark.read.json(f"{root}/dq").select("table", "outcome", "violations")


_BATCH_SQL = """, src AS (
  SELECT id_consulta, id_paciente, id_profissional, data_consulta, 'revisado' AS motivo, diagnostico
  FROM consultas WHERE diagnostico = 'P')
SELECT * FROM src UNION ALL SELECT * FROM consultas WHERE diagnostico <> 'P'"""


@register("upsert_table_merge", O.with_staged(_BATCH_SQL))
def upsert_table_merge(spark, sf_dir):
    """Two upserts through the catalog table; the batch holds an older version
    of every key, of which the last is kept."""
    root, ns = _place(spark)
    cons = S.staged_tables(spark, sf_dir)["consultas"]
    upsert_table(spark, cons, f"{ns}.consultas", "id_consulta", f"{root}/consultas")
    changed = cons.filter("diagnostico = 'P'").withColumns({"motivo": F.lit("revisado"), "at": F.lit(2)})
    older = changed.withColumns({"motivo": F.lit("velho"), "at": F.lit(1)})
    batch = latest_by(older.unionByName(changed), "id_consulta", "at").drop("at")
    upsert_table(spark, batch, f"{ns}.consultas", "id_consulta", f"{root}/consultas")
    return spark.table(f"{ns}.consultas")


@register("upsert_touched_buckets", O.with_staged(_BATCH_SQL))
def upsert_touched_buckets(spark, sf_dir):
    """A load, a batch of changes and the same batch again, by touched buckets."""
    root, ns = _place(spark)
    cons = S.staged_tables(spark, sf_dir)["consultas"]
    changed = cons.filter("diagnostico = 'P'").withColumn("motivo", F.lit("revisado"))
    for batch in (cons, changed, changed):
        upsert_buckets(spark, batch, f"{ns}.consultas", "id_consulta", f"{root}/consultas")
    return read_bucketed(spark, f"{ns}.consultas")


# Raw orders with values that do not fit their types: an id as text with a
# letter, a patient beyond an int, a date that is none.
_MISFIT = """raw AS (
  SELECT CASE WHEN o_orderstatus = 'P' THEN 'x' || CAST(o_orderkey AS VARCHAR) ELSE CAST(o_orderkey AS VARCHAR) END AS id_consulta,
         CASE WHEN o_orderpriority = '1-URGENT' THEN o_custkey + 3000000000 ELSE o_custkey END AS id_paciente,
         o_custkey AS id_profissional,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'unknown' ELSE '1996-01-02' END AS data_consulta,
         o_orderpriority AS motivo, o_orderstatus AS diagnostico
  FROM orders)"""


def _misfits(spark, sf_dir):
    return S.table(spark, sf_dir, "orders").selectExpr(
        "IF(o_orderstatus = 'P', concat('x', o_orderkey), CAST(o_orderkey AS STRING)) AS id_consulta",
        "IF(o_orderpriority = '1-URGENT', o_custkey + 3000000000L, o_custkey) AS id_paciente",
        "o_custkey AS id_profissional",
        "IF(o_orderpriority = '5-LOW', 'unknown', '1996-01-02') AS data_consulta",
        "o_orderpriority AS motivo",
        "o_orderstatus AS diagnostico",
    )


@register(
    "stg_cast_failures",
    f"""WITH {_MISFIT}, t AS (
  SELECT count(*) AS n, count(*) FILTER (WHERE diagnostico = 'P') AS ids,
         count(*) FILTER (WHERE motivo = '1-URGENT') AS patients, count(*) FILTER (WHERE motivo = '5-LOW') AS days FROM raw)
SELECT 'consultas' AS "table", c.name AS "column", n AS "rows",
       CASE c.name WHEN 'id_consulta' THEN ids WHEN 'id_paciente' THEN patients WHEN 'data_consulta' THEN days ELSE 0 END AS failures
FROM t, (SELECT unnest(['id_consulta', 'id_paciente', 'id_profissional', 'data_consulta', 'motivo', 'diagnostico']) AS name) c""",
)
def stg_cast_failures(spark, sf_dir):
    """Values lost by the casts, counted per column."""
    return cast_failures(_misfits(spark, sf_dir), STAGING_SPECS["consultas"])


@register(
    "stg_rejected_rows",
    f"""WITH {_MISFIT}, f AS (
  SELECT *, list_filter([CASE WHEN diagnostico = 'P' THEN 'id_consulta' END, CASE WHEN motivo = '1-URGENT' THEN 'id_paciente' END,
                         CASE WHEN motivo = '5-LOW' THEN 'data_consulta' END], lambda x: x IS NOT NULL) AS failed FROM raw)
SELECT id_consulta, id_paciente, data_consulta, array_to_string(failed, ',') AS failed, (SELECT count(*) FROM raw) AS "rows"
FROM f WHERE len(failed) > 0""",
)
def stg_rejected_rows(spark, sf_dir):
    """The raw rows kept aside, beside the number of rows observed meanwhile."""
    root, _ = _place(spark)
    seen = quarantine(_misfits(spark, sf_dir), STAGING_SPECS["consultas"], f"{root}/rejects")
    kept = spark.read.parquet(f"{root}/rejects")
    return kept.select(
        "id_consulta", "id_paciente", "data_consulta", F.array_join(FAILED, ",").alias("failed"), F.lit(seen["rows"]).cast("long").alias("rows")
    )


# Order lines as text: some lack fields, some hold a word where a number belongs.
_LINE = (
    "CASE WHEN o_orderstatus = 'P' THEN CAST(o_orderkey AS {text}) || '|' || o_orderpriority "
    "WHEN o_orderpriority = '5-LOW' THEN CAST(o_orderkey AS {text}) || '|many|' || o_orderstatus || '|' || o_orderpriority "
    "ELSE CAST(o_orderkey AS {text}) || '|' || CAST(o_custkey AS {text}) || '|' || o_orderstatus || '|' || o_orderpriority END"
)
_LINE_SCHEMA = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string"


def _checked_lines(spark, sf_dir):
    root, _ = _place(spark)
    S.table(spark, sf_dir, "orders").selectExpr(_LINE.format(text="string") + " AS line").write.text(f"{root}/lines")
    return root, read_checked(spark, f"{root}/lines", _LINE_SCHEMA, sep="|")


@register(
    "src_checked_rows",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders "
    "WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'",
)
def src_checked_rows(spark, sf_dir):
    """The lines that parse."""
    return _checked_lines(spark, sf_dir)[1][0]


@register(
    "src_quarantined_lines",
    "SELECT line FROM (SELECT " + _LINE.format(text="varchar") + " AS line, o_orderstatus, o_orderpriority FROM orders) "
    "WHERE o_orderstatus = 'P' OR o_orderpriority = '5-LOW'",
)
def src_quarantined_lines(spark, sf_dir):
    """The lines that do not, from the quarantine."""
    root, (_, bad) = _checked_lines(spark, sf_dir)
    write_quarantine(bad, f"{root}/quarantine", "run-1")
    return spark.read.parquet(f"{root}/quarantine/run-1").select("line")


@register(
    "cat_rediscover",
    "SELECT l_orderkey, l_linenumber, l_returnflag, CASE WHEN l_returnflag = 'N' THEN l_quantity END AS l_quantity "
    "FROM lineitem WHERE l_returnflag <> 'R'",
)
def cat_rediscover(spark, sf_dir):
    """A folder is found, then loses a partition and gains one with a new column."""
    root, ns = _place(spark)
    rows = S.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    old = rows.filter("l_returnflag <> 'N'").drop("l_quantity")
    old.write.partitionBy("l_returnflag").parquet(f"{root}/found/lines")
    assert C.discover(spark, ns, f"{root}/found")["lines"].columns == ["l_orderkey", "l_linenumber", "l_returnflag"]
    C.remove_folder(spark, f"{root}/found/lines/l_returnflag=R")
    rows.filter("l_returnflag = 'N'").drop("l_returnflag").write.parquet(f"{root}/found/lines/l_returnflag=N")
    return C.discover(spark, ns, f"{root}/found")["lines"].select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")


@register(
    "upsert_null_keys",
    O.with_staged(
        "SELECT * FROM consultas UNION ALL SELECT CAST(NULL AS INTEGER), id_paciente, id_profissional, data_consulta, "
        "motivo, diagnostico FROM consultas WHERE diagnostico = 'O'"
    ),
)
def upsert_null_keys(spark, sf_dir):
    """Rows without a key are inserted, all of them."""
    root, ns = _place(spark)
    cons = S.staged_tables(spark, sf_dir)["consultas"]
    upsert_table(spark, cons, f"{ns}.consultas", "id_consulta", f"{root}/consultas")
    batch = cons.filter("diagnostico = 'O'").withColumn("id_consulta", F.lit(None).cast("int"))
    upsert_table(spark, batch, f"{ns}.consultas", "id_consulta", f"{root}/consultas")
    return spark.table(f"{ns}.consultas")


@register(
    "sql_unqualified",
    O.with_curated("SELECT estado, count(*) AS n FROM dim_hospital GROUP BY estado"),
)
def sql_unqualified(spark, sf_dir):
    """Unqualified names mean the namespace given."""
    from strata.operators.sqlsurface import sql_run

    root, ns = _place(spark)
    replace_table(spark, S.curated_tables(spark, sf_dir)["dim_hospital"], f"{ns}.dim_hospital", f"{root}/dim_hospital")
    return sql_run(spark, "SELECT estado, count(*) AS n FROM dim_hospital GROUP BY estado", namespace=ns).df


def fact_totals(fact: DataFrame, table: str, key: str, cost: str) -> DataFrame:
    """One row of totals of a fact. Its rows are grouped by the bare key,
    map-side; a name beside the key would be hashed with every row."""
    sums = fact.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("ids"), F.sum(cost).alias("custo"))
    return sums.select(F.lit(table).alias("table"), "rows", "ids", "custo")


@register(
    "pipe_run_all",
    O.with_curated(
        "SELECT 'fato_exames_receitas' AS \"table\", count(*) AS \"rows\", count(DISTINCT id_evento) AS ids, "
        "sum(custo) AS custo FROM fato_exames_receitas UNION ALL "
        "SELECT 'fato_consultas_procedimentos', count(*), count(DISTINCT id_fato), NULL FROM fato_consultas_procedimentos"
    ),
)
def pipe_run_all(spark, sf_dir):
    """Raw folders to staged, curated and judged tables, then totals of both facts."""
    from strata.plans import workflow as W

    root, ns = _place(spark)
    raw = S.raw_tables(spark, sf_dir)
    W.parallel(spark, {t: (lambda t=t: raw[t].write.parquet(f"{root}/raw/{t}")) for t in raw}, workers=len(raw))
    W.run_all(spark, f"{root}/tables", raw_root=f"{root}/raw", staged_namespace=f"{ns}_staged", curated_namespace=ns)
    exams, visits = "fato_exames_receitas", "fato_consultas_procedimentos"
    return fact_totals(spark.table(f"{ns}.{exams}"), exams, "id_evento", "custo").unionByName(
        fact_totals(spark.table(f"{ns}.{visits}"), visits, "id_fato", "custo_estimado")
    )


# ------------------------------------------- order, names, answers, codec ---
def _places(ordered: DataFrame) -> DataFrame:
    """The rows with the place each has in the query's own order."""
    return ordered.coalesce(1).withColumn("place", F.monotonically_increasing_id() + 1)


@register(
    "sort_desc_places",
    O.with_curated(
        "SELECT custo_medio, row_number() OVER (ORDER BY custo_medio DESC NULLS LAST) AS place FROM ("
        "SELECT avg(custo) AS custo_medio FROM fato_exames_receitas GROUP BY tipo_evento)"
    ),
)
def sort_desc_places(spark, sf_dir):
    """Mean costs of the event types, numbered as the query puts them out (types of one mean are in no order)."""
    fact = S.stored_curated_table(spark, sf_dir, "fato_exames_receitas")
    ordered = P.cost_by_procedure(fact.selectExpr("tipo_evento AS procedimento", "custo AS custo_estimado"))
    return _places(ordered).select("custo_medio", "place")


@register(
    "sort_multi_places",
    O.with_curated(
        "SELECT *, row_number() OVER (ORDER BY mes NULLS LAST, tipo_evento NULLS LAST) AS place FROM ("
        "SELECT strftime(data, '%Y-%m') AS mes, tipo_evento, count(*) AS total_eventos "
        "FROM fato_exames_receitas GROUP BY 1, 2)"
    ),
)
def sort_multi_places(spark, sf_dir):
    """Events per month and type, numbered as the query puts them out."""
    return _places(P.events_by_month(S.stored_curated_table(spark, sf_dir, "fato_exames_receitas")))


@register(
    "sql_three_part_names",
    O.with_curated("SELECT estado, 's3_tables_db.x.y' AS note, count(*) AS n FROM dim_hospital GROUP BY estado"),
)
def sql_three_part_names(spark, sf_dir):
    """A catalog alias in front of namespace and table, but not inside text."""
    from strata.operators.sqlsurface import sql_run

    root, ns = _place(spark)
    replace_table(spark, S.curated_tables(spark, sf_dir)["dim_hospital"], f"{ns}.dim_hospital", f"{root}/dim_hospital")
    text = f"SELECT estado, 's3_tables_db.x.y' AS note, count(*) AS n FROM S3_TABLES_DB.{ns}.dim_hospital GROUP BY estado;"
    return sql_run(spark, text, catalog_alias="s3_tables_db").df


# (name, statement over the namespace {ns}, what it is answered with)
_STATEMENTS = (
    ("rows", "SELECT id_hospital FROM {ns}.dim_hospital", "answer"),
    ("no such table", "SELECT * FROM {ns}.dim_clinic", "query"),
    ("no such column", "SELECT clinic FROM {ns}.dim_hospital", "query"),
    ("not SQL", "SELEKT * FROM {ns}.dim_hospital", "query"),
    ("at run time", "SELECT raise_error('odd') FROM {ns}.dim_hospital", "query"),
    ("drop", "DROP TABLE {ns}.dim_hospital", "refused"),
    ("insert", "INSERT INTO {ns}.dim_hospital SELECT * FROM {ns}.dim_hospital", "refused"),
    ("set", "SET spark.sql.shuffle.partitions = 1", "refused"),
    ("two statements", "SELECT 1; DROP TABLE {ns}.dim_hospital", "query"),
    ("rows again", "WITH h AS (SELECT * FROM {ns}.dim_hospital) SELECT id_hospital FROM h", "answer"),
)
_TITLES = {
    "answer": (200, None),
    "query": (400, "The query cannot be answered"),
    "refused": (400, "Only queries may run here"),
}


@register(
    "sql_answers",
    O.with_curated(
        " UNION ALL ".join(
            f"SELECT '{name}' AS statement, {_TITLES[kind][0]} AS status, "
            + (f"CAST(NULL AS VARCHAR) AS error, (SELECT count(*) FROM dim_hospital) AS \"rows\"" if kind == "answer"
               else f"'{_TITLES[kind][1]}' AS error, CAST(NULL AS BIGINT) AS \"rows\"")
            for name, _, kind in _STATEMENTS
        )
    ),
)
def sql_answers(spark, sf_dir):
    """Answers, errors and refusals as the caller gets them; commands leave
    the table and the session as they were."""
    from strata.operators.sqlsurface import respond

    root, ns = _place(spark)
    replace_table(spark, S.curated_tables(spark, sf_dir)["dim_hospital"], f"{ns}.dim_hospital", f"{root}/dim_hospital")
    rows = []
    for name, text, _ in _STATEMENTS:
        got = respond(spark, text.format(ns=ns), limit=None)
        rows.append((name, got["status"], got.get("error"), len(got["rows"]) if "rows" in got else None))
    return spark.createDataFrame(rows, "statement string, status int, error string, rows bigint")


@register(
    "dq_past_dates",
    O.with_curated("SELECT data FROM fato_exames_receitas WHERE data < current_date"),
)
def dq_past_dates(spark, sf_dir):
    """``current_date`` as the engine's own function, over dates on both sides."""
    from strata.operators import quality as Q

    fact = S.stored_curated_table(spark, sf_dir, "fato_exames_receitas")
    return Q.violations(fact, "SELECT data FROM primary WHERE data < current_date")


@register("cat_codec", "SELECT 'zstd' AS codec, count(*) AS \"rows\" FROM part")
def cat_codec(spark, sf_dir):
    """The codec that the files of a created table carry in their names."""
    root, ns = _place(spark)
    rows = S.table(spark, sf_dir, "part")
    C.create_table_from_df(spark, rows, f"{ns}.part", location=f"{root}/part")
    rows.write.insertInto(f"{ns}.part")
    codec = F.regexp_extract(F.input_file_name(), r"\.(\w+)\.parquet$", 1).alias("codec")
    return spark.table(f"{ns}.part").groupBy(codec).agg(F.count(F.lit(1)).alias("rows"))
