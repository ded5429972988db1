"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The driver tables are registered as views under their own names. The CTEs
below repeat the stand-in derivation of ``strata.plans.standins`` and the
staging casts in DuckDB's dialect; each registered query then runs on them.
They follow the original two-branch formulation of the exam/prescription
fact, so they also check the fused plan of the Spark side.
"""

from __future__ import annotations

STAGED_CTES = """
lines AS (SELECT *, l_orderkey * 10 + l_linenumber AS line_id FROM lineitem),
hospitais AS (
  SELECT TRY_CAST(s_suppkey AS INTEGER) AS id_hospital, s_name AS nome, n_name AS cidade, r_name AS estado
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
                LEFT JOIN region ON n_regionkey = r_regionkey),
profissionais_saude AS (
  SELECT TRY_CAST(c_custkey AS INTEGER) AS id_profissional, c_name AS nome, c_mktsegment AS especialidade,
         CAST(c_custkey AS VARCHAR) AS crm, TRY_CAST(c_nationkey AS INTEGER) AS hospital_id
  FROM customer),
consultas AS (
  SELECT TRY_CAST(o_orderkey AS INTEGER) AS id_consulta, TRY_CAST(o_custkey AS INTEGER) AS id_paciente,
         TRY_CAST(o_custkey AS INTEGER) AS id_profissional, CAST(o_orderdate AS DATE) AS data_consulta,
         o_orderpriority AS motivo, o_orderstatus AS diagnostico
  FROM orders),
exames AS (
  SELECT TRY_CAST(line_id AS INTEGER) AS id_exame, TRY_CAST(l_orderkey AS INTEGER) AS id_consulta,
         CASE WHEN l_partkey % 7 = 0 THEN NULL WHEN l_returnflag = 'A' THEN 'sangue'
              WHEN l_returnflag = 'N' THEN 'imagem' ELSE 'Sangue' END AS tipo,
         'qty:' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS resultado,
         CAST(l_shipdate AS DATE) AS data
  FROM lines WHERE l_linestatus = 'O'),
receitas AS (
  SELECT TRY_CAST(line_id AS INTEGER) AS id_receita, TRY_CAST(l_orderkey AS INTEGER) AS id_consulta,
         'med-' || CAST(l_partkey % 50 AS VARCHAR) AS medicamento,
         CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ' mg' AS dosagem,
         CAST(l_shipdate AS DATE) AS inicio, CAST(l_shipdate AS DATE) + 7 AS fim,
         l_returnflag AS origem
  FROM lines WHERE l_linestatus = 'F'),
internacoes AS (
  SELECT TRY_CAST(event_id AS INTEGER) AS id_internacao, TRY_CAST(user_id AS INTEGER) AS id_paciente,
         TRY_CAST(event_id // 100 AS INTEGER) AS id_hospital, props AS motivo,
         CAST(ts AS DATE) AS data_entrada, CAST(ts + INTERVAL 3 DAY AS DATE) AS data_saida
  FROM events),
procedimentos AS (
  SELECT TRY_CAST(line_id AS INTEGER) AS id_procedimento, TRY_CAST(l_partkey AS INTEGER) AS id_paciente,
         'proc-' || CAST(l_partkey % 6 AS VARCHAR) AS tipo, CAST(l_shipdate AS DATE) AS data_procedimento,
         TRY_CAST(l_suppkey AS INTEGER) AS hospital_id
  FROM lines)"""

CURATED_CTES = STAGED_CTES + """,
dim_hospital AS (SELECT id_hospital, nome, cidade, estado FROM hospitais),
dim_profissional AS (SELECT id_profissional, nome, especialidade, crm FROM profissionais_saude),
fato_consultas_procedimentos AS (
  SELECT id_consulta AS id_fato, id_paciente, CAST(id_profissional AS VARCHAR) AS id_profissional,
         data_consulta AS data_evento, 'Consulta' AS tipo_evento, diagnostico,
         CAST(NULL AS VARCHAR) AS procedimento, CAST(NULL AS DOUBLE) AS custo_estimado,
         CAST(NULL AS VARCHAR) AS id_hospital
  FROM consultas
  UNION ALL
  SELECT id_procedimento, id_paciente, CAST(NULL AS VARCHAR), data_procedimento, 'Procedimento',
         CAST(NULL AS VARCHAR), tipo, CAST(NULL AS DOUBLE), CAST(hospital_id AS VARCHAR)
  FROM procedimentos),
exam_events AS (
  SELECT e.id_exame AS id_evento, e.id_consulta, c.id_paciente, c.id_profissional, i.id_hospital,
         e.tipo AS tipo_evento, e.resultado AS descricao, e.data,
         CAST(CASE WHEN e.tipo = 'sangue' THEN 100.0 WHEN e.tipo = 'imagem' THEN 300.0 ELSE 150.0 END AS DOUBLE) AS custo
  FROM exames e
  LEFT JOIN consultas c ON e.id_consulta = c.id_consulta
  LEFT JOIN internacoes i ON c.id_paciente = i.id_paciente
  LEFT JOIN profissionais_saude p ON c.id_profissional = p.id_profissional
  LEFT JOIN hospitais h ON i.id_hospital = h.id_hospital),
prescription_events AS (
  SELECT r.id_receita AS id_evento, r.id_consulta, c.id_paciente, c.id_profissional, i.id_hospital,
         r.medicamento AS tipo_evento, r.dosagem AS descricao, r.inicio AS data, CAST(50.0 AS DOUBLE) AS custo
  FROM receitas r
  LEFT JOIN consultas c ON r.id_consulta = c.id_consulta
  LEFT JOIN internacoes i ON c.id_paciente = i.id_paciente
  LEFT JOIN profissionais_saude p ON c.id_profissional = p.id_profissional
  LEFT JOIN hospitais h ON i.id_hospital = h.id_hospital),
fato_exames_receitas AS (SELECT * FROM exam_events UNION ALL SELECT * FROM prescription_events)"""

TUTORIAL_CTES = """
customers AS (
  SELECT TRY_CAST(c_custkey AS INTEGER) AS Cust_Id, c_name AS Customer,
         CAST(floor(c_acctbal) AS INTEGER) AS Balance, 0 AS Past_Due,
         CASE WHEN c_mktsegment = 'BUILDING' THEN 'yes' ELSE 'no' END AS Vip
  FROM customer),
procedures AS (
  SELECT CAST(p_partkey AS VARCHAR) AS Procedure_Id, p_name AS Procedure, p_type AS Category,
         CAST(floor(p_retailprice) AS INTEGER) AS Price, p_size AS Duration,
         CASE WHEN p_size % 2 = 0 THEN 'yes' ELSE 'no' END AS Insurance,
         TRY_CAST(p_partkey AS INTEGER) AS Customer_Id
  FROM part)"""


def with_staged(body: str) -> str:
    return f"WITH {STAGED_CTES}\n{body}"


def with_curated(body: str) -> str:
    return f"WITH {CURATED_CTES}\n{body}"


def with_tutorial(body: str) -> str:
    return f"WITH {TUTORIAL_CTES}\n{body}"


_DUCK_TYPES = "CASE {t} WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' WHEN 'DATE' THEN 'date' " \
    "WHEN 'DOUBLE' THEN 'double' WHEN 'BIGINT' THEN 'bigint' ELSE lower({t}) END"


def _q(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def dq_outcome_selects(table: str, rules, context: str) -> list[str]:
    """One DuckDB SELECT per rule, giving the outcome row of that rule."""
    out = []
    head = f"{_q(context)} AS context, {_q(table)} AS \"table\""
    for r in rules:
        meta = f"{head}, {_q(r.text)} AS rule, {_q(r.kind)} AS rule_type, CAST({_q(r.column)} AS VARCHAR) AS \"column\""
        if r.kind == "ColumnExists":
            out.append(
                f"SELECT {meta}, CASE WHEN count({r.column}) >= 0 THEN 'Passed' END AS outcome, "
                f"CAST(NULL AS DOUBLE) AS actual, CAST(NULL AS BIGINT) AS violations, "
                f"CAST(NULL AS VARCHAR) AS reason FROM {table}"
            )
        elif r.kind == "ColumnDataType":
            mapped = _DUCK_TYPES.format(t=f"(SELECT typeof({r.column}) FROM {table} LIMIT 1)")
            out.append(
                f"SELECT {meta}, CASE WHEN {mapped} = {_q(str(r.value))} THEN 'Passed' ELSE 'Failed' END, "
                f"CAST(NULL AS DOUBLE), CAST(NULL AS BIGINT), "
                f"CASE WHEN {mapped} <> {_q(str(r.value))} THEN 'type is ' || {mapped} || ', expected {r.value}' END"
            )
        elif r.kind == "IsComplete":
            nulls = f"(count(*) - count({r.column}))"
            out.append(
                f"SELECT {meta}, CASE WHEN {nulls} = 0 THEN 'Passed' ELSE 'Failed' END, "
                f"CASE WHEN count(*) > 0 THEN round(count({r.column}) / count(*), 6) END, "
                f"CAST({nulls} AS BIGINT), "
                f"CASE WHEN {nulls} > 0 THEN printf('%d of %d values are NULL', {nulls}, count(*)) END "
                f"FROM {table}"
            )
        elif r.kind == "RowCount":
            v = r.text.split()[-1]
            op = "<>" if r.op == "!=" else r.op
            out.append(
                f"SELECT {meta}, CASE WHEN count(*) {op} {v} THEN 'Passed' ELSE 'Failed' END, "
                f"CAST(count(*) AS DOUBLE), CAST(NULL AS BIGINT), "
                f"CASE WHEN NOT (count(*) {op} {v}) THEN printf('row count %d is not {r.op} {v}', count(*)) END "
                f"FROM {table}"
            )
        elif r.kind == "CustomSql":
            inner = r.sql.replace("FROM primary", f"FROM {table}")
            n = f"(SELECT count(*) FROM ({inner}) v)"
            out.append(
                f"SELECT {meta}, CASE WHEN {n} = 0 THEN 'Passed' ELSE 'Failed' END, CAST({n} AS DOUBLE), "
                f"CAST({n} AS BIGINT), CASE WHEN {n} > 0 THEN printf('%d rows selected', {n}) END"
            )
    return out


def dq_outcomes_sql(rulesets: dict, context_prefix: str) -> str:
    selects = []
    for name, rs in rulesets.items():
        selects += dq_outcome_selects(name, rs.rules, context_prefix + name)
    return with_curated("\nUNION ALL\n".join(selects))


def completeness_sql(tables: dict[str, list[str]]) -> str:
    selects = []
    for t, cols in tables.items():
        for c in cols:
            selects.append(
                f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", count(*) AS \"rows\", "
                f"count(*) - count({c}) AS nulls FROM {t}"
            )
    return with_curated("\nUNION ALL\n".join(selects))


def kb_search_sql(k: int, message: str) -> str:
    msg = message.replace("'", "''")
    return rf"""
WITH q AS (
  SELECT item_id AS qid, unnest(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+')) AS term FROM benchmark),
qt AS (SELECT qid, term, count(*) AS qtf FROM q WHERE term <> '' GROUP BY qid, term),
d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS toks
  FROM documents),
stats AS (SELECT count(*) AS n, avg(len(toks)) AS avgdl FROM d),
dt AS (SELECT doc_id, len(toks) AS dl, unnest(toks) AS term FROM d),
tf AS (
  SELECT doc_id, term, count(*) AS tf, any_value(dl) AS dl FROM dt
  WHERE term IN (SELECT term FROM qt) GROUP BY doc_id, term),
dfq AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
idf AS (SELECT term, ln(1 + ((SELECT n FROM stats) - df + 0.5) / (df + 0.5)) AS idf FROM dfq),
w AS (
  SELECT tf.doc_id, tf.term,
         idf.idf * tf.tf * 2.2 / (tf.tf + 1.2 * (0.25 + 0.75 * tf.dl / (SELECT avgdl FROM stats))) AS w
  FROM tf JOIN idf USING (term)),
scored AS (
  SELECT qt.qid, w.doc_id, round(sum(w.w * qt.qtf), 9) AS score
  FROM w JOIN qt USING (term) GROUP BY qt.qid, w.doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rnk FROM scored),
best AS (SELECT * FROM ranked WHERE rnk <= {k})
SELECT b.item_id, CAST(best.rnk AS INTEGER) AS rank, best.doc_id, best.score,
       CASE WHEN best.doc_id IS NULL THEN '{msg}' END AS message
FROM benchmark b LEFT JOIN best ON b.item_id = best.qid"""


def kb_search_vec_sql(k: int, message: str) -> str:
    msg = message.replace("'", "''")
    return f"""
WITH e AS (
  SELECT vec_id, label, unnest(embedding) AS x, unnest(generate_series(0, len(embedding) - 1)) AS pos
  FROM embeddings),
comp AS (SELECT label AS qid, pos, avg(x) AS c FROM e GROUP BY label, pos),
qn AS (SELECT qid, sqrt(sum(c * c)) AS qn FROM comp GROUP BY qid),
vn AS (SELECT vec_id, sqrt(sum(x * x)) AS vn FROM e GROUP BY vec_id),
dots AS (SELECT comp.qid, e.vec_id, sum(e.x * comp.c) AS dot FROM e JOIN comp USING (pos) GROUP BY comp.qid, e.vec_id),
scored AS (
  SELECT dots.qid, dots.vec_id,
         round(CASE WHEN vn.vn > 0 AND qn.qn > 0 THEN dot / (vn.vn * qn.qn) END, 9) AS score
  FROM dots JOIN vn USING (vec_id) JOIN qn USING (qid)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC NULLS LAST, vec_id) AS rnk FROM scored),
best AS (SELECT * FROM ranked WHERE rnk <= {k})
SELECT q.qid, CAST(best.rnk AS INTEGER) AS rank, best.vec_id, best.score,
       CASE WHEN best.vec_id IS NULL THEN '{msg}' END AS message
FROM (SELECT DISTINCT qid FROM comp) q LEFT JOIN best USING (qid)"""
