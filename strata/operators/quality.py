"""Declarative data-quality rules evaluated as Spark jobs.

Five rule forms are supported, written as in the source rulesets:

    ColumnExists "c"
    IsComplete "c"
    ColumnDataType "c" = "int"
    RowCount > 0                     (any of > >= < <= = !=)
    CustomSql "SELECT ... FROM primary ..."

Meaning (our definitions where the original evaluator is closed):

* schema rules (``ColumnExists``, ``ColumnDataType``) read the schema only;
* ``IsComplete`` passes when the column has no NULL; ``actual`` is the
  non-NULL fraction, ``violations`` the NULL count;
* ``RowCount`` compares ``count(*)`` with the threshold;
* ``CustomSql`` statements select offending rows from the table (bound as the
  view ``primary``); the rule passes when the result is empty and
  ``violations`` is its row count;
* a rule on a missing column fails with a reason instead of raising;
* a failed rule stops nothing: outcomes are data.

``evaluate`` returns the outcomes as one lazy DataFrame. All counts of a
table (rows, NULLs per column, rows met by a filtering CustomSql rule) come
from a single aggregate pass. A rule on repeated keys groups that pass: the
counts are made per key, map-side, and summed, so it costs no scan of its own.
Each other CustomSql rule adds one count over its own (column-pruned) plan. Only the
one-row aggregates reach the outcome rows, so nothing large is collected.
"""

from __future__ import annotations

import re
import threading
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.functions.casts import type_name

from strata.operators.sqlsurface import is_query

OUTCOME_SCHEMA = (
    "context string, table string, rule string, rule_type string, column string, "
    "outcome string, actual double, violations bigint, reason string"
)
PASSED, FAILED = "Passed", "Failed"
_OPS = {">": "__gt__", ">=": "__ge__", "<": "__lt__", "<=": "__le__", "=": "__eq__", "!=": "__ne__"}
_VIEW_LOCK = threading.Lock()


@dataclass(frozen=True)
class Rule:
    kind: str
    column: str | None = None
    op: str | None = None
    value: str | float | None = None
    sql: str | None = None

    @property
    def text(self) -> str:
        if self.kind in ("ColumnExists", "IsComplete"):
            return f'{self.kind} "{self.column}"'
        if self.kind == "ColumnDataType":
            return f'ColumnDataType "{self.column}" = "{self.value}"'
        if self.kind == "RowCount":
            v = int(self.value) if float(self.value).is_integer() else self.value
            return f"RowCount {self.op} {v}"
        return f'CustomSql "{self.sql}"'


@dataclass(frozen=True)
class Ruleset:
    table: str
    rules: tuple[Rule, ...]


def column_exists(c: str) -> Rule:
    return Rule("ColumnExists", column=c)


def is_complete(c: str) -> Rule:
    return Rule("IsComplete", column=c)


def column_type(c: str, t: str) -> Rule:
    return Rule("ColumnDataType", column=c, op="=", value=t)


def row_count(op: str, n: float) -> Rule:
    if op not in _OPS:
        raise ValueError(f"unknown comparison {op!r}")
    return Rule("RowCount", op=op, value=float(n))


def custom_sql(sql: str) -> Rule:
    return Rule("CustomSql", sql=sql)


_FORMS = [
    (re.compile(r'^ColumnExists\s+"([^"]+)"$'), lambda m: column_exists(m[1])),
    (re.compile(r'^IsComplete\s+"([^"]+)"$'), lambda m: is_complete(m[1])),
    (re.compile(r'^ColumnDataType\s+"([^"]+)"\s*=\s*"([^"]+)"$'), lambda m: column_type(m[1], m[2])),
    (re.compile(r"^RowCount\s*(>=|<=|!=|>|<|=)\s*([0-9.]+)$"), lambda m: row_count(m[1], float(m[2]))),
    (re.compile(r'^CustomSql\s+"(.+)"$'), lambda m: custom_sql(m[1])),
]


def load_rules(text: str, table: str) -> Ruleset:
    """Read a ``Rules = [ ... ]`` block (one rule per line, ``#`` comments)."""
    body = text.strip()
    if "[" in body:
        body = body[body.index("[") + 1 : body.rindex("]")]
    rules = []
    for raw in body.splitlines():
        line = re.sub(r'#[^"]*$', "", raw).strip().rstrip(",").strip()
        if not line:
            continue
        for pattern, make in _FORMS:
            m = pattern.match(line)
            if m:
                rules.append(make(m))
                break
        else:
            raise ValueError(f"unsupported rule: {line}")
    return Ruleset(table, tuple(rules))


# ---------------------------------------------------------- evaluation ---
class NotAQuery(ValueError):
    """A rule whose statement would do more than select rows."""


_CURRENT_DATE = re.compile(r"\bcurrent_date\b(\s*\(\s*\))?", re.IGNORECASE)


def with_as_of(sql: str, as_of) -> str:
    """Bind ``current_date`` in rule SQL to a fixed date, for repeatable checks."""
    if as_of is None:
        return sql
    day = str(as_of)[:10]
    return _CURRENT_DATE.sub(f"DATE'{day}'", sql)


def violations(df: DataFrame, sql: str) -> DataFrame:
    """Rows selected by a CustomSql statement over ``df`` bound as ``primary``.

    ``spark.sql`` resolves the view while analysing, so the returned frame
    keeps pointing at ``df`` after the view is dropped; the lock keeps
    concurrent evaluations from swapping the view mid-analysis, and a
    caller's own temp view named ``primary`` is put back afterwards.
    """
    spark = df.sparkSession
    with _VIEW_LOCK:
        previous = None
        if spark.catalog.tableExists("primary") and spark.catalog.getTable("primary").isTemporary:
            previous = spark.table("primary")
        df.createOrReplaceTempView("primary")
        try:
            if not is_query(spark, sql):  # spark.sql would run a command on the spot
                raise NotAQuery("not a query; rules may only select rows")
            return spark.sql(sql)
        finally:
            if previous is not None:
                previous.createOrReplaceTempView("primary")
            else:
                spark.catalog.dropTempView("primary")


def sql_str(v) -> str:
    """A Spark SQL string literal (or NULL)."""
    if v is None:
        return "NULL"
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _row(context, table, rule: Rule, outcome: str, actual: str, n_viol: str, reason: str) -> str:
    """SQL text of one outcome struct; the value arguments are SQL expressions."""
    return (
        f"named_struct('context', {sql_str(context)}, 'table', {sql_str(table)}, "
        f"'rule', {sql_str(rule.text)}, 'rule_type', {sql_str(rule.kind)}, "
        f"'column', CAST({sql_str(rule.column)} AS STRING), 'outcome', CAST({outcome} AS STRING), "
        f"'actual', CAST({actual} AS DOUBLE), 'violations', CAST({n_viol} AS BIGINT), "
        f"'reason', CAST({reason} AS STRING))"
    )


def _custom_row(context, table, rule: Rule, bad: str) -> str:
    """Outcome of a CustomSql rule whose offending rows are counted by ``bad``."""
    return _row(
        context, table, rule,
        f"CASE WHEN {bad} = 0 THEN {sql_str(PASSED)} ELSE {sql_str(FAILED)} END",
        bad,
        bad,
        f"CASE WHEN {bad} > 0 THEN format_string('%d rows selected', {bad}) END",
    )


def _schema_type(schema: StructType, column: str) -> str | None:
    return schema[column].dataType.simpleString() if column in schema.fieldNames() else None


def _quoted(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


_NAMES = r"([\w`]+(?:\s*,\s*[\w`]+)*)"
_FILTER_RULE = re.compile(rf"^\s*SELECT\s+{_NAMES}\s+FROM\s+primary\s+WHERE\s+(.+?)\s*;?\s*$", re.I | re.S)
_KEY_RULE = re.compile(
    rf"^\s*SELECT\s+{_NAMES}\s+FROM\s+primary\s+GROUP\s+BY\s+{_NAMES}\s+HAVING\s+COUNT\s*\(\s*(?:\*|1)\s*\)\s*>\s*1\s*;?\s*$",
    re.I,
)
_MORE_THAN_A_FILTER = re.compile(r"\b(SELECT|GROUP|HAVING|ORDER|LIMIT|OFFSET|UNION|EXCEPT|INTERSECT|WINDOW|OVER)\b", re.I)


def filter_condition(df: DataFrame, sql: str) -> str | None:
    """The condition of a statement that only filters rows of ``primary``, if
    it is one: its violations can be counted beside the other counts."""
    m = _FILTER_RULE.match(sql)
    if not m or _MORE_THAN_A_FILTER.search(m[2]) or "--" in m[2] or "/*" in m[2] or _known(df, m[1]) is None:
        return None
    try:
        df.selectExpr(f"count_if({m[2]})")
    except AnalysisException:
        return None  # reported as the statement's own failure
    return m[2]


def _known(df: DataFrame, names: str) -> list[str] | None:
    """The columns that a list of plain names means, None if one is not there."""
    there = {c.lower(): c for c in df.columns}
    if len(there) < len(df.columns):
        return None
    found = [there.get(n.strip().strip("`").lower()) for n in names.split(",")]
    return None if None in found else found


def repeated_key(df: DataFrame, sql: str) -> list[str] | None:
    """The key of a statement that only selects keys occurring more than once,
    if it is one: the other counts can be made inside its groups."""
    m = _KEY_RULE.match(sql)
    keys = m and _known(df, m[2])
    return keys if keys and _known(df, m[1]) == keys else None


def evaluate(df: DataFrame, ruleset: Ruleset, context: str | None = None, as_of=None) -> DataFrame:
    """Outcome rows (``OUTCOME_SCHEMA``) of every rule of ``ruleset`` on ``df``.

    ``as_of`` (a date) replaces ``current_date`` in CustomSql statements.

    The outcome expressions are generated as SQL text so a ruleset costs a
    handful of driver calls however many rules it has.
    """
    context = context or ruleset.table
    table = ruleset.table
    schema = df.schema
    cols = set(schema.fieldNames())
    passed, failed_ = sql_str(PASSED), sql_str(FAILED)

    complete_cols = sorted({r.column for r in ruleset.rules if r.kind == "IsComplete" and r.column in cols})
    aggs = ["count(1) AS __rows"] + [
        f"count({_quoted(c)}) AS __nn_{i}" for i, c in enumerate(complete_cols)
    ]

    conditions = {}
    for i, rule in enumerate(ruleset.rules):
        if rule.kind == "CustomSql" and (cond := filter_condition(df, with_as_of(rule.sql, as_of))):
            conditions[rule] = f"__bad_{i}"
            aggs.append(f"count_if({cond}) AS __bad_{i}")

    # one key rule groups the rows; all other counts are sums over its groups
    counted = None
    for rule in ruleset.rules:
        if rule.kind == "CustomSql" and rule not in conditions and (keys := repeated_key(df, rule.sql)):
            names = [a.rsplit(" AS ", 1)[1] for a in aggs]
            sums = [f"coalesce(sum({n}), 0) AS {n}" for n in names]
            grouped = df.groupBy(*[F.col(_quoted(k)) for k in keys]).agg(*map(F.expr, aggs))
            counted = grouped.selectExpr(*sums, "count_if(__rows > 1) AS __repeated")
            conditions[rule] = "__repeated"
            break
    if counted is None:
        counted = df.selectExpr(*aggs)

    structs = []
    for rule in ruleset.rules:
        if rule in conditions:
            structs.append(_custom_row(context, table, rule, conditions[rule]))
            continue
        missing = sql_str(f"column {rule.column} not found")
        if rule.kind == "ColumnExists":
            ok = rule.column in cols
            structs.append(_row(context, table, rule, passed if ok else failed_, "NULL", "NULL",
                                "NULL" if ok else missing))
        elif rule.kind == "ColumnDataType":
            actual_t = _schema_type(schema, rule.column)
            want = type_name(str(rule.value))
            ok = actual_t == want
            reason = "NULL" if ok else (
                missing if actual_t is None else sql_str(f"type is {actual_t}, expected {want}")
            )
            structs.append(_row(context, table, rule, passed if ok else failed_, "NULL", "NULL", reason))
        elif rule.kind == "IsComplete":
            if rule.column not in cols:
                structs.append(_row(context, table, rule, failed_, "NULL", "NULL", missing))
                continue
            nn = f"__nn_{complete_cols.index(rule.column)}"
            nulls = f"(__rows - {nn})"
            structs.append(_row(
                context, table, rule,
                f"CASE WHEN {nulls} = 0 THEN {passed} ELSE {failed_} END",
                f"CASE WHEN __rows > 0 THEN round({nn} / __rows, 6) END",
                nulls,
                f"CASE WHEN {nulls} > 0 THEN format_string('%d of %d values are NULL', {nulls}, __rows) END",
            ))
        elif rule.kind == "RowCount":
            threshold = rule.text.split()[-1]
            cmp = f"(__rows {'<>' if rule.op == '!=' else rule.op} {threshold})"
            structs.append(_row(
                context, table, rule,
                f"CASE WHEN {cmp} THEN {passed} ELSE {failed_} END",
                "__rows",
                "NULL",
                f"CASE WHEN NOT {cmp} THEN format_string('row count %d is not {rule.op} {threshold}', __rows) END",
            ))
    parts = []
    if structs:
        parts.append(counted.selectExpr(f"inline(array({', '.join(structs)}))"))
    for rule in ruleset.rules:
        if rule.kind != "CustomSql" or rule in conditions:
            continue
        try:
            bad = violations(df, with_as_of(rule.sql, as_of))
        except (AnalysisException, NotAQuery) as exc:  # the statement's fault: a failed rule, not a failed job
            msg = str(exc).splitlines()[0][:500]
            row = _row(context, table, rule, failed_, "NULL", "NULL", sql_str(f"statement failed: {msg}"))
            parts.append(df.selectExpr("count(1) AS __rows").selectExpr(f"inline(array({row}))"))
            continue
        row = _custom_row(context, table, rule, "__bad")
        parts.append(bad.selectExpr("count(1) AS __bad").selectExpr(f"inline(array({row}))"))
    if not parts:
        return df.sparkSession.createDataFrame([], OUTCOME_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


def evaluate_all(
    tables: dict[str, DataFrame], rulesets: dict[str, Ruleset], context_prefix: str = "", as_of=None
) -> DataFrame:
    """Outcomes of every ruleset on its table, as one frame; never raises on
    failed rules. Rules on a table that is not given fail with that reason."""
    spark = next(iter(tables.values())).sparkSession
    frames = [
        evaluate(tables[name], rs, f"{context_prefix}{name}", as_of)
        if name in tables
        else not_evaluated(spark, rs, f"{context_prefix}{name}", f"table {name} not found")
        for name, rs in rulesets.items()
    ]
    return reduce(DataFrame.unionByName, frames)


def not_evaluated(spark, ruleset: Ruleset, context: str, reason: str) -> DataFrame:
    """A failed outcome for every rule, for a table that is not there."""
    rows = [
        _row(context, ruleset.table, rule, sql_str(FAILED), "NULL", "NULL", sql_str(reason)) for rule in ruleset.rules
    ]
    return spark.range(1).selectExpr(f"inline(array({', '.join(rows)}))")


def failed(outcomes: DataFrame) -> DataFrame:
    return outcomes.filter(F.col("outcome") == FAILED)


def assert_passed(outcomes: DataFrame, fail_on: str = "never") -> None:
    """Raise when rules failed and ``fail_on='any'``; default is to go on."""
    if fail_on == "never":
        return
    bad = failed(outcomes).select("table", "rule").limit(20).collect()
    if bad:
        raise AssertionError(f"data-quality rules failed: {[tuple(r) for r in bad]}")


def completeness(df: DataFrame, table: str) -> DataFrame:
    """NULL count of every column in one pass: (table, column, rows, nulls)."""
    names = df.columns
    aggs = ["count(1) AS __rows"] + [f"count({_quoted(c)}) AS __nn_{i}" for i, c in enumerate(names)]
    rows = ", ".join(
        f"named_struct('table', {sql_str(table)}, 'column', {sql_str(c)}, 'rows', __rows, "
        f"'nulls', __rows - __nn_{i})"
        for i, c in enumerate(names)
    )
    return df.selectExpr(*aggs).selectExpr(f"inline(array({rows}))")
