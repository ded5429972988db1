"""Ad-hoc SQL over the curated layer with a fixed result and error contract.

``sql_run`` takes SQL text and returns a ``QueryResult`` holding the text
and the (lazy) result DataFrame, or raises ``QueryError`` carrying a kind,
an HTTP-like status, a message and suggestions:

* ``refused`` (400): the text is not a query (DDL, DML, SET, ...) while
  read-only mode is on (the default);
* ``query``   (400): parse, analysis or run-time error of the statement
  (unknown table or column, division by zero, a cast that does not fit, ...);
* ``catalog`` (500): the namespace to query does not exist;
* ``internal``(500): anything else.

Read-only mode is checked without running anything: the text must parse as
a subquery (``SELECT * FROM (<text>)``), which only queries do. ``spark.sql``
would otherwise execute commands on the spot.

Rows leave Spark as JSON objects with NULLs kept and dates as ISO text
(``to_rows_json``); the caller decides whether to collect them or to write
them out (``strata.sources.sinks.write_result_files``).
"""

from __future__ import annotations

import json
import re
import threading
import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException, ParseException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERY_ERROR_SUGGESTIONS = (
    "See that every table is spelled as in the layer's description",
    "See that columns exist and that their types fit the functions used",
    "Use try_cast and try_divide where values may not fit",
)

MAX_ROWS = 10_000  # of an answer through the driver
MAX_SECONDS = 900  # of an answer's jobs

_LITERAL = re.compile(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`")


@dataclass
class QueryError(Exception):
    kind: str
    message: str
    status: int = 400
    suggestions: tuple[str, ...] = field(default_factory=tuple)

    def __str__(self) -> str:
        return f"{self.kind}: {self.message}"

    def to_dict(self) -> dict:
        titles = {
            "query": "The query cannot be answered",
            "refused": "Only queries may run here",
            "catalog": "The layer cannot be reached",
            "internal": "The engine failed",
        }
        out = {"error": titles.get(self.kind, self.kind), "details": self.message}
        if self.suggestions:
            out["suggestions"] = list(self.suggestions)
        return out


@dataclass
class QueryResult:
    sql: str
    df: DataFrame

    @property
    def columns(self) -> list[str]:
        return self.df.columns

    def rows_json(self) -> DataFrame:
        return to_rows_json(self.df)

    def fetch(self, limit: int | None = MAX_ROWS, timeout: float | None = None) -> list[dict]:
        """At most ``limit`` rows as dicts (API boundary; None: all of them;
        larger answers are written out). Of columns with one name the last one
        wins, as in any JSON reader. ``timeout`` (seconds) ends the statement's
        jobs."""
        df = self.rows_json()
        if limit is not None:
            df = df.limit(limit)
        with time_bound(df.sparkSession, timeout):
            try:
                return [json.loads(r[0]) for r in df.collect()]
            except (QueryError, ParseException, AnalysisException):
                raise
            except PySparkException as exc:
                raise _run_time_error(exc) from exc


@contextmanager
def time_bound(spark: SparkSession, seconds: float | None):
    """Jobs started inside by this thread are cancelled after ``seconds``;
    the statement then fails with kind ``query``."""
    if seconds is None:
        yield
        return
    sc, tag, late = spark.sparkContext, f"statement-{uuid.uuid4().hex}", threading.Event()

    def stop() -> None:
        late.set()
        sc.cancelJobsWithTag(tag)

    timer = threading.Timer(seconds, stop)
    sc.addJobTag(tag)
    timer.start()
    try:
        yield
    except Exception as exc:
        if late.is_set():
            raise QueryError("query", f"the statement ran longer than {seconds:g} s", 400, QUERY_ERROR_SUGGESTIONS) from exc
        raise
    finally:
        timer.cancel()
        sc.removeJobTag(tag)


def _run_time_error(exc: PySparkException) -> QueryError:
    """Errors with a SQL state are the statement's own; others the engine's."""
    state = exc.getSqlState() or ""
    if state and not state.startswith(("XX", "58")):
        return QueryError("query", _message(exc), 400, QUERY_ERROR_SUGGESTIONS)
    return QueryError("internal", _message(exc), 500)


def to_rows_json(df: DataFrame) -> DataFrame:
    """One JSON object per row, NULL fields kept, column order kept."""
    names = df.columns
    # by position: names may repeat
    by_place = df.toDF(*[f"c{i}" for i in range(len(names))])
    if len(set(names)) == len(names):
        fields = [F.col(f"c{i}").alias(n) for i, n in enumerate(names)]
        return by_place.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("row"))
    pairs = []
    for i, n in enumerate(names):
        one = F.to_json(F.struct(F.col(f"c{i}").alias("v")), {"ignoreNullFields": "false"})
        value = one.substr(F.lit(6), F.length(one) - 6)  # between {"v": and }
        pairs.append(F.concat(F.lit(json.dumps(n, ensure_ascii=False) + ":"), value))
    return by_place.select(F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}")).alias("row"))


def replace_catalog_alias(sql: str, alias: str, catalog: str = "spark_catalog") -> str:
    """Map three-part names ``alias.ns.table`` onto ``catalog.ns.table``
    outside string literals and quoted identifiers."""
    pattern = re.compile(rf"(?<![\w.`]){re.escape(alias)}\s*\.", re.IGNORECASE)
    out, pos = [], 0
    for m in _LITERAL.finditer(sql):
        out.append(pattern.sub(f"{catalog}.", sql[pos : m.start()]))
        out.append(m.group(0))
        pos = m.end()
    out.append(pattern.sub(f"{catalog}.", sql[pos:]))
    return "".join(out)


def is_query(spark: SparkSession, sql: str) -> bool:
    """True when ``sql`` parses as a query (nothing is executed)."""
    try:
        spark.sql(f"SELECT * FROM ({sql}\n) AS __checked")
        return True
    except ParseException:
        return False


def _clean(sql: str) -> str:
    return sql.strip().rstrip(";").strip()


def sql_run(
    spark: SparkSession,
    sql: str,
    read_only: bool = True,
    catalog_alias: str | None = None,
    namespace: str | None = None,
) -> QueryResult:
    """Run caller SQL; see the module docstring for the contract."""
    text = _clean(sql)
    if catalog_alias and not spark.conf.get(f"spark.sql.catalog.{catalog_alias}", None):
        # no catalog of that name: the layer lives in the session catalog
        text = replace_catalog_alias(text, catalog_alias)
    if namespace:
        if not spark.catalog.databaseExists(namespace):
            raise QueryError("catalog", f"namespace {namespace} not found", 500)
        # unqualified names mean this namespace, for this statement only
        before = spark.catalog.currentDatabase()
        spark.catalog.setCurrentDatabase(namespace)
        try:
            return sql_run(spark, sql, read_only, catalog_alias)
        finally:
            spark.catalog.setCurrentDatabase(before)
    try:
        if read_only and not is_query(spark, text):
            try:
                spark.sql(f"EXPLAIN {text}")  # parses without running
            except ParseException as exc:
                raise QueryError("query", _message(exc), 400, QUERY_ERROR_SUGGESTIONS) from exc
            raise QueryError("refused", "only queries (SELECT) may run in read-only mode", 400)
        df = spark.sql(text)
    except QueryError:
        raise
    except (ParseException, AnalysisException) as exc:
        raise QueryError("query", _message(exc), 400, QUERY_ERROR_SUGGESTIONS) from exc
    except Exception as exc:  # noqa: BLE001 - reported, not swallowed
        raise QueryError("internal", _message(exc), 500) from exc
    return QueryResult(sql, df)


def _message(exc: Exception) -> str:
    return str(exc).strip().splitlines()[0] if str(exc).strip() else type(exc).__name__


def respond(
    spark: SparkSession,
    sql: str,
    limit: int | None = MAX_ROWS,
    result_root: str | None = None,
    run_id: str | None = None,
    timeout: float | None = MAX_SECONDS,
    **options,
) -> dict:
    """Contract as a plain dict: ``{"status", "sql", "rows", "truncated"}`` or
    an error. At most ``limit`` rows come through the driver (None: all), and
    ``truncated`` says whether there are more; whole answers go to files. Jobs
    that run longer than ``timeout`` seconds are ended (None: never).

    With ``result_root`` the whole result is also stored as header CSV under
    ``result_root/<run_id>`` (by the executors, not through the driver) and
    the response names that ``output_location``.
    """
    from strata.sources.sinks import write_result_files

    try:
        result = sql_run(spark, sql, **options)
        out = {"status": 200, "sql": result.sql}
        if result_root:
            with time_bound(spark, timeout):
                out["output_location"] = write_result_files(result.df, result_root, run_id or uuid.uuid4().hex)
        rows = result.fetch(None if limit is None else limit + 1, timeout)
        out["truncated"] = limit is not None and len(rows) > limit
        out["rows"] = rows[:limit] if out["truncated"] else rows
        return out
    except QueryError as err:
        return {"status": err.status, "sql": sql, **err.to_dict()}
    except PySparkException as exc:  # while the result was written
        return {"status": (err := _run_time_error(exc)).status, "sql": sql, **err.to_dict()}
