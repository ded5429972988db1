"""Date parsing and date buckets.

Two parsing modes exist because the staged tables were produced by two
different code paths:

* ``cast``   - ``CAST(x AS DATE)``, NULL on failure. Accepts ``yyyy``,
  ``yyyy-M``, ``yyyy-M-d`` and a trailing time part.
* ``legacy`` - the lenient ``yyyy-MM-dd`` pattern parser of Spark 2
  (``timeParserPolicy=LEGACY``): one- or two-digit month and day, any number
  of year digits, anything after the day ignored, impossible dates NULL.

``legacy`` is written with built-in string functions so it behaves the same
under every session policy (under ``EXCEPTION`` even ``try_to_date`` throws)
and stays inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType

_LEGACY_PREFIX = r"^\s*([0-9]+)-([0-9]+)-([0-9]+)"


def _legacy_from_string(s: Column) -> Column:
    year = F.regexp_extract(s, _LEGACY_PREFIX, 1).try_cast("int")
    month = F.regexp_extract(s, _LEGACY_PREFIX, 2).try_cast("int")
    day = F.regexp_extract(s, _LEGACY_PREFIX, 3).try_cast("int")
    canonical = F.format_string("%04d-%02d-%02d", year, month, day)
    return F.when(year >= 1, canonical.try_cast("date"))


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


_LEGACY_PREFIX_SQL = "'^\\\\s*([0-9]+)-([0-9]+)-([0-9]+)'"


def parse_date_sql(name: str, mode: str = "cast", source_type=None) -> str:
    """SQL text of :func:`parse_date` for a column name (one driver call
    when used in ``selectExpr``)."""
    c = _q(name)
    if isinstance(source_type, DateType):
        return c
    if isinstance(source_type, (TimestampType, TimestampNTZType)):
        return f"to_date({c})"
    if mode == "cast":
        return f"try_cast({c} AS DATE)"
    if mode == "legacy":
        s = c if isinstance(source_type, StringType) else f"try_cast({c} AS STRING)"
        part = [f"try_cast(regexp_extract({s}, {_LEGACY_PREFIX_SQL}, {i}) AS INT)" for i in (1, 2, 3)]
        return (
            f"CASE WHEN {part[0]} >= 1 THEN "
            f"try_cast(format_string('%04d-%02d-%02d', {part[0]}, {part[1]}, {part[2]}) AS DATE) END"
        )
    raise ValueError(f"unknown date mode {mode!r}; use 'cast' or 'legacy'")


def parse_date(column: str | Column, mode: str = "cast", source_type=None) -> Column:
    """Parse a raw value into a DATE, NULL when it is not a date.

    ``source_type`` is the raw column's Spark type when known; date and
    timestamp inputs are returned as their date in every mode.
    """
    if isinstance(column, str):
        return F.expr(parse_date_sql(column, mode, source_type))
    c = column
    if isinstance(source_type, DateType):
        return c
    if isinstance(source_type, (TimestampType, TimestampNTZType)):
        return F.to_date(c)
    if mode == "cast":
        return c.try_cast("date")
    if mode == "legacy":
        s = c if isinstance(source_type, StringType) else c.try_cast("string")
        return _legacy_from_string(s)
    raise ValueError(f"unknown date mode {mode!r}; use 'cast' or 'legacy'")


def month_bucket(column: str | Column) -> Column:
    """``yyyy-MM`` text of a date (the published month grouping)."""
    c = F.col(column) if isinstance(column, str) else column
    return F.date_format(c, "yyyy-MM")


def as_of_date(as_of: str | _dt.date | None = None) -> Column:
    """``current_date()`` or a fixed date for repeatable checks."""
    if as_of is None:
        return F.current_date()
    return F.lit(str(as_of)).cast("date")
