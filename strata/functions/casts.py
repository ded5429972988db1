"""NULL-tolerant casts.

Staging must turn unparsable raw values into NULL instead of failing the job,
whatever ``spark.sql.ansi.enabled`` says, so every cast goes through
``try_cast``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

_TYPE_NAMES = {
    "int": "int",
    "integer": "int",
    "bigint": "bigint",
    "long": "bigint",
    "string": "string",
    "date": "date",
    "double": "double",
    "float": "float",
    "boolean": "boolean",
    "timestamp": "timestamp",
}


def type_name(t: str | DataType) -> str:
    """Normalise a type given as text or DataType to Spark's simple name."""
    if isinstance(t, DataType):
        return t.simpleString()
    return _TYPE_NAMES.get(t.strip().lower(), t.strip().lower())


def cast_to(column: str | Column, t: str | DataType) -> Column:
    """``try_cast(column AS t)``: NULL when the value does not fit."""
    c = F.col(column) if isinstance(column, str) else column
    return c.try_cast(type_name(t))


def typed_null(t: str | DataType) -> Column:
    """A NULL literal of a given type, used to align union branches."""
    return F.lit(None).cast(type_name(t))
