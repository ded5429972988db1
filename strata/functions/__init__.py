"""Column expressions shared by the operators (all built-in, JVM side)."""

from strata.functions.casts import cast_to, typed_null
from strata.functions.dates import as_of_date, month_bucket, parse_date

__all__ = ["as_of_date", "cast_to", "month_bucket", "parse_date", "typed_null"]
