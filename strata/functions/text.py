"""Text tokenisation as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens are maximal runs of letters or digits, lower-cased.
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"


def tokens(text: str | Column) -> Column:
    """Array of lower-case tokens of the whole text (empty strings removed;
    ``array_remove`` stays in generated code, unlike a lambda filter)."""
    c = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.lower(c), TOKEN_SPLIT), "")
