"""Queries of the training-data operators and their oracle SQL."""

from __future__ import annotations

from strata.llm import (
    chat_format,
    html_extract,
    mixing,
    packing,
    prefix_trie,
    quality_model,
    quality_rules,
    simhash,
    spelling,
    suffix_dedup,
    token_io,
    warc,
    winnowing,
)

_MODULES = (
    token_io,
    winnowing,
    quality_rules,
    chat_format,
    suffix_dedup,
    simhash,
    quality_model,
    html_extract,
    mixing,
    packing,
    warc,
    spelling,
    prefix_trie,
)

QUERIES = {name: q for m in _MODULES for name, q in m.QUERIES.items()}
ORACLE = {name: sql for m in _MODULES for name, sql in m.ORACLE.items()}
