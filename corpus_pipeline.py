"""Corpus pipeline: documents to packed training sequences.

Each stage calls one operator of ``strata.llm`` on all its predecessor kept.
``run`` writes every stage as Parquet into the shared folder and reads it
again as the next one's input.

Defined results, stage by stage: null and empty texts fail the quality rules
and go; of rows that agree in id and text (repeated rows), and of each group
of near copies, one row stays; a text that is all repeated passages goes with
them; texts are read whole, however long; a null source is a source of its
own; an empty table gives an empty result. Columns beside those of
``documents``, whatever they are called, pass the first four stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm.common import stored
from strata.llm.mixing import take_copies
from strata.llm.packing import pack_documents
from strata.llm.quality_rules import kept_rows
from strata.llm.simhash import simhash_keep
from strata.llm.suffix_dedup import without_copies


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return kept_rows(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (its smallest id)."""
    return simhash_keep(docs)


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages stay in their first place only."""
    return without_copies(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return take_copies(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences, token ids included."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", rules_stage),
    ("simhash_near_dedup", simhash_stage),
    ("suffix_array_dedup", suffix_stage),
    ("source_mixing", mixing_stage),
    ("packing", packing_stage),
]

# Fingerprints, suffix order, Newton steps and token ids have no SQL form; the
# pipeline is tested against a plain version (tests/llm/test_pipeline.py).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
