"""SimHash near-duplicate groups by pigeonhole blocks.

A text's words (ASCII lower case) give shingles of ``shingle`` words, repeats
included; each is hashed with XXH64 (seed 42), and bit i of the 64-bit
fingerprint is set when over half the hashes have it.

Two fingerprints at Hamming distance ``d`` or less, cut into ``blocks`` > d
blocks, agree on at least ``blocks - d`` of them. So every choice of
``blocks - d`` blocks is one key, and close pairs share a key for sure; the
distance is then verified. More blocks mean longer keys and fewer chance
meetings, but more keys: for distance 4, 6 blocks give 15 keys of 20 bits or
more, 7 give 35 of 27 and 8 give 70 of 32. The meetings of a key grow with the
square of the fingerprints over its values, so the number of blocks follows
the number of distinct fingerprints (``blocks_for``); results do not depend
on it.

Only distinct fingerprints are linked, so copies cost one row each. A key
with many fingerprints is first tied to its smallest one (a star: one row per
fingerprint); after contracting those stars, the pairwise join of a key emits
only links between fingerprints not yet in one component. So a large group of
near copies does not emit all its pairs, no link between components is lost,
and the join's hot partitions can be split by adaptive execution.

Defined results: null text and text without words have fingerprint zero,
linked like any other; texts shorter than a shingle hash their whole word
sequence; texts of any length are read whole, their shingles counted in
chunks; repeated rows each get a row; the component is the smallest ``doc_id``
of its rows (null only if all are null); an empty table gives an empty result;
other columns are ignored by ``simhash_groups`` and kept by ``simhash_keep``,
which of rows that agree in id and text keeps the least by the hash of the
whole row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import returning, row_hashes, stored
from strata.llm.components import connected_components

SHINGLE = 4
MAX_BITS = 4
_SHARING = 16
_CHUNK = 1 << 15  # shingle hashes counted at a time


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit SimHash of one text."""
    # bytes.lower() and bytes.split() know ASCII only: A-Z, and the six blanks
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(line, 42)  # one hash: each bit is over half of one
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[: -shingle] + 1))
    spans = list(zip(starts.tolist(), ends[shingle - 1 :].tolist(), strict=True))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(spans), _CHUNK):
        part = np.array([digest(line[i:j], 42) for i, j in spans[at : at + _CHUNK]], "<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(spans), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, h, fp)``, one row per row: the hash of the text as it is, and
    the fingerprint as a signed long."""

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            fp = np.array([fingerprint(t, shingle) for t in f["text"]], np.uint64).view(np.int64)
            yield pd.DataFrame({"id": f["id"], "no_id": f["no_id"], "h": f["h"], "fp": fp})

    whole = F.col(f"`{text}`").cast("string")
    rows = df.select(*_id_columns(doc_id), F.xxhash64(whole).alias("h"), whole.alias("text"))
    out = rows.mapInPandas(lambda frames: returning(batches(frames)), "id long, no_id boolean, h long, fp long")
    return out.selectExpr("IF(no_id, NULL, id) AS doc_id", "h", "fp")


def _id_columns(doc_id: str) -> list:
    """An id without nulls: exact in pandas, and a plain join key."""
    c = F.col(f"`{doc_id}`").cast("long")
    return [F.coalesce(c, F.lit(0)).alias("id"), c.isNull().alias("no_id")]


def _masks(blocks: int, max_bits: int) -> list[int]:
    """One 64-bit mask per choice of ``blocks - max_bits`` blocks."""
    cuts = [round(i * 64 / blocks) for i in range(blocks + 1)]
    one = [((1 << cuts[i + 1]) - (1 << cuts[i])) for i in range(blocks)]
    return [sum(c) for c in combinations(one, blocks - max_bits)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def blocks_for(fingerprints: int, max_bits: int = MAX_BITS) -> int:
    """The least number of blocks, two more than the distance or more, whose
    keys have at most about ``_SHARING`` fingerprints a value."""
    blocks = max_bits + 2
    while blocks < max_bits + 6 and fingerprints > _SHARING << (64 * (blocks - max_bits) // blocks - 1):
        blocks += 1
    return min(blocks, 64)


def simhash_links(fps: DataFrame, max_bits: int = MAX_BITS, blocks: int | None = None) -> DataFrame:
    """``(node, component)`` of the distinct ``fp`` values: see
    ``connected_components``."""
    blocks = blocks or blocks_for(fps.agg(F.approx_count_distinct("fp")).first()[0], max_bits)
    if not max_bits < blocks <= 64:
        raise ValueError("the pigeonhole needs more blocks than differing bits, and at most 64")
    close = f"bit_count(x.fp ^ y.fp) <= {max_bits}"
    masks = ", ".join(f"{_signed(m)}L" for m in _masks(blocks, max_bits))
    keys = fps.select("fp").distinct().selectExpr(
        "fp", f"posexplode(transform(array({masks}), m -> fp & m)) AS (part, bits)"
    ).selectExpr("fp", "xxhash64(part, bits) AS key")
    # keys of one fingerprint link nothing
    shared = keys.groupBy("key").agg(F.min("fp").alias("first"), F.count("*").alias("n")).filter("n > 1")
    members = stored(keys.join(shared.select("key", "first"), "key"), "simhash-keys")
    star = connected_components(
        members.filter(f"fp != first AND bit_count(fp ^ first) <= {max_bits}").select("fp", "first"), "fp", "first"
    )
    named = members.select("key", "fp").join(star.withColumnRenamed("node", "fp"), "fp", "left")
    named = stored(named.selectExpr("key", "fp", "coalesce(component, fp) AS component"), "simhash-named")
    links = named.alias("x").join(
        named.alias("y"), F.expr(f"x.key = y.key AND x.component < y.component AND {close}")
    )
    across = links.selectExpr("x.component AS a", "y.component AS b").distinct()
    return connected_components(star.selectExpr("node AS a", "component AS b").union(across), "a", "b")


def _grouped(df: DataFrame, doc_id: str, text: str, shingle: int, max_bits: int, blocks: int | None) -> DataFrame:
    """``(doc_id, h, fp, component, component_id)``: ``component`` names the
    group by its smallest fingerprint, ``component_id`` by its smallest id."""
    rows = stored(fingerprints(df, doc_id, text, shingle), "simhash-rows")
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    linked = simhash_links(rows, max_bits, blocks)
    named = classes.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
    named = stored(named.selectExpr("fp", "least", "coalesce(component, fp) AS component"), "simhash-classes")
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_fp = stored(named.join(ids, "component").select("fp", "component", "component_id"), "simhash-ids")
    return rows.join(by_fp, "fp").select("doc_id", "h", "fp", "component", "component_id")


def simhash_groups(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    blocks: int | None = None,
) -> DataFrame:
    """``(doc_id, fp, component_id)``, one row per input row."""
    return _grouped(df, doc_id, text, shingle, max_bits, blocks).select("doc_id", "fp", "component_id")


def simhash_keep(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    blocks: int | None = None,
) -> DataFrame:
    """The rows of ``df`` that stay: of each group the one with the smallest
    ``doc_id`` (null ids last; among equal ids the least text by hash)."""
    groups = _grouped(df, doc_id, text, shingle, max_bits, blocks)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), "h"))
    heads = groups.groupBy("component").agg(first.alias("head")).select("head.*")
    key = ["id", "no_id", "h"]  # without nulls: one exchange serves both the grouping and the join
    rows = df.select(
        F.struct("*").alias("__row"),
        *_id_columns(doc_id),
        F.xxhash64(F.col(f"`{text}`").cast("string")).alias("h"),
        F.struct(*row_hashes(df)).alias("__all"),
    )
    # rows may agree in id and text: the least by hash, chosen map-side first, so many of them are one row a task
    alone = rows.groupBy(*key).agg(F.min_by("__row", "__all").alias("__row"))
    return alone.join(heads, key).select("__row.*")


def op6_simhash_near_dedup(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    groups = simhash_groups(docs)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op6_simhash_near_dedup": op6_simhash_near_dedup}
ORACLE = {}
