"""Mixture-controlled packing into sequences of fixed length.

Documents wait in one queue per source, in table order. Deficit round-robin
serves the queues: every window grants a source ``quantum = window * share``
tokens, its share being its part of all tokens, and the queue sends documents
while its granted tokens cover them. What is granted and not yet sent carries
over into the next window. So with E tokens up to and including a document in
its queue, the document goes out in window ``ceil(E / quantum)``. That needs
no loop: E is the sum over earlier partitions (a table of partitions by
sources) plus the tokens before it in its own partition, so deficits carry
across windows and partitions alike.

The stream of all windows is cut into sequences of ``length`` tokens,
documents being cut where a sequence ends. What remains at the very end is
cut at powers of two, so no sequence holds padding.

Texts are tokenized once; ids and counts are written to the shared folder,
the plan is made from the counts alone, and ids are joined to it by row.

Defined results: null text is the empty document (its end id only); null
sources form a queue; repeated rows and ids are documents of their own; a
document longer than a window or a sequence goes through several of them; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import returning, stored
from strata.llm.tokens import pieces

LENGTH = 4096
WINDOW = 64 * LENGTH
END_ID = 2
_CHUNK = 1 << 10  # windows summed together
_BATCH_BYTES = 16 << 20
TABLE_BYTES = 40 << 20  # of known pieces: what follows this stage needs the memory of its workers


def _ids(f: pd.DataFrame) -> list:
    """Ids come as text: pandas would turn them into floating point beside nulls."""
    return [None if pd.isna(d) else int(d) for d in f["doc_id"]]


def tokenized(df: DataFrame, vocabulary: str, doc_id="doc_id", text="text", source="source", end_id=END_ID) -> DataFrame:
    """``(part, row, doc_id, source, n, before, ids)``: ids with the end id as
    little-endian bytes; ``before``: tokens of the same source earlier in the
    partition."""
    schema = "part int, row long, doc_id long, source string, n long, before long, ids binary"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = pieces(vocabulary, table_bytes=TABLE_BYTES)
        width = np.dtype(known.dtype).itemsize
        end = np.array([end_id], known.dtype).tobytes()
        part, row, sums, out, held = TaskContext.get().partitionId(), 0, {}, [], 0
        for f in frames:
            for d, s, ids in zip(_ids(f), f["source"], known.many(list(f["text"])), strict=True):
                ids += end
                n = len(ids) // width
                s = None if pd.isna(s) else s
                out.append((part, row, d, s, n, sums.get(s, 0), ids))
                sums[s] = sums.get(s, 0) + n
                row += 1
                held += len(ids)
                if held >= _BATCH_BYTES:
                    yield _frame(out)
                    out, held = [], 0
        if out:
            yield _frame(out)
        known.rest()

    def _frame(rows):
        f = pd.DataFrame(rows, columns=["part", "row", "doc_id", "source", "n", "before", "ids"])
        return f.astype({"doc_id": "Int64"})

    rows = df.select(
        F.col(f"`{doc_id}`").cast("long").cast("string").alias("doc_id"),
        F.col(f"`{source}`").cast("string").alias("source"),
        F.col(f"`{text}`").cast("string").alias("text"),
    )
    return rows.mapInPandas(lambda frames: returning(run(frames)), schema)


def planned(counts: DataFrame, window: int = WINDOW) -> tuple[DataFrame, int]:
    """``(part, row, at)``: each document's place in the packed stream, and
    the stream's length, from ``(part, row, source, n, before)``."""
    per_part = stored(counts.groupBy("part", "source").agg(F.sum("n").alias("n")), "pack-parts")
    total = per_part.agg(F.sum("n")).first()[0] or 0
    if not total:
        return counts.selectExpr("part", "row", "0L AS at").limit(0), 0
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shares = per_part.groupBy("source").agg(F.expr(f"sum(n) / {total}D * {window}D").alias("quantum"))
    queue = (
        per_part.withColumn("sent", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .selectExpr("part AS __p", "source AS __s", "sent")
        .join(shares, F.expr("__s <=> source"))
        .select("__p", "__s", "sent", "quantum")
    )
    rows = counts.join(queue, F.expr("part = __p AND source <=> __s")).selectExpr(
        "part", "row", "source", "n", "sent + before AS first",
        "CAST(ceil((sent + before + n) / quantum) AS BIGINT) AS win",
    )
    rows = stored(rows, "pack-rows")
    # what each window sends of each source; then sums over the windows before, in two levels
    cells = rows.groupBy("win", "source").agg(F.sum("n").alias("n"), F.min("first").alias("first"))
    cells = stored(cells.withColumn("chunk", F.expr(f"win div {_CHUNK}")), "pack-cells")
    chunks = cells.groupBy("chunk").agg(F.sum("n").alias("n")).withColumn(
        "ahead", F.sum("n").over(Window.orderBy("chunk")) - F.col("n")
    )
    inside = Window.partitionBy("chunk").orderBy("win", "source")
    bases = cells.withColumn("__in", F.sum("n").over(inside) - F.col("n")).join(chunks.select("chunk", "ahead"), "chunk")
    bases = bases.selectExpr("win AS __w", "source AS __s", "ahead + __in - first AS shift")
    placed = rows.join(bases, F.expr("win = __w AND source <=> __s")).selectExpr("part", "row", "first + shift AS at")
    return placed, total


def _cuts(at: int, n: int, length: int, total: int) -> Iterator[tuple[int, int, int, int]]:
    """``(start, size, sequence, offset)`` of the pieces of ``n`` tokens that
    lie from ``at`` on in a stream of ``total`` tokens."""
    whole = total // length
    start = 0
    while start < n:
        pos = at + start
        seq, off = divmod(pos, length)
        room = length - off
        if seq >= whole:  # the tail: one sequence for each power of two in what remains
            off, left = pos - whole * length, total - whole * length
            seq, bit = whole, 1 << (left.bit_length() - 1)
            while off >= bit:
                off, left, seq = off - bit, left - bit, seq + 1
                bit = 1 << (left.bit_length() - 1)
            room = bit - off
        size = min(n - start, room)
        yield start, size, seq, off
        start += size


def pack_documents(
    df: DataFrame,
    vocabulary: str,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    length: int = LENGTH,
    window: int = WINDOW,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: ``(doc_id, source, start, length, doc_tokens,
    sequence_id, offset, ids)``, ids as little-endian 32-bit integers."""
    docs = stored(tokenized(df, vocabulary, doc_id, text, source, end_id), "pack-ids")
    plan, total = planned(docs.select("part", "row", "source", "n", "before"), window)
    schema = "doc_id long, source string, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        dtype = pieces(vocabulary).dtype
        names = ["doc_id", "source", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
        out, held = [], 0

        def frame(rows):
            return pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

        for f in frames:
            for d, s, n, at, raw in zip(_ids(f), f["source"], f["n"], f["at"], f["ids"], strict=True):
                ids = np.frombuffer(raw, dtype).astype("<u4")
                for start, size, seq, off in _cuts(int(at), int(n), length, total):
                    out.append((d, s, start, size, n, seq, off, ids[start : start + size].tobytes()))
                    held += 4 * size
                if held >= _BATCH_BYTES:
                    yield frame(out)
                    out, held = [], 0
        if out:
            yield frame(out)

    rows = docs.join(plan, ["part", "row"])
    rows = rows.select(F.col("doc_id").cast("string").alias("doc_id"), "source", "n", "at", "ids")
    return rows.mapInPandas(run, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, ids)``: the pieces of each sequence put together."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    # the empty binary first: concat of one binary stays binary
    return parts.select("sequence_id", F.expr("aggregate(p, X'', (a, x) -> a || x.ids)").alias("ids"))


def op10_mixture_packing(spark, sf_dir):
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    packed = pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


QUERIES = {"op10_mixture_packing": op10_mixture_packing}
ORACLE = {}
