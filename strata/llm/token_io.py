"""Token ids of a corpus in a compressed binary format.

A corpus is a folder of Parquet files in ascending ``doc_id`` order (nulls
first; equal ids by the hash of the text). Every row is one block: whole documents of some
``BLOCK_IDS`` ids, coded by the adaptive range coder, decodable and
checksummed on its own. Beside the block its row has its place
(``part``, ``block``), the ids before it in its part, and its counts, so that
readers find their part of the corpus without decoding.

The texts are sorted by one range partitioning, which deals equal shares of
rows whatever the ids are. A lost executor repeats its tasks; a block is
never shared between tasks.

Defined results: null text is the empty document (its end id only); repeated
rows are documents of their own; a text longer than a block makes a block of
its own; an empty table is a corpus without blocks; other columns are
ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import returning, shared_dir, small_batches
from strata.llm.rangecoder import decode_block, encode_block
from strata.llm.tokens import pieces

END_ID = 2
BLOCK_IDS = 4_000_000
GATHER_CHARS = 6 << 20
BLOCKS = "part int, block long, ids_before long, n_docs long, n_ids long, data binary"


def gathered(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[list, list]]:
    """Ids and texts of whole frames, about ``GATHER_CHARS`` together: the more
    texts at a time, the fewer look-ups of the pieces they share."""
    ids, texts, held = [], [], 0
    for f in frames:
        ids += list(f["doc_id"])
        texts += list(f["text"])
        held += sum(len(t) for t in f["text"] if t)
        if held >= GATHER_CHARS:
            yield ids, texts
            ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def encode_corpus(
    df: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID
) -> DataFrame:
    """The rows of the format (``BLOCKS``), each partition in order."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = pieces(vocabulary)
        symbols = max(known.tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1)
        end = np.array([end_id], known.dtype).tobytes()
        part, block, before, keys, texts, held = TaskContext.get().partitionId(), 0, 0, [], [], 0

        def flush() -> pd.DataFrame:
            ids = np.frombuffer(b"".join(texts), known.dtype)
            lengths = [len(t) // ids.itemsize for t in texts]
            data = encode_block(keys, lengths, ids, symbols)
            return pd.DataFrame(
                [(part, block, before, len(keys), len(ids), data)],
                columns=["part", "block", "ids_before", "n_docs", "n_ids", "data"],
            )

        for ids_of, rows in gathered(frames):
            for d, ids in zip(ids_of, known.many(rows), strict=True):
                ids += end
                n = len(ids) // np.dtype(known.dtype).itemsize
                if keys and held + n > BLOCK_IDS:
                    yield flush()
                    block, before, keys, texts, held = block + 1, before + held, [], [], 0
                keys.append(None if pd.isna(d) else int(d))
                texts.append(ids)
                held += n
        if keys:
            yield flush()

    rows = df.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")
    )
    rows = rows.withColumns({"id": F.col("doc_id").cast("string"), "h": F.xxhash64("text")})
    # the sampled keys are numbers, never texts
    ordered = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text")
    # as text: pandas would turn ids beside nulls into floating point
    return ordered.select(F.col("id").alias("doc_id"), "text").mapInPandas(lambda frames: returning(run(frames)), BLOCKS)


def write_corpus(df: DataFrame, path: str, vocabulary: str, **how) -> None:
    with small_batches(df.sparkSession):
        encode_corpus(df, vocabulary, **how).write.parquet(path)


def read_corpus(spark: SparkSession, path: str, texts: bool = False) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` per document, and ``ids``
    (little-endian unsigned 32-bit, binary) if ``texts``. ``start`` counts the
    ids of all documents before it."""
    blocks = spark.read.schema(BLOCKS).parquet(path)
    schema = "part int, at long, doc_id long, n_tokens long, ids_crc32 long" + (", ids binary" if texts else "")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for part, before, data in zip(f["part"], f["ids_before"], f["data"], strict=True):
                keys, lengths, ids = decode_block(data)
                ends = np.cumsum(lengths)
                spans = list(zip((ends - lengths).tolist(), ends.tolist(), strict=True))
                out = pd.DataFrame(
                    {
                        "part": np.int32(part),
                        "at": ends - lengths + before,
                        "doc_id": pd.array(keys, "Int64"),
                        "n_tokens": lengths,
                        "ids_crc32": [zlib.crc32(ids[i:j]) for i, j in spans],
                    }
                )
                if texts:
                    out["ids"] = [ids[i:j].tobytes() for i, j in spans]
                yield out

    docs = blocks.select("part", "ids_before", "data").mapInPandas(lambda frames: returning(run(frames)), schema)
    # one row a part: parts are the partitions of the writer, so few rows sum here
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    bases = parts.select(
        F.col("part").alias("__p"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base")
    )
    return docs.join(bases, F.col("part") == F.col("__p")).select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if texts else [])
    )


def op1_context_mixing_tokens(spark, sf_dir):
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = f"{shared_dir(spark)}/strata-token-corpus-{uuid.uuid4().hex}"
    write_corpus(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_corpus(spark, path)


QUERIES = {"op1_context_mixing_tokens": op1_context_mixing_tokens}
ORACLE = {}
