"""Prefix trie of conversations, with a count-min screen before the grouping.

A conversation's prefix of d turns is named by a 128-bit digest, chained turn
by turn. Every distinct prefix is a node. Most prefixes belong to one
conversation alone, and what lies below such a prefix does too; so the rows
that must meet other conversations' rows are few:

1. Turns are dealt by the group of conversations that share first turns,
   sorted, and read as a stream that chains the digests (``prefixes``). Texts
   end here; a row per prefix is written, with the digest of its parent.
2. A count-min sketch counts the digests: two rows of counters, kept as "two
   or more" bits. A count of one in either row proves that a prefix occurs
   once. The sketch has ``CELLS_A_PREFIX`` cells a prefix and row, at most
   ``MOST_CELLS``: so many bits are the most that is broadcast (16 MB). A
   smaller sketch only screens less; results do not depend on it.
3. A prefix whose parent is proved to occur once is a tail: its node is
   emitted where it is. The others are grouped by digest, exactly. So every
   shared node is grouped, and so is the first node of every conversation that
   it shares with none.
4. Leaves and savings are summed over subtrees of shared nodes by pointer
   doubling: after k rounds a node holds the sums of all nodes less than 2^k
   below it, so the rounds follow the logarithm of the depth.
5. The ids ending at a node are sorted across partitions, rendered in bounded
   pieces, and the pieces of a node hashed as a stream.

Grouping is combined map-side, so the root and very common first turns cost
one row a task. A single conversation is read in the order of its turns by
one task, which holds one turn at a time.

Defined results: a null role or text is empty; null turns come first; turns
with one number are ordered by role, then text; repeated rows are turns of
their own; rows with a null id are one conversation, which has no first turns
of another, is written as the empty text among ids and comes first; an empty
table has no nodes, not even a root; texts of any length are hashed whole;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stored

CELLS_A_PREFIX = 8
MOST_CELLS = 1 << 26  # in each of the sketch's two rows
_BUCKET = 1 << 15  # bits in a piece of Spark's bitmap functions
_PIECE_IDS = 4096
_ROOT = bytes(16)
GROUP, MOST_SHARED = 5, 9
PREFIXES = "conv_id long, depth long, digest binary, parent binary, bytes long, ends boolean"


def shared_turns(conv_id: int) -> int:
    """How many first turns a conversation takes from its group's first one."""
    return zlib.crc32(str(conv_id).encode()) % MOST_SHARED


def prefixes(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", shared=shared_turns
) -> DataFrame:
    """One row per conversation and prefix (``PREFIXES``), the root included.
    A conversation c consists of the first ``shared(c)`` (below
    ``MOST_SHARED``) turns of conversation c - c % ``GROUP`` and of its own
    turns after its first ``shared(c)``; ``shared=None``: of its own turns."""
    take = shared or (lambda c: 0)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple] = []
        base, first = None, []  # the conversation others take from, and its first prefixes
        now = None  # (id as text, digest, depth, own turns read, own turns left out)
        held: tuple | None = None  # the last prefix: whether it ends is not known yet

        def begin(c: str | None) -> None:
            nonlocal now, base, first, held
            rows.append((c, 0, _ROOT, None, 0))
            number = None if c is None else int(c)
            n = 0 if number is None else take(number)
            if number is not None and base != number - number % GROUP:
                base, first = number - number % GROUP, []
            digest, depth = _ROOT, 0
            if number is not None and number != base:
                for digest_, size in first[:n]:
                    rows.append((c, depth + 1, digest_, digest, size))
                    digest, depth = digest_, depth + 1
            now = [c, digest, depth, 0, 0 if number is None or number == base else n]

        def out(done: bool) -> pd.DataFrame:
            """All rows but the last, unless its conversation is over."""
            nonlocal rows
            ready, rows = (rows, []) if done else (rows[:-1], rows[-1:])
            nxt = [r[0] for r in ready[1:]] + [rows[0][0] if rows else ()]
            return pd.DataFrame(
                {
                    "conv_id": pd.array([None if r[0] is None else int(r[0]) for r in ready], "Int64"),
                    "depth": np.array([r[1] for r in ready], np.int64),
                    "digest": [r[2] for r in ready],
                    "parent": [r[3] for r in ready],
                    "bytes": np.array([r[4] for r in ready], np.int64),
                    "ends": [r[0] != after for r, after in zip(ready, nxt, strict=True)],
                }
            )

        for f in frames:
            for c, r, t in zip(f["conv"], f["role"], f["text"], strict=True):
                if now is None or c != now[0]:
                    begin(c)
                now[3] += 1
                r, t = r.encode("utf-8", "surrogatepass"), t.encode("utf-8", "surrogatepass")
                if now[3] > now[4]:
                    digest = hashlib.blake2b(now[1] + struct.pack("<Q", len(r)) + r + t, digest_size=16).digest()
                    rows.append((c, now[2] + 1, digest, now[1], len(t)))
                    now[1], now[2] = digest, now[2] + 1
                    if now[0] is not None and int(c) == base and now[3] < MOST_SHARED:
                        first.append((digest, len(t)))
            if len(rows) > 1:
                yield out(False)
        if rows:
            yield out(True)

    c = F.col(f"`{conv}`").cast("long")
    empty = F.lit("")
    turns = df.select(
        c.alias("id"),
        (c - F.pmod(c, F.lit(GROUP))).alias("base"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), empty).alias("role"),
        F.coalesce(F.col(f"`{text}`").cast("string"), empty).alias("text"),
    )
    ordered = turns.repartition("base").sortWithinPartitions("base", "id", "turn", "role", "text")
    # ids as text: pandas would turn ids beside nulls into floating point
    return ordered.select(F.col("id").cast("string").alias("conv"), "role", "text").mapInPandas(run, PREFIXES)


def _cells(width: int) -> list:
    return [F.pmod(F.xxhash64("digest"), F.lit(width)), width + F.pmod(F.xxhash64("digest", F.lit(1)), F.lit(width))]


def shared_bits(rows: DataFrame, width: int) -> np.ndarray:
    """The sketch of ``rows.digest``: a byte for eight of ``2 * width`` cells,
    bits set where the count is two or more."""
    cells = rows.select(F.explode(F.array(*_cells(width))).alias("cell")).groupBy("cell").agg(F.count("*").alias("n"))
    packed = (
        cells.filter("n > 1")
        .groupBy(F.expr("bitmap_bucket_number(cell + 1)").alias("bucket"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(cell + 1))").alias("bits"))
    )
    bits = np.zeros(-(-2 * width // _BUCKET) * (_BUCKET >> 3), np.uint8)
    for r in packed.collect():  # at most 2 * MOST_CELLS bits
        at = (r["bucket"] - 1) * (_BUCKET >> 3)
        bits[at : at + len(r["bits"])] = np.frombuffer(r["bits"], np.uint8)
    return bits


def _screened(rows: DataFrame, cells_a_prefix: int) -> DataFrame:
    """``rows`` with ``alone``: whether the parent is proved to occur once."""
    width = 1 << 10
    n = rows.count()
    while width < min(n * cells_a_prefix, MOST_CELLS):
        width *= 2
    sketch = rows.sparkSession.sparkContext.broadcast(shared_bits(rows, width))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = sketch.value
        for f in frames:
            many = np.ones(len(f), bool)
            for name in ("cell0", "cell1"):
                at = f[name].to_numpy(np.int64)
                many &= (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
            many |= f["depth"].to_numpy() == 0
            yield f[["conv_id", "depth", "digest", "parent", "bytes", "ends"]].assign(alone=~many)

    cells = [c.alias(f"cell{i}") for i, c in enumerate(_cells(width))]
    of_parent = rows.withColumn("kept", F.col("digest")).withColumn("digest", F.coalesce("parent", "digest"))
    ready = of_parent.select(
        F.col("conv_id").cast("string").alias("conv_id"), "depth", F.col("kept").alias("digest"), "parent", "bytes", "ends", *cells
    )
    out = ready.mapInPandas(run, PREFIXES.replace("conv_id long", "conv_id string") + ", alone boolean")
    return out.withColumn("conv_id", F.col("conv_id").cast("long"))


def _hash_of_ids(ends: DataFrame) -> DataFrame:
    """``(digest, ends_sha256)`` of ``(digest, conv_id)``: ids sorted, joined by commas."""

    def render(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        digest, ids = None, []

        def piece() -> tuple:
            return digest, int(ids[0]) if ids[0] else None, ",".join(ids)

        def frame(done: list[tuple]) -> pd.DataFrame:
            digests, at, texts = zip(*done, strict=True)
            return pd.DataFrame({"digest": digests, "at": pd.array(at, "Int64"), "ids": texts})

        for f in frames:
            done = []
            for d, c in zip(f["digest"], f["id"], strict=True):
                d = bytes(d)
                if ids and (d != digest or len(ids) >= _PIECE_IDS):
                    done.append(piece())
                    ids = []
                digest = d
                ids.append(c)
            if done:
                yield frame(done)
        if ids:
            yield frame([piece()])

    def digested(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        digest, sha = None, None
        for f in frames:
            done = []
            for d, ids in zip(f["digest"], f["ids"], strict=True):
                d = bytes(d)
                if d == digest:
                    sha.update(b",")
                else:
                    if digest is not None:
                        done.append((digest, sha.hexdigest()))
                    digest, sha = d, hashlib.sha256()
                sha.update(ids.encode())
            yield pd.DataFrame(done, columns=["digest", "ends_sha256"])
        if digest is not None:
            yield pd.DataFrame([(digest, sha.hexdigest())], columns=["digest", "ends_sha256"])

    ordered = ends.repartitionByRange("digest", "conv_id").sortWithinPartitions("digest", "conv_id")
    texts = ordered.select("digest", F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("id"))
    pieces = texts.mapInPandas(render, "digest binary, at long, ids string")
    sorted_pieces = pieces.repartition("digest").sortWithinPartitions("digest", "at")
    return sorted_pieces.select("digest", "ids").mapInPandas(digested, "digest binary, ends_sha256 string")


def _subtrees(nodes: DataFrame) -> DataFrame:
    """``(digest, leaves, saved)`` summed over each node's subtree, from
    ``(digest, above, leaves, saved)``: own values, and the node above."""
    now = stored(nodes.select("digest", "above", "leaves", "saved"), "trie-sums")
    while not now.filter("above IS NOT NULL").isEmpty():
        below = now.filter("above IS NOT NULL").groupBy(F.col("above").alias("digest")).agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")
        )
        summed = now.join(below, "digest", "left").selectExpr(
            "digest", "above", "leaves + coalesce(more_leaves, 0) AS leaves", "saved + coalesce(more_saved, 0) AS saved"
        )
        hops = now.selectExpr("digest AS above", "above AS further")
        now = stored(summed.join(hops, "above", "left").selectExpr("digest", "further AS above", "leaves", "saved"), "trie-sums")
    return now.select("digest", "leaves", "saved")


def prefix_trie(rows: DataFrame, cells_a_prefix: int = CELLS_A_PREFIX) -> DataFrame:
    """The nodes of ``rows`` (``PREFIXES``): ``conv_id``, ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256``."""
    rows = stored(rows, "trie-prefixes")
    rows = stored(_screened(rows, cells_a_prefix), "trie-screened")
    own = F.sha2(F.when(F.col("ends"), F.coalesce(F.col("conv_id").cast("string"), F.lit(""))).otherwise(""), 256)
    nobody = hashlib.sha256().hexdigest()

    def singles(df: DataFrame, parent) -> DataFrame:
        return df.select(
            "conv_id",
            "depth",
            parent.alias("parent_conv_id"),
            F.lit(1).cast("long").alias("n_convs"),
            F.when(F.col("ends"), 0).otherwise(1).cast("long").alias("n_children"),
            F.lit(1).cast("long").alias("n_leaves"),
            F.lit(0).cast("long").alias("saved_tokens"),
            own.alias("ends_sha256"),
        )

    tails = singles(rows.filter("alone"), F.col("conv_id"))
    met = rows.filter("NOT alone")
    nodes = stored(
        met.groupBy("digest").agg(
            F.min("conv_id").alias("conv_id"),
            F.min("depth").alias("depth"),
            F.min("parent").alias("parent"),
            F.min("bytes").alias("bytes"),
            F.count("*").alias("n"),
            F.max("ends").alias("ends"),
        ),
        "trie-nodes",
    )
    above = nodes.filter("n > 1").selectExpr("digest AS parent", "conv_id AS parent_conv_id", "true AS shared")
    # a parent that is not shared belongs to the same conversation
    placed = stored(nodes.join(above, "parent", "left"), "trie-placed")
    alone = placed.filter("n = 1")
    firsts = singles(alone, F.when(F.col("shared"), F.col("parent_conv_id")).when(F.col("depth") > 0, F.col("conv_id")))
    children = placed.filter("shared").groupBy(F.col("parent").alias("digest")).agg(
        F.count("*").alias("n_children"), F.count_if(F.col("n") == 1).alias("single")
    )
    shared = placed.filter("n > 1").join(children, "digest", "left")
    shared = shared.withColumns(
        {
            "n_children": F.coalesce("n_children", F.lit(0)),
            "leaves": F.when(F.col("n_children").isNull(), 1).otherwise(F.col("single")).cast("long"),
            "saved": (F.col("n") - 1) * F.col("bytes"),
        }
    )
    shared = stored(shared.drop("shared", "single"), "trie-shared")
    sums = _subtrees(shared.select("digest", F.col("parent").alias("above"), "leaves", "saved"))
    hashes = stored(_hash_of_ids(met.filter("ends").select("digest", "conv_id")), "trie-ends")
    inner = shared.drop("leaves", "saved").join(sums, "digest").join(hashes, "digest", "left")
    inner = inner.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        F.col("n").alias("n_convs"),
        "n_children",
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nobody)).alias("ends_sha256"),
    )
    return tails.unionByName(firsts).unionByName(inner)


def op13_prefix_trie(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return prefix_trie(prefixes(table))


def _oracle() -> str:
    from strata.llm.spelling import CRC_TABLE_SQL, crc32_sql

    return f"""
WITH {CRC_TABLE_SQL}, turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, encode(coalesce(role, '')), encode(coalesce(text, ''))) AS i
  FROM conversations
), convs AS (
  SELECT c, c - c % {GROUP} AS base, {crc32_sql("CAST(c AS VARCHAR)")} % {MOST_SHARED} AS h FROM (SELECT DISTINCT c FROM turns), crc
), sizes AS (
  SELECT c, count(*) AS n FROM turns GROUP BY c
), rebuilt AS (
  SELECT v.c, t.i AS d, t.role, t.text FROM convs v JOIN turns t ON t.c = v.base AND t.i <= v.h
  UNION ALL
  SELECT v.c, t.i - v.h + least(v.h, coalesce(s.n, 0)), t.role, t.text
  FROM convs v JOIN turns t ON t.c = v.c AND t.i > v.h LEFT JOIN sizes s ON s.c = v.base
), paths AS (
  SELECT c, d, text, list(sha256(role || chr(10) || text)) OVER (PARTITION BY c ORDER BY d) AS path FROM rebuilt
  UNION ALL SELECT c, 0, '', [] FROM convs
), members AS (
  SELECT *, max(d) OVER (PARTITION BY c) = d AS last FROM paths
), nodes AS (
  SELECT path, any_value(d) AS d, min(c) AS conv_id, count(*) AS n, (count(*) - 1) * any_value(strlen(text)) AS saved,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE last), '')) AS ends_sha256
  FROM members GROUP BY path
), children AS (
  SELECT path[:len(path) - 1] AS path, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1
), tree AS (
  SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN children k ON k.path = n.path
), upward AS (
  SELECT path[:k] AS path, saved, CAST(n_children = 0 AS INT) AS leaf FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM tree)
), sums AS (
  SELECT path, sum(saved) AS saved, sum(leaf) AS leaves FROM upward GROUP BY path
)
SELECT t.conv_id, CAST(t.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, t.n AS n_convs, CAST(t.n_children AS BIGINT) AS n_children,
       CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, t.ends_sha256
FROM tree t JOIN sums s ON s.path = t.path LEFT JOIN tree p ON t.d > 0 AND p.path = t.path[:len(t.path) - 1]
"""


QUERIES = {"op13_prefix_trie": op13_prefix_trie}
ORACLE = {"op13_prefix_trie": _oracle()}
