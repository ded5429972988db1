"""Repeated passages by sparse suffix arrays.

Of all positions of a text only those are kept whose ``GRAM``-word hash is
the least of some ``MIN_WORDS - GRAM + 1`` neighbouring ones (minimisers;
ties: the rightmost). They depend on the words alone, so any two equal
passages of ``MIN_WORDS`` words keep a common position, one with ``GRAM``
words or more of the passage from there on.

The suffixes at positions whose gram occurs again are sorted over the whole
corpus: Spark range-partitions and sorts them by their text (then by what
stands before them, and by document), so a hot passage is split between
partitions like any other stretch of the order. A window of ``MIN_WORDS``
words around a kept position has ``r`` words from there on and the rest before
it. Suffixes that begin with the same ``r`` words are neighbours, so the scan
keeps, for every ``r`` from ``GRAM`` to ``MIN_WORDS``, the earliest suffix of
each left part among the neighbours that share ``r`` words, and compares every
suffix with all of them. Windows that may go on in another partition are
grouped by their words in one more, small, round. So every window that occurs
earlier is found, and the spans do not depend on the partitions.

A suffix row carries ``MIN_WORDS`` words to the right and as many as a passage
can have before its first kept position to the left. Longer matches are
covered by the rows of their further positions, which are never farther
apart, so their length is not bounded.

Of two matching occurrences the later one (by document id, then hash of the
text, then position) is the copy. The earlier one named is the first of its
sort partition. Removing all copies never loses text: each
points to an earlier occurrence of the same words, and the first is no copy.

Defined results: null and empty texts have no words; texts shorter than
``MIN_WORDS`` words have no passages; a passage repeated within one text is a
copy of its first occurrence; rows that agree in id and text are one
document; null ids come first; an empty table has no passages. Words are
compared exactly, blanks between them do not matter. Texts are read whole,
however long; other columns are ignored, or pass ``without_copies``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import returning, stored

MIN_WORDS = 50
GRAM = 25
_BASE = 0x9E3779B97F4A7C15  # odd: invertible modulo 2^64
_BATCH_ROWS = 20_000
_MOST_HELD = 400_000  # windows kept by a scan; more are handed to the round of the partitions' edges
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()  # bytes split at the six ASCII blanks


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``_BASE**i`` and its inverse, modulo 2^64, for i < n."""
    up, down = np.full(n, _BASE, np.uint64), np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
    if n:
        up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def kept_positions(words: list[bytes], gram: int = GRAM, min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Minimiser positions (ascending) and their gram hashes (signed)."""
    n, span = len(words), min_words - gram + 1
    if n < min_words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(w) for w in words], np.uint64)
    up, down = _powers(n + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * up[:n], dtype=np.uint64)))
    rolled = (sums[gram:] - sums[:-gram]) * down[: n - gram + 1]
    rolled ^= rolled >> np.uint64(31)
    rolled *= np.uint64(0xBF58476D1CE4E5B9)
    rolled ^= rolled >> np.uint64(29)
    # the rightmost least of every window: the first least seen from the right
    back = np.lib.stride_tricks.sliding_window_view(rolled[::-1], span)
    chosen = np.unique(len(rolled) - 1 - (back.argmin(axis=1) + np.arange(len(back))))
    return chosen, rolled[chosen].view(np.int64)


def _rows(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    t = F.col(f"`{text}`").cast("string")
    return df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.xxhash64(t).alias("h"), t.alias("text"))


def _ids_as_text(df: DataFrame) -> DataFrame:
    """Before pandas: it would turn ids beside nulls into floating point."""
    return df.withColumn("doc_id", F.col("doc_id").cast("string"))


def _ids(f: pd.DataFrame) -> list:
    return [None if pd.isna(d) else int(d) for d in f["doc_id"]]


def _grams(df: DataFrame, gram: int, min_words: int) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for d, h, t in zip(_ids(f), f["h"], f["text"], strict=True):
                at, key = kept_positions(_words(t), gram, min_words)
                if len(at):
                    out = pd.DataFrame({"h": np.int64(h), "at": at.astype(np.int32), "gram": key})
                    out.insert(0, "doc_id", pd.array([d] * len(at), "Int64"))
                    yield out

    def joined(frames):
        held, n = [], 0
        for f in run(frames):
            held.append(f)
            n += len(f)
            if n >= _BATCH_ROWS:
                yield pd.concat(held)
                held, n = [], 0
        if held:
            yield pd.concat(held)

    return _ids_as_text(df).mapInPandas(lambda frames: returning(joined(frames)), "doc_id long, h long, at int, gram long")


def _suffixes(df: DataFrame, gram: int, min_words: int) -> DataFrame:
    """Rows ``(doc_id, h, at, suffix, before)``: the text of ``min_words`` words
    from ``at`` on, and of up to ``min_words - gram`` words before, the
    nearest first. A blank ends every word, the last one too: so texts that
    begin with the same words are neighbours whatever bytes the words hold."""
    lead = min_words - gram
    names = ["doc_id", "h", "at", "suffix", "before"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = []
        for f in frames:
            for d, h, t, places in zip(_ids(f), f["h"], f["text"], f["places"], strict=True):
                words = _words(t)
                for at in places:
                    at = int(at)
                    before = words[max(0, at - lead) : at]
                    before.reverse()
                    out.append((d, h, at, _ended(words[at : at + min_words]), _ended(before)))
                if len(out) >= _BATCH_ROWS:
                    yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})
                    out = []
        if out:
            yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})

    return _ids_as_text(df).mapInPandas(lambda frames: returning(run(frames)), "doc_id long, h long, at int, suffix binary, before binary")


def _ended(words: list[bytes]) -> bytes:
    return b" ".join(words) + b" " if words else b""


_NULL_FIRST = -(1 << 63)


class _Suffix:
    __slots__ = ("doc", "h", "at", "suffix", "before", "order", "words")

    def __init__(self, doc, h, at, suffix, before):
        self.doc, self.h, self.at, self.suffix, self.before = doc, h, at, suffix, before
        self.order = (_NULL_FIRST if doc is None else doc, h, at)
        self.words = suffix.count(b" ")


def _common(a: _Suffix, b: _Suffix) -> int:
    """Equal words at the start of two suffixes."""
    if a.suffix == b.suffix:
        return a.words
    n = 0
    for x, y in zip(a.suffix.split(b" "), b.suffix.split(b" "), strict=False):
        if x != y:
            break
        n += 1
    return min(n, a.words, b.words)


_MATCH = "doc_id long, h long, first int, last int, of_doc_id long, of_h long, of_first int, edge binary"
_MATCH_NAMES = ["doc_id", "h", "first", "last", "of_doc_id", "of_h", "of_first", "edge"]


def _copy(a: _Suffix, b: _Suffix, left: int, right: int) -> tuple:
    """The row of ``b``, a copy of ``a`` from ``left`` words before to ``right`` words on."""
    return (b.doc, b.h, b.at - left, b.at + right, a.doc, a.h, a.at - left, None)


def _window(s: _Suffix, left: int, right: int) -> tuple:
    """The row of a window for the round of the edges, with its words."""
    words = s.before.split(b" ")[:left][::-1] + s.suffix.split(b" ")[:right]
    return (s.doc, s.h, s.at - left, s.at + right, None, 0, 0, b" ".join(words))


def _beside(rows: Iterator[_Suffix], most: int) -> Iterator[tuple[_Suffix, int, int]]:
    """Each suffix with its equal words with the one before and the one after
    (``most`` beyond the ends: another partition may go on there)."""
    s, back = next(rows, None), most
    while s is not None:
        after = next(rows, None)
        ahead = most if after is None else _common(s, after)
        yield s, back, ahead
        s, back = after, ahead


def _copies(members: list[tuple[_Suffix, int, list]], min_words: int) -> Iterator[tuple]:
    """Rows of the copies among ``members``, each with its groups by rising ``r``."""
    for s, least, groups in members:
        spans: dict[int, list] = {}
        for r, (e,) in enumerate(groups, least):
            if e.order < s.order:
                spans.setdefault(id(e), [e, r, r])[2] = r
        for e, low, high in spans.values():  # equal at both, so at all between
            yield _copy(e, s, min_words - low, high)


def _scan(rows: Iterator[_Suffix], gram: int, min_words: int, most_held: int = _MOST_HELD) -> Iterator[tuple]:
    """Rows of the copies among sorted suffixes, and (``edge`` set) of the
    windows that may occur in other partitions too.

    ``open_[r]`` holds, for the neighbours so far that share ``r`` words, a
    group for each left part of ``min_words - r`` words: windows around two
    suffixes are equal if and only if they meet in one of these. A group knows
    its earliest member; all others are copies of it, given when no neighbour
    shares ``gram`` words any more.
    """
    lengths = range(gram, min_words + 1)
    open_: dict[int, dict[bytes, list[_Suffix]]] = {r: {} for r in lengths}
    cut = dict.fromkeys(lengths, True)  # not all of these neighbours were seen here
    members: list[tuple[_Suffix, int, list]] = []
    held, prev, groups, least = 0, None, None, gram

    def windows(r: int) -> list[tuple]:
        return [_window(e, min_words - r, r) for (e,) in open_[r].values()]

    for s, back, ahead in _beside(rows, min_words):
        # the same windows as the one before, which comes first in the order too
        if groups is None or s.suffix != prev.suffix or s.before != prev.before:
            for r in range(max(gram, back + 1), min_words + 1):
                if open_[r]:
                    if cut[r]:
                        yield from windows(r)
                    open_[r].clear()
                cut[r] = False
            if back < gram:
                yield from _copies(members, min_words)
                members.clear()
                held = 0
            ends, at = [0], 0
            while (at := s.before.find(b" ", at) + 1) > 0:
                ends.append(at)
            least, groups = max(gram, min_words - len(ends) + 1), []
            # more words than either neighbour shares, nobody shares
            for r in range(least, min(s.words, max(back, ahead)) + 1):
                group = open_[r].setdefault(s.before[: ends[min_words - r]], [s])
                if s.order < group[0].order:
                    group[0] = s
                groups.append(group)
            held += len(groups)
        prev = s
        if groups:
            members.append((s, least, groups))
            held += 1
        if held > most_held:
            yield from _copies(members, min_words)
            members.clear()
            for r in lengths:
                yield from windows(r)
                open_[r].clear()
                cut[r] = True
            held, groups = 0, None
    yield from _copies(members, min_words)
    for r in lengths:
        yield from windows(r)


def _sorted_matches(rows: DataFrame, gram: int, min_words: int) -> DataFrame:
    """Matches of ``rows`` in their partitions' order, and (``edge`` set) the
    windows at the partitions' edges."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def each() -> Iterator[_Suffix]:
            for f in frames:
                columns = (_ids(f), f["h"], f["at"], f["suffix"], f["before"])
                for d, h, at, s, b in zip(*columns, strict=True):
                    yield _Suffix(d, int(h), int(at), bytes(s), bytes(b))

        out = []
        for row in _scan(each(), gram, min_words):
            out.append(row)
            if len(out) >= _BATCH_ROWS:
                yield _frame(out)
                out = []
        if out:
            yield _frame(out)

    def _frame(out):
        return pd.DataFrame(out, columns=_MATCH_NAMES).astype({"doc_id": "Int64", "of_doc_id": "Int64"})

    return _ids_as_text(rows).mapInPandas(lambda frames: returning(run(frames)), _MATCH)


def _edge_matches(edges: DataFrame) -> DataFrame:
    """Edge windows that are copies of the earliest with the same words. A
    partition gives a window once (and once more each time it held too many)."""
    order = [F.col("doc_id").asc_nulls_first(), F.col("h"), F.col("first")]
    earliest = F.first(F.struct("doc_id", "h", "first")).over(Window.partitionBy("edge").orderBy(*order))
    named = edges.withColumn("of", earliest)
    copies = named.filter("NOT (doc_id <=> of.doc_id AND h = of.h AND first = of.first)")
    return copies.selectExpr(
        "doc_id", "h", "first", "last", "of.doc_id AS of_doc_id", "of.h AS of_h", "of.first AS of_first"
    )


def repeated_passages(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, gram: int = GRAM
) -> DataFrame:
    """``(doc_id, h, first, last, of_doc_id, of_h, of_first)``: words
    ``first`` to ``last`` (excluded) of the document are a copy of the words
    from ``of_first`` on of an earlier place. ``h`` is the text's hash."""
    docs = _rows(df, doc_id, text)
    grams = stored(_grams(docs, gram, min_words), "suffix-grams")
    # written, so that the join deals both sides alike and the partition of a hot gram can be split
    again = stored(grams.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1").select("gram"), "suffix-again")
    places = grams.join(again, "gram").groupBy("doc_id", "h").agg(F.collect_set("at").alias("places"))
    places = places.withColumnsRenamed({"doc_id": "__d", "h": "__h"})
    # rows equal in id and text are one document: any of them will do
    with_text = docs.join(places, F.expr("h = __h AND doc_id <=> __d")).select("doc_id", "h", "text", "places")
    suffixes = _suffixes(with_text, gram, min_words)
    # in the order of the sort, so neighbours stay together; equal ones may go to several partitions, by document
    ordered = suffixes.repartitionByRange("suffix", "before", "doc_id").sortWithinPartitions(
        "suffix", "before", "doc_id", "h", "at"
    )
    found = stored(_sorted_matches(ordered, gram, min_words), "suffix-matches")
    edges = _edge_matches(found.filter("edge IS NOT NULL").select("doc_id", "h", "first", "last", "edge"))
    return found.filter("edge IS NULL").drop("edge").union(edges)


def without_copies(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``df`` with copies of passages cut out of ``text`` (``n_chars``, if
    there, counted anew). Rows that are copies as a whole are dropped; rows
    without words stay as they are."""
    found = repeated_passages(df, doc_id, text, **how)
    spans = found.groupBy("doc_id", "h").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    spans = spans.withColumnsRenamed({"doc_id": "__d", "h": "__h"})
    key = F.xxhash64(F.col(f"`{text}`").cast("string"))
    rows = df.select(F.struct("*").alias("row"), F.col(f"`{doc_id}`").cast("long").alias("d"), key.alias("h"))
    rows = rows.join(spans, F.expr("h = __h AND d <=> __d"), "left")

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([_cut(t, s) for t, s in zip(texts, spans, strict=True)], dtype=object)

    changed = rows.withColumn("kept", F.when(F.col("spans").isNull(), F.col(f"row.`{text}`")).otherwise(
        cut(F.col(f"row.`{text}`"), F.col("spans"))
    ))
    # a text with copies and nothing else is gone
    changed = changed.filter("spans IS NULL OR kept != ''")

    def column(c: str):
        if c == text:
            return F.col("kept").alias(c)
        if c == "n_chars":
            whole = F.when(F.col("spans").isNull(), F.col("row.n_chars")).otherwise(F.length("kept"))
            return whole.cast(df.schema[c].dataType).alias(c)
        return F.col(f"row.`{c}`").alias(c)

    return changed.select(*[column(c) for c in df.columns])


def _cut(text: str | None, spans) -> str | None:
    """``text`` without the words of ``spans``, each with the blanks after it."""
    if spans is None or text is None:
        return text
    starts = [m.start() for m in _WORD.finditer(text)] + [len(text)]
    gone = np.zeros(len(starts), np.int64)
    for s in spans:
        gone[s["first"]] += 1
        gone[s["last"]] -= 1
    gone = np.cumsum(gone) > 0
    out, at = [text[: starts[0]]], 0
    for i in range(len(starts) - 1):
        if gone[i]:
            out.append(text[starts[at] : starts[i]] if i > at else "")
            at = i + 1
    out.append(text[starts[at] :] if at < len(starts) else "")
    return "".join(out).strip(" \t\n\x0b\f\r")


def merged_passages(found: DataFrame) -> DataFrame:
    """``(doc_id, h, first, last, of_doc_id)``: overlapping or touching copies
    of a document joined into one; ``of_doc_id`` is the least document that
    one of them is a copy of."""
    order = Window.partitionBy("doc_id", "h").orderBy("first", "last", "of_doc_id", "of_first")
    reach = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col("first") <= reach, 0).otherwise(1)
    numbered = found.withColumn("__opens", opens).withColumn("__n", F.sum("__opens").over(order))
    return numbered.groupBy("doc_id", "h", "__n").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.min("of_doc_id").alias("of_doc_id")
    ).drop("__n")


def op5_suffix_passages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = merged_passages(repeated_passages(docs))
    return found.selectExpr("doc_id", "first AS first_word", "last AS end_word", "of_doc_id")


QUERIES = {"op5_suffix_passages": op5_suffix_passages}
ORACLE = {}
