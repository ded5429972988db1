"""Packing: every id once, full sequences, proportions by window."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from strata.llm.packing import _cuts, op10_mixture_packing, pack_documents, sequences
from tests.llm.conftest import tricky_rows

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(rows):
    t = Tokenizer.from_file(PATH)
    return [t.encode(r[1] or "", add_special_tokens=False).ids + [2] for r in rows]


def whole(pieces, length):
    """Gapless sequences, each full or a power of two."""
    by = defaultdict(list)
    for p in pieces:
        by[p["sequence_id"]].append((p["offset"], p["length"]))
    assert sorted(by) == list(range(len(by)))
    padding = 0
    for spans in by.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at and n > 0
            at += n
        assert at <= length
        padding += 0 if at & (at - 1) == 0 else length - at
    return padding


def test_query_against_the_library(spark, folder):
    rows = tricky_rows()
    got = op10_mixture_packing(spark, folder).collect()
    assert whole(got, 4096) == 0
    want = defaultdict(list)
    for r, ids in zip(rows, ids_of(rows), strict=True):
        want[r[0]].append(ids)
    pieces = defaultdict(list)
    for p in got:
        pieces[p["doc_id"], p["doc_tokens"]].append(p)
    assert sum(p["length"] for p in got) == sum(len(i) for v in want.values() for i in v)
    for (d, n), parts in pieces.items():
        assert any(len(i) == n for i in want[d])
        for p in parts:
            part = [np.array(i[p["start"] : p["start"] + p["length"]], "<u4") for i in want[d] if len(i) == n]
            assert p["ids_crc32"] in {zlib.crc32(x.tobytes()) for x in part}


def test_sequences_hold_their_pieces(spark, tricky, empty):
    packed = pack_documents(tricky, PATH, length=256, window=1024).cache()
    pieces = packed.collect()
    assert whole(pieces, 256) == 0
    stream = {r["sequence_id"]: np.frombuffer(r["ids"], "<u4") for r in sequences(packed).collect()}
    for p in pieces:
        at = stream[p["sequence_id"]][p["offset"] : p["offset"] + p["length"]]
        assert at.tobytes() == bytes(p["ids"])
    packed.unpersist()
    assert pack_documents(empty, PATH).count() == 0


def test_windows_keep_the_proportions(spark):
    rows = [(i, "word " * (5 + i % 40), ("a", "a", "a", "b", "b", "c")[i % 6]) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    window = 2048
    pieces = pack_documents(df, PATH, length=512, window=window).collect()
    total, share = sum(p["length"] for p in pieces), defaultdict(int)
    sent = defaultdict(lambda: defaultdict(int))
    for p in pieces:
        share[p["source"]] += p["length"] / total
        sent[p["sequence_id"] * 512 // window][p["source"]] += p["length"]
    done = defaultdict(int)
    for w in sorted(sent):
        for s, n in sent[w].items():
            done[s] += n
        for s in share:
            # deficits: a source is never off by more than its longest document (and the round's reach)
            assert abs(done[s] - share[s] * sum(done.values())) <= 3 * 50


@pytest.mark.parametrize("total", [0, 1, 7, 8, 13, 16, 29, 64])
def test_cuts_cover_the_stream(total):
    seen = []
    for at in range(0, total, 5):
        n = min(5, total - at)
        parts = list(_cuts(at, n, 8, total))
        assert [p[0] for p in parts] == [sum(q[1] for q in parts[:i]) for i in range(len(parts))]
        seen += [(seq, off + k) for _, size, seq, off in parts for k in range(size)]
    assert len(seen) == len(set(seen)) == total and seen == sorted(seen)
    sizes = defaultdict(int)
    for seq, _ in seen:
        sizes[seq] += 1
    assert all(n == 8 or n & (n - 1) == 0 for n in sizes.values())
