"""Prefix trie against a plain one."""

import hashlib
import random

import pytest

from strata.llm.common import stored
from strata.llm.prefix_trie import _PIECE_IDS, _screened, op13_prefix_trie, prefix_trie, prefixes, shared_turns

SCHEMA = "conv_id long, turn long, role string, text string, digest string, depth int"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def conversations(rows, shared):
    turns = {}
    for c, t, r, x, *_ in rows:
        turns.setdefault(c, []).append((t is not None, t or 0, (r or "").encode(), (x or "").encode()))
    own = {c: [v[2:] for v in sorted(ts)] for c, ts in turns.items()}
    out = {}
    for c, ts in own.items():
        h = 0 if c is None or shared is None else shared(c)
        out[c] = ts if c is None else own.get(c - c % 5, [])[:h] + ts[h:]
    return out


def plain(rows, shared=shared_turns):
    convs = conversations(rows, shared)
    nodes = {}
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(tuple(ts[:d]), []).append(c)
    least = {p: min((c for c in m if c is not None), default=None) for p, m in nodes.items()}
    children, leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for p in nodes:
        if p:
            children[p[:-1]] += 1
    for p, m in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, m in nodes.items():
        ends = sorted((c for c in m if len(convs[c]) == len(p)), key=lambda c: (c is not None, c or 0))
        sha = hashlib.sha256(",".join("" if c is None else str(c) for c in ends).encode()).hexdigest()
        out.append((least[p], len(p), least[p[:-1]] if p else None, len(m), children[p], leaves[p], saved[p], sha))
    return sorted(out, key=repr)


def told(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def tricky(seed):
    rng = random.Random(seed)
    rows = []
    for c in range(120):
        n = rng.choice([1, 2, 3, 5, 8, 12, 20])
        rows += [(c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "é" * 9, "", "hello there"]), "d", 7) for t in range(n)]
    rows += [(c, t, "user", "same", "", 0) for c in (200, 201, 202, 203, 300, 411) for t in range(9)]  # copies, also in one group
    rows += [(502, 0, "user", "no first one of its group", "", 1), (-3, 0, "user", "below zero", "", 1), (-5, 0, "x", "y", "", 1)]
    rows += [(600, t, None, None, None, None) for t in (None, None, 0, 0)]  # null turns, ties, repeated rows
    rows += [(600, 0, "user", "x", None, None), (601, 3, "", "", None, None)]
    rows += [(None, 1, "user", "nobody", "", 1), (None, None, "user", "a", "", 1)]
    rows += [(c, t, "user", f"t{t}" if t < 45 else f"{c}", "", 1) for c in (700, 715) for t in range(60)]  # deep
    rows += [(800, 0, "user", "long " * 50_000, "", 1), (805, 0, "user", "long " * 50_000, "", 1)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("shared", "cells"), [(shared_turns, 0), (None, 8)])
def test_all_nodes(spark, shared, cells):
    rows = tricky(3)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert told(prefix_trie(prefixes(df, shared=shared), cells)) == plain(rows, shared)


def test_the_query(spark, tmp_path):
    rows = tricky(4)
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    assert told(op13_prefix_trie(spark, str(tmp_path))) == plain(rows)


def test_ids_of_a_very_common_conversation(spark):
    """More ids end at one node than a piece holds, over several partitions."""
    n = 3 * _PIECE_IDS + 5
    rows = spark.range(n).selectExpr("id AS conv_id", "0L AS turn", "'user' AS role", "'hello' AS text")
    got = {r["depth"]: r for r in prefix_trie(prefixes(rows, shared=None)).collect()}
    assert got[1]["ends_sha256"] == hashlib.sha256(",".join(map(str, range(n))).encode()).hexdigest()
    assert (got[0]["n_convs"], got[0]["n_children"], got[0]["saved_tokens"]) == (n, 1, 5 * (n - 1))


def test_the_screen_proves_most_singletons(spark):
    """Tails do not meet other rows, and no shared prefix is taken for one."""
    rows = spark.range(3000).selectExpr("id AS conv_id", "explode(sequence(0L, 5L)) AS turn", "'u' AS role").selectExpr(
        "*", "IF(turn = 0, 'hi', concat(conv_id, ' ', turn)) AS text"
    )
    made = stored(prefixes(rows, shared=None), "screen-test")
    seen = _screened(made, 8)
    tails = {(r["conv_id"], r["depth"]) for r in seen.filter("alone").collect()}
    assert all(d >= 3 for _, d in tails) and len(tails) > 0.9 * 3000 * 4
