"""Winnowing against a plain version."""

import hashlib

import pytest

from strata.llm.winnowing import GRAM, WINDOW, fingerprints, op2_winnowing
from tests.llm.conftest import prose, tricky_rows


def test_edited_texts_and_next_documents(spark, folder):
    got = op2_winnowing(spark, folder).collect()
    rows = {(r[0], r[1] or "") for r in tricky_rows()}
    assert len(got) == len(tricky_rows())
    # rows of one id follow each other by the hash of the text
    texts = [(r[0], r[1] or "") for r in tricky_rows()]
    hashed = spark.createDataFrame(texts, "d long, t string").selectExpr("t", "xxhash64(t) AS h").distinct().collect()
    h = {r["t"]: r["h"] for r in hashed}
    order = sorted(rows, key=lambda r: (-(1 << 63) if r[0] is None else r[0], h[r[1]]), reverse=True)
    want = {}
    for i, (d, t) in enumerate(order):
        after, third = order[(i + 1) % len(order)][1], len(t) // 3
        edited = t[: len(t) - third] + after[:third]
        want.setdefault((d, len(t)), set()).add(hashlib.sha256(edited.encode()).hexdigest())
    prints = {}
    for r in got:
        assert r["edited_sha256"] in want[r["doc_id"], r["n_chars"]]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        prints.setdefault(r["doc_id"], set()).add(r["fingerprint"])
    assert prints[3] == prints[100] == prints[105]
    long_ones = [r["near_edited"] for r in got if r["n_chars"] > 600 and r["doc_id"] not in (405, 407)]
    assert min(long_ones) > 0.3


@pytest.mark.parametrize("words", [0, 1, 3, 4, 6, 9, 10, 300])
def test_least_hash_of_each_window_the_rightmost(spark, words):
    import random

    text = prose(random.Random(words), words, 8) if words else " "
    # the gram hashes as the operator computes them, positions from windows one by one
    w = text.split()
    grams = [w] if 0 < len(w) < GRAM else [w[i : i + GRAM] for i in range(len(w) - GRAM + 1)]
    df = spark.createDataFrame([(i, g) for i, g in enumerate(grams)] or [(0, [])], "i int, g array<string>")
    cols = ", ".join(f"xxhash64(get(g, {k}))" for k in range(GRAM))
    one = "xxhash64(transform(g, x -> xxhash64(x)))"
    e = one if len(w) < GRAM else f"xxhash64({cols})"
    h = [r[0] for r in df.orderBy("i").selectExpr(f"shiftrightunsigned({e}, 32)").collect()] if grams else []
    want = []
    for i in range(max(1, len(h) - WINDOW + 1) if h else 0):
        window = h[i : i + WINDOW]
        at = i + max(j for j, x in enumerate(window) if x == min(window))
        if at not in want:
            want.append(at)
    got = fingerprints(spark.createDataFrame([(text, 5)], "text string, fingerprint int")).first()["fingerprint"]
    assert [m["position"] for m in got] == want
    assert [(m["hash"]) % (1 << 32) for m in got] == [h[i] for i in want]


def test_shared_passage_shares_a_mark(spark):
    import random

    rng = random.Random(11)
    shared = prose(rng, GRAM + WINDOW + 3).replace("\n", " ").split()[: GRAM + WINDOW - 1]
    rows = [(i, prose(rng, 50) + " " + " ".join(shared) + " " + prose(rng, 50)) for i in range(20)]
    marks = fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    common = set.intersection(*({m["hash"] for m in r["fingerprint"]} for r in marks))
    assert common
