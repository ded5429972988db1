"""Spelling variants against all pairs by brute force."""

import random
import re
import zlib

import pytest

from strata.llm import spelling
from strata.llm.spelling import count_words, near_pairs, spelling_variants, word_runs
from tests.llm.conftest import tricky_rows


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(counts):
    out = []
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    forms = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    for w in counts:
        root = w
        while forms[root]:
            root = forms[root]
        f = forms[w]
        out.append((w, counts[w], len(near[w]), f, counts[f] if f else None, root))
    return sorted(out)


def vocabulary(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abéz") for _ in range(rng.randrange(5, 12))) for _ in range(60)]
    words = set(base)
    for w in base * 6:
        i = rng.randrange(len(w) + 1)
        words.add(rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("abéz") + w[i:], w[:i] + "q" + w[i + 1 :]]))
    words |= {"aaaaa" + c for c in "abcdefghijklmnopqrstuvwxyz"} | {"a" * n for n in range(5, 12)} | {"é" * 40, "é" * 39 + "a", "é" * 41}
    return {w: rng.choice([3, 3, 4, 6, 7, 12, 30, 60]) for w in words}


@pytest.mark.parametrize("most_pairs", [0, 3, 1 << 14])
def test_all_near_words(spark, most_pairs):
    """Keys cut down to single code points, partly, and not at all."""
    counts = vocabulary(5)
    df = spark.createDataFrame([(w, n, "x", 1) for w, n in counts.items()], "word string, n long, key string, at int").repartition(4)
    got = spelling_variants(df, most_pairs=most_pairs)
    columns = ("word", "n", "n_near", "form", "form_n", "root")
    assert sorted(tuple(r[c] for c in columns) for r in got.collect()) == plain(counts)


def test_a_hot_key_makes_few_meetings(spark):
    """5,000 words with one beginning: 25 million meetings if met on it."""
    rng = random.Random(1)
    words = {"interna" + "".join(rng.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(5000)}
    words |= {w[:9] + "z" + w[10:] for w in list(words)[:50]}
    df = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    near = {(a, b) for a in words for b in (w for w in _neighbours(a) if w in words) if a < b}
    assert {(r["a"], r["b"]) for r in near_pairs(df).collect()} == near


def _neighbours(w):
    letters = "abcdefghijklmnopqrstuvwxyz"
    yield from (w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in letters if c != w[i])


def test_words_of_texts(spark, tricky):
    got = sorted((r["doc_id"], r["run"]) for r in word_runs(tricky).collect())
    lower = str.maketrans(spelling._UPPER, spelling._LOWER)
    rows = [("" if d is None else str(d), t or "") for d, t, *_ in tricky_rows()]
    assert got == sorted((d, w.translate(lower)) for d, t in rows for w in re.findall(spelling.LETTERS, t))


def test_the_query_on_tricky_rows(spark, folder):
    lower = str.maketrans(spelling._UPPER, spelling._LOWER)
    counts = {}
    for d, t, *_ in tricky_rows():
        for w in re.findall(spelling.LETTERS, t or ""):
            w = w.translate(lower)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % spelling.TYPO_EVERY == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] = counts.get(w, 0) + 1
    counts = {w: n for w, n in counts.items() if n >= 3 and len(w) >= 5}
    got = spelling.op12_spelling_variants(spark, folder)
    columns = ("word", "n", "n_near", "form", "form_n", "root")
    assert sorted(tuple(r[c] for c in columns) for r in got.collect()) == plain(counts)


def test_counts_and_nulls(spark):
    words = spark.createDataFrame([("abcde",)] * 3 + [("abcd",)] * 9 + [("abcdf",)] * 2 + [(None,)] * 5, "word string")
    assert [tuple(r) for r in count_words(words).collect()] == [("abcde", 3)]
