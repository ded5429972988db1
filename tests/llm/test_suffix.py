"""Repeated passages: sound by checking every span, whole by planted cases and
by comparison with all windows."""

import random

from strata.llm.suffix_dedup import (
    MIN_WORDS,
    _ended,
    _scan,
    _Suffix,
    kept_positions,
    op5_suffix_passages,
    repeated_passages,
    without_copies,
)
from tests.llm.conftest import prose, tricky_rows

B = " \t\n\x0b\x0c\r"


def words(text):
    for b in B:
        text = (text or "").replace(b, " ")
    return [w for w in text.split(" ") if w]


def windows(texts):
    """Window -> its first place, in the order of (id, place in the list)."""
    first = {}
    for key, t in texts:
        w = words(t)
        for i in range(len(w) - MIN_WORDS + 1):
            first.setdefault(tuple(w[i : i + MIN_WORDS]), (key, i))
    return first


def test_spans_are_copies_and_passages_are_found(spark, tricky):
    found = repeated_passages(tricky).collect()
    by_id = {}
    for r in tricky_rows():
        by_id.setdefault(r[0], []).append(r[1])
    for m in found:
        span = [words(t)[m["first"] : m["last"]] for t in by_id[m["doc_id"]]]
        n = m["last"] - m["first"]
        assert n >= MIN_WORDS
        origin = [words(t)[m["of_first"] : m["of_first"] + n] for t in by_id[m["of_doc_id"]]]
        assert any(s == o and len(s) == n for s in span for o in origin)
    pairs = {(m["doc_id"], m["of_doc_id"]) for m in found}
    assert {(301, 300), (302, 300), (303, 300), (304, 300)} <= pairs
    assert {d for d, _ in pairs} >= {100, 105, 201, 205, 301, 304}
    assert not {d for d, _ in pairs} & {0, 1, 2, 400, 401, 402, 403, 406, 407}


def test_planted_passages_of_every_length(spark):
    rng = random.Random(21)
    rows, passages = [], []
    for k in range(30):
        passages.append(prose(rng, MIN_WORDS + 1 + 3 * k).split(" "))
        for _ in range(3):
            rows.append((len(rows), prose(rng, 90), "x"))
    for k, p in enumerate(passages):
        for j in range(3):
            d, t, x = rows[3 * k + j]
            rows[3 * k + j] = (d, t + " " + " ".join(p) + " " + prose(rng, 60), x)
    clean = [(1000 + i, prose(rng, 200), "x") for i in range(20)]
    df = spark.createDataFrame(rows + clean, "doc_id long, text string, row string").repartition(7)
    out = {r["doc_id"]: r for r in without_copies(df).collect()}
    for d, t, _ in clean:
        assert out[d]["text"] == t and out[d]["row"] == "x"
    left = [" ".join(words(r["text"])) for r in out.values()]
    for p in passages:
        body = " ".join(words(" ".join(p)))
        assert sum(body in t for t in left) == 1
    # no window of MIN_WORDS words occurs twice any more
    seen = set()
    for t in left:
        w = t.split(" ")
        for i in range(len(w) - MIN_WORDS + 1):
            assert tuple(w[i : i + MIN_WORDS]) not in seen
            seen.add(tuple(w[i : i + MIN_WORDS]))
    # and none is lost
    assert seen >= set() and {x for x in windows([(d, t) for d, t, _ in rows])} - seen <= {
        x for x in windows([(d, t) for d, t, _ in rows])
    }
    every = set(words(" ".join(t for _, t, _ in rows)))
    assert every == set(words(" ".join(left))) - set(words(" ".join(t for _, t, _ in clean))) | every


def test_removal_keeps_rows_and_columns(spark, tricky, empty):
    out = without_copies(tricky)
    assert out.columns == tricky.columns
    rows = out.collect()
    texts = {r["doc_id"]: r for r in rows}
    assert texts[0]["text"] == tricky_rows()[0][1]
    assert {400, 401, 402, 403, 407} <= set(texts) and not {100, 105} & set(texts)
    assert texts[301]["n_chars"] == len(texts[301]["text"])
    assert texts[400]["text"] is None and texts[402]["text"] == " \t\n\r\x0b\x0c "
    assert without_copies(empty).count() == 0


def test_positions_depend_on_the_words_alone():
    rng = random.Random(2)
    body = prose(rng, 300).split()
    a, _ = kept_positions([w.encode() for w in body])
    b, _ = kept_positions([w.encode() for w in prose(rng, 37).split() + body])
    for i in range(0, 300 - MIN_WORDS):
        inside = [x for x in a if i <= x <= i + MIN_WORDS - 25]
        assert inside
    assert {x - 37 for x in b if x >= 37 + 30 and x < 37 + 240} == {x for x in a if 30 <= x < 240}


def later_windows(texts):
    """(id, word) of all words in windows that also occur at an earlier place."""
    first, covered = {}, set()
    for d, t in sorted(texts):
        w = words(t)
        for i in range(len(w) - MIN_WORDS + 1):
            if first.setdefault(tuple(w[i : i + MIN_WORDS]), (d, i)) != (d, i):
                covered |= {(d, j) for j in range(i, i + MIN_WORDS)}
    return covered


def clipped_and_edited():
    """A passage in many documents; earlier ones that share only 25 to 49 of
    its words; edited copies; repeats that reach 50 words only with their left part."""
    rng = random.Random(77)
    passage = prose(rng, 60).split()
    rows = []
    for i in range(30):  # clipped: too short to count, with the smallest ids
        n = 25 + rng.randrange(25)
        at = rng.randrange(60 - n + 1)
        rows.append(prose(rng, 40).split() + passage[at : at + n] + prose(rng, 40).split())
    rows += [prose(rng, 40).split() + passage + prose(rng, 40).split() for _ in range(40)]
    base = prose(rng, 300).split()
    for i in range(12):
        w = list(base)
        for _ in range(3):
            w[rng.randrange(300)] = f"edit{rng.randrange(10**6)}"
        rows.append(w[rng.randrange(60) :] if i % 2 else w[: 300 - rng.randrange(60)])
    control = ["a\x01b", "a", "\x02"]  # sorts before a blank
    tail = prose(rng, 50).split() + ["end"]
    rows += [prose(rng, 30).split() + tail + more for more in ([], ["x"], control, control[1:])]
    rows += [prose(rng, 30).split() + tail[:-1] + ["end\x01" + str(i)] + prose(rng, 30).split() for i in range(3)]
    return [(i, " ".join(w)) for i, w in enumerate(rows)]


def covered_by(found):
    return {(m["doc_id"], j) for m in found for j in range(m["first"], m["last"])}


def test_every_repeated_window_is_covered_and_first_ones_are_kept(spark):
    rows = clipped_and_edited()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = repeated_passages(df).collect()
    assert covered_by(found) == later_windows(rows)
    texts = {d: words(t) for d, t in rows}
    for m in found:
        n = m["last"] - m["first"]
        assert (m["of_doc_id"], m["of_first"]) < (m["doc_id"], m["first"])
        assert texts[m["doc_id"]][m["first"] : m["last"]] == texts[m["of_doc_id"]][m["of_first"] : m["of_first"] + n]


def test_a_scan_that_may_hold_little_hands_the_rest_on():
    rows = []
    for d, t in clipped_and_edited():
        w = [x.encode() for x in words(t)]
        rows += [
            _Suffix(d, 0, int(at), _ended(w[at : at + MIN_WORDS]), _ended(w[max(0, at - 25) : at][::-1]))
            for at in kept_positions(w)[0]
        ]
    rows.sort(key=lambda s: (s.suffix, s.before, s.order))
    out = [m for k in range(0, len(rows), 50) for m in _scan(iter(rows[k : k + 50]), 25, MIN_WORDS, 40)]
    covered, first = set(), {}
    for m in sorted((m for m in out if m[7] is not None), key=lambda m: (m[0], m[2])):
        if first.setdefault(m[7], (m[0], m[2])) != (m[0], m[2]):
            covered |= {(m[0], j) for j in range(m[2], m[3])}
    covered |= {(m[0], j) for m in out if m[7] is None for j in range(m[2], m[3])}
    assert covered == later_windows(clipped_and_edited())


def test_spans_do_not_depend_on_the_partitions(spark):
    """One hot suffix, with left parts shared by some of its documents."""
    rng = random.Random(5)
    hot, lefts = prose(rng, 50).split(), [prose(rng, 20).split() for _ in range(6)]
    rows = [(i, " ".join(prose(rng, 30).split() + lefts[i % 6] + hot)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")
    before = {n: spark.conf.get(n) for n in names}
    try:
        spark.conf.set(names[1], "false")
        for n in (1, 13):
            spark.conf.set(names[0], n)
            assert covered_by(repeated_passages(df).collect()) == later_windows(rows)
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


def test_query_and_removal_against_all_windows(spark, tmp_path):
    rows = clipped_and_edited()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    later = later_windows(rows)
    out = op5_suffix_passages(spark, str(tmp_path)).collect()
    places = [(r["doc_id"], j) for r in out for j in range(r["first_word"], r["end_word"])]
    assert sorted(places) == sorted(later)  # each word once
    assert all(r["of_doc_id"] <= r["doc_id"] for r in out)
    left = {r["doc_id"]: words(r["text"]) for r in without_copies(df).collect()}
    for d, t in rows:  # nothing else is gone
        assert left.get(d, []) == [w for j, w in enumerate(words(t)) if (d, j) not in later]
