"""Mixing: targets against plain resharing, rates against the equations."""

import math
import random

from strata.llm.mixing import mix_sources, source_targets, take_copies
from tests.llm.conftest import tricky_rows


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, target = share * sum(sizes.values()), set(names), {}
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total >= cap * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / total for s in free}
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
        free -= over
    return target


def test_targets(spark):
    rng = random.Random(3)
    for _ in range(6):
        sizes = {f"s{i}": rng.choice([0, 5, 90, 1000, 40_000]) + rng.randrange(9) for i in range(rng.randrange(1, 9))}
        sizes |= {None: rng.randrange(500)}
        df = spark.createDataFrame(list(sizes.items()), "source string, size long")
        got = {r["source"]: r["target"] for r in source_targets(df).collect()}
        want = plain_targets(sizes)
        assert all(math.isclose(got[s], want[s], rel_tol=1e-9, abs_tol=1e-6) for s in sizes)


def check(rows, most_off=1.0):
    by = {}
    for r in rows:
        assert r["copies"] in (0, 1, 2) and r["taken"] == r["copies"] * r["size"]
        assert 0 <= r["rate"] <= 2
        by.setdefault(r["source"], []).append(r)
    sizes = {s: sum(r["size"] for r in v) for s, v in by.items()}
    want = plain_targets(sizes)
    for s, v in by.items():
        assert {r["source_size"] for r in v} == {sizes[s]}
        assert all(math.isclose(r["target"], want[s], rel_tol=1e-9, abs_tol=1e-6) for r in v)
        # the dual is solved: rates meet the target, tilted by size alone
        assert math.isclose(sum(r["rate"] * r["size"] for r in v), want[s], rel_tol=1e-6, abs_tol=1e-3)
        tilt = {round(math.log(r["rate"] / (2 - r["rate"])) / r["size"], 9) for r in v if r["size"] and 0 < r["rate"] < 1.999}
        assert not tilt or max(tilt) - min(tilt) <= 1e-6 * max(1, abs(max(tilt)))
        # the taken words are within one document of the target
        assert abs(sum(r["taken"] for r in v) - want[s]) <= most_off * max(r["size"] for r in v)


def test_tricky_rows(spark, tricky, empty):
    rows = mix_sources(tricky).collect()
    assert len(rows) == len(tricky_rows())
    check(rows, 2.0)  # two rows of one id are rounded alike
    again = mix_sources(tricky.repartition(3)).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))
    taken = take_copies(tricky)
    assert taken.columns == tricky.columns
    copies = sum(r["copies"] for r in rows)
    assert taken.count() == copies
    assert take_copies(empty).count() == 0


def test_hot_source_and_wide_sizes(spark):
    rng = random.Random(9)
    rows = []
    for i in range(1500):
        n = min(4000, int(rng.lognormvariate(3, 1.5)) + 1)
        rows.append((i, "w " * n, "hot" if i % 3 == 0 else f"s{rng.randrange(6)}"))
    rows += [(5000 + i, "a b c", "hot") for i in range(800)]
    check(mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect())


def test_rows_of_one_id_are_rounded_each(spark):
    """A third of a source under a null id, some rows equal in all; one more id repeated."""
    rng = random.Random(13)
    rows = [(None if i % 3 == 0 else i, f"w{i} " + "w " * 40, "a") for i in range(600)]
    rows += [(None, "same text of six words here", "a")] * 150 + [(7, f"v{i} w w", "b") for i in range(200)]
    rows += [(None, None, None), (None, "", "b"), (1, "x", None)]
    rows += [(2000 + i, "w " * rng.randrange(1, 60), f"s{i % 3}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    mixed = mix_sources(df).collect()
    assert len(mixed) == len(rows)
    check(mixed)
    taken = take_copies(df).collect()
    assert len(taken) == sum(r["copies"] for r in mixed)
    words, want = {}, {}
    for r in taken:
        words[r["source"]] = words.get(r["source"], 0) + len((r["text"] or "").split())
    for r in mixed:
        want[r["source"]] = want.get(r["source"], 0) + r["taken"]
    assert {s: n for s, n in words.items() if n} == {s: n for s, n in want.items() if n}
    assert sorted(map(repr, taken)) == sorted(map(repr, take_copies(df.repartition(2)).collect()))
