"""SimHash groups and components against brute force."""

import random

import pytest
import xxhash

from strata.llm.components import connected_components
from strata.llm.simhash import fingerprint, fingerprints, op6_simhash_near_dedup, simhash_keep, simhash_links
from tests.llm.conftest import SCHEMA, tricky_rows


def plain(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(items, linked):
    """Smallest item reachable from each, by repeated passes."""
    least = {x: x for x in items}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            m = min(least[a], least[b])
            for x in (a, b):
                if least[x] != m:
                    least[x], changed = m, True
    return least


def test_fingerprints_against_the_rule(spark):
    for row in tricky_rows():
        if len(row[1] or "") < 20_000:
            assert fingerprint(row[1]) == plain(row[1])
    df = spark.createDataFrame([(1, "Ab cd ef gh"), (2, None)], "doc_id long, text string")
    assert {r["doc_id"]: r["fp"] % (1 << 64) for r in fingerprints(df).collect()} == {1: plain("ab cd ef gh"), 2: 0}


def test_groups_against_brute_force(spark, folder):
    got = op6_simhash_near_dedup(spark, folder).collect()
    rows = tricky_rows()
    prints = [fingerprint(r[1]) for r in rows]
    n = range(len(rows))
    linked = [(a, b) for a in n for b in n if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    least = classes(n, linked)
    ids = {}
    for i in n:
        ids.setdefault(least[i], []).append(rows[i][0])
    named = {c: min((d for d in v if d is not None), default=None) for c, v in ids.items()}
    want = [(rows[i][0], f"{prints[i]:016x}", named[least[i]]) for i in n]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("bits,blocks", [(4, 6), (3, 4), (2, 5)])
def test_links_lose_no_pair(spark, bits, blocks):
    rng = random.Random(bits)
    values = [rng.getrandbits(64) for _ in range(120)]
    for v in values[:80]:
        for d in (1, bits, bits + 1):
            for b in rng.sample(range(64), d):
                v ^= 1 << b
            values.append(v)
    values = sorted({v - (1 << 64) if v >> 63 else v for v in values})
    got = simhash_links(spark.createDataFrame([(v,) for v in values], "fp long"), bits, blocks)
    found = {r["node"]: r["component"] for r in got.collect()}
    linked = [(a, b) for a in values for b in values if a < b and ((a ^ b) % (1 << 64)).bit_count() <= bits]
    assert {v: found.get(v, v) for v in values} == classes(values, linked)


def test_components_of_chains_and_stars(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(40)] + [(1000, 2000 + i) for i in range(300)]
    edges += [(rng.randrange(5000, 5400), rng.randrange(5000, 5400)) for _ in range(200)]
    got = connected_components(spark.createDataFrame(edges, "x long, y long"), "x", "y")
    found = {r["node"]: r["component"] for r in got.collect()}
    want = classes({x for e in edges for x in e}, edges)
    assert found == {x: c for x, c in want.items() if x != c}


def test_one_document_of_each_group_stays(spark, tricky, empty):
    kept = simhash_keep(tricky)
    assert kept.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    rows = kept.collect()
    prints = [fingerprint(r["text"]) for r in rows]
    ids = [r["doc_id"] for r in rows]
    assert 3 in ids and not {9, 100, 101, 205} & set(ids)
    assert ids.count(8) == 2  # two texts under one id, each the first of its group
    # a representative of every group, and only one
    every = sorted({fingerprint(r[1]) for r in tricky_rows()})
    least = classes(every, [(a, b) for a in every for b in every if a < b and (a ^ b).bit_count() <= 4])
    assert sorted(least[p] for p in prints) == sorted(set(least.values()))
    assert simhash_keep(empty).count() == 0
