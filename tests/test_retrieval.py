import math
import re
from collections import Counter

import numpy as np

from strata.operators import retrieval as R

DOCS = [
    (1, "The hospital mission is to care for every patient."),
    (2, "Our vision: a hospital network that cares. Mission and vision!"),
    (3, "Parking rules and visiting hours."),
    (4, "Missão, visão e valores do hospital."),
]
QUERIES = [(10, "hospital mission"), (11, "visiting hours"), (12, "zebra quantum")]


def toks(t):
    return [x for x in re.split(r"[^\w]+|_", t.lower()) if x]


def brute_bm25(k=2):
    d_toks = {d: toks(t) for d, t in DOCS}
    n = len(DOCS)
    avgdl = sum(len(v) for v in d_toks.values()) / n
    out = {}
    for q, text in QUERIES:
        qtf = Counter(toks(text))
        scores = {}
        for d, tk in d_toks.items():
            tf = Counter(tk)
            s = 0.0
            for term, qc in qtf.items():
                if tf[term]:
                    df = sum(1 for v in d_toks.values() if term in v)
                    idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
                    s += qc * idf * tf[term] * 2.2 / (tf[term] + 1.2 * (0.25 + 0.75 * len(tk) / avgdl))
            if s:
                scores[d] = round(s, 9)
        out[q] = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:k]
    return out


def test_kb_search_equals_brute_force(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    qs = spark.createDataFrame(QUERIES, "qid long, text string")
    rows = R.kb_search(qs, docs, k=2).collect()
    got = {}
    for r in rows:
        got.setdefault(r.qid, [])
        if r.doc_id is not None:
            got[r.qid].append((r.rank, r.doc_id, r.score))
    want = brute_bm25(2)
    for q, lst in want.items():
        assert [(d, s) for _, d, s in sorted(got[q])] == [(d, s) for d, s in lst]
    miss = [r for r in rows if r.qid == 12]
    assert len(miss) == 1 and miss[0].message == R.NOT_FOUND_MESSAGE and miss[0].doc_id is None


def test_kb_search_vec_equals_numpy(spark):
    rng = np.random.default_rng(3)
    vecs = rng.normal(size=(60, 8)).astype("float32")
    labels = rng.integers(0, 3, size=60)
    df = spark.createDataFrame(
        [(i, [float(x) for x in vecs[i]], int(labels[i])) for i in range(60)],
        "vec_id long, embedding array<float>, label int",
    )
    rows = R.kb_search_vec(R.label_centroids(df), df, k=4).collect()
    for lab in range(3):
        c = vecs[labels == lab].astype("float64").mean(axis=0)
        sims = (vecs.astype("float64") @ c) / (np.linalg.norm(vecs.astype("float64"), axis=1) * np.linalg.norm(c))
        want = list(np.argsort(-sims, kind="stable")[:4])
        got = [r.vec_id for r in sorted((r for r in rows if r.qid == lab), key=lambda r: r.rank)]
        assert got == want


def hits(df):
    return sorted(map(tuple, df.collect()), key=repr)


def many_docs():
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(80)]
    docs = [(i, " ".join(rng.choice(words, rng.integers(1, 60)))) for i in range(150)]
    # an id twice, a null id, texts without tokens
    return docs + [(7, "w1 w2 w3"), (None, "w1 w79"), (900, None), (901, ""), (902, "...")]


def test_index_answers_like_the_scan(spark, scratch, monkeypatch):
    docs = spark.createDataFrame(many_docs(), "doc_id long, text string").repartition(5)
    queries = spark.createDataFrame(
        [(1, "w1 w2 w2"), (2, "w79 unknown"), (3, "unknown"), (4, None), (5, "W5, w6!")], "qid int, text string"
    )
    R.build_index(docs, scratch + "/index", buckets=16)
    plain = hits(R.kb_search(queries, docs, k=4))
    assert hits(R.search_index(spark, scratch + "/index", queries, k=4)) == plain
    monkeypatch.setattr(R, "QUERY_ROWS", 2)  # several blocks of queries
    monkeypatch.setattr(R, "_CELLS", 9)
    assert hits(R.search_index(spark, scratch + "/index", queries, k=4)) == plain
    assert hits(R.kb_search(queries, docs, k=4)) == plain


def test_a_later_request_reads_its_buckets_only(spark, scratch):
    docs = spark.createDataFrame(many_docs(), "doc_id long, text string")
    R.build_index(docs, scratch + "/index", buckets=16)
    term = spark.sql("SELECT xxhash64('w5') AS t").first()["t"]
    postings = R.index_postings(spark, scratch + "/index", [term])
    plan = postings._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull(bucket" in plan or f"bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    read = {f.split("bucket=")[1].split("/")[0] for f in postings.inputFiles()}
    scanned = spark.read.parquet(scratch + "/index/postings").filter(f"bucket = {term % 16}")
    assert postings.count() == sum("w5" in (t or "").split() for _, t in many_docs())
    assert len(read) <= 16 and scanned.count() < spark.read.parquet(scratch + "/index/postings").count()


def clustered(n=600, dim=8, groups=12):
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(groups, dim)) * 10
    rows = [(i, [float(x) for x in np.float32(centres[i % groups] + rng.normal(size=dim) * 0.3)]) for i in range(n)]
    return centres, rows + [(n, [0.0] * dim), (n + 1, None), (n + 2, rows[5][1])]


def test_cells_answer_exactly_and_read_few(spark, scratch):
    from strata.operators.vectorcells import CellSearch, build_cells

    centres, rows = clustered()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    queries = spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(centres)], "qid int, vector array<double>")
    build_cells(df, scratch + "/cells")
    search = CellSearch(spark, scratch + "/cells", queries, k=5)
    assert hits(search.answer()) == hits(R.kb_search_vec(queries, df, k=5))
    print(f"cells read: {search.read} of {search.held} vectors")
    assert search.read < 0.3 * search.held


def test_cells_with_few_vectors_and_zero_queries(spark, scratch):
    from strata.operators.vectorcells import build_cells, search_cells

    _, rows = clustered(n=6)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    queries = spark.createDataFrame([(1, rows[0][1]), (2, [0.0] * 8)], "qid int, vector array<double>")
    build_cells(df, scratch + "/cells")
    for k in (3, 20):
        assert hits(search_cells(spark, scratch + "/cells", queries, k=k)) == hits(R.kb_search_vec(queries, df, k=k))


def test_cells_of_no_vectors(spark, scratch):
    from strata.operators.vectorcells import build_cells, search_cells

    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    queries = spark.createDataFrame([(1, [1.0, 2.0])], "qid int, vector array<double>")
    build_cells(df, scratch + "/cells")
    got = search_cells(spark, scratch + "/cells", queries).collect()
    assert [(r.qid, r.vec_id, r.message) for r in got] == [(1, None, R.NOT_FOUND_MESSAGE)]


def test_an_index_of_no_documents(spark, scratch):
    docs = spark.createDataFrame([], "doc_id long, text string")
    queries = spark.createDataFrame([(1, "w1")], "qid int, text string")
    R.build_index(docs, scratch + "/index")
    assert hits(R.search_index(spark, scratch + "/index", queries)) == hits(R.kb_search(queries, docs))


def test_token_work_is_bounded_and_answers_stay(spark, scratch, monkeypatch):
    import pyarrow as pa

    lengths = [3, 0, 70, 20, 20, 20, None, 49, 1, 130, 5]
    toks = [None if n is None else list(np.random.default_rng(i).integers(0, 30, n)) for i, n in enumerate(lengths)]
    batch = pa.RecordBatch.from_pydict(
        {
            "doc": pa.array(range(len(toks)), pa.int64()),
            "doc_id": pa.array([9, 9, None, *range(8)], pa.int64()),
            "toks": pa.array(toks, pa.list_(pa.int64())),
        }
    )
    whole = pa.Table.from_batches(list(R._postings_of([batch])))
    monkeypatch.setattr(R, "_TOKENS", 50)
    parts = list(R._postings_of([batch]))
    assert pa.Table.from_batches(parts).to_pylist() == whole.to_pylist()
    assert whole.to_pylist()[0]["length"] == 3 and sum(whole["tf"].to_pylist()) == sum(n or 0 for n in lengths)
    for part in parts:
        assert sum(part["tf"].to_pylist()) <= 50 or len(set(part["doc"].to_pylist())) == 1

    docs = spark.createDataFrame(many_docs(), "doc_id long, text string").repartition(2)
    queries = spark.createDataFrame([(1, "w1 w2 w2"), (2, "w79 unknown"), (3, "unknown")], "qid int, text string")
    R.build_index(docs, scratch + "/index", buckets=16)
    sliced = hits(R.search_index(spark, scratch + "/index", queries, k=4))
    assert sliced == hits(R.kb_search(queries, docs, k=4))
    monkeypatch.setattr(R, "_TOKENS", 1 << 30)
    assert sliced == hits(R.kb_search(queries, docs, k=4))
