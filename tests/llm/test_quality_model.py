"""The discriminant against numpy, and its held-out accuracy."""

import zlib

import numpy as np

from strata.llm import quality_model as M
from tests.conftest import SF_SMALL


def test_scores_against_numpy(spark):
    rng = np.random.default_rng(5)
    d = len(M.STATISTICS)
    x = np.concatenate((rng.normal(0, 1, (300, d)), rng.normal(0.7, 2, (200, d))))
    x[:, 3] = 0.25  # never varies
    y = np.r_[np.zeros(300, int), np.ones(200, int)]
    rows = [(int(k), [float(v) for v in r]) for k, r in zip(y, x, strict=True)] + [(None, [9.0] * d)]
    df = spark.createDataFrame(rows, "label int, stats array<double>")
    model = M.fit(df)
    got = [r[0] for r in df.selectExpr(f"{model.score()} AS s").collect()][:500]
    means = [x[y == k].mean(axis=0) for k in (0, 1)]
    covs = [np.cov(x[y == k].T, bias=True) for k in (0, 1)]
    pooled = 0.6 * covs[0] + 0.4 * covs[1]
    logs = []
    for k in (0, 1):
        c = (1 - M.SHRINK_CLASS) * covs[k] + M.SHRINK_CLASS * pooled
        c = (1 - M.SHRINK_DIAGONAL) * c + M.SHRINK_DIAGONAL * np.diag(np.maximum(np.diag(pooled), M.FLOOR))
        c += M.FLOOR * np.eye(d)
        z = x - means[k]
        logs.append(-0.5 * (np.einsum("ij,jk,ik->i", z, np.linalg.inv(c), z) + np.linalg.slogdet(c)[1]))
    want = 1 / (1 + np.exp(-(logs[1] - logs[0] + np.log(200 / 300))))
    assert np.allclose(got, want, atol=1e-9)


def test_one_class_or_none(spark):
    d = len(M.STATISTICS)
    schema = "label int, stats array<double>"
    one = M.fit(spark.createDataFrame([(1, [0.0] * d)], schema))
    assert spark.sql(f"SELECT {one.score()} AS s").first()[0] > 0.99
    assert spark.sql(f"SELECT {M.fit(spark.createDataFrame([], schema)).score()} AS s").first()[0] == 0.5


def test_held_out_accuracy(spark):
    sf = SF_SMALL.replace("sf0.001", "sf0.01")
    got = {r["doc_id"]: r for r in M.op7_quality_discriminant(spark, sf).collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for d, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(got[d]["score"], q) for d, q in labels.items() if got[d]["held_out"]]
    pairs = [(a > b) + 0.5 * (a == b) for a, qa in held if qa == 1 for b, qb in held if qb == 0]
    assert sum(pairs) / len(pairs) > 0.95
    assert np.mean([(s >= 0.7) == (q == 1) for s, q in held]) > 0.9


def test_tricky_rows_are_scored(spark, folder, tmp_path):
    import shutil

    base = f"{tmp_path}/t"
    shutil.copytree(folder, base)
    labels = [(i, i % 2, 0) for i in range(24)] + [(5, None, 0), (None, 1, 0), (9999, 1, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    rows = M.op7_quality_discriminant(spark, base).collect()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert not [r for r in rows if r["doc_id"] is None and r["held_out"]]
