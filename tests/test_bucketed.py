"""Upserts that rewrite touched buckets only."""

import glob
import os

import pytest

from strata.operators import bucketed as B
from strata.operators.upsert import DuplicateKeyError, merged

SCHEMA = "k1 int, k2 string, v string"


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def files(root):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{root}/{B.BUCKET}=*/*.parquet")}


@pytest.fixture
def ns(spark):
    spark.sql("CREATE NAMESPACE IF NOT EXISTS bucket_ns")
    return "bucket_ns"


def test_one_key_rewrites_one_bucket(spark, scratch, ns):
    first = spark.createDataFrame([(i, str(i), "t") for i in range(200)], SCHEMA)
    B.upsert_buckets(spark, first, f"{ns}.one", "k1", f"{scratch}/one", buckets=8)
    before = files(f"{scratch}/one")
    touched = B.upsert_buckets(spark, spark.createDataFrame([(7, "7", "s")], SCHEMA), f"{ns}.one", "k1", f"{scratch}/one")
    after = files(f"{scratch}/one")
    assert len(touched) == 1
    same = {f for f in before if after.get(f) == before[f]}
    assert before.keys() - same == {f for f in before if f"{B.BUCKET}={touched[0]}/" in f}
    assert after.keys() - same == {f for f in after if f"{B.BUCKET}={touched[0]}/" in f}
    assert rows(B.read_bucketed(spark, f"{ns}.one")) == sorted(
        [(i, str(i), "s" if i == 7 else "t") for i in range(200)], key=repr
    )


def test_the_scan_is_pruned(spark, scratch, ns):
    first = spark.createDataFrame([(i, str(i), "t") for i in range(200)], SCHEMA)
    B.upsert_buckets(spark, first, f"{ns}.pruned", "k1", f"{scratch}/p", buckets=8)
    plan = spark.table(f"{ns}.pruned").filter(f"{B.BUCKET} IN (3)")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(__bucket" in plan or "PartitionFilters: [__bucket" in plan


@pytest.mark.parametrize("null_keys", ["insert", "match"])
def test_equals_the_merge_as_a_plan(spark, scratch, ns, null_keys):
    target = spark.createDataFrame([(i % 50 if i else None, str(i), "t") for i in range(100)], SCHEMA).dropDuplicates(["k1"])
    target = target.unionByName(spark.createDataFrame([(None, None, "n")], SCHEMA)) if null_keys == "insert" else target
    batch = spark.createDataFrame([(3, "x", "s"), (None, "y", "s"), (900, "z", None)], SCHEMA)
    name = f"{ns}.plan_{null_keys}"
    B.upsert_buckets(spark, target, name, ["k1"], f"{scratch}/t", buckets=4, null_keys=null_keys)
    want = rows(merged(target, batch, "k1", null_keys=null_keys))
    B.upsert_buckets(spark, batch, name, ["k1"], f"{scratch}/t", null_keys=null_keys)
    assert rows(B.read_bucketed(spark, name)) == want


def test_a_writer_that_died_is_completed(spark, scratch, ns, monkeypatch):
    first = spark.createDataFrame([(i, str(i), "t") for i in range(60)], SCHEMA)
    name, root = f"{ns}.died", f"{scratch}/d"
    B.upsert_buckets(spark, first, name, "k1", root, buckets=4)
    batch = spark.createDataFrame([(i, str(i), "s") for i in range(50, 70)], SCHEMA)

    def dies(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(B, "_overwrite", dies)
        with pytest.raises(OSError):
            B.upsert_buckets(spark, batch, name, "k1", root)
    later = spark.createDataFrame([(5, "5", "u")], SCHEMA)
    B.upsert_buckets(spark, later, name, "k1", root)
    got = {r.k1: r.v for r in spark.table(name).collect()}
    assert len(got) == 70 and got[5] == "u" and got[55] == "s" and got[69] == "s" and got[6] == "t"
    assert not B.complete_pending(spark, name)


def test_refusals(spark, scratch, ns):
    first = spark.createDataFrame([(1, "a", "t")], SCHEMA)
    name, root = f"{ns}.refuse", f"{scratch}/r"
    B.upsert_buckets(spark, first, name, "k1", root, buckets=4)
    with pytest.raises(DuplicateKeyError):
        B.upsert_buckets(spark, first.union(first), name, "k1", root)
    with pytest.raises(ValueError, match="kept by"):
        B.upsert_buckets(spark, first, name, "k1,k2", root)
    assert B.upsert_buckets(spark, first.limit(0), name, "k1", root) == []
    latest = spark.createDataFrame([(1, "a", "x", 1), (1, "a", "y", 2)], SCHEMA + ", at int")
    first.write.saveAsTable(f"{ns}.other")
    with pytest.raises(ValueError, match="not kept in buckets"):
        B.upsert_buckets(spark, first, f"{ns}.other", "k1", root)
    assert rows(B.latest_by(latest, "k1", "at").drop("at")) == [(1, "a", "y")]


def test_a_stream_rewrites_touched_buckets(spark, scratch):
    from strata.plans.hospital import STAGING_SPECS
    from strata.streaming.incremental import stage_stream

    schema = "id_hospital string, nome string, cidade string, estado string"
    raw = f"{scratch}/raw/hospitais"
    spark.createDataFrame([(str(i), "a", "c", "e") for i in range(40)], schema).write.parquet(raw)
    spark.sql("CREATE NAMESPACE IF NOT EXISTS stream_ns")
    args = dict(spec=STAGING_SPECS["hospitais"], table="stream_ns.touched", table_root=f"{scratch}/t",
                checkpoint=f"{scratch}/c", touched_buckets=8)
    stage_stream(spark, raw, **args).awaitTermination()
    before = files(f"{scratch}/t")
    spark.createDataFrame([("2", "B", "c", "e")], schema).write.mode("append").parquet(raw)
    stage_stream(spark, raw, **args).awaitTermination()
    after = files(f"{scratch}/t")
    changed = {f.split(f"{B.BUCKET}=")[1].split("/")[0] for f in set(before) ^ set(after)}
    assert len(changed) == 1
    spark.catalog.refreshTable("stream_ns.touched")
    names = {r.id_hospital: r.nome for r in spark.table("stream_ns.touched").collect()}
    assert len(names) == 40 and names[2] == "B" and names[3] == "a"
