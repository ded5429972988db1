import pytest

from strata.operators.upsert import DuplicateKeyError, check_source, merged, table_location, upsert_table

SCHEMA = "k1 int, k2 string, v string"


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def test_merge_update_insert_keep(spark):
    target = spark.createDataFrame([(1, "a", "old"), (2, "b", "same"), (None, "n", "t")], SCHEMA)
    source = spark.createDataFrame([(1, "a", "new"), (3, "c", "ins"), (None, "n", "s")], SCHEMA)
    out = merged(target, source, "k1")
    # NULL key never matches: both NULL rows stay (faithful MERGE semantics)
    assert rows(out) == sorted([(1, "a", "new"), (2, "b", "same"), (3, "c", "ins"), (None, "n", "t"),
                                (None, "n", "s")], key=repr)
    matched = merged(target, source, "k1", null_keys="match")
    assert (None, "n", "t") not in rows(matched) and (None, "n", "s") in rows(matched)


def test_composite_key_text(spark):
    target = spark.createDataFrame([(1, "a", "x"), (1, "b", "y")], SCHEMA)
    source = spark.createDataFrame([(1, "b", "z")], SCHEMA)
    assert rows(merged(target, source, "k1,k2")) == [(1, "a", "x"), (1, "b", "z")]


def test_empty_sides(spark):
    empty = spark.createDataFrame([], SCHEMA)
    data = spark.createDataFrame([(1, "a", "x")], SCHEMA)
    assert rows(merged(empty, data, "k1")) == [(1, "a", "x")]
    assert rows(merged(data, empty, "k1")) == [(1, "a", "x")]


def test_duplicate_source_keys_raise(spark):
    source = spark.createDataFrame([(1, "a", "x"), (1, "a", "y")], SCHEMA)
    with pytest.raises(DuplicateKeyError, match="duplicate"):
        check_source(source, ["k1", "k2"])
    with pytest.raises(ValueError):
        check_source(spark.createDataFrame([(None, "a", "x")], SCHEMA), ["k1"], null_keys="reject")


def test_upsert_twice_is_upsert_once(spark):
    target = spark.createDataFrame([(i, str(i), "t") for i in range(20)], SCHEMA)
    source = spark.createDataFrame([(i, str(i), "s") for i in range(10, 30)], SCHEMA)
    once = merged(target, source, "k1")
    twice = merged(once, source, "k1")
    assert rows(once) == rows(twice)
    assert once.count() == 30


def test_upsert_table_versions(spark, scratch):
    spark.sql("CREATE NAMESPACE IF NOT EXISTS up_ns")
    first = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], SCHEMA)
    p1 = upsert_table(spark, first, "up_ns.t", "k1", f"{scratch}/t")
    assert rows(spark.table("up_ns.t")) == [(1, "a", "x"), (2, "b", "y")]
    second = spark.createDataFrame([(2, "b", "z"), (3, "c", "w")], SCHEMA)
    p2 = upsert_table(spark, second, "up_ns.t", "k1", f"{scratch}/t")
    assert p1 != p2 and table_location(spark, "up_ns.t").endswith(p2.split("/")[-1])
    assert rows(spark.table("up_ns.t")) == [(1, "a", "x"), (2, "b", "z"), (3, "c", "w")]
    upsert_table(spark, second, "up_ns.t", "k1", f"{scratch}/t")  # re-run safe
    assert spark.table("up_ns.t").count() == 3
    with pytest.raises(DuplicateKeyError):
        upsert_table(spark, second.union(second), "up_ns.t", "k1", f"{scratch}/t")


def test_replace_table_positional_versions(spark, scratch):
    from strata.operators.upsert import replace_table

    spark.sql("CREATE NAMESPACE IF NOT EXISTS up_ns")
    first = spark.createDataFrame([(1, "a", "x")], SCHEMA)
    replace_table(spark, first, "up_ns.r", f"{scratch}/r", comment="refreshed")
    # different names, same positions: matched by position
    second = spark.createDataFrame([(2, "b", "y"), (3, "c", "z")], "a int, b string, c string")
    replace_table(spark, second, "up_ns.r", f"{scratch}/r")
    assert spark.table("up_ns.r").columns == ["k1", "k2", "v"]
    assert rows(spark.table("up_ns.r")) == [(2, "b", "y"), (3, "c", "z")]
    with pytest.raises(ValueError, match="columns"):
        replace_table(spark, spark.createDataFrame([(1,)], "a int"), "up_ns.r", f"{scratch}/r")


def test_bucketed_upsert_shuffles_only_the_source(spark, scratch):
    import contextlib
    import io

    from strata.operators.upsert import bucket_spec

    spark.sql("CREATE NAMESPACE IF NOT EXISTS up_ns")
    first = spark.createDataFrame([(i, str(i), "t") for i in range(40)], SCHEMA)
    upsert_table(spark, first, "up_ns.b", "k1", f"{scratch}/b", buckets=4)
    assert bucket_spec(spark, "up_ns.b") == (4, ["k1"])
    second = spark.createDataFrame([(i, str(i), "s") for i in range(30, 50)], SCHEMA)
    upsert_table(spark, second, "up_ns.b", "k1", f"{scratch}/b")
    assert bucket_spec(spark, "up_ns.b") == (4, ["k1"])
    got = dict((r.k1, r.v) for r in spark.table("up_ns.b").collect())
    assert len(got) == 50 and got[10] == "t" and got[35] == "s" and got[49] == "s"
    # with broadcasting off, the anti join shuffles the source side only
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            merged(spark.table("up_ns.b"), second, "k1").explain()
        plan = out.getvalue()
        assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
