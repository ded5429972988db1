"""Randomised invariants: upsert idempotence and row counts,
salted fan-out join = plain left join, union row counts."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.operators.joins import left_join_counted, times_in
from strata.operators.upsert import merged

SCHEMA = "k int, v string"
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

keys = st.integers(min_value=0, max_value=12)
rows = st.lists(st.tuples(keys, st.sampled_from(["a", "b", "c"])), max_size=15)
unique_rows = rows.map(lambda r: list({k: (k, v) for k, v in r}.values()))


def bag(df):
    return sorted(map(tuple, df.collect()), key=repr)


@SETTINGS
@given(target=unique_rows, source=unique_rows)
def test_upsert_invariants(spark, target, source):
    t = spark.createDataFrame(target, SCHEMA)
    s = spark.createDataFrame(source, SCHEMA)
    once = merged(t, s, "k")
    expected = {k: v for k, v in target}
    expected.update({k: v for k, v in source})
    assert bag(once) == sorted(expected.items(), key=repr)
    assert bag(merged(once, s, "k")) == bag(once)


@SETTINGS
@given(
    left=st.lists(st.tuples(st.integers(0, 200), st.one_of(st.none(), keys)), max_size=25),
    right=st.lists(st.tuples(st.one_of(st.none(), keys), st.integers(0, 3)), max_size=25),
    broadcast_rows=st.sampled_from([0, 1, 100]),
)
def test_counted_joins_equal_left_join(spark, left, right, broadcast_rows):
    lf = spark.createDataFrame(left, "lid int, k int")
    rf = spark.createDataFrame(right, "k int, rid int")
    plain = lf.join(rf, "k", "left")
    assert bag(left_join_counted(lf, rf, "k", "rid").select(plain.columns)) == bag(plain)
    assert bag(times_in(lf, rf, "k", broadcast_rows)) == bag(plain.select("lid", "k"))
