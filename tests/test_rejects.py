"""Values lost by casts, lines that do not parse, folders found again, database loads, resumed runs."""

import os

import pytest

from strata.operators.rejects import FAILED, cast_failures, quarantine, rejected_rows
from strata.operators.staging import ColumnSpec, StagingSpec, stage
from strata.sources import catalog as C
from strata.sources.files import read_checked
from strata.sources.jdbc import extract_increment, level_predicates, read_jdbc_level, write_jdbc, write_jdbc_once
from strata.sources.sinks import write_quarantine

SPEC = StagingSpec("t", ("id",), (ColumnSpec("id", "int"), ColumnSpec("day", "date", "cast"), ColumnSpec("x", "double")))
DERBY = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


@pytest.fixture
def raw(spark):
    rows = [("1", "2024-01-05", "1.5"), ("x", "2024-02-30", "2"), (None, None, None), ("3000000000", "2024-01-05", ""), ("", "", "nan?")]
    return spark.createDataFrame(rows, "id string, day string, x string")


def test_failures_are_counted_and_kept(spark, raw, scratch):
    counts = {r["column"]: (r["rows"], r["failures"]) for r in cast_failures(raw, SPEC).collect()}
    assert counts == {"id": (5, 3), "day": (5, 2), "x": (5, 2)}
    seen = quarantine(raw, SPEC, f"{scratch}/rejects")
    assert seen == {"rows": 5, "id": 3, "day": 2, "x": 2}
    kept = {r["id"]: r[FAILED] for r in spark.read.parquet(f"{scratch}/rejects").collect()}
    assert kept == {"x": ["id", "day"], "3000000000": ["id", "x"], "": ["id", "day", "x"]}
    # the staged rows are all there, with NULLs
    assert stage(raw, SPEC).count() == 5 and rejected_rows(raw.filter("id = '1'"), SPEC).count() == 0


def test_nothing_to_reject(spark, raw, scratch):
    assert quarantine(raw.limit(0), SPEC, f"{scratch}/none") == {"rows": 0, "id": 0, "day": 0, "x": 0}
    assert spark.read.parquet(f"{scratch}/none").count() == 0


def test_bad_lines_go_to_quarantine(spark, scratch):
    os.makedirs(f"{scratch}/in")
    with open(f"{scratch}/in/a.csv", "w") as f:
        f.write('id,nome\n1,Ann\nx,Bob\n2\n3,"quoted, comma"\n4,a,b\n,\n')
    good, bad = read_checked(spark, f"{scratch}/in", "id int, nome string", header=True)
    assert sorted(map(tuple, good.collect()), key=repr) == sorted([(1, "Ann"), (3, "quoted, comma"), (None, None)], key=repr)
    assert good.select("nome").count() == 3  # not changed by the columns used
    assert write_quarantine(bad, f"{scratch}/q", "r1") == 3 == write_quarantine(bad, f"{scratch}/q", "r1")
    kept = spark.read.parquet(f"{scratch}/q/r1").collect()
    assert sorted(r["line"] for r in kept) == ["2", "4,a,b", "x,Bob"] and all(r["file"].endswith("a.csv") for r in kept)


def test_found_again(spark, scratch):
    base = f"{scratch}/lake/t"
    spark.createDataFrame([(1, "a")], "id int, nome string").write.parquet(f"{base}/day=1")
    spark.createDataFrame([(2, "b")], "id int, nome string").write.parquet(f"{base}/day=2")
    assert C.discover(spark, "again_ns", f"{scratch}/lake")["t"].count() == 2
    C.remove_folder(spark, f"{base}/day=1")
    spark.createDataFrame([(3, "c", 9.5)], "id int, nome string, nota double").write.parquet(f"{base}/day=3")
    found = C.discover(spark, "again_ns", f"{scratch}/lake")["t"]
    direct = spark.read.option("mergeSchema", True).parquet(base)
    assert sorted(map(tuple, found.select(*direct.columns).collect())) == sorted(map(tuple, direct.collect()))
    assert C.discover(spark, "again_ns", f"{scratch}/lake")["t"].count() == 2


def test_clustered_ids_are_read_in_level_slices(spark):
    url = "jdbc:derby:memory:strata_level;create=true"
    ids = list(range(1000)) + [10**9 + i * 7 for i in range(20)] + [5 * 10**8] * 60
    df = spark.createDataFrame([(i, f"h{i}") for i in ids] + [(None, "none")], "ID int, NOME string")
    write_jdbc(df, url, "CLUSTERED", DERBY, mode="overwrite", num_partitions=2)
    cuts = level_predicates(spark, url, "CLUSTERED", "ID", DERBY, num_partitions=8)
    back = read_jdbc_level(spark, url, "CLUSTERED", "ID", DERBY, num_partitions=8)
    sizes = [r[1] for r in back.selectExpr("spark_partition_id() AS p").groupBy("p").count().collect()]
    assert sum(sizes) == 1081 and len(cuts) <= 17 and max(sizes) <= 135
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    empty = spark.createDataFrame([], "ID int, NOME string")
    write_jdbc(empty, url, "NOTHING", DERBY, mode="overwrite")
    assert read_jdbc_level(spark, url, "NOTHING", "ID", DERBY).count() == 0


def test_a_second_extract_reads_new_rows_only(spark, scratch):
    url = "jdbc:derby:memory:strata_increment;create=true"
    rows = lambda a, b: spark.createDataFrame([(i, f"h{i}") for i in range(a, b)], "ID int, NOME string")
    write_jdbc(rows(0, 40), url, "LOG", DERBY, mode="overwrite")
    path, high = extract_increment(spark, url, "LOG", "ID", f"{scratch}/raw", DERBY)
    assert high == 39 and spark.read.parquet(path).count() == 40
    assert extract_increment(spark, url, "LOG", "ID", f"{scratch}/raw", DERBY) == (None, 39)
    write_jdbc(rows(40, 55), url, "LOG", DERBY)
    path, high = extract_increment(spark, url, "LOG", "ID", f"{scratch}/raw", DERBY)
    assert high == 54 and sorted(r.ID for r in spark.read.parquet(path).collect()) == list(range(40, 55))
    assert spark.read.parquet(f"{scratch}/raw/log").count() == 55


def test_a_repeated_seed_adds_nothing(spark):
    url = "jdbc:derby:memory:strata_once;create=true"
    df = spark.createDataFrame([(i, f"h{i}") for i in range(30)], "ID int, NOME string")
    write_jdbc(df.limit(0), url, "SEED", DERBY, mode="overwrite")
    assert write_jdbc_once(df, url, "SEED", "ID", DERBY) == 30
    assert write_jdbc_once(df, url, "SEED", "ID", DERBY) == 0
    more = df.unionByName(spark.createDataFrame([(99, "new")], "ID int, NOME string"))
    assert write_jdbc_once(more, url, "SEED", "ID", DERBY) == 1
    assert spark.read.jdbc(url, "SEED", properties=DERBY).count() == 31


def test_a_failed_run_is_resumed(spark, scratch, monkeypatch):
    from strata.plans import standins as S
    from strata.plans import workflow as W
    from strata.plans.ledger import IncompleteLayerError, Ledger
    from tests.conftest import SF_SMALL

    raw = S.raw_tables(spark, SF_SMALL)
    args = dict(raw=raw, staged_namespace="resumed_staged", curated_namespace="resumed", run_id="day-1")
    plain, loads = W.stage_table, []

    def stage_table(spark, table, *rest):
        loads.append(table)
        if table == "exames" and loads.count("exames") == 1:
            raise OSError("lost")
        return plain(spark, table, *rest)

    monkeypatch.setattr(W, "stage_table", stage_table)
    with pytest.raises(OSError):
        W.run_all(spark, f"{scratch}/t", **args)
    assert not spark.catalog.tableExists("resumed.dim_hospital")
    with pytest.raises(IncompleteLayerError, match="exames"):
        W.run_curation(spark, "resumed_staged", "resumed", f"{scratch}/t", ledger=Ledger(spark, f"{scratch}/t", "day-1"))
    outcomes = W.run_all(spark, f"{scratch}/t", rejects_root=f"{scratch}/rejects", **args)
    assert sorted(loads) == sorted([*raw, "exames"])  # the six others ran once
    assert outcomes.count() == 83
    W.run_all(spark, f"{scratch}/t", **args)
    assert len(loads) == 8


def test_a_statement_is_ended_in_time(spark):
    import time

    from strata.operators.sqlsurface import respond

    began = time.time()
    got = respond(spark, "SELECT count(*) AS n FROM range(100000) a JOIN range(100000) b ON sqrt(a.id * b.id) < -1", timeout=2)
    assert got["status"] == 400 and "longer than 2 s" in got["details"] and time.time() - began < 30
    assert respond(spark, "SELECT 1 AS one", timeout=60)["rows"] == [{"one": 1}]
