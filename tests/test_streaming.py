from strata.plans.hospital import STAGING_SPECS
from strata.streaming.incremental import stage_stream

SCHEMA = "id_hospital string, nome string, cidade string, estado string"


def test_incremental_staging(spark, scratch):
    raw = f"{scratch}/raw/hospitais"
    spark.createDataFrame([("1", "a", "c", "e"), ("2", "b", "c", "e")], SCHEMA).write.mode("append").parquet(raw)
    spark.sql("CREATE NAMESPACE IF NOT EXISTS stream_ns")
    args = dict(spec=STAGING_SPECS["hospitais"], table="stream_ns.hospitais",
                table_root=f"{scratch}/tables/hospitais", checkpoint=f"{scratch}/ckpt")
    q = stage_stream(spark, raw, **args)
    q.awaitTermination()
    assert spark.table("stream_ns.hospitais").count() == 2
    # a new file: one update, one insert; old files are not read again
    spark.createDataFrame([("2", "B", "c", "e"), ("3", "c", "c", "e")], SCHEMA).write.mode("append").parquet(raw)
    q = stage_stream(spark, raw, **args)
    q.awaitTermination()
    spark.catalog.refreshTable("stream_ns.hospitais")  # the batches ran in the stream's session
    rows = {r.id_hospital: r.nome for r in spark.table("stream_ns.hospitais").collect()}
    assert rows == {1: "a", 2: "B", 3: "c"}


def test_replayed_files_leave_the_table_unchanged(spark, scratch):
    """A batch delivered again (fresh checkpoint = every file replayed) upserts
    the same rows: the table is unchanged."""
    raw = f"{scratch}/raw/hospitais"
    spark.createDataFrame([("1", "a", "c", "e"), ("2", "b", "c", "e")], SCHEMA).write.parquet(raw)
    spark.sql("CREATE NAMESPACE IF NOT EXISTS stream_ns")
    common = dict(spec=STAGING_SPECS["hospitais"], table="stream_ns.replay", table_root=f"{scratch}/tables/replay")
    stage_stream(spark, raw, checkpoint=f"{scratch}/ckpt1", **common).awaitTermination()
    spark.catalog.refreshTable("stream_ns.replay")
    before = sorted(map(tuple, spark.table("stream_ns.replay").collect()))
    stage_stream(spark, raw, checkpoint=f"{scratch}/ckpt2", **common).awaitTermination()
    spark.catalog.refreshTable("stream_ns.replay")
    assert sorted(map(tuple, spark.table("stream_ns.replay").collect())) == before
