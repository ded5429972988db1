"""Incremental staging: new raw files -> typed rows -> keyed upsert.

A file-source stream over a raw table folder picks up only files it has not
seen (tracked in the checkpoint). Each micro-batch is staged and upserted
with ``foreachBatch``. A batch replayed after a failure upserts the same
rows again, which leaves the table unchanged for unique non-NULL keys, so
the sink is effectively exactly-once. By default a batch writes a new version
of the table; ``touched_buckets`` rewrites part of it. The table is swapped by the stream's
session: other sessions call ``spark.catalog.refreshTable`` before reading.
``available_now`` processes what is
there and stops, the shape of a scheduled load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from strata.operators.bucketed import upsert_buckets
from strata.operators.staging import StagingSpec, stage
from strata.operators.upsert import upsert_table


def stage_stream(
    spark: SparkSession,
    raw_path: str,
    spec: StagingSpec,
    table: str,
    table_root: str,
    checkpoint: str,
    schema=None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    order_by: str | list[str] | None = None,
    touched_buckets: int | None = None,
) -> StreamingQuery:
    """Start the stream; ``schema`` defaults to the schema of the files
    present. With ``order_by`` a batch may hold several versions of a key, of
    which the last is kept. With ``touched_buckets`` the table is kept in so
    many buckets of its key, and a batch rewrites those it touches."""
    schema = schema or spark.read.parquet(raw_path).schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(raw_path)

    def upsert_batch(batch: DataFrame, epoch_id: int) -> None:
        rows, session = stage(batch, spec), batch.sparkSession
        if touched_buckets:
            upsert_buckets(session, rows, table, spec.key, table_root, buckets=touched_buckets, order_by=order_by)
        else:
            upsert_table(session, rows, table, spec.key, table_root, order_by=order_by)

    writer = stream.writeStream.foreachBatch(upsert_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
