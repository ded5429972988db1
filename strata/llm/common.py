"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the
    session. Only a session in one local process (tests) may lack it; it then
    gets a temporary folder."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="strata-llm-"))
        path = sc.getCheckpointDir()
    return path.rstrip("/")


BATCH_ROWS = 1000  # whole texts handed to a Python worker at a time


def returning(frames):
    """The frames of a task's generator; when it ends, memory that the Python
    worker freed goes back to the system: workers stay between tasks, beside
    the JVM and one another."""
    import ctypes
    import gc

    import pyarrow as pa

    try:
        yield from frames
    finally:
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library
            pass


@contextmanager
def small_batches(spark: SparkSession):
    """Arrow batches of at most ``BATCH_ROWS`` rows for what runs inside: a row
    may be a long text, and a worker holds a batch in several forms."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(BATCH_ROWS, int(before)) if int(before) > 0 else BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stored(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written once as Parquet into the shared folder and read back.

    Cuts the lineage: what follows reads files that survive lost executors.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/strata-{tag}-{uuid.uuid4().hex}"
    with small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_hashes(df: DataFrame) -> list:
    """Two 64-bit hashes of whole rows: alike in both only for equal rows."""

    def hashable(field) -> object:
        c = F.col(f"`{field.name}`")
        return F.to_json(F.struct(c)) if "map<" in field.dataType.simpleString() else c  # maps have no hash

    columns = [hashable(f) for f in df.schema.fields]
    return [F.xxhash64(F.lit(i), *columns).alias(name) for i, name in enumerate(("__a", "__b"))]


def words_of(text: str) -> str:
    """SQL expression: the words of the (non-null) string expression ``text``:
    runs of anything but the six ASCII blanks."""
    bare = f"btrim({text}, ' \\t\\n\\u000b\\u000c\\r')"
    return f"IF({bare} = '', CAST(array() AS ARRAY<STRING>), split({bare}, '[\\\\x20\\\\x09-\\\\x0D]+'))"
