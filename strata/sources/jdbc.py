"""Relational sources and sinks over JDBC.

Reads are split into ``num_partitions`` range queries on a numeric column so
every executor pulls a slice; bounds come from one ``min/max`` query pushed
to the database when not given. Where ids are clustered, equal widths make
unequal slices: ``level_predicates`` lets the database count rows per range and
cuts the crowded ranges again, until the slices are level.

``extract_increment`` copies only rows beyond the last extract's highest id;
``write_jdbc_once`` adds only rows whose key is not there yet.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    mode: str = "append",
    batch_size: int = 10_000,
    num_partitions: int | None = None,
) -> None:
    """Append (or overwrite) a frame into a database table; each task writes
    its partition in batches. ``num_partitions`` caps concurrent connections."""
    out = df.coalesce(num_partitions) if num_partitions else df
    props = dict(properties or {})
    props.setdefault("batchsize", str(batch_size))
    out.write.jdbc(url, table, mode=mode, properties=props)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    num_partitions: int = 8,
    lower: int | None = None,
    upper: int | None = None,
) -> DataFrame:
    props = dict(properties or {})
    if not partition_column:
        return spark.read.jdbc(url, table, properties=props)
    if lower is None or upper is None:
        bounds = spark.read.jdbc(
            url,
            f"(SELECT MIN({partition_column}) AS lo, MAX({partition_column}) AS hi FROM {table}) b",
            properties=props,
        ).first()
        found = {k.lower(): v for k, v in bounds.asDict().items()}
        lower = int(found["lo"] or 0)
        upper = int(found["hi"] or 0)
    return spark.read.jdbc(
        url,
        table,
        column=partition_column,
        lowerBound=lower,
        upperBound=upper + 1,
        numPartitions=num_partitions,
        properties=props,
    )


def _pushed(spark: SparkSession, url: str, sql: str, properties) -> list[dict]:
    rows = spark.read.jdbc(url, f"({sql}) q", properties=dict(properties or {})).collect()
    return [{k.lower(): v for k, v in r.asDict().items()} for r in rows]


_BINS = 32


def level_predicates(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    properties: dict[str, str] | None = None,
    num_partitions: int = 8,
) -> list[str]:
    """Read predicates on an integer column that cut the table into at most
    about twice ``num_partitions`` slices of at most about its share of rows
    each, however the ids lie. The database counts rows in bins of equal width;
    a bin with more than a share is binned again. A single crowded id stays one
    slice, rows without an id are one more."""
    total = _pushed(
        spark, url, f"SELECT COUNT(*) AS n, COUNT({column}) AS k, MIN({column}) AS lo, MAX({column}) AS hi FROM {table}", properties
    )[0]
    found = [f"{column} IS NULL"] if total["n"] > total["k"] else []
    if not total["k"]:
        return found or [f"{column} IS NULL"]
    share = max(1, -(-total["k"] // num_partitions))
    bins: list[tuple[int, int, int]] = []
    crowded = [(int(total["lo"]), int(total["hi"]), int(total["k"]))]
    while crowded:
        lo, hi, n = crowded.pop()
        if n <= share or lo == hi:
            bins.append((lo, hi, n))
            continue
        width = max(1, -(-(hi - lo + 1) // _BINS))
        inner = f"SELECT ({column} - ({lo})) / {width} AS b FROM {table} WHERE {column} BETWEEN {lo} AND {hi}"
        for r in _pushed(spark, url, f"SELECT b, COUNT(*) AS n FROM ({inner}) x GROUP BY b", properties):
            at = lo + int(r["b"]) * width
            crowded.append((at, min(hi, at + width - 1), int(r["n"])))
    bins.sort()
    slices: list[tuple[int, int, int]] = []
    for lo, hi, n in bins:  # neighbours are joined up to a share
        if slices and slices[-1][2] + n <= share:
            slices[-1] = (slices[-1][0], hi, slices[-1][2] + n)
        else:
            slices.append((lo, hi, n))
    return [f"{column} >= {lo} AND {column} <= {hi}" for lo, hi, _ in slices] + found


def read_jdbc_level(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    properties: dict[str, str] | None = None,
    num_partitions: int = 8,
) -> DataFrame:
    """The table in slices of level size (``level_predicates``)."""
    cuts = level_predicates(spark, url, table, column, properties, num_partitions)
    return spark.read.jdbc(url, table, predicates=cuts, properties=dict(properties or {}))


def last_watermark(spark: SparkSession, raw_root: str, name: str) -> int | None:
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(f"{raw_root.rstrip('/')}.watermarks/{name}").agg({"high": "max"}).first()[0]
    except AnalysisException:  # no extract yet
        return None


def extract_increment(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    raw_root: str,
    properties: dict[str, str] | None = None,
    num_partitions: int = 8,
) -> tuple[str | None, int | None]:
    """Copy the rows whose integer ``column`` lies beyond the last extract's
    highest value into ``raw_root/<table>/extract_from=<that value>``; returns
    the folder (None: nothing new) and the new highest value.

    The highest value is read first and bounds the copy, so rows that arrive
    meanwhile wait for the next extract. The watermark is written after the
    rows; a job that dies in between copies the same range into the same
    folder again, so nothing is lost or doubled."""
    name = table.split(".")[-1].lower()
    last = last_watermark(spark, raw_root, name)
    high = _pushed(spark, url, f"SELECT MAX({column}) AS hi FROM {table}", properties)[0]["hi"]
    if high is None or (last is not None and int(high) <= last):
        return None, last
    beyond = f"{column} > {last} AND " if last is not None else ""
    bounded = f"(SELECT * FROM {table} WHERE {beyond}{column} <= {int(high)}) u"
    rows = read_jdbc_level(spark, url, bounded, column, properties, num_partitions)
    path = f"{raw_root.rstrip('/')}/{name}/extract_from={'start' if last is None else last}"
    rows.write.mode("overwrite").parquet(path)
    mark = spark.createDataFrame([(last, int(high))], "low long, high long")
    mark.write.mode("append").parquet(f"{raw_root.rstrip('/')}.watermarks/{name}")
    return path, int(high)


def _execute(spark: SparkSession, url: str, statements: list[str], properties: dict[str, str]) -> list[int]:
    """Run statements on the database from the driver, in one transaction."""
    jvm = spark._jvm
    props = jvm.java.util.Properties()
    for k, v in properties.items():
        props.setProperty(k, v)
    if "driver" in properties:
        jvm.java.lang.Class.forName(properties["driver"])
    link = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        link.setAutoCommit(False)
        done = [link.createStatement().executeUpdate(s) for s in statements]
        link.commit()
        return done
    finally:
        link.close()


def write_jdbc_once(
    df: DataFrame,
    url: str,
    table: str,
    key: str | list[str],
    properties: dict[str, str] | None = None,
    batch_size: int = 10_000,
    num_partitions: int | None = None,
) -> int:
    """Insert the rows whose key the (existing) table does not hold yet, and
    return how many those were. Tasks fill a load table of this run's own; one
    statement then moves its new keys over, so a repeated seed adds nothing
    and a lost job leaves the table as it was. Rows without a key are always
    new. Keys of ``df`` should be unique."""
    keys = [key] if isinstance(key, str) else list(key)
    props = dict(properties or {})
    load = f"{table}_LOAD_{uuid.uuid4().hex[:8].upper()}"
    write_jdbc(df, url, load, props, mode="overwrite", batch_size=batch_size, num_partitions=num_partitions)
    columns = ", ".join(f'"{c}"' for c in df.columns)
    same = " AND ".join(f't."{k}" = s."{k}"' for k in keys)
    insert = f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {load} s WHERE NOT EXISTS (SELECT 1 FROM {table} t WHERE {same})"
    try:
        return _execute(df.sparkSession, url, [insert], props)[0]
    finally:
        _execute(df.sparkSession, url, [f"DROP TABLE {load}"], props)


def spark_of(df: DataFrame) -> SparkSession:
    return df.sparkSession


def extract_to_parquet(
    spark: SparkSession,
    url: str,
    tables: list[str],
    raw_root: str,
    properties: dict[str, str] | None = None,
    partition_columns: dict[str, str] | None = None,
    num_partitions: int = 8,
) -> dict[str, str]:
    """Copy database tables into one raw Parquet folder each
    (``raw_root/<table>/``), the input of staging."""
    out = {}
    for t in tables:
        col = (partition_columns or {}).get(t)
        df = read_jdbc(spark, url, t, properties, col, num_partitions)
        name = t.split(".")[-1].lower()
        path = f"{raw_root.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(path)
        out[name] = path
    return out
