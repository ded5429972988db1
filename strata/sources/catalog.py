"""Namespaces, tables and layer documentation in the session catalog."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def quote(name: str) -> str:
    return ".".join(f"`{p.strip('`')}`" for p in name.split("."))


def create_namespace(spark: SparkSession, namespace: str, comment: str | None = None) -> None:
    sql = f"CREATE NAMESPACE IF NOT EXISTS {quote(namespace)}"
    if comment:
        sql += " COMMENT '" + comment.replace("'", "\\'") + "'"
    spark.sql(sql)


def ddl_columns(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def create_table_from_df(
    spark: SparkSession,
    df: DataFrame,
    table: str,
    location: str | None = None,
    compression: str = "zstd",
    comment: str | None = None,
) -> None:
    """``CREATE TABLE IF NOT EXISTS`` with the DDL taken from ``df``'s schema."""
    sql = (
        f"CREATE TABLE IF NOT EXISTS {quote(table)} ({ddl_columns(df.schema)}) "
        f"USING parquet OPTIONS ('compression' = '{compression}')"
    )
    if location:
        sql += f" LOCATION '{location}'"
    if comment:
        sql += " COMMENT '" + comment.replace("'", "\\'") + "'"
    spark.sql(sql)


def create_table_at(spark: SparkSession, table: str, schema: StructType, location: str) -> None:
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {quote(table)} ({ddl_columns(schema)}) "
        f"USING parquet OPTIONS ('compression' = 'zstd') LOCATION '{location}'"
    )


def register_path(
    spark: SparkSession,
    table: str,
    path: str,
    fmt: str = "parquet",
    partitioned: bool | None = None,
) -> DataFrame:
    """Register files found under ``path`` as a table with an inferred schema
    (the crawler's job). The schema is merged over all files, and partition
    folders ``k=v`` become partition columns (``partitioned=None``: if there
    are any). Registering again brings the table up to date: columns that
    newer files have are added, partitions are added and removed as their
    folders are. Columns that no file has any more stay, and read as NULL."""
    found = spark.read.option("mergeSchema", True).format(fmt).load(path)
    if not spark.catalog.tableExists(table):
        parts = partition_columns(spark, path, fmt) if partitioned is None or partitioned else []
        by = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in parts)})" if parts else ""
        spark.sql(f"CREATE TABLE {quote(table)} ({ddl_columns(found.schema)}) USING {fmt}{by} LOCATION '{path}'")
    else:
        known = {c.name.lower() for c in spark.catalog.listColumns(table)}
        more = [f for f in found.schema.fields if f.name.lower() not in known]
        if more:
            spark.sql(f"ALTER TABLE {quote(table)} ADD COLUMNS ({ddl_columns(StructType(more))})")
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        spark.sql(f"MSCK REPAIR TABLE {quote(table)} SYNC PARTITIONS")
    spark.catalog.refreshTable(table)
    return spark.table(table)


def partition_columns(spark: SparkSession, path: str, fmt: str = "parquet") -> list[str]:
    """The columns that come from ``k=v`` folders, outermost first."""
    frame = spark.read.format(fmt).load(path)
    inside = frame.select("_metadata.file_path").first()
    if inside is None:
        return []
    base = path.rstrip("/").split("://")[-1].lstrip("/")
    below = unquote(inside["file_path"]).split(base, 1)[-1]
    names = {c.lower(): c for c in frame.columns}
    folders = [unquote(p.split("=", 1)[0]) for p in below.split("/")[:-1] if "=" in p]
    return [names[n.lower()] for n in folders if n.lower() in names]


def subfolders(spark: SparkSession, root: str) -> list[str]:
    """Names of the visible folders directly under ``root``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    listed = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    names = [s.getPath().getName() for s in listed if s.isDirectory()]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder of the lake with all it holds."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def discover(
    spark: SparkSession,
    namespace: str,
    root: str,
    names: list[str] | None = None,
    prefix: str = "",
    fmt: str = "parquet",
) -> dict[str, DataFrame]:
    """Register one table per sub-folder ``root/<name>`` as
    ``namespace.<prefix><name>``, partitions included; without ``names`` the
    folder is listed."""
    create_namespace(spark, namespace)
    names = subfolders(spark, root) if names is None else names
    return {
        n: register_path(spark, f"{namespace}.{prefix}{n}", f"{root.rstrip('/')}/{n}", fmt) for n in names
    }


def comment_table(spark: SparkSession, table: str, text: str, columns: dict[str, str] | None = None) -> None:
    esc = text.replace("'", "\\'")
    spark.sql(f"COMMENT ON TABLE {quote(table)} IS '{esc}'")
    for col, c_text in (columns or {}).items():
        c_esc = c_text.replace("'", "\\'")
        spark.sql(f"ALTER TABLE {quote(table)} ALTER COLUMN `{col}` COMMENT '{c_esc}'")


def describe_layer(spark: SparkSession, namespace: str) -> DataFrame:
    """One row per table of a namespace: name, comment and column list."""
    rows = []
    for t in spark.catalog.listTables(namespace):
        cols = spark.catalog.listColumns(f"{namespace}.{t.name}")
        rows.append((t.name, t.description, ", ".join(f"{c.name} {c.dataType}" for c in cols)))
    return spark.createDataFrame(rows, "table string, description string, columns string")
