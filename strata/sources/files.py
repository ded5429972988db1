"""File and catalog sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.catalog import quote


def read_csv(spark: SparkSession, path: str, header: bool = True, infer_schema: bool = True) -> DataFrame:
    """Header CSV with inferred types (a pass over all files runs first; use
    ``read_delimited`` with a schema for large inputs)."""
    return spark.read.csv(path, header=header, inferSchema=infer_schema)


def read_delimited(
    spark: SparkSession, path: str, schema: str, sep: str = ",", header: bool = False
) -> DataFrame:
    """Delimited text with a declared schema, PERMISSIVE: a field that does
    not parse becomes NULL, the row is kept."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").csv(path, sep=sep, header=header)


BAD_LINE = "__bad_line"


def read_checked(
    spark: SparkSession, path: str, schema: str, sep: str = ",", header: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Delimited text with a declared schema, split into the rows that parse
    and the lines that do not: a field of another type, too few or too many
    fields. The bad ones are (file, line). Both sides parse every column, so
    which lines are bad does not depend on the columns that are used later."""
    reader = spark.read.schema(f"{schema}, `{BAD_LINE}` string").option("mode", "PERMISSIVE")
    reader = reader.option("columnNameOfCorruptRecord", BAD_LINE).option("columnPruning", "false")
    rows = reader.csv(path, sep=sep, header=header)
    fields = [c for c in rows.columns if c != BAD_LINE]
    # always true, but reads every field: Spark refuses to look at the text of bad records alone
    parsed = F.bit_count(F.hash(*fields)) >= 0
    good = rows.filter(F.col(BAD_LINE).isNull() & parsed).drop(BAD_LINE)
    bad = rows.filter(F.col(BAD_LINE).isNotNull() & parsed)
    return good, bad.select(F.col("_metadata.file_path").alias("file"), F.col(BAD_LINE).alias("line"))


def create_text_table(
    spark: SparkSession, table: str, schema: str, location: str, sep: str = ",", header: bool = False
) -> DataFrame:
    """``CREATE TABLE ... USING csv LOCATION`` over delimited text files."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {quote(table)} ({schema}) USING csv "
        f"OPTIONS (sep '{sep}', header '{str(header).lower()}', mode 'PERMISSIVE') LOCATION '{location}'"
    )
    return spark.table(table)


def read_parquet_dir(spark: SparkSession, base: str, table: str) -> DataFrame:
    """Raw Parquet folder of one table: ``base/table/``."""
    return spark.read.parquet(f"{base.rstrip('/')}/{table}/")


def read_table(spark: SparkSession, namespace: str, table: str) -> DataFrame:
    return spark.table(f"{namespace}.{table}")
