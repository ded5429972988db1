"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job of the library relies on. AQE re-plans joins from
# measured shuffle sizes (broadcast only what is actually small), coalesces
# tiny partitions and splits skewed ones. Dates and times are UTC so results
# do not depend on the machine running the driver.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # layer loads run as concurrent jobs, one scheduler pool each
    "spark.scheduler.mode": "FAIR",
}


def session_conf(
    shuffle_partitions: int | None = None,
    warehouse: str | None = None,
    catalog: str | None = None,
    catalog_impl: str | None = None,
    catalog_conf: dict[str, str] | None = None,
    conf: dict[str, str] | None = None,
) -> dict[str, str]:
    """The settings :func:`build_session` applies.

    ``catalog`` names an extra table catalog (for example an Iceberg catalog)
    made the default one: ``catalog_impl`` is its class and ``catalog_conf``
    its options (``{"warehouse": ...}`` becomes
    ``spark.sql.catalog.<catalog>.warehouse``). They are applied only when
    asked for, since such jars are not bundled.
    """
    settings = dict(_DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if warehouse:
        settings["spark.sql.warehouse.dir"] = warehouse
    if catalog:
        settings["spark.sql.defaultCatalog"] = catalog
        if catalog_impl:
            settings[f"spark.sql.catalog.{catalog}"] = catalog_impl
        for key, value in (catalog_conf or {}).items():
            settings[f"spark.sql.catalog.{catalog}.{key.lstrip('.')}"] = value
    settings.update(conf or {})
    return settings


def build_session(
    master: str | None = None,
    app_name: str = "strata",
    shuffle_partitions: int | None = None,
    warehouse: str | None = None,
    catalog: str | None = None,
    catalog_impl: str | None = None,
    catalog_conf: dict[str, str] | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) the session used by all jobs (see :func:`session_conf`)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = session_conf(shuffle_partitions, warehouse, catalog, catalog_impl, catalog_conf, conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared folder for lineage cuts and versioned tables.

    The cluster names it in ``spark.checkpoint.dir``; only when that is unset
    and Spark runs locally (tests) a folder is created and registered. On a
    cluster an unset setting is an error rather than a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        return current
    if fallback is None and not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir is not set; name a folder shared by all executors")
    path = fallback or tempfile.mkdtemp(prefix="strata-ckpt-")
    os.makedirs(path, exist_ok=True)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path
