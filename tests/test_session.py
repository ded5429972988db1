from strata.session import checkpoint_dir, session_conf


def test_session_conf_catalog_only_when_asked():
    base = session_conf()
    assert base["spark.sql.adaptive.enabled"] == "true"
    assert base["spark.sql.session.timeZone"] == "UTC"
    assert not any(k.startswith("spark.sql.catalog.") for k in base)
    conf = session_conf(
        shuffle_partitions=32,
        catalog="lake",
        catalog_impl="org.apache.iceberg.spark.SparkCatalog",
        catalog_conf={"warehouse": "s3://bucket/wh", ".type": "rest"},
    )
    assert conf["spark.sql.shuffle.partitions"] == "32"
    assert conf["spark.sql.defaultCatalog"] == "lake"
    assert conf["spark.sql.catalog.lake"] == "org.apache.iceberg.spark.SparkCatalog"
    assert conf["spark.sql.catalog.lake.warehouse"] == "s3://bucket/wh"
    assert conf["spark.sql.catalog.lake.type"] == "rest"


def test_checkpoint_dir_reads_the_session(spark):
    assert checkpoint_dir(spark) == checkpoint_dir(spark)
