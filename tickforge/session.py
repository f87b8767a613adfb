"""Session settings that the jobs expect."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def with_rocksdb(spark: SparkSession) -> SparkSession:
    """The store that operators with several states a key need, for the streams that start from now on."""
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(key, SETTINGS[key])
    return spark
