"""Intermediate tables in the folder that driver and executors share. A written table cuts the lineage and outlives executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``. Where it is unset, a temporary folder if all runs on this machine, else an error."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return _local.setdefault(context.applicationId, "file://" + tempfile.mkdtemp(prefix="tickforge-"))


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of a path in any store."""
    out = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return out.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), out


def staged(df: DataFrame, name: str = "table") -> DataFrame:
    """`df` written once and read again; the table goes when the session ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    fs, at = hadoop_path(spark, path)
    fs.deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)
