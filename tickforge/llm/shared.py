"""Tables written to the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tickforge.staging import hadoop_path, shared_dir


class Scratch:
    """Written intermediate tables of one operator call, which go when the session ends. A written table cuts the lineage and outlives executors."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.mode("overwrite").parquet(path)
        fs, root = hadoop_path(self.spark, self.root)
        fs.deleteOnExit(root)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Delete a table that no later plan reads."""
        fs, path = hadoop_path(self.spark, self.path(name))
        fs.delete(path, True)
