"""Gapless places of rows in an order, without one task per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import Scratch

#: Rows of a range part, some.
PART_ROWS = 250_000


def source_key(source: Column) -> Column:
    """A key that is never null and sorts like the source's UTF-8 bytes, null first."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit(""))


def placed(rows: DataFrame, by: list[str], order: list[str], scratch: Scratch, name: str) -> DataFrame:
    """`rows` with `pos` (from 0, by `order` within `by`, nulls first) and `n` (rows of the key); `by` holds no nulls.

    Rows are dealt by ranges of (by, order) and written with the number of their part. A place is then the rows of the
    key in the parts before, from a table with a row a key and part, and the place within the part, so a key that holds
    a third of all rows is spread over as many parts. `rows` must be cheap to read twice.
    """
    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // PART_ROWS))
    cut = scratch.write(rows.repartitionByRange(parts, *by, *order).withColumn("__part", F.spark_partition_id()), name)
    sizes = cut.groupBy(*by, "__part").agg(F.count("*").alias("__rows"))
    key = Window.partitionBy(*by)
    before = F.coalesce(F.sum("__rows").over(key.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(*by, "__part", before.alias("__before"), F.sum("__rows").over(key).alias("n"))
    at = F.row_number().over(Window.partitionBy(*by, "__part").orderBy(*order)) - 1
    out = cut.withColumn("__at", at).join(sizes, [*by, "__part"])
    return out.withColumn("pos", (F.col("__before") + F.col("__at")).cast("long")).drop("__part", "__before", "__at")
