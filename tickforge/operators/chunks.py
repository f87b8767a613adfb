"""Ordered work on long series without one task per series.

A window over a whole instrument would put its entire history into one task. Here a series is cut into time chunks:
windows run inside a chunk, and what a chunk needs from before is either one carried row (the last of the chunk
before) or a copied stretch (the last `overlap` of time).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickforge.functions.times import DAY


def chunk_of(ts: Column, chunk_us: int) -> Column:
    return F.floor((ts - F.pmod(ts, F.lit(chunk_us))) / chunk_us)


def with_previous(df: DataFrame, key: list[str], order: list[str], values: dict[str, str], ts: str = "ts_us", chunk_us: int = DAY) -> DataFrame:
    """Adds for each new name the value of a column in the row before (by `order` within `key`); null for the first row."""
    names = [*order, *values.values()]
    cut = df.withColumn("__chunk", chunk_of(F.col(ts), chunk_us))
    w = Window.partitionBy(*key, "__chunk").orderBy(*order)
    held = cut.withColumn("__prev", F.lag(F.struct(*dict.fromkeys(names))).over(w))
    # One row a chunk: small enough for a window over the series.
    ends = cut.groupBy(*key, "__chunk").agg(F.max_by(F.struct(*dict.fromkeys(names)), F.struct(*order)).alias("__end"))
    carried = ends.select(*key, "__chunk", F.lag("__end").over(Window.partitionBy(*key).orderBy("__chunk")).alias("__carry"))
    out = held.join(carried, [*key, "__chunk"])
    before = F.coalesce("__prev", "__carry")
    return out.withColumns({new: before[old] for new, old in values.items()}).drop("__chunk", "__prev", "__carry")


def with_overlap(df: DataFrame, overlap_us: int, ts: str = "ts_us", chunk_us: int = DAY, ahead_us: int = 0) -> DataFrame:
    """Each row in its own chunk (`__own` true), in the later chunks that begin within `overlap_us` after it, and in the
    earlier ones that end within `ahead_us` before it (for frames that look forward)."""
    own = chunk_of(F.col(ts), chunk_us)
    first, last = chunk_of(F.col(ts) - ahead_us, chunk_us), chunk_of(F.col(ts) + overlap_us, chunk_us)
    return df.withColumn("__chunk", F.explode(F.sequence(first, last))).withColumn("__own", F.col("__chunk") == own)


def with_rows_before(df: DataFrame, key: list[str], order: list[str], rows: int, ts: str = "ts_us", chunk_us: int = DAY, block: int = 4096) -> DataFrame:
    """Each row in its own block of `block` rows of the series (`__own` true), and the last `rows` of a block in the next one too:
    a window of so many rows before is then a window over (key, `__block`)."""
    if not 0 <= rows <= block:
        raise ValueError(f"between 0 and {block} rows")
    laid = running_sum(df.withColumn("__one", F.lit(1).cast("long")), key, order, "__one", "__no", ts, chunk_us).drop("__one")
    own, place = F.floor((F.col("__no") - 1) / block), F.pmod(F.col("__no") - 1, F.lit(block))
    blocks = F.when(place >= block - rows, F.array(own, own + 1)).otherwise(F.array(own))
    return laid.withColumn("__block", F.explode(blocks)).withColumn("__own", F.col("__block") == own).drop("__no")


def running_sum(df: DataFrame, key: list[str], order: list[str], value: str, name: str, ts: str = "ts_us", chunk_us: int = DAY) -> DataFrame:
    """Sum of `value` from the start of the series to the row itself."""
    cut = df.withColumn("__chunk", chunk_of(F.col(ts), chunk_us))
    w = Window.partitionBy(*key, "__chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    totals = cut.groupBy(*key, "__chunk").agg(F.sum(value).alias("__t"))
    before = F.sum("__t").over(Window.partitionBy(*key).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1))
    totals = totals.select(*key, "__chunk", F.coalesce(before, F.lit(0)).alias("__before"))
    return cut.join(totals, [*key, "__chunk"]).withColumn(name, F.col("__before") + F.coalesce(F.sum(value).over(w), F.lit(0))).drop("__chunk", "__before")
