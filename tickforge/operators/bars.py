"""OHLC bars from ticks.

Rules: a bar's label is the start of its interval on the epoch grid; the forming bar (the last one of a series) is
not emitted; intervals without ticks make no bar. first and last follow (ts_us, seq), never the order of arrival.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.functions.times import floor_to, month_of
from tickforge.schemas import TIMEFRAMES

PRICES = ("bid", "ask")


def aggregate(ticks: DataFrame, seconds: int | dict[str, int], price: str = "bid") -> DataFrame:
    """Closed bars of one grid, or of several named ones from a single scan (never bars of bars)."""
    grids = {None: seconds} if isinstance(seconds, int) else seconds
    if not grids or any(s <= 0 for s in grids.values()):
        raise ValueError(f"seconds must be positive: {seconds}")
    if price not in PRICES:
        raise ValueError(f"bars are of bid or ask, not {price}")
    if price not in ticks.columns:
        raise ValueError(f"ticks have no column {price}")
    grid = F.explode(F.array(*(F.struct(F.lit(name).cast("string").alias("timeframe"), F.lit(s).alias("seconds")) for name, s in grids.items())))
    px, at = F.col(price), F.struct("ts_us", "seq")
    laid = ticks.select("instrument", "ts_us", "seq", price, grid.alias("g")).withColumn("label", floor_to(F.col("ts_us"), F.col("g.seconds")))
    bars = laid.groupBy("instrument", F.col("g.timeframe").alias("timeframe"), F.col("g.seconds").alias("seconds"), F.col("label").alias("ts_us")).agg(
        F.min_by(px, at).alias("open"), F.max(px).alias("high"), F.min(px).alias("low"), F.max_by(px, at).alias("close"), F.count("*").alias("n_ticks")
    )
    closed = _closed(bars, ["instrument", "timeframe"]).withColumn("range_usd_oz", F.col("high") - F.col("low"))
    names = ["instrument", *(["timeframe"] if None not in grids else []), "ts_us", "open", "high", "low", "close", "range_usd_oz", "n_ticks"]
    return closed.select(*names)


def _closed(bars: DataFrame, series: list[str]) -> DataFrame:
    """Without each series' last bar, which is still forming.

    The newest label comes from the aggregated bars. Its aggregate reads all their columns, so that both sides of the
    join are one exchange of one scan.
    """
    bars = bars.where(F.col("ts_us").isNotNull())  # said on both sides, else only one of them would infer it
    newest = bars.groupBy(*(F.col(c).alias(f"__{c}") for c in series)).agg(F.max(F.struct("ts_us", *(c for c in bars.columns if c != "ts_us"))).alias("__newest"))
    same = None
    for c in series:
        each = bars[c].eqNullSafe(newest[f"__{c}"])
        same = each if same is None else same & each
    return bars.join(newest, same).where(F.col("ts_us") < F.col("__newest.ts_us")).drop("__newest", *(f"__{c}" for c in series))


def aggregate_tf(ticks: DataFrame, timeframe: str, price: str = "bid") -> DataFrame:
    if timeframe not in TIMEFRAMES:
        raise ValueError(f"no such timeframe: {timeframe}")
    return aggregate(ticks, {timeframe: TIMEFRAMES[timeframe]}, price)


def aggregate_all(ticks: DataFrame, timeframes: dict[str, int] = TIMEFRAMES, price: str = "bid") -> DataFrame:
    return aggregate(ticks, timeframes, price)


def in_month(bars: DataFrame, year: int, month: int) -> DataFrame:
    """Bars whose label is in the month. Aggregating the continuous series first leaves no bar out at the month's edge."""
    return bars.where(month_of(F.col("ts_us")) == f"{year:04d}-{month:02d}")


def both_sides(ticks: DataFrame, seconds: int = 60) -> DataFrame:
    """Bid and ask extremes on one axis from one aggregation: instrument, ts_us, bid_high, bid_low, ask_high, ask_low."""
    bars = ticks.groupBy("instrument", floor_to(F.col("ts_us"), seconds).alias("label")).agg(
        F.max("bid").alias("bid_high"), F.min("bid").alias("bid_low"), F.max("ask").alias("ask_high"), F.min("ask").alias("ask_low")
    )
    return _closed(bars.withColumnRenamed("label", "ts_us"), ["instrument"])


def with_partitions(rows: DataFrame) -> DataFrame:
    """Adds `year` and `month` for the partitioned layout."""
    month = month_of(F.col("ts_us"))
    return rows.withColumns({"year": F.substring(month, 1, 4).cast("int"), "month": F.substring(month, 6, 2).cast("int")})

