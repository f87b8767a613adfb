"""Checks on ticks and raw files: month summary, gaps, completeness, scale continuity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickforge.functions.times import DAY, HOUR, SECOND, floor_to, hour_of
from tickforge.schemas import InstrumentSpec
from tickforge.staging import staged

from .chunks import with_previous
from .ranks import quantiles

#: Seconds above which gaps are counted.
GAP_LIMITS = (60, 300, 3600, 14400)
#: Factors by which a wrong price scale shows.
SCALE_FACTORS = (0.001, 0.01, 0.1, 10.0, 100.0, 1000.0)


def summarize(ticks: DataFrame) -> DataFrame:
    """Per instrument: count, first and last time, extremes of bid, spread min/p50/p95/max, negative spreads."""
    s = F.col("ask") - F.col("bid")
    out = ticks.groupBy("instrument").agg(
        F.count("*").alias("n"), F.min("ts_us").alias("first_us"), F.max("ts_us").alias("last_us"), F.min("bid").alias("bid_min"), F.max("bid").alias("bid_max"),
        F.min(s).alias("spread_min"), F.max(s).alias("spread_max"), F.count_if(s < 0).alias("spread_negative"),
    )
    q = quantiles(ticks.select("instrument", s.alias("s")), ["instrument"], "s", {"spread_p50": 0.5, "spread_p95": 0.95})
    return out.join(q, "instrument", "left")


def ticks_per_hour(ticks: DataFrame) -> DataFrame:
    return ticks.groupBy("instrument", hour_of(F.col("ts_us")).alias("hour")).agg(F.count("*").alias("n"))


def gaps(ticks: DataFrame) -> DataFrame:
    """instrument, from_us, to_us, gap_s between consecutive ticks."""
    cut = with_previous(ticks.select("instrument", "ts_us", "seq"), ["instrument"], ["ts_us", "seq"], {"from_us": "ts_us"})
    return cut.where("from_us is not null").select("instrument", "from_us", F.col("ts_us").alias("to_us"), ((F.col("ts_us") - F.col("from_us")) / SECOND).alias("gap_s"))


def gap_stats(ticks: DataFrame) -> DataFrame:
    """Per instrument: n (ticks), p50/p95/p99/max of the gaps and how many exceed each limit; `sem_dados` below two ticks."""
    over = [F.count_if(F.col("gap_s") > s).alias(f"above_{s}") for s in GAP_LIMITS]
    between = staged(gaps(ticks), "gaps")
    found = between.groupBy("instrument").agg(F.max("gap_s").alias("gap_max"), *over)
    q = quantiles(between, ["instrument"], "gap_s", {"gap_p50": 0.5, "gap_p95": 0.95, "gap_p99": 0.99})
    n = ticks.groupBy("instrument").agg(F.count("*").alias("n"))
    out = n.join(found, "instrument", "left").join(q, "instrument", "left")
    return out.withColumn("status", F.when(F.col("n") < 2, "sem_dados").otherwise("ok"))


def largest_gaps(ticks: DataFrame, top: int = 10) -> DataFrame:
    """The `top` largest gaps of each instrument, earlier ones first among equals."""
    w = Window.partitionBy("instrument").orderBy(F.desc("gap_s"), "from_us")
    return gaps(ticks).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def hour_calendar(spark, first_us: int, end_us: int, reverse: bool = False) -> DataFrame:
    """hour_us of every hour in [first, end), the end floored to its hour; newest first if `reverse`."""
    hours = spark.range(-(-first_us // HOUR), end_us // HOUR).select((F.col("id") * HOUR).alias("hour_us"))
    return hours.orderBy(F.desc("hour_us")) if reverse else hours


def file_state(has_file: Column, size: Column, has_marker: Column) -> Column:
    """presente / vazio / ausente / falhou: only the last one calls for action."""
    return F.when(has_file & (size > 0), "presente").when(has_file, "vazio").when(has_marker, "ausente").otherwise("falhou")


def completeness(calendar: DataFrame, listing: DataFrame) -> DataFrame:
    """Each hour of the calendar with its state. listing: hour_us, size, has_file, has_absent_marker (instrument if the calendar has it)."""
    on = [c for c in ("instrument", "hour_us") if c in calendar.columns and c in listing.columns]
    seen = calendar.join(listing, on, "left")
    no = F.lit(False)
    state = file_state(F.coalesce("has_file", no), F.coalesce("size", F.lit(0)), F.coalesce("has_absent_marker", no))
    return seen.select(*calendar.columns, state.alias("state"))


def completeness_counts(states: DataFrame, by: list[str] | None = None, listed: int = 200) -> DataFrame:
    """Counts by state, the first `listed` failed hours, and whether nothing failed."""
    count = [F.count_if(F.col("state") == s).alias(s) for s in ("presente", "vazio", "ausente", "falhou")]
    failed = F.sort_array(F.collect_list(F.when(F.col("state") == "falhou", F.col("hour_us"))))  # hours of a calendar
    out = states.groupBy(*(by or [])).agg(*count, F.slice(failed, 1, listed).alias("missing"))
    return out.withColumn("complete", F.col("falhou") == 0)


def tally(outcomes: DataFrame, by: list[str] | None = None) -> DataFrame:
    """How many files came to which outcome (column `outcome`)."""
    return outcomes.groupBy(*(by or []), "outcome").agg(F.count("*").alias("n"))


def per_day_counts(states: DataFrame) -> DataFrame:
    day = F.floor(F.col("hour_us") / DAY).cast("int")
    return states.groupBy(day.alias("day")).agg(*(F.count_if(F.col("state") == s).alias(s) for s in ("presente", "vazio", "ausente", "falhou")))


def scale_outcome(first_bid: Column, prev_bid: Column, gap_s: Column, low: float, high: float, max_jump: float = 0.05, max_gap_s: float = 7200, tolerance: float = 0.05) -> Column:
    """struct(ok, reason, ratio, factor) for an hour's first bid after the last bid before it.

    Near 1: continuity. Near one of the factors: wrong scale. Anything else: the market moved. Without a recent anchor
    the plausible range decides.
    """
    ratio = first_bid / prev_bid
    anchored = prev_bid.isNotNull() & (prev_bid > 0) & (gap_s <= max_gap_s)
    near = [(F.abs(ratio / f - 1) <= tolerance, f) for f in SCALE_FACTORS]
    factor = F.coalesce(*(F.when(c, F.lit(f)) for c, f in near))
    in_range = first_bid.between(low, high)
    out = lambda ok, reason, r, f: F.struct(ok.alias("ok"), F.lit(reason).alias("reason"), r.cast("double").alias("ratio"), f.cast("double").alias("factor"))
    none = F.lit(None)
    return (
        F.when(~F.coalesce(anchored, F.lit(False)), F.when(in_range, out(F.lit(True), "range", none, none)).otherwise(out(F.lit(False), "out of range", none, none)))
        .when(F.abs(ratio - 1) <= max_jump, out(F.lit(True), "continuity", ratio, none))
        .when(factor.isNotNull(), out(F.lit(False), "scale", ratio, factor))
        .otherwise(out(F.lit(True), "market move", ratio, none))
    )


def scale_check(ticks: DataFrame, spec: InstrumentSpec, price: str = "bid") -> DataFrame:
    """Every hour with ticks against the last hour that has some: instrument, hour_us, first_bid, prev_last_bid, gap_s, ok, reason, ratio, factor."""
    at = F.struct("ts_us", "seq")
    hours = ticks.groupBy("instrument", floor_to(F.col("ts_us"), 3600).alias("hour_us")).agg(
        F.min_by(price, at).alias("first_bid"), F.min("ts_us").alias("first_us"), F.max_by(price, at).alias("last_bid"), F.max("ts_us").alias("last_us")
    )
    chained = with_previous(hours, ["instrument"], ["hour_us"], {"prev_last_bid": "last_bid", "prev_us": "last_us"}, ts="hour_us", chunk_us=365 * DAY)
    gap = (F.col("first_us") - F.col("prev_us")) / SECOND
    chained = chained.withColumn("gap_s", gap).withColumn("r", scale_outcome(F.col("first_bid"), F.col("prev_last_bid"), gap, *spec.plausible_range))
    return chained.select("instrument", "hour_us", "first_bid", "prev_last_bid", "gap_s", "r.ok", "r.reason", "r.ratio", "r.factor")


def require_scale(ticks: DataFrame, spec: InstrumentSpec, strict: bool = True) -> DataFrame:
    """The ticks of hours whose scale is right; with `strict`, an error if an hour's is wrong."""
    checked = scale_check(ticks, spec).select("instrument", "hour_us", "ok", "factor")
    joined = ticks.withColumn("hour_us", floor_to(F.col("ts_us"), 3600)).join(checked, ["instrument", "hour_us"])
    bad = F.raise_error(F.format_string("scale of %s at %d is off by %s", F.col("instrument"), F.col("hour_us"), F.col("factor").cast("string"))).cast("boolean") if strict else F.lit(False)
    return joined.where(F.when(F.col("ok"), F.lit(True)).otherwise(bad)).select(*ticks.columns)
