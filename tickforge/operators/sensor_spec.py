"""The volatility sensor around the rolling components: baselines, normalisation, states, acceptance metrics, cost classes.

Where the specification leaves a choice open, ours is stated: atr is the mean true range of the last n bars; components
are normalised by their baseline and clamped to 0..1; a baseline pools all readings of a minute of day over the last n
days with data, as the median of the days' medians; states follow fixed thresholds on the value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickforge.functions.times import HOUR, SECOND, day_of, floor_to, hour_of, minute_of_day, weekday_of
from tickforge.staging import staged

from .asof import backward, forward
from .chunks import with_previous, with_rows_before
from .ranks import counted, numbered, quantiles, tile, tiles
from .windows import components_many

STATES = ((0.25, "CALM"), (0.5, "NORMAL"), (0.75, "EXPANDING"))
COST_CLASSES = ((0.10, "A"), (0.20, "B"))


def baselines(readings: DataFrame, wanted: dict[str, tuple[str, float]], days: int = 20, closed_days: DataFrame | None = None, weight: str | None = None) -> DataFrame:
    """instrument, day, minute, and for each wanted name (value, quantile): the quantile over the last `days` earlier days of that minute's daily median.

    Sundays and `closed_days` (day) count for no baseline. Minutes are 1440 series of one row a day, so windows stay small.
    weight: a reading stands for so many.
    """
    kept = list(dict.fromkeys(value for value, _ in wanted.values()))
    own = readings.select("instrument", day_of(F.col("ts_us")).alias("day"), minute_of_day(F.col("ts_us")).alias("minute"), *(F.col(c).alias(f"__{c}") for c in kept), weekday_of(F.col("ts_us")).alias("wd"), (F.col(weight) if weight else F.lit(1)).alias("__weight"))
    daily = own.groupBy("instrument", "day", "minute", "wd").agg(*(F.percentile(f"__{c}", F.lit(0.5), F.col("__weight")).alias(f"__{c}") for c in kept))
    counts = F.col("wd") != 6
    if closed_days is not None:
        closed = F.broadcast(closed_days.select("day", F.lit(True).alias("closed")).distinct())  # days of a calendar
        daily = daily.join(closed, "day", "left")
        counts = counts & F.col("closed").isNull()
    daily = daily.withColumns({f"__{c}": F.when(counts, F.col(f"__{c}")) for c in kept})
    w = Window.partitionBy("instrument", "minute").orderBy("day").rowsBetween(-days, -1)
    return daily.select("instrument", "day", "minute", *(F.percentile(f"__{value}", F.lit(q)).over(w).alias(name) for name, (value, q) in wanted.items()))


def baseline_by_minute(readings: DataFrame, value: str, days: int = 20, quantile: float = 0.5, name: str = "baseline", closed_days: DataFrame | None = None) -> DataFrame:
    """`baselines` of one value."""
    return baselines(readings, {name: (value, quantile)}, days, closed_days)


def relative_spread(ticks: DataFrame) -> DataFrame:
    """spr: a tick's spread over the median spread of its hour of day on earlier days."""
    s = F.col("ask") - F.col("bid")
    keyed = ticks.withColumns({"s": s, "day": day_of(F.col("ts_us")), "hour": hour_of(F.col("ts_us"))})
    daily = keyed.groupBy("instrument", "hour", "day").agg(F.percentile("s", F.lit(0.5)).alias("m"))
    before = daily.select("instrument", "hour", "day", F.percentile("m", F.lit(0.5)).over(Window.partitionBy("instrument", "hour").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)).alias("usual"))
    out = keyed.join(before, ["instrument", "hour", "day"])
    return out.select("instrument", "ts_us", "seq", F.when(F.col("usual") > 0, F.col("s") / F.col("usual")).alias("spr"))


def atr(bars: DataFrame, n: int = 14) -> DataFrame:
    """Adds true_range and atr, the mean true range of the bar and the n - 1 before it."""
    cut = with_previous(bars, ["instrument"], ["ts_us"], {"__c": "close"}, chunk_us=365 * 24 * HOUR)
    move = F.greatest(F.col("high") - F.col("low"), F.coalesce(F.abs(F.col("high") - F.col("__c")), F.lit(0.0)), F.coalesce(F.abs(F.col("low") - F.col("__c")), F.lit(0.0)))
    blocks = with_rows_before(cut.withColumn("true_range", move).drop("__c"), ["instrument"], ["ts_us"], n - 1, chunk_us=365 * 24 * HOUR)
    w = Window.partitionBy("instrument", "__block").orderBy("ts_us").rowsBetween(-(n - 1), 0)
    return blocks.withColumn("atr", F.avg("true_range").over(w)).where("__own").drop("__own", "__block")


def normalised(value: Column, usual: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), value / F.when(usual > 0, usual)))


def raw_value(micro: Column, macro: Column, alpha: float = 0.7) -> Column:
    if not 0.5 < alpha <= 1:
        raise ValueError("alpha lies above 0.5 and up to 1")
    return F.lit(alpha) * micro + F.lit(1 - alpha) * macro


def state_of(value: Column) -> Column:
    out = F.when(value.isNull(), F.lit(None).cast("string"))
    for limit, name in STATES:
        out = out.when(value < limit, name)
    return out.otherwise("CLIMAX")


def sensor_rows(components: DataFrame, baseline: DataFrame, macro: DataFrame | None = None, alpha: float = 0.7, warm_up: int = 10, now_us: int | None = None) -> DataFrame:
    """components (rg, tr, er ...) with their day-and-minute baseline (`baseline`): base_rg, raw_value, value, state, dq (their er, if they have it), conf, fresh_ms.

    macro: the components of a longer window (instrument, ts_us, seq, rg), mixed in with 1 - alpha; without it micro
    stands alone. fresh_ms counts from the reading to now_us, or to the next reading of the instrument (null for its last).
    """
    rows = components
    if now_us is None:  # before the joins, which would be made again for the ends of chunks
        back = rows.withColumn("__t", -F.col("ts_us")).withColumn("__s", -F.col("seq"))
        rows = with_previous(back, ["instrument"], ["__t", "__s"], {"__next": "__t"}, ts="__t").drop("__t", "__s")
    keyed = rows.withColumns({"day": day_of(F.col("ts_us")), "minute": minute_of_day(F.col("ts_us"))})
    out = keyed.join(baseline.withColumnRenamed("baseline", "base_rg"), ["instrument", "day", "minute"], "left").drop("day", "minute")
    if macro is None:
        out = out.withColumn("raw_value", F.col("rg"))
    else:
        longer = macro.select("instrument", "ts_us", "seq", F.col("rg").alias("__macro"))
        out = out.join(longer, ["instrument", "ts_us", "seq"], "left").withColumn("raw_value", raw_value(F.col("rg"), F.coalesce("__macro", "rg"), alpha)).drop("__macro")
    out = out.withColumn("value", normalised(F.col("raw_value"), F.col("base_rg") * 2))
    conf = F.least(F.lit(1.0), F.col("tr") / warm_up) * F.when(F.col("base_rg").isNull(), 0.0).otherwise(1.0)
    quality = {"dq": F.col("er")} if "er" in components.columns else {}
    out = out.withColumns({"state": state_of(F.col("value")), **quality, "conf": conf})
    until = F.lit(now_us) if now_us is not None else -F.col("__next")
    return out.withColumn("fresh_ms", (until - F.col("ts_us")) / 1000).drop("__next")


def detection_latency(rows: DataFrame, events: DataFrame, state: str = "CLIMAX", within_s: float = 300.0) -> DataFrame:
    """Per instrument: events (instrument, ts_us), how many saw the state within the time, and the median seconds until it."""
    hits = rows.where(F.col("state") == state).select("instrument", "ts_us").withColumn("seq", F.lit(0).cast("long"))
    met = forward(events, hits, [], clip=False).withColumn("after_s", (F.col("match_ts") - F.col("ts_us")) / SECOND)
    met = met.withColumn("after_s", F.when(F.col("after_s") <= within_s, F.col("after_s")))
    seen = met.groupBy("instrument").agg(F.count("*").alias("events"), F.count("after_s").alias("detected"))
    return seen.join(quantiles(met, ["instrument"], "after_s", {"latency_p50_s": 0.5}), "instrument", "left")


def agreement(ours: DataFrame, theirs: DataFrame, value: str, tolerance: float = 1e-4) -> DataFrame:
    """Two computations of one sensor (instrument, ts_us, seq, value), row by row: common, only_ours, only_theirs, largest difference, and whether all is within the tolerance."""
    on = ["instrument", "ts_us", "seq"]
    both = ours.select(*on, F.col(value).alias("__a")).join(theirs.select(*on, F.col(value).alias("__b")), on, "full")
    far = F.abs(F.col("__a") - F.col("__b"))
    out = both.agg(F.count(far).alias("common"), F.count_if(F.col("__b").isNull()).alias("only_ours"), F.count_if(F.col("__a").isNull()).alias("only_theirs"), F.max(far).alias("largest"))
    return out.withColumn("agrees", (F.col("common") > 0) & (F.col("only_ours") + F.col("only_theirs") == 0) & (F.col("largest") <= tolerance))


def step_size(base_rg: Column, k: float) -> Column:
    return F.lit(k) * base_rg


def state_changes(rows: DataFrame) -> DataFrame:
    """Per instrument: rows whose state differs from the row before, and how many an hour of the span."""
    cut = with_previous(rows, ["instrument"], ["ts_us", "seq"], {"__s": "state"})
    out = cut.groupBy("instrument").agg(F.count_if(F.col("__s") != F.col("state")).alias("changes"), (F.max("ts_us") - F.min("ts_us")).alias("span"))
    return out.select("instrument", "changes", F.when(F.col("span") > 0, F.col("changes") / (F.col("span") / HOUR)).alias("per_hour"))


def logged(rows: DataFrame, every_s: int = 5) -> DataFrame:
    """What is written to the log: every change of state, and else the first row of each `every_s` seconds."""
    cut = with_previous(rows, ["instrument"], ["ts_us", "seq"], {"__s": "state", "__t": "ts_us"})
    fresh = F.col("__t").isNull() | ~F.col("__s").eqNullSafe(F.col("state")) | (floor_to(F.col("__t"), every_s) != floor_to(F.col("ts_us"), every_s))
    return cut.where(fresh).drop("__s", "__t")


def spearman(rows: DataFrame, a: str, b: str, key: str, weight: str | None = None) -> DataFrame:
    """Rank correlation per key, average ranks on ties; with `weight` a row stands for so many."""
    both = rows.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(key, a, b).agg((F.sum(weight) if weight else F.count("*")).alias("pairs"))
    return spearman_counted(both, a, b, key)


def spearman_counted(both: DataFrame, a: str, b: str, key: str) -> DataFrame:
    """The same of counts: key, a, b and `pairs`, a row for each pair of values that are not null.

    Average ranks of n rows have the mean (n + 1) / 2 whatever their ties, so ranks are met with the pairs once.
    """
    ranked = lambda name, out: counted(both, [key], name, {"n": F.sum("pairs")}).select(key, name, (F.col("n_below") + (F.col("n") + 1) / 2).alias(out))
    w = F.col("pairs")
    each = both.join(ranked(a, "ra"), [key, a]).join(ranked(b, "rb"), [key, b])
    mean = each.join(both.groupBy(key).agg(F.sum(w).alias("n")), key).withColumns({"da": F.col("ra") - (F.col("n") + 1) / 2, "db": F.col("rb") - (F.col("n") + 1) / 2})
    out = mean.groupBy(key, "n").agg(F.sum(w * F.col("da") * F.col("db")).alias("ab"), F.sum(w * F.col("da") * F.col("da")).alias("aa"), F.sum(w * F.col("db") * F.col("db")).alias("bb"))
    return out.select(key, F.try_divide("ab", F.sqrt(F.col("aa") * F.col("bb"))).alias("rho"), "n")


def quintiles(rows: DataFrame, by: str, outcome: str, key: str, order: str, weight: str | None = None) -> DataFrame:
    """Mean outcome in each fifth of the key's rows by `by` (ties by `order`): monotone if the sensor means anything.
    weight: a row stands for so many, which may fall into two fifths."""
    if weight:
        placed = numbered(rows.select(key, by, order, outcome, weight), [key], by, order, "place", weight)
        laid = placed.join(rows.groupBy(key).agg(F.sum(weight).alias("total")), key)
        each = laid.select(key, outcome, F.explode(tiles(F.col("place"), F.col(weight), F.col("total"), 5)).alias("t"))
        return each.groupBy(key, F.col("t.tile").alias("quintile")).agg((F.sum(F.col(outcome) * F.col("t.n")) / F.sum("t.n")).alias("mean"), F.sum("t.n").alias("n"))
    placed = numbered(rows.select(key, by, order, outcome), [key], by, order, "place")
    total = rows.groupBy(key).agg(F.count("*").alias("total"))
    laid = placed.join(total, key).withColumn("quintile", tile(F.col("place"), F.col("total"), 5))
    return laid.groupBy(key, "quintile").agg(F.avg(outcome).alias("mean"), F.count("*").alias("n"))


def variation(rows: DataFrame, value: str, key: str) -> DataFrame:
    """Coefficient of variation per key."""
    return rows.groupBy(key).agg((F.stddev_samp(value) / F.avg(value)).alias("cv"))


def monotone(fifths: DataFrame, key: str) -> DataFrame:
    """Per key of `quintiles`: whether all five are there and their means strictly increase."""
    means = F.transform(F.array_sort(F.collect_list(F.struct("quintile", "mean"))), lambda x: x["mean"])
    up = F.aggregate(F.sequence(F.lit(1), F.lit(4)), F.lit(True), lambda ok, i: ok & (F.get("__m", i) > F.get("__m", i - 1)))
    return fifths.groupBy(key).agg(means.alias("__m")).select(key, F.when(F.size("__m") == 5, up).otherwise(F.lit(False)).alias("increasing"))  # five rows a key


def usual_range(ticks: DataFrame, window_s: int, peers: bool = False) -> DataFrame:
    """instrument, minute, base_rg: the median over all days but Sundays of a minute's daily median range. 1440 rows an instrument."""
    rg = components_many(ticks, (window_s,), peers=peers).select("instrument", day_of(F.col("ts_us")).alias("day"), minute_of_day(F.col("ts_us")).alias("minute"), F.col(f"rg_{window_s}").alias("rg"))
    daily = rg.where(F.pmod(F.col("day") + 3, F.lit(7)) != 6).groupBy("instrument", "minute", "day").agg(F.percentile("rg", F.lit(0.5)).alias("m"))
    return daily.groupBy("instrument", "minute").agg(F.percentile("m", F.lit(0.5)).alias("base_rg"))


def cross_feed(ours: DataFrame, theirs: DataFrame, window_s: int, most: float = 0.15, peers: bool = False) -> DataFrame:
    """Whether distances taken from base_rg carry over from one feed to another: per instrument the other clock's offset
    (found by `feed_offset`, and taken off), the minutes of day that both have, the coefficient of variation of
    base_rg(ours) / base_rg(theirs) over them, and whether that is below `most`."""
    offset = staged(feed_offset(ours, theirs).select("instrument", "offset_h"), "offset")  # a row an instrument
    aligned = theirs.join(offset, "instrument").withColumn("ts_us", F.col("ts_us") - F.col("offset_h") * HOUR).drop("offset_h")
    both = usual_range(ours, window_s, peers).join(usual_range(aligned, window_s, peers).withColumnRenamed("base_rg", "__theirs"), ["instrument", "minute"])
    ratio = F.when((F.col("__theirs") > 0) & F.col("base_rg").isNotNull(), F.col("base_rg") / F.col("__theirs"))
    out = both.groupBy("instrument").agg(F.count(ratio).alias("minutes"), F.try_divide(F.stddev_samp(ratio), F.avg(ratio)).alias("cv"))
    return out.join(offset, "instrument").select("instrument", "offset_h", "minutes", "cv", (F.col("cv") < most).alias("passed"))


def cost_class(usd_oz: Column) -> Column:
    out = F.when(usd_oz.isNull(), F.lit(None).cast("string"))
    for limit, name in COST_CLASSES:
        out = out.when(usd_oz <= limit, name)
    return out.otherwise("C")


def feed_offset(ours: DataFrame, theirs: DataFrame, hours: range = range(-12, 13)) -> DataFrame:
    """The hour offset of another feed's clock, by the least dispersion of price differences: instrument, offset_h, dispersion, n.

    ours, theirs: instrument, ts_us, bid, seq. The offsets are a fixed list; only the other feed's rows are copied for each,
    so chunks of the join are an hour, not a day: a busy day's copies would meet in one task.
    """
    probes = theirs.withColumn("offset_h", F.explode(F.array(*(F.lit(h) for h in hours))))
    probes = probes.select("instrument", "offset_h", (F.col("ts_us") - F.col("offset_h") * HOUR).alias("ts_us"), F.col("bid").alias("their_bid"))
    met = backward(probes, ours, ["bid"], chunk_us=HOUR).where(F.col("match_ts") >= F.col("ts_us") - 60 * SECOND)
    each = met.groupBy("instrument", "offset_h").agg(F.stddev_samp(F.col("bid") - F.col("their_bid")).alias("dispersion"), F.count("*").alias("n"))
    best = each.where(F.col("dispersion").isNotNull()).groupBy("instrument").agg(F.min(F.struct("dispersion", "offset_h", "n")).alias("b"))
    return best.select("instrument", "b.offset_h", "b.dispersion", "b.n")
