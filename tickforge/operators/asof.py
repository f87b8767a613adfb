"""As-of joins by union and windows over time chunks; a chunk that ends or starts without a match takes the carried row."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickforge.functions.times import DAY, HOUR

from .chunks import chunk_of, running_sum, with_previous


def _asof(probes: DataFrame, rows: DataFrame, values: list[str], key: str, forward: bool, chunk_us: int) -> DataFrame:
    names = probes.columns
    right = F.struct(F.col("ts_us").alias("match_ts"), *values)
    # Equal times match both ways: probes sort before rows looking forward, after them looking backward.
    left = probes.select(key, "ts_us", F.lit(0 if forward else 1).alias("__turn"), F.lit(None).cast("long").alias("__seq"), F.struct(*names).alias("__probe"))
    seq = F.col("seq") if "seq" in rows.columns else F.lit(0).cast("long")
    right_rows = rows.select(key, "ts_us", F.lit(1 if forward else 0).alias("__turn"), seq.alias("__seq"), right.alias("__row"))
    both = left.unionByName(right_rows, allowMissingColumns=True).withColumn("__chunk", chunk_of(F.col("ts_us"), chunk_us))
    # Looking forward is looking back in the opposite order: a running last is linear, a frame that shrinks is not.
    turned = F.desc if forward else F.asc
    w = Window.partitionBy(key, "__chunk").orderBy(*map(turned, ("ts_us", "__turn", "__seq")))
    own = F.last("__row", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    at = F.when(F.col("__row").isNotNull(), F.struct("ts_us", "__seq"))
    pick = (F.min_by if forward else F.max_by)("__row", at)
    # A row a chunk; the window over chunks carries the nearest match into chunks that have none.
    ends = both.groupBy(key, "__chunk").agg(pick.alias("__end"))
    wc = Window.partitionBy(key).orderBy(turned("__chunk"))
    carry = F.last("__end", ignorenulls=True).over(wc.rowsBetween(Window.unboundedPreceding, -1))
    ends = ends.select(key, "__chunk", carry.alias("__carry"))
    found = both.withColumn("__own", own).where(F.col("__probe").isNotNull()).join(ends, [key, "__chunk"]).withColumn("__m", F.coalesce("__own", "__carry"))
    return found.select(*(F.col("__probe")[n].alias(n) for n in names), *(F.col("__m")[n].alias(n) for n in ["match_ts", *values]))


def backward(probes: DataFrame, rows: DataFrame, values: list[str], key: str = "instrument", chunk_us: int = DAY) -> DataFrame:
    """Each probe with `values` of the last row at or before it (of equal times the largest seq); null if there is none."""
    return _asof(probes, rows, values, key, False, chunk_us)


def forward(probes: DataFrame, rows: DataFrame, values: list[str], key: str = "instrument", clip: bool = True, chunk_us: int = DAY) -> DataFrame:
    """Each probe with `values` of the first row at or after it; with `clip`, of the series' last row if there is none."""
    out = _asof(probes, rows, values, key, True, chunk_us)
    if not clip:
        return out
    order = F.struct("ts_us", "seq") if "seq" in rows.columns else F.col("ts_us")
    last = rows.groupBy(F.col(key).alias("__k")).agg(F.max_by(F.struct(F.col("ts_us").alias("match_ts"), *values), order).alias("__last"))
    joined = out.join(last, out[key] == last["__k"], "left")
    return joined.select(*probes.columns, *(F.when(F.col("match_ts").isNull(), F.col("__last")[n]).otherwise(F.col(n)).alias(n) for n in ["match_ts", *values]))


def in_path(entries: DataFrame, bars: DataFrame, horizon_us: int, key: str = "instrument", bucket_us: int = DAY, before_us: int = 0, until: str | None = None) -> DataFrame:
    """Range join: each entry (its `start_ts`) with the bars of [start_ts - before_us, start_ts + horizon_us], both ends included; `until`
    names a column that ends it earlier. Entries go to the time buckets that they reach, so that the join has an equi-key and isn't a
    nested loop."""
    cut = lambda c: chunk_of(c, bucket_us)
    start, end = F.col("start_ts") - before_us, F.col("start_ts") + horizon_us
    if until:
        end = F.least(end, F.col(until))
    spread = entries.withColumn("__b", F.explode(F.sequence(cut(start), cut(end))))
    cells = bars.withColumn("__b", cut(F.col("ts_us"))).withColumnRenamed("ts_us", "bar_ts")
    near = spread.join(cells, [key, "__b"])
    return near.where(F.col("bar_ts").between(start, end)).drop("__b")


def around(entries: DataFrame, ticks: DataFrame, minutes: int = 15, key: str = "instrument") -> DataFrame:
    """The raw ticks `minutes` either side of each entry (`start_ts`), with the entry's columns; what is stored beside a trade."""
    return in_path(entries, ticks, minutes * 60_000_000, key, HOUR, before_us=minutes * 60_000_000)


def stretches(entries: DataFrame, minutes: int = 15, key: str = "instrument") -> DataFrame:
    """The time `minutes` either side of the entries (`start_ts`, `entry_id`), where it overlaps taken once: per entry its
    columns and from_us, to_us of the stretch that holds it. Stretches of an instrument have no time in common."""
    reach = minutes * 60_000_000
    order = ["start_ts", "entry_id"]
    cut = with_previous(entries, [key], order, {"__last": "start_ts"}, ts="start_ts")
    apart = F.col("__last").isNull() | (F.col("start_ts") - F.col("__last") > 2 * reach)
    laid = running_sum(cut.withColumn("__new", apart.cast("long")), [key], order, "__new", "__no", ts="start_ts").drop("__new", "__last")
    # A busy day is one stretch of any number of entries: its bounds meet in partial sums, and come back by an equi-join.
    bounds = laid.groupBy(F.col(key).alias("__k"), F.col("__no").alias("__n")).agg((F.min("start_ts") - reach).alias("from_us"), (F.max("start_ts") + reach).alias("to_us"))
    return laid.join(bounds, (F.col(key) == F.col("__k")) & (F.col("__no") == F.col("__n"))).drop("__k", "__n", "__no")


def within(held: DataFrame, ticks: DataFrame, key: str = "instrument", bucket_us: int = HOUR) -> DataFrame:
    """The ticks inside the stretches `held` (key, from_us, to_us; none overlap), each once, with from_us of its stretch."""
    cells = held.select(key, "from_us", "to_us").distinct().withColumn("__b", F.explode(F.sequence(chunk_of(F.col("from_us"), bucket_us), chunk_of(F.col("to_us"), bucket_us))))
    near = ticks.withColumn("__b", chunk_of(F.col("ts_us"), bucket_us)).join(cells, [key, "__b"])
    return near.where(F.col("ts_us").between(F.col("from_us"), F.col("to_us"))).drop("__b", "to_us")


def rollovers(first_us: int, last_us: int, spark, hour: int = 21, triple_weekday: int | None = None) -> DataFrame:
    """(ts_us, weight) of the daily rollovers in [first, last]: 0 at weekends, 3 on the triple weekday, else 1."""
    from tickforge.functions.times import weekday_of

    day0, day1 = first_us // DAY, last_us // DAY
    days = spark.range(day0, day1 + 1).select((F.col("id") * DAY + hour * HOUR).alias("ts_us")).where(F.col("ts_us").between(first_us, last_us))
    weekday = weekday_of(F.col("ts_us"))
    weight = F.when(weekday >= 5, 0).when(F.lit(triple_weekday).cast("int") == weekday, 3).otherwise(1)
    return days.select("ts_us", weight.cast("long").alias("weight"))


def nights(ts, origin_day: int, hour: int = 21, triple_weekday: int | None = None):
    """Weighted rollovers since the day `origin_day` (days since the epoch) up to and including ts, in closed form: a step
    function of time needs no join. A rollover exactly at ts counts."""
    shifted = ts - F.lit(hour * HOUR)
    day = F.floor((shifted - F.pmod(shifted, F.lit(DAY))) / DAY)  # the last day whose rollover has passed
    count = lambda d: _weights_until(d, triple_weekday)
    return count(day) - count(F.lit(origin_day - 1))


def _weights_until(day, triple_weekday: int | None):
    """Sum of weights over the days 0..day, day 0 being a Thursday."""
    weights = [0 if (d + 3) % 7 >= 5 else 3 if (d + 3) % 7 == triple_weekday else 1 for d in range(7)]
    sums = [sum(weights[: i + 1]) for i in range(7)]
    full, rest = F.floor((day - F.pmod(day, F.lit(7))) / 7), F.pmod(day, F.lit(7))
    return full * sum(weights) + F.element_at(F.array(*(F.lit(s) for s in sums)), (rest + 1).cast("int"))
