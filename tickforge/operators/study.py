"""Trade entries against matched synthetic ones: episodes, excursion and time to profit, carry, matching, superiority, bootstrap."""

from __future__ import annotations

from hashlib import md5

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickforge.functions.digests import MOST, first_digits
from tickforge.functions.times import DAY, HOUR, MINUTE, SECOND, hour_of, weekday_of
from tickforge.functions.values import finite, side_sign
from tickforge.schemas import OvernightCost
from tickforge.staging import staged

from .asof import nights
from .chunks import chunk_of, running_sum, with_previous
from .ranks import counted, numbered, quantiles

HORIZONS_H = (24, 72, 168)
EPISODE_GAPS_MIN = (5, 15, 60, 240)
SCHEMES = ("aleatorio", "horario", "volatilidade")
#: Least finite candidates for deciles, and least candidates within one.
MIN_POOL, MIN_DECILE = 10, 5
#: Least replicates of a bootstrap that have a value.
MIN_REPLICATES = 10


def episodes(entries: DataFrame, gap_min: float | Column, key: list[str] | None = None) -> DataFrame:
    """Adds `episode`: a new one begins where the side changes or the gap to the entry before exceeds gap_min minutes (equal stays)."""
    key = key or []
    tag = entries.withColumn("__all", F.lit(0))
    cut = with_previous(tag, [*key, "__all"], ["ts_us", "entry_id"], {"__ts": "ts_us", "__side": "side"})
    starts = F.col("__ts").isNull() | (F.col("__side") != F.col("side")) | (F.col("ts_us") - F.col("__ts") > F.lit(gap_min).cast("double") * MINUTE)
    cut = cut.withColumn("__new", starts.cast("long"))
    return running_sum(cut, [*key, "__all"], ["ts_us", "entry_id"], "__new", "episode").drop("__new", "__ts", "__side", "__all")


def episode_sizes(entries: DataFrame, gaps_min: tuple[float, ...] = EPISODE_GAPS_MIN) -> DataFrame:
    """Per gap: episodes, largest and median size."""
    each = entries.withColumn("gap_min", F.explode(F.array(*(F.lit(float(g)) for g in gaps_min))))
    sizes = episodes(each, F.col("gap_min"), ["gap_min"]).groupBy("gap_min", "episode").agg(F.count("*").alias("size"))
    sizes = staged(sizes, "sizes")
    out = sizes.groupBy("gap_min").agg(F.count("*").alias("episodes"), F.max("size").alias("max_size"))
    return out.join(quantiles(sizes, ["gap_min"], "size", {"p50_size": 0.5}), "gap_min")


def swap_paid(from_us: Column, to_us: Column, side: Column, cost: OvernightCost) -> Column:
    """Carry in USD per ounce over the rollovers in (from, to]."""
    count = nights(to_us, 0, cost.rollover_hour, cost.triple_weekday) - nights(from_us, 0, cost.rollover_hour, cost.triple_weekday)
    return count * F.when(side == "buy", F.lit(float(cost.buy))).otherwise(F.lit(float(cost.sell)))


EXTREMES = {"bid_high": F.max, "bid_low": F.min, "ask_high": F.max, "ask_low": F.min, "last": F.max}
#: Levels of block extremes above the bars: hours in a day, and what is looked up: a block, it and its parent's later blocks, it and its parent's earlier ones.
HOURS_A_DAY = 24
WHOLE, ONWARD, UPTO = 0, 1, 2
#: More than the blocks of a piece can be; three levels of as many are less than a second's microseconds.
LENGTHS = 10_000


def extremes(bars: DataFrame, key: str, seconds: int = 60, offset_us: int = 0) -> DataFrame:
    """Extremes of the bars (level 0), hours (1) and days (2, from `offset_us` after midnight): key, level, block, part, the extremes, last (bar).

    part WHOLE is the block; ONWARD and UPTO reach from it to the end of its hour or day, and from their start to it. These
    exist for each block of an hour or day that has any bar, so a stretch of time is a few of them wherever bars are missing.
    """
    per_hour = HOUR // (seconds * SECOND)
    leaf = bars.select(key, chunk_of(F.col("ts_us") - offset_us, seconds * SECOND).alias("block"), *(c for c in EXTREMES if c != "last"), F.col("ts_us").alias("last"))

    def parents(rows, n):
        return rows.groupBy(key, F.floor(F.col("block") / n).alias("block")).agg(*(f(c).alias(c) for c, f in EXTREMES.items()))

    def parts(rows, above, n, level):
        every = above.select(key, F.col("block").alias("__in"), F.explode(F.sequence(F.col("block") * n, F.col("block") * n + n - 1)).alias("block")).join(rows, [key, "block"], "left")
        w = Window.partitionBy(key, "__in").orderBy("block")  # 60 rows at most, or 3600 of bars of seconds
        frames = {ONWARD: w.rowsBetween(0, Window.unboundedFollowing), UPTO: w.rowsBetween(Window.unboundedPreceding, 0)}
        reach = {part: [f(c).over(frame).alias(c) for c, f in EXTREMES.items()] for part, frame in frames.items()}
        each = every.select(key, "block", F.struct(F.lit(WHOLE).alias("part"), *EXTREMES).alias("p0"), *(F.struct(F.lit(part).alias("part"), *cols).alias(f"p{part}") for part, cols in reach.items()))
        return each.select(key, F.lit(level).alias("level"), "block", F.explode(F.array("p0", "p1", "p2")).alias("p")).select(key, "level", "block", "p.*").where(F.col("last").isNotNull())

    hours = parents(leaf, per_hour)
    days = parents(hours, HOURS_A_DAY)
    top = days.select(key, F.lit(2).alias("level"), "block", F.lit(WHOLE).alias("part"), *EXTREMES)
    return parts(leaf, hours, per_hour, 0).unionByName(parts(hours, days, HOURS_A_DAY, 1)).unionByName(top)


PIECE = "struct<level:int,block:bigint,part:int,lo:bigint,hi:bigint>"


def _piece(level: int, block: Column, part: int, lo: Column, hi: Column) -> Column:
    return F.struct(F.lit(level).alias("level"), block.cast("long").alias("block"), F.lit(part).alias("part"), lo.cast("long").alias("lo"), hi.cast("long").alias("hi")).cast(PIECE)


def _each(level: int, lo: Column, hi: Column) -> Column:
    """The blocks lo..hi of a level, one by one."""
    return F.transform(F.sequence(lo.cast("long"), hi.cast("long")), lambda x: _piece(level, x, WHOLE, x, x))


def pieces(first: Column, last: Column, per_hour: int) -> Column:
    """The bars' places first..last as pieces in order of time: two ends of hours, two of days, whole days; the bars or hours themselves if they are of one hour or day."""

    def between(level, a, b, n, inner):
        up, down = F.floor(a / n), F.floor(b / n)
        ends = F.concat(F.array(_piece(level, a, ONWARD, a, up * n + n - 1)), inner(up + 1, down - 1), F.array(_piece(level, b, UPTO, down * n, b)))
        return F.when(a > b, F.array().cast(f"array<{PIECE}>")).when(up == down, _each(level, a, b)).otherwise(ends)

    days = lambda a, b: F.when(a > b, F.array().cast(f"array<{PIECE}>")).otherwise(_each(2, a, b))
    return between(0, first, last, per_hour, lambda p, q: between(1, p, q, HOURS_A_DAY, days))


def evaluate(entries: DataFrame, bars: DataFrame, cost: OvernightCost, horizons_h: tuple[float, ...] = HORIZONS_H, key: str = "instrument", coverage: DataFrame | None = None, seconds: int = 60) -> DataFrame:
    """Per entry: mae_usd_oz, horas_ate_verde, horas_ate_verde_liq (after carry), swap_usd_oz, verde_em (horizon -> green, null if censored).

    entries: key, entry_id, side, start_ts (label of the entry's bar), price. bars: key, ts_us (multiples of `seconds`, which
    divide an hour), bid_high, bid_low, ask_high, ask_low.
    Times count from the bar's label, the entry's bar counts whole, and the path holds both its ends.

    No path is formed: an entry looks at the extremes of some dozen pieces of its horizon, then opens the first one that turns
    green down to the bar. Days begin at the rollover, so carry is the same throughout a piece.
    Entries of one side, bar and price have one result and are judged once: of many draws from a history few are different.
    """
    if not horizons_h or min(horizons_h) <= 0:
        raise ValueError("horizons are positive hours")
    if seconds <= 0 or HOUR % (seconds * SECOND):
        raise ValueError("bars' seconds divide an hour")
    step, offset = seconds * SECOND, cost.rollover_hour * HOUR
    per_hour = HOUR // step
    sign, long = side_sign(F.col("side")), F.col("side") == "buy"
    keys = [key, "side", "start_ts", "price"]
    asked = staged(entries.select(key, "entry_id", *keys[1:]), "asked")
    levels = staged(extremes(bars, key, seconds, offset), "extremes").withColumnRenamed(key, "__key")
    place = lambda ts: chunk_of(ts - offset, step)
    reach = int(max(horizons_h) * HOUR)

    def looked_up(rows, how="inner"):
        """rows with the extremes of their piece `p`."""
        same = (rows[key] == levels["__key"]) & (F.col("p.level") == levels["level"]) & (F.col("p.block") == levels["block"]) & (F.col("p.part") == levels["part"])
        return rows.join(levels, same, how)

    width = F.element_at(F.array(F.lit(step), F.lit(HOUR), F.lit(DAY)), F.col("p.level") + 1)
    began = F.lit(offset) + F.col("p.lo") * width
    gain = sign * (F.when(long, F.col("bid_high")).otherwise(F.col("ask_low")) - F.col("price"))
    carry = swap_paid(F.col("start_ts"), began, F.col("side"), cost)
    # A piece as one number, so that the first one is the least: where it begins, then its level and length, which are less than a second.
    coded = began + F.col("p.level") * LENGTHS + F.col("p.hi") - F.col("p.lo")
    turns = lambda paid: F.min(F.when(gain - paid > 0, coded))
    spread = asked.select(*keys).distinct().select(*keys, F.explode(pieces(place(F.col("start_ts")), place(F.col("start_ts") + reach), per_hour)).alias("p"))
    found = looked_up(spread).groupBy(*keys).agg(F.max("last").alias("last_bar"), turns(F.lit(0.0)).alias("gross"), turns(carry).alias("net"))
    each = F.explode(F.array(*(F.struct(F.lit(c == "net").alias("net"), F.col(c).alias("found")) for c in ("gross", "net"))))
    found = found.select(*keys, "last_bar", each.alias("f")).select(*keys, "last_bar", "f.*")
    rest = F.pmod(F.col("found"), F.lit(SECOND))
    at, level = F.col("found") - rest, F.floor(rest / LENGTHS).cast("int")
    lo = chunk_of(at - offset, F.element_at(F.array(F.lit(step), F.lit(HOUR), F.lit(DAY)), level + 1))
    hi = lo + F.pmod(rest, F.lit(LENGTHS))
    # Opened twice: a day to hours, hours to bars; what is a bar already stays.
    for _ in range(2):
        opened = (
            F.when(level == 2, _each(1, lo * HOURS_A_DAY, lo * HOURS_A_DAY + HOURS_A_DAY - 1)).when((level == 1) & (lo == hi), _each(0, lo * per_hour, lo * per_hour + per_hour - 1))
            .when(level == 1, _each(1, lo, hi)).otherwise(_each(0, lo, hi))
        )
        found = looked_up(found.select(*keys, "net", "last_bar", F.explode_outer(opened).alias("p")), "left").groupBy(*keys, "net", "last_bar").agg(turns(F.when(F.col("net"), carry).otherwise(F.lit(0.0))).alias("found"))
    turned = found.groupBy(*keys).agg(F.max(F.when(~F.col("net"), at)).alias("green"), F.max(F.when(F.col("net"), at)).alias("green_net"), F.max("last_bar").alias("last_bar"))
    turned = turned.withColumn("until", F.coalesce("green", "last_bar"))
    kept = [*keys, "green", "green_net", "until"]
    loss = sign * (F.when(long, F.col("bid_low")).otherwise(F.col("ask_high")) - F.col("price"))
    worst = looked_up(turned.select(*kept, F.explode(pieces(place(F.col("start_ts")), place(F.col("until")), per_hour)).alias("p"))).groupBy(*kept).agg(F.min(loss).alias("loss"))
    if coverage is None:
        coverage = bars.groupBy(key).agg(F.max("ts_us").alias("covered"))
    mine = asked.select(*(F.col(c).alias(f"__{c}") for c in keys), "entry_id")
    same = F.lit(True)
    for c in keys:
        same = same & worst[c].eqNullSafe(mine[f"__{c}"])
    out = worst.join(mine, same).join(coverage, key)
    hours = lambda c: (F.col(c) - F.col("start_ts")) / HOUR
    green = F.map_from_entries(F.array(*(
        F.struct(F.lit(float(h)).alias("h"), F.when(F.col("start_ts") + int(h * HOUR) <= F.col("covered"), F.coalesce(F.col("green") <= F.col("start_ts") + int(h * HOUR), F.lit(False))).alias("green"))
        for h in horizons_h
    )))
    return out.select(
        key, "entry_id", "side", "start_ts", F.greatest(F.lit(0.0), -F.col("loss")).alias("mae_usd_oz"), hours("green").alias("horas_ate_verde"),
        hours("green_net").alias("horas_ate_verde_liq"), swap_paid(F.col("start_ts"), F.col("until"), F.col("side"), cost).alias("swap_usd_oz"), green.alias("verde_em"),
    )


def describe(values: DataFrame, column: str, by: list[str], weight: str | None = None) -> DataFrame:
    """by, n, p50, p90, max of the values that are not null; a row stands for `weight` values."""
    out = values.where(F.col(column).isNotNull())
    q = quantiles(out.select(*by, column, *([weight] if weight else [])), by, column, {"p50": 0.5, "p90": 0.9}, weight)
    return out.groupBy(*by).agg((F.sum(weight) if weight else F.count("*")).alias("n"), F.max(column).alias("max")).join(q, by).select(*by, "n", "p50", "p90", "max")


def not_green(results: DataFrame, horizon_h: float) -> DataFrame:
    """Share of entries not green at the horizon, with how many were judged and how many censored."""
    v = F.element_at("verde_em", F.lit(float(horizon_h)))
    return results.agg(F.avg((~v).cast("double")).alias("fraction"), F.count(v).alias("judged"), F.count_if(v.isNull()).alias("censored"))


MEASURES = ("mae_usd_oz", "horas_ate_verde", "horas_ate_verde_liq", "swap_usd_oz")


def summary(results: DataFrame, horizons_h: tuple[float, ...] = HORIZONS_H, by: list[str] | None = None, weight: str | None = None) -> DataFrame:
    """One row (per group): n, and n/p50/p90/max of the four measures, and the share not green at each horizon.

    A row stands for `weight` entries. Equal results are counted first, so what is ranked is no longer than there are different ones.
    """
    by = by or []
    group = [*by, "__all"]
    green = {h: f"__green_{i}" for i, h in enumerate(horizons_h)}
    laid = results.select(*by, F.lit(0).alias("__all"), *(F.col(c).cast("double").alias(c) for c in MEASURES), *(F.element_at("verde_em", F.lit(float(h))).alias(c) for h, c in green.items()), (F.col(weight) if weight else F.lit(1)).cast("long").alias("__w"))
    keyed = staged(laid.groupBy(*group, *MEASURES, *green.values()).agg(F.sum("__w").alias("__w")), "results")
    aggs = [F.sum("__w").alias("n")]
    for h, c in green.items():
        known = F.sum(F.when(F.col(c).isNotNull(), F.col("__w")))
        aggs += [(F.sum(F.when(~F.col(c), F.col("__w")).when(F.col(c), 0)) / known).alias(f"not_green_{h}h"), F.coalesce(F.sum(F.when(F.col(c).isNull(), F.col("__w"))), F.lit(0)).alias(f"censored_{h}h")]
    out = keyed.groupBy(*group).agg(*aggs)
    # All measures in one pass: each value is counted under its measure's name.
    long = keyed.select(*group, "__w", F.explode(F.array(*(F.struct(F.lit(c).alias("measure"), F.col(c).alias("x")) for c in MEASURES))).alias("m"))
    each = describe(long.select(*group, "__w", "m.measure", "m.x"), "x", [*group, "measure"], "__w")
    for c in MEASURES:
        mine = each.where(F.col("measure") == c).select(*group, F.col("n").alias(f"{c}_n"), F.col("p50").alias(f"{c}_p50"), F.col("p90").alias(f"{c}_p90"), F.col("max").alias(f"{c}_max"))
        out = out.join(mine, group, "left").withColumn(f"{c}_n", F.coalesce(f"{c}_n", F.lit(0)))
    return out.drop("__all")


def pool(bars: DataFrame, horizon_h: float, key: str = "instrument") -> DataFrame:
    """Bars with the whole horizon of data ahead."""
    last = bars.groupBy(key).agg(F.max("ts_us").alias("__last"))
    return bars.join(last, key).where(F.col("ts_us") <= F.col("__last") - int(horizon_h * HOUR)).drop("__last")


def with_cells(bars: DataFrame, value: str = "pre_range") -> DataFrame:
    """Adds weekday, hour and decile: how many of the cell's nine linear quantile cuts (over finite values) are at or below the value.

    Cells with fewer than MIN_POOL finite values have no decile, nor have rows whose own value is not finite.
    """
    laid = bars.withColumns({"weekday": weekday_of(F.col("ts_us")), "hour": hour_of(F.col("ts_us"))})
    ok = finite(F.col(value))
    fine = laid.where(ok)
    cuts = quantiles(fine, ["weekday", "hour"], value, {f"c{k}": k / 10 for k in range(1, 10)}).join(fine.groupBy("weekday", "hour").agg(F.count("*").alias("finite_n")), ["weekday", "hour"])
    cuts = cuts.select("weekday", "hour", "finite_n", F.array(*(f"c{k}" for k in range(1, 10))).alias("cuts"))
    # 168 cells at most.
    out = laid.join(F.broadcast(cuts), ["weekday", "hour"], "left")
    decile = F.when(ok & (F.col("finite_n") >= MIN_POOL), F.size(F.filter("cuts", lambda c: c <= F.col(value))))
    return out.withColumn("decile", decile).drop("cuts")


def _rolls(k: int, seed: int):
    """(function) ids as text -> of each the digests of both salts and k draws, as `dice` makes them; longer texts than a block one by one."""
    numbers = np.arange(1, k + 1)

    def run(ids: pd.Series) -> pd.Series:
        out = np.empty((len(ids), 2, k), np.int64)
        for salt in (1, 2):
            heads = [b"%d|%d|" % (seed, salt) + (b"" if x is None else x.encode() + b"|") for x in ids]
            sizes = np.array([len(h) for h in heads])
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                for lo, hi in _runs([len(str(i)) for i in numbers.tolist()], k):
                    mine = [heads[i] for i in at]
                    if size + len(str(hi)) > MOST:
                        out[at, salt - 1, lo:hi] = [[int(md5(h + b"%d" % i).hexdigest()[:15], 16) for i in numbers[lo:hi].tolist()] for h in mine]
                    else:
                        out[at, salt - 1, lo:hi] = first_digits(mine, numbers[lo:hi])
        return pd.Series(list(out.reshape(len(ids), -1)), dtype=object)

    return run


def _rolls_of(k: int, seed: int) -> str:
    return f"__rolls_{k}_{seed}"


def with_rolls(entries: DataFrame, k: int, seed: int = 0) -> DataFrame:
    """Adds what k draws of each entry roll, the same for every scheme: a column that `draw` looks for."""
    udf = F.pandas_udf(_rolls(k, seed), "array<long>")
    return entries.withColumn(_rolls_of(k, seed), udf(F.col("entry_id").cast("string")))


def draw(entries: DataFrame, candidates: DataFrame, scheme: str, k: int, seed: int = 0, value: str = "pre_range") -> DataFrame:
    """k candidates with replacement for each entry: entry columns, `draw` (1..k), cand_ts (jittered by 0-59 s), fallback.

    entries and candidates (the pool): ts_us and `value`; entries also entry_id. `aleatorio` draws from the whole pool,
    `horario` from the entry's weekday and hour, or if the pool has none there from all. `volatilidade` starts from the
    same and goes on to the candidates in the entry's decile, cut over the finite values there; with fewer than MIN_POOL
    of these, or an entry without a finite value, it draws from all there, and where the decile has fewer than
    MIN_DECILE, from the finite ones there. fallback: less was matched than the scheme asks for.

    Candidates are numbered inside their cells; a hash of seed, entry and draw picks a number, and an equi-join on (cell,
    number) fetches it, so draws don't depend on order or layout.
    """
    if scheme not in SCHEMES or k < 1:
        raise ValueError(f"scheme is one of {SCHEMES} and k positive")
    rolls = _rolls_of(k, seed)
    if rolls not in entries.columns:
        entries = with_rolls(entries, k, seed)
    everywhere, x = F.lit("tudo"), F.col("__x")
    keyed = lambda rows: rows.withColumns({"__x": F.col(value).cast("double"), "__hour": F.concat_ws("/", F.lit("hora"), weekday_of(F.col("ts_us")), hour_of(F.col("ts_us")))})
    places = {"aleatorio": [everywhere], "horario": [F.col("__hour"), everywhere], "volatilidade": [F.col("__hour"), everywhere]}[scheme]
    based = keyed(candidates).select("ts_us", "__x", F.explode(F.array(*places)).alias("__base"))
    cells = [F.col("__base")]
    if scheme == "volatilidade":
        fine = based.where(finite(x))
        cuts = quantiles(fine, ["__base"], "__x", {f"c{i}": i / 10 for i in range(1, 10)}).join(fine.groupBy("__base").agg(F.count("*").alias("__finite")), "__base")
        cuts = staged(cuts.select("__base", "__finite", F.array(*(f"c{i}" for i in range(1, 10))).alias("__cuts")), "cuts")  # 169 rows at most
        based = based.join(cuts, "__base", "left")
        decile = F.size(F.filter("__cuts", lambda c: c <= x)).cast("string")
        cells += [F.when(finite(x), F.concat_ws("/", "__base", F.lit("finitos"))), F.when(finite(x) & (F.col("__finite") >= MIN_POOL), F.concat_ws("/", F.col("__base"), decile))]
    levelled = based.select("ts_us", F.explode(F.array_compact(F.array(*cells))).alias("cell"))
    # Places inside cells by buckets of time: counts of earlier buckets plus a rank in the own one.
    bucketed = levelled.withColumn("b", chunk_of(F.col("ts_us"), 30 * DAY))
    sizes = bucketed.groupBy("cell", "b").agg(F.count("*").alias("c"))
    before = sizes.withColumn("before", F.coalesce(F.sum("c").over(Window.partitionBy("cell").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("c")
    numbered = bucketed.withColumn("r", F.row_number().over(Window.partitionBy("cell", "b").orderBy("ts_us"))).join(before, ["cell", "b"])
    numbered = numbered.select(F.col("cell").alias("c_cell"), (F.col("before") + F.col("r")).alias("c_no"), F.col("ts_us").alias("c_ts"))
    counts = staged(sizes.groupBy("cell").agg(F.sum("c").alias("n")), "cells")
    sized = lambda rows, cell, name: rows.join(counts.select(F.col("cell").alias("__cell"), F.col("n").alias(name)), cell == F.col("__cell"), "left").drop("__cell")
    placed = sized(sized(keyed(entries), F.col("__hour"), "__n_hour"), everywhere, "__n_all")
    hourly = F.col("__n_hour").isNotNull() if scheme != "aleatorio" else F.lit(False)
    placed = placed.withColumn("__base", F.when(hourly, F.col("__hour")).otherwise(everywhere))
    lost = F.lit(scheme != "aleatorio") & ~hourly
    choice = lambda cell, n, fallback: F.struct(cell.alias("cell"), n.alias("n"), fallback.alias("fallback"))
    whole = choice(F.col("__base"), F.when(hourly, F.col("__n_hour")).otherwise(F.col("__n_all")), lost)
    if scheme == "volatilidade":
        placed = placed.join(cuts, "__base", "left")
        own, rest = F.concat_ws("/", F.col("__base"), F.size(F.filter("__cuts", lambda c: c <= x)).cast("string")), F.concat_ws("/", F.col("__base"), F.lit("finitos"))
        placed = sized(sized(placed, own, "__n_own"), rest, "__n_rest")
        loose = ~finite(x) | x.isNull() | (F.coalesce("__finite", F.lit(0)) < MIN_POOL)
        whole = F.when(loose, choice(F.col("__base"), F.when(hourly, F.col("__n_hour")).otherwise(F.col("__n_all")), F.lit(True))).when(F.col("__n_own") >= MIN_DECILE, choice(own, F.col("__n_own"), lost)).otherwise(choice(rest, F.col("__n_rest"), F.lit(True)))
    rolled = F.explode(F.transform(F.sequence(F.lit(1), F.lit(k)), lambda i: F.struct(i.alias("draw"), F.get(rolls, i - 1).alias("which"), F.get(rolls, i + k - 1).alias("late"))))
    picked = placed.withColumn("pick", whole).where(F.col("pick.n").isNotNull()).withColumn("__roll", rolled)
    picked = picked.withColumns({"no": F.pmod(F.col("__roll.which"), F.col("pick.n")) + 1, "draw": F.col("__roll.draw")})
    out = picked.join(staged(numbered, "numbered"), (F.col("pick.cell") == F.col("c_cell")) & (F.col("no") == F.col("c_no")))
    jitter = F.pmod(F.col("__roll.late"), F.lit(60)) * SECOND
    return out.select(*(c for c in entries.columns if c != rolls), "draw", (F.col("c_ts") + jitter).alias("cand_ts"), F.col("c_ts").alias("cand_bar"), F.col("pick.fallback").alias("fallback"))


def synthetic(legs: DataFrame, start_us: int, first: float, spread: float, key: str = "instrument") -> DataFrame:
    """Ticks a second apart that go from `first` in straight legs: series whose results are known.

    legs: key, leg (their order), seconds (1 or more; others add no tick), price (where the leg ends). A series of many
    legs is no task of its own: a leg needs the price before it and the seconds until it, both carried over blocks of legs.
    """
    used = legs.where("seconds >= 1")
    laid = with_previous(used, [key], ["leg"], {"__from": "price"}, ts="leg", chunk_us=4096)
    laid = running_sum(laid, [key], ["leg"], "seconds", "__until", ts="leg", chunk_us=4096)
    at = laid.withColumns({"__from": F.coalesce("__from", F.lit(float(first))), "__i": F.explode(F.sequence(F.lit(1).cast("long"), F.col("seconds").cast("long")))})
    ticks = at.select(key, (F.col("__until") - F.col("seconds") + F.col("__i")).cast("long").alias("seq"), (F.col("__from") + (F.col("price") - F.col("__from")) * F.col("__i") / F.col("seconds")).alias("bid"))
    starts = used.select(key).distinct().select(key, F.lit(0).cast("long").alias("seq"), F.lit(float(first)).alias("bid"))
    return starts.unionByName(ticks).select(key, (F.lit(start_us) + F.col("seq") * SECOND).alias("ts_us"), "seq", "bid", (F.col("bid") + spread).alias("ask"))


def _sides(values: DataFrame, column: str, is_a: str, by: list[str], *more: Column, weight: str | None = None) -> DataFrame:
    """by, x and how many of a and of b, of the finite values; a row stands for `weight` values."""
    x = F.col(column).cast("double")
    w = F.col(weight) if weight else F.lit(1)
    side = lambda mine: F.when(mine, w).otherwise(F.lit(0)).cast("long")
    return values.where(finite(x)).withColumn("__all", F.lit(0)).select(*by, "__all", x.alias("x"), side(F.col(is_a)).alias("a"), side(~F.col(is_a)).alias("b"), *more)


def superiority(values: DataFrame, column: str, is_a: str, by: list[str] | None = None, weight: str | None = None) -> DataFrame:
    """P(a < b) + P(a = b) / 2 over finite values: (by,) p, n_a, n_b; without `by` one row. A row stands for `weight` values.

    By counts of each distinct value, so pairs are never formed.
    """
    by = by or []
    ranked = counted(_sides(values, column, is_a, by, weight=weight), [*by, "__all"], "x", {"a": F.sum("a"), "b": F.sum("b")})
    out = ranked.groupBy(*by).agg(F.sum(F.col("b") * (F.col("a_below") + F.col("a") / 2)).alias("u"), F.coalesce(F.sum("a"), F.lit(0)).alias("n_a"), F.coalesce(F.sum("b"), F.lit(0)).alias("n_b"))
    return out.select(*by, F.try_divide("u", F.col("n_a") * F.col("n_b")).alias("p"), "n_a", "n_b")


#: Rows of a block of values, distinct values of it worked on together; places a task draws for at once, replicates it draws
#: together, episodes of a block of draws; bytes of draws that a task of replicates holds.
BLOCK_ROWS, BLOCK_VALUES, DRAW_PLACES, DRAW_TOGETHER, DRAW_EPISODES, STRIP_BYTES = 16384, 1024, 2048, 16, 2048, 1 << 26


def _runs(sizes: list[int], most: int) -> list[tuple[int, int]]:
    """From and to of the runs of one size, cut after `most`."""
    edges = [i for i in range(1, len(sizes)) if sizes[i] != sizes[i - 1]]
    return [(at, min(at + most, hi)) for lo, hi in zip([0, *edges], [*edges, len(sizes)]) for at in range(lo, hi, most)]


def _draws(group: list[str], n: int, seed: int):
    """(function) places (group, episodes, place) -> packed draws: group, episodes, block of them, and the (episode, replicate) drawn
    as numbers inside the block. The draw is `dice`(episodes, seed, replicate, place)."""
    heads = [b"%d|%d|" % (seed, r) for r in range(n)]
    runs = _runs([len(h) for h in heads], DRAW_TOGETHER)

    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        places, episodes = np.sort(rows["place"].to_numpy()), int(rows["episodes"].iloc[0])
        if episodes > np.iinfo(np.int32).max:
            raise ValueError("more episodes than places of four bytes")
        no = np.empty((n, len(places)), np.int32)
        for lo, hi in _runs([len(str(p)) for p in places.tolist()], len(places)):
            for first, last in runs:
                no[first:last, lo:hi] = first_digits(heads[first:last], places[lo:hi]) % np.uint64(episodes)
        block = no // DRAW_EPISODES
        code = ((no - block * DRAW_EPISODES) * n + np.arange(n, dtype=np.int32)[:, None]).ravel()
        block = block.ravel().astype(np.min_scalar_type(episodes // DRAW_EPISODES))  # small numbers are sorted by their digits
        by = np.argsort(block, kind="stable")
        blocks, first = np.unique(block[by], return_index=True)
        head = {c: [rows[c].iloc[0]] * len(blocks) for c in group} | {"episodes": episodes}
        return pd.DataFrame(head | {"__block": blocks.astype(np.int64), "codes": [x.tobytes() for x in np.split(code[by], first[1:])]})

    def run(batches):
        for batch in batches:
            for _, rows in batch.groupby(group, sort=False, dropna=False):
                for lo in range(0, len(rows), DRAW_PLACES):
                    yield packed(rows.iloc[lo : lo + DRAW_PLACES])

    return run


def _times(group: list[str], n: int):
    """(function) a block's packed draws -> per episode `no` how often each replicate drew it, as an array of bytes or of wider numbers."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        # Counted together: a count of each packed row by itself would walk the whole block for a few draws.
        held = np.bincount(np.frombuffer(b"".join(rows["codes"]), np.int32), minlength=DRAW_EPISODES * n).reshape(DRAW_EPISODES, n)
        held = held.astype(np.uint8 if held.max() < 256 else np.uint32)
        drawn = np.flatnonzero(held.any(axis=1))
        head = {c: [rows[c].iloc[0]] * len(drawn) for c in group}
        return pd.DataFrame(head | {"no": rows["__block"].iloc[0] * DRAW_EPISODES + drawn, "times": [held[i].tobytes() for i in drawn]})

    return run


#: What a task of replicates reads: draws first, then values.
DRAWN, VALUES = 0, 1


def _strips(group: list[str], n: int, width: int):
    """(function) a block's packed draws -> a row a strip of `width` replicates: how often each drew each of the block's episodes."""
    times = _times([], n)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        mine, block = times(rows), rows["__block"].iloc[0]
        each = np.frombuffer(b"".join(mine["times"]), f"<u{len(mine['times'].iloc[0]) // n}").reshape(-1, n)
        held = np.zeros((DRAW_EPISODES, n), each.dtype)
        held[mine["no"].to_numpy() - block * DRAW_EPISODES] = each
        firsts = range(0, n, width)
        head = {c: [rows[c].iloc[0]] * len(firsts) for c in group} | {"episodes": rows["episodes"].iloc[0], "__block": block}
        return pd.DataFrame(head | {"kind": DRAWN, "strip": range(len(firsts)), "data": [held[:, lo : lo + width].tobytes() for lo in firsts]})

    return run


def _packed(group: list[str]):
    """(function) a block's rows -> a row: their episodes, counts where any is not 1, and where values begin, for both sides; of
    each value of b the values of a below it, and those up to it."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("x", kind="stable")
        parts, at = [], []
        for side in "ab":
            own = rows[rows[side] > 0]
            x, count = own["x"].to_numpy(), own[side].to_numpy()
            starts = np.flatnonzero(np.append(True, np.diff(x) != 0)[: len(x)])
            parts += [own["no"].to_numpy(), count if (count > 1).any() else count[:0], starts]
            at.append(x[starts])
        parts += [np.searchsorted(at[0], at[1], side) for side in ("left", "right")]
        head = {c: [rows[c].iloc[0]] for c in [*group, "episodes", "__block"]}
        return pd.DataFrame(head | {"data": [b"".join(x.astype(np.int32).tobytes() for x in [np.array([len(p) for p in parts]), *parts])]})

    return run


def _replicates(group: list[str], n: int, width: int):
    """(function) rows of a strip, the draws before the values -> a row a block of values: the strip's sums of a and of b, and of b's
    over a's of the block below them, halves for ties."""

    def sums(held, no, count, starts):
        if not len(starts):
            return np.zeros((0, held.shape[1]), np.int64)
        drawn = held.take(no, axis=0)
        return np.add.reduceat(drawn * count[:, None].astype(np.int64) if len(count) else drawn, starts, axis=0, dtype=np.int64)

    def block(held, data):
        sizes = np.frombuffer(data, np.int32, 8)
        no_a, count_a, starts_a, no, count, starts, under, upto = np.split(np.frombuffer(data, np.int32, offset=32), np.cumsum(sizes)[:-1])
        below = np.zeros((len(starts_a) + 1, held.shape[1]), np.int64)
        np.cumsum(sums(held, no_a, count_a, starts_a), axis=0, out=below[1:])
        b, twice = np.zeros((2, held.shape[1]), np.int64)
        for at in range(0, len(starts), BLOCK_VALUES):
            own = starts[at : at + BLOCK_VALUES]
            rows = slice(own[0], starts[at + BLOCK_VALUES] if at + BLOCK_VALUES < len(starts) else len(no))
            in_b = sums(held, no[rows], count[rows], own - own[0])
            b += in_b.sum(axis=0)
            twice += (in_b * (below[under[at : at + BLOCK_VALUES]] + below[upto[at : at + BLOCK_VALUES]])).sum(axis=0)
        return below[-1], b, twice / 2

    def run(batches):
        of, held = None, None
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                if of != (row["strip"], row["episodes"]):
                    of = row["strip"], row["episodes"]
                    held = np.zeros((-(-row["episodes"] // DRAW_EPISODES) * DRAW_EPISODES, min(width, n - row["strip"] * width)), np.uint8)
                if row["kind"] == DRAWN:
                    mine = np.frombuffer(row["data"], f"<u{len(row['data']) // DRAW_EPISODES // held.shape[1]}").reshape(DRAW_EPISODES, -1)
                    held = held.astype(mine.dtype) if mine.itemsize > held.itemsize else held
                    held[row["__block"] * DRAW_EPISODES :][:DRAW_EPISODES] = mine
                else:
                    a, b, u = block(held, row["data"])
                    out.append({c: row[c] for c in [*group, "__block"]} | {"first": row["strip"] * width, "a": a, "b": b, "u": u})
            if out:
                yield pd.DataFrame(out)

    return run


def bootstrap(values: DataFrame, column: str, is_a: str, episode: str = "episode", n: int = 1000, seed: int = 0, by: list[str] | None = None) -> DataFrame:
    """CI95 of the superiority by resampling episodes: (by,) lo, hi, episodes; null below 3 episodes, or 10 replicates that have values of both sides.

    A replicate counts each episode as often as it was drawn and ranks its values like `superiority`. Draws are hashes of
    seed, replicate and place, sent to their block of episodes as four bytes each; groups of as many episodes share them.
    A task has a strip of replicates, for which it holds a byte an episode and replicate, and goes through the values in
    blocks of some BLOCK_ROWS rows in order; a value with more rows is a block of its own, whose rows are split, since of
    equal values only sums count. So neither values nor rows of them meet an array of all replicates, and only sums of
    blocks have a row a replicate.
    """
    by = by or []
    group = [*by, "__all"]
    spark = values.sparkSession
    ok = _sides(values, column, is_a, by, F.col(episode).alias("e")).groupBy(*group, "e", "x").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    ok = staged(ok, "values")
    kinds = dict(values.dtypes) | {"__all": "int"}
    head = ", ".join(f"`{c}` {kinds[c]}" for c in group)
    names = staged(numbered(ok.select(*group, "e").distinct(), group, "e", "e", "no").select(*group, "e", "no"), "episodes")
    total = staged(names.groupBy(*group).agg(F.count("*").alias("episodes")), "totals")
    most = total.agg(F.max("episodes")).first()[0] or 1
    # Fewer replicates a strip have more copies of the values, more have more memory.
    width = max(1, min(-(-n // (2 * spark.sparkContext.defaultParallelism)), STRIP_BYTES // most))
    strips = -(-n // width)
    enough = total.where("episodes >= 3")
    # Draws depend on the number of episodes alone: one group stands for all that have as many.
    one = enough.groupBy("episodes").agg(F.min(F.struct(*group)).alias("g")).select("episodes", "g.*")
    # A place costs n digests, so few places are worth a task.
    places = names.join(F.broadcast(one), group).select(*group, "episodes", F.col("no").alias("place")).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "place")
    codes = places.mapInPandas(_draws(group, n, seed), head + ", episodes long, `__block` long, codes binary")
    order = [*group, "episodes", "__block", "kind", "strip", "data"]
    drawn = codes.groupBy(*group, "__block").applyInPandas(_strips(group, n, width), head + ", episodes long, `__block` long, kind int, strip int, data binary").select(*order)
    ranked = counted(ok.select(*group, "x"), group, "x").select(*group, "x", F.col("n").alias("__n"), F.floor(F.col("n_below") / BLOCK_ROWS).alias("__block"))
    large = F.col("__n") > BLOCK_ROWS
    ranked = ranked.select(*group, "x", (F.col("__block") * 2 + large.cast("long")).alias("__block"), F.when(large, F.ceil(F.col("__n") / BLOCK_ROWS)).otherwise(F.lit(1)).alias("__parts"))
    placed = ok.join(ranked, [*group, "x"]).join(names.join(enough, group), [*group, "e"]).withColumn("__salt", F.pmod(F.xxhash64("e"), F.col("__parts")))
    placed = placed.select(*group, "episodes", "__block", "__salt", "x", "no", "a", "b")
    blocks = placed.groupBy(*group, "__block", "__salt").applyInPandas(_packed(group), head + ", episodes long, `__block` long, data binary")
    each_strip = F.explode(F.sequence(F.lit(0), F.lit(strips - 1)))
    blocks = staged(blocks, "packed").withColumns({"kind": F.lit(VALUES), "strip": each_strip}).select(*order)
    both = drawn.unionByName(blocks).repartitionById(strips, F.col("strip")).sortWithinPartitions("strip", "episodes", "kind")
    part = both.mapInPandas(_replicates(group, n, width), head + ", `__block` long, first int, a array<long>, b array<long>, u array<double>")
    part = staged(part, "blocks").select(*group, "__block", "first", F.posexplode(F.arrays_zip("a", "b", "u")).alias("id", "s")).select(*group, "__block", (F.col("first") + F.col("id")).alias("id"), "s.*")
    each = part.groupBy(*group, "__block", "id").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("u").alias("u"))
    each = each.withColumn("u", F.when(F.col("__block") % 2 == 1, F.col("b") * F.col("a") / 2).otherwise(F.col("u")))
    below = F.coalesce(F.sum("a").over(Window.partitionBy(*group, "id").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    each = each.withColumn("below", below).groupBy(*group, "id").agg(F.try_divide(F.sum(F.col("u") + F.col("b") * F.col("below")), F.sum("a") * F.sum("b")).alias("p"))
    known = lambda q: F.when(F.count("p") >= MIN_REPLICATES, F.percentile("p", F.lit(q)))
    ci = each.groupBy(*group).agg(known(0.025).alias("lo"), known(0.975).alias("hi"))  # n values
    out = total.join(ci, group, "left")
    if by:
        return out.select(*by, "lo", "hi", "episodes")
    return out.groupBy().agg(F.max("lo").alias("lo"), F.max("hi").alias("hi"), F.coalesce(F.max("episodes"), F.lit(0)).alias("episodes"))


def compare(real: DataFrame, drawn: DataFrame, column: str, treat_missing: str = "drop", n: int = 1000, seed: int = 0) -> DataFrame:
    """Real entries against drawn ones: p (a real value is less than a drawn one), lo, hi, episodes, n_real, n_drawn.

    real and drawn: episode and the measure. An entry that never turned green has no time to it: `drop` leaves it out,
    so the comparison is among those that did; `worst` lets it lose against every other.
    """
    if treat_missing not in ("drop", "worst"):
        raise ValueError("treat_missing is drop or worst")
    never = F.lit(1e300) if treat_missing == "worst" else F.lit(None).cast("double")
    pick = lambda df, a: df.select("episode", F.coalesce(F.col(column).cast("double"), never).alias("x"), F.lit(a).alias("is_a"))
    both = staged(pick(real, True).unionByName(pick(drawn, False)).where("x is not null"), "compared")
    p = superiority(both, "x", "is_a").select("p", F.col("n_a").alias("n_real"), F.col("n_b").alias("n_drawn"))
    return p.join(bootstrap(both, "x", "is_a", n=n, seed=seed), F.lit(True))  # a row each
