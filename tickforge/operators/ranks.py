"""Exact ranks and quantiles of long series without one task per series.

Values are counted first (partial sums before the shuffle), then cut into buckets by approximate quantiles of each
series, which outliers don't move. What lies below a value is the counts of the buckets before (a small table) and the
part of its own bucket before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickforge.staging import staged

#: Buckets a series.
BUCKETS = 64


def _bucketed(rows: DataFrame, key: list[str], value: str, buckets: int = BUCKETS) -> DataFrame:
    """`rows` with `__bucket`: ascending buckets of the value within the key.

    Cuts are written: approximate quantiles depend on the order in which parts arrive, so a second reading of them could
    cut otherwise, and a value's bucket would not be that of the sums. A row a key.
    """
    cuts = F.percentile_approx(value, F.array(*(F.lit(i / buckets) for i in range(1, buckets))), F.lit(20 * buckets))
    bounds = staged(rows.groupBy(*key).agg(cuts.alias("__cuts")), "cuts")
    return rows.join(bounds, key).withColumn("__bucket", F.size(F.filter("__cuts", lambda c: c < F.col(value)))).drop("__cuts")


def _before(rows: DataFrame, key: list[str], weights: dict[str, Column]) -> DataFrame:
    """key, __bucket and for each weight `<weight>_before`: its sum in the buckets before. A row a bucket, so the window is small."""
    sizes = rows.groupBy(*key, "__bucket").agg(*(c.alias(w) for w, c in weights.items()))
    w = Window.partitionBy(*key).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(*key, "__bucket", *(F.coalesce(F.sum(x).over(w), F.lit(0)).alias(f"{x}_before") for x in weights))


def _below(each: DataFrame, key: list[str], value: str, weights: list[str]) -> DataFrame:
    """each (a row a value) with `<weight>_below` for the weights."""
    each = _bucketed(each, key, value)
    before = _before(each, key, {w: F.sum(w) for w in weights})
    w = Window.partitionBy(*key, "__bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    out = each.withColumns({f"{x}_own": F.coalesce(F.sum(x).over(w), F.lit(0)) for x in weights}).join(before, [*key, "__bucket"])
    return out.select(*key, value, *weights, *((F.col(f"{x}_before") + F.col(f"{x}_own")).alias(f"{x}_below") for x in weights))


def _values(rows: DataFrame, key: list[str], value: str, weights: dict[str, Column]) -> DataFrame:
    """A row a value of a key with the weights, written once, for it is read several times."""
    return staged(rows.where(F.col(value).isNotNull()).groupBy(*key, value).agg(*(c.alias(w) for w, c in weights.items())), "values")


def counted(rows: DataFrame, key: list[str], value: str, weights: dict[str, Column] | None = None) -> DataFrame:
    """key, value, the weights summed (default n: rows), and for each `<weight>_below`: its sum over lesser values of the key."""
    weights = weights or {"n": F.count("*")}
    return _below(_values(rows, key, value, weights), key, value, list(weights))


def quantiles(rows: DataFrame, key: list[str], value: str, probabilities: dict[str, float], weight: str | None = None) -> DataFrame:
    """key and each named quantile of the values that are not null, linear between neighbours (like `percentile`).
    weight: a row stands for so many.

    Selection: the sums of buckets say which of them hold the wanted ranks, and the values of those alone are ranked.
    """
    each = _bucketed(rows.where(F.col(value).isNotNull()).groupBy(*key, value).agg((F.sum(weight) if weight else F.count("*")).alias("n")), key, value)
    each = staged(each, "values")
    w = Window.partitionBy(*key)
    sizes = each.groupBy(*key, "__bucket").agg(F.sum("n").alias("__n"))  # a row a bucket
    sizes = sizes.withColumns({"__before": F.coalesce(F.sum("__n").over(w.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "__total": F.sum("__n").over(w)})
    at = {name: F.lit(p) * (F.col("__total") - 1) for name, p in probabilities.items()}
    ranks = {f"__{end}_{name}": f(x) for name, x in at.items() for end, f in (("lo", F.floor), ("hi", F.ceil))}
    wanted = sizes.where(F.exists(F.array(*ranks.values()), lambda r: (F.col("__before") <= r) & (r < F.col("__before") + F.col("__n")))).drop("__n")
    below = F.col("__before") + F.coalesce(F.sum("n").over(Window.partitionBy(*key, "__bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    held = each.join(wanted, [*key, "__bucket"]).withColumn("__below", below)
    holds = lambda rank: F.max(F.when((F.col("__below") <= rank) & (rank < F.col("__below") + F.col("n")), F.col(value)))
    out = held.groupBy(*key, "__total").agg(*(holds(rank).alias(name) for name, rank in ranks.items()))
    between = lambda name: F.col(f"__lo_{name}") + (F.col(f"__hi_{name}") - F.col(f"__lo_{name}")) * (at[name] - F.floor(at[name]))
    return out.select(*key, *(between(name).alias(name) for name in probabilities))


def numbered(rows: DataFrame, key: list[str], value: str, order: str, name: str, weight: str | None = None) -> DataFrame:
    """`rows` with `name`: their place (from 0) within the key by value, then by `order`. Null values come first.
    weight: a row stands for so many, and its place is that of the first of them."""
    cut = _bucketed(staged(rows, "rows"), key, value)
    w = Window.partitionBy(*key, "__bucket").orderBy(value, order)
    row = F.coalesce(F.sum(weight).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) if weight else F.row_number().over(w) - 1
    return cut.withColumn("__row", row).join(_before(cut, key, {"__n": F.sum(weight) if weight else F.count("*")}), [*key, "__bucket"]).withColumn(name, F.col("__n_before") + F.col("__row")).drop("__bucket", "__n_before", "__row")


def tiles(place: Column, weight: Column, total: Column, n: int) -> Column:
    """The tiles that the places from `place` on, `weight` of them, fall into: an array of (tile, n)."""
    size, larger = F.floor(total / n), F.pmod(total, F.lit(n))
    edge = lambda k: k * size + F.least(k, larger)
    held = lambda k: F.least(place + weight, edge(k)) - F.greatest(place, edge(k - 1))
    return F.filter(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda k: F.struct(k.cast("int").alias("tile"), held(k).alias("n"))), lambda t: t["n"] > 0)


def tile(place: Column, total: Column, n: int) -> Column:
    """Which of n tiles (from 1) a place belongs to; the first ones are larger by one where n doesn't divide the total."""
    size, larger = F.floor(total / n), F.pmod(total, F.lit(n))
    edge = larger * (size + 1)
    return (F.when(place < edge, F.floor(place / (size + 1))).otherwise(larger + F.floor((place - edge) / size)) + 1).cast("int")
