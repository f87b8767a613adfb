"""Bars against a reference feed's bars. 'Nothing compared' is not 'no divergence'."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIELDS = ("open", "high", "low", "close")


class NothingCompared(ValueError):
    """The two sides have no label in common."""


def matched(ours: DataFrame, reference: DataFrame, key: tuple[str, ...] = ("ts_us",)) -> DataFrame:
    """Full outer join: key, d_open..d_close (absolute differences, null on one-sided labels), in_ours, in_reference."""
    a = ours.select(*key, *(F.col(f).alias(f"a_{f}") for f in FIELDS), F.lit(True).alias("in_a"))
    b = reference.select(*key, *(F.col(f).alias(f"b_{f}") for f in FIELDS), F.lit(True).alias("in_b"))
    joined = a.join(b, list(key), "full_outer")
    return joined.select(*key, *(F.abs(F.col(f"a_{f}") - F.col(f"b_{f}")).alias(f"d_{f}") for f in FIELDS), F.coalesce("in_a", F.lit(False)).alias("in_ours"), F.coalesce("in_b", F.lit(False)).alias("in_reference"))


def compare(ours: DataFrame, reference: DataFrame, key: tuple[str, ...] = ("ts_us",)) -> DataFrame:
    """One row: comuns, so_nossas, so_referencia, max_open..max_close, and the worst field, label and difference.

    Ties go to the field named first and then to the earliest label.
    """
    m = matched(ours, reference, key)
    both = F.col("in_ours") & F.col("in_reference")
    worst = F.greatest(*(F.col(f"d_{f}") for f in FIELDS))
    field = F.coalesce(*(F.when(F.col(f"d_{f}") == worst, F.lit(i)) for i, f in enumerate(FIELDS)))
    pick = F.max(F.when(both & worst.isNotNull(), F.struct(worst.alias("d"), (-field).alias("f"), (-F.col("ts_us")).alias("t"))))
    out = m.agg(
        F.count_if(both).alias("comuns"), F.count_if(F.col("in_ours") & ~F.col("in_reference")).alias("so_nossas"), F.count_if(F.col("in_reference") & ~F.col("in_ours")).alias("so_referencia"),
        *(F.max(f"d_{f}").alias(f"max_{f}") for f in FIELDS), pick.alias("p"),
    )
    names = F.array(*(F.lit(f) for f in FIELDS))
    return out.select("comuns", "so_nossas", "so_referencia", *(f"max_{f}" for f in FIELDS), F.element_at(names, (1 - F.col("p.f")).cast("int")).alias("worst_field"), (-F.col("p.t")).alias("worst_us"), F.col("p.d").alias("worst"))


def require_comparison(diff: DataFrame) -> DataFrame:
    """The row of `compare`, or an error if no label was in common."""
    if diff.first()["comuns"] == 0:
        raise NothingCompared("no label is on both sides: a divergence of 0 would mean nothing")
    return diff


def top_divergences(ours: DataFrame, reference: DataFrame, n: int = 10, key: tuple[str, ...] = ("ts_us",)) -> DataFrame:
    """The n common labels with the largest difference in any field, earliest first among equals."""
    m = matched(ours, reference, key).where("in_ours and in_reference")
    return m.withColumn("worst", F.greatest(*(F.col(f"d_{f}") for f in FIELDS))).orderBy(F.desc("worst"), *key).limit(n).select(*key, *(f"d_{f}" for f in FIELDS), "worst")
