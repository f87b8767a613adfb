"""The study's report: real entries beside drawn ones of every scheme, a figure a row (bloco, medida, campo, valor)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickforge.staging import staged

from .study import EPISODE_GAPS_MIN, HORIZONS_H, MEASURES, bootstrap, episode_sizes, summary, superiority

REAL = "real"


def _figures(wide: DataFrame, block: Column | str, named: list[tuple[str, str, Column | str]]) -> DataFrame:
    """A row a figure (medida, campo, column) of each row of `wide`."""
    of = lambda c: (F.col(c) if isinstance(c, str) else c).cast("double")
    block = F.col(block) if isinstance(block, str) else block
    rows = F.array(*(F.struct(F.lit(m).alias("medida"), F.lit(f).alias("campo"), of(c).alias("valor")) for m, f, c in named))
    return wide.select(block.alias("bloco"), F.explode(rows).alias("f")).select("bloco", "f.*")


def blocks(results: DataFrame, horizons_h: tuple[float, ...] = HORIZONS_H, weight: str | None = None) -> DataFrame:
    """Per bloco: n, of each measure n, p50, p90, max, and at each horizon how many were judged, censored, and the share not green."""
    wide = summary(results, horizons_h, ["bloco"], weight)
    named = [("entradas", "n", "n")] + [(m, f, f"{m}_{f}") for m in MEASURES for f in ("n", "p50", "p90", "max")]
    for h in horizons_h:
        named += [(f"nao_virou_{h}h", "n", F.col("n") - F.col(f"censored_{h}h")), (f"nao_virou_{h}h", "censuradas", f"censored_{h}h"), (f"nao_virou_{h}h", "fracao", f"not_green_{h}h")]
    return _figures(wide, "bloco", named)


def comparisons(real: DataFrame, drawn: DataFrame, tally: DataFrame, n: int = 1000, seed: int = 0) -> DataFrame:
    """Per scheme: P that a real entry's excursion is smaller with its interval by episodes, P that it turns green sooner, entries that fell back.

    tally: the results of both, bloco and how many `n` a row stands for.
    """
    schemes = drawn.select("scheme").distinct()  # a few names
    long = tally.select("bloco", "n", F.explode(F.array(*(F.struct(F.lit(m).alias("medida"), F.col(m).cast("double").alias("x")) for m in ("mae_usd_oz", "horas_ate_verde")))).alias("v"))
    long = staged(long.select("bloco", "n", "v.*").where("x is not null").groupBy("bloco", "medida", "x").agg(F.sum("n").alias("n")), "compared")
    is_real = F.col("bloco") == REAL
    sides = long.where(is_real).join(F.broadcast(schemes)).withColumn("is_a", F.lit(True)).drop("bloco").unionByName(long.where(~is_real).withColumnRenamed("bloco", "scheme").withColumn("is_a", F.lit(False)))
    p = superiority(sides, "x", "is_a", ["scheme", "medida"], "n")
    pick = lambda df, a: df.select("scheme", "episode", F.lit(a).alias("is_a"), F.col("mae_usd_oz").cast("double").alias("x"))
    both = pick(real.join(F.broadcast(schemes)), True).unionByName(pick(drawn, False)).where("x is not null")
    p = _figures(p.withColumn("bloco", F.col("scheme")), "bloco", [("mae_usd_oz", "p_real_menor", F.when(F.col("medida") == "mae_usd_oz", F.col("p"))), ("horas_ate_verde", "p_real_menor", F.when(F.col("medida") == "horas_ate_verde", F.col("p")))]).where("valor is not null")
    ci = _figures(bootstrap(both, "x", "is_a", n=n, seed=seed, by=["scheme"]), "scheme", [("mae_usd_oz", "ic95_min", "lo"), ("mae_usd_oz", "ic95_max", "hi")])
    fell = drawn.where("fallback").groupBy("scheme", "of").agg(F.lit(1).alias("one")).groupBy("scheme").agg(F.count("*").alias("n"))
    fell = schemes.join(fell, "scheme", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return p.unionByName(ci).unionByName(_figures(fell, "scheme", [("entradas", "recuos", "n")]))


def report(entries: DataFrame, real: DataFrame, drawn: DataFrame, gap_min: float = 60, outside: DataFrame | None = None, n: int = 1000, seed: int = 0, horizons_h: tuple[float, ...] = HORIZONS_H, tally: DataFrame | None = None) -> DataFrame:
    """All figures of the study.

    entries: those inside the coverage (entry_id, ts_us, side); real: their results (`evaluate`) and `episode`; drawn: results of
    drawn entries with scheme, of (the real entry), episode (its), fallback; outside: entries that the bars don't cover.
    tally: the results of both counted, as bloco (REAL or a scheme), the measures, verde_em and n; from it alone come all figures
    but the interval, so real and drawn need no measure but mae_usd_oz. Left out, each result is a row of it.
    """
    gaps = tuple(sorted({float(g) for g in (*EPISODE_GAPS_MIN, gap_min)}))
    sizes = episode_sizes(entries, gaps)
    grouped = _figures(sizes.where(F.col("gap_min") == float(gap_min)), F.lit("episodios"), [("episodios", "n_efetivo", "episodes"), ("episodios", "maior", "max_size"), ("episodios", "p50", "p50_size")])
    by_gap = sizes.select(F.lit("episodios").alias("bloco"), F.format_string("gap_%dmin", F.col("gap_min").cast("int")).alias("medida"), F.lit("n_efetivo").alias("campo"), F.col("episodes").cast("double").alias("valor"))
    if tally is None:
        tally = real.select(F.lit(REAL).alias("bloco"), *MEASURES, "verde_em").unionByName(drawn.select(F.col("scheme").alias("bloco"), *MEASURES, "verde_em")).withColumn("n", F.lit(1))
    out = [blocks(tally, horizons_h, "n"), comparisons(real, drawn, tally, n, seed), grouped, by_gap]
    if outside is not None:
        out.append(_figures(outside.agg(F.count("*").alias("n")), F.lit(REAL), [("entradas", "fora_do_historico", "n")]))
    return reduce(DataFrame.unionByName, out)
