import pytest
from pyspark.sql import functions as F

from fixtures import T0, ticks
from tickforge.functions.times import HOUR, months_between
from tickforge.operators import asof, quality, validate
from tickforge.schemas import InstrumentSpec

S = 1_000_000
GOLD = InstrumentSpec("X", 3, plausible_range=(500.0, 20000.0))


@pytest.mark.parametrize(("first", "prev", "gap", "ok", "factor", "reason"), [
    (3301, 3300, 1, True, None, "continuity"), (3400, 3300, 1, True, None, "continuity"), (3600, 3300, 1, True, None, "market move"), (660, 6600, 1, False, 0.1, "scale"),
    *((3300 * f, 3300, 1, False, f, "scale") for f in quality.SCALE_FACTORS), (3300, 3300, 216000, True, None, "range"), (3300, None, None, True, None, "range"), (3.3, None, None, False, None, "out of range"),
    (300, 299, 1, True, None, "continuity"),
])
def test_scale(spark, first, prev, gap, ok, factor, reason):
    row = spark.createDataFrame([(float(first), None if prev is None else float(prev), None if gap is None else float(gap))], "f double, p double, g double")
    r = row.select(quality.scale_outcome(F.col("f"), F.col("p"), F.col("g"), 500.0, 20000.0).alias("r")).first().r
    assert (r.ok, r.factor, r.reason) == (ok, factor, reason)


def test_scale_chain_over_hours(spark):
    good = ticks(spark, [(0, 3300), (1, 3300), (3600, 3301), (3601, 3301), (7200, 3302.5), (7201, 3303)])
    assert quality.require_scale(good, GOLD).count() == 6
    bad = ticks(spark, [(3598, 3300), (3599, 3300), (3600, 33000), (3601, 33000)])
    assert quality.require_scale(bad, GOLD, strict=False).count() == 2
    with pytest.raises(Exception, match="scale of X"):
        quality.require_scale(bad, GOLD).collect()


def test_gaps(spark):
    t = ticks(spark, [(i, 1) for i in range(60)] + [(6 * 3600 + i, 1) for i in range(60)])
    r = quality.gap_stats(t).first()
    assert (r.n, r.gap_p50, r.above_14400, r.above_60, r.status) == (120, 1.0, 1, 1, "ok")
    assert quality.largest_gaps(t, 1).first().gap_s == 6 * 3600 - 59
    assert quality.gap_stats(ticks(spark, [(0, 1)])).first().status == "sem_dados"


def test_four_states(spark):
    first, end = 20635 * 24 * HOUR, 20666 * 24 * HOUR  # July 2026
    listing = spark.createDataFrame([(first, 10, True, False), (first + HOUR, 0, True, False), (first + 2 * HOUR, 0, False, True)], "hour_us long, size long, has_file boolean, has_absent_marker boolean")
    states = quality.completeness(quality.hour_calendar(spark, first, end), listing)
    r = quality.completeness_counts(states).first()
    assert (r.presente, r.vazio, r.ausente, r.falhou, r.complete, len(r.missing)) == (1, 1, 1, 741, False, 200)
    absent = quality.hour_calendar(spark, first, end).select("hour_us", F.lit(0).alias("size"), F.lit(False).alias("has_file"), F.lit(True).alias("has_absent_marker"))
    assert quality.completeness_counts(quality.completeness(quality.hour_calendar(spark, first, end), absent)).first().complete


def test_months():
    assert months_between("2025-11", "2026-02") == [(2025, 11), (2025, 12), (2026, 1), (2026, 2)]
    for a, b in (("2026-02", "2026-01"), ("2026-13", "2026-14"), ("x", "2026-01")):
        with pytest.raises(ValueError):
            months_between(a, b)


def bar_table(spark, n=6, change=None):
    rows = [[T0 + i * 60 * S, 3300.0 + i, 3300.8 + i, 3299.6 + i, 3300.2 + i] for i in range(n)]
    for i, c, d in change or []:
        rows[i][c] += d
    return spark.createDataFrame([tuple(r) for r in rows], "ts_us long, open double, high double, low double, close double")


def test_injected_divergences_are_reported(spark):
    ours = bar_table(spark)
    r = validate.compare(bar_table(spark, change=[(3, 2, 0.5)]), ours).first()
    assert (r.comuns, r.worst_field, r.worst_us, r.max_open, r.max_low) == (6, "high", T0 + 180 * S, 0.0, 0.0) and r.max_high == pytest.approx(0.5)
    r = validate.compare(bar_table(spark, change=[(4, 0, 600 * S)]), ours).first()
    assert (r.comuns, r.so_nossas, r.so_referencia) == (5, 1, 1)
    shifted = ours.withColumn("ts_us", F.col("ts_us") + 60 * S)
    r = validate.compare(shifted, ours).first()
    assert (r.comuns, r.so_nossas, r.so_referencia) == (5, 1, 1) and r.worst > 0.5
    with pytest.raises(validate.NothingCompared):
        validate.require_comparison(validate.compare(ours.withColumn("ts_us", F.col("ts_us") + 10**12), ours))
    top = validate.top_divergences(bar_table(spark, 8, [(1, 2, 0.1), (5, 3, -0.75), (6, 4, 0.3)]), bar_table(spark, 8), 3).collect()
    assert [(t.ts_us - T0) // (60 * S) for t in top] == [5, 6, 1]


def test_asof_ties_and_empty_chunks(spark):
    t = ticks(spark, [(0, 1), (10, 2), (10, 3), (300000, 4)])
    probes = spark.createDataFrame([("X", T0 + x * S) for x in (-5, 0, 10, 11, 200000, 300001)], "instrument string, ts_us long")
    back = [r.bid for r in asof.backward(probes, t, ["bid"]).orderBy("ts_us").collect()]
    assert back == [None, 1, 3, 3, 3, 4]
    ahead = [r.bid for r in asof.forward(probes, t, ["bid"]).orderBy("ts_us").collect()]
    assert ahead == [1, 1, 2, 4, 4, 4]
