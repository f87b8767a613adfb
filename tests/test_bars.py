import pytest
from pyspark.sql import functions as F

from fixtures import T0, ticks
from tickforge.operators import bars
from tickforge.schemas import TIMEFRAMES

S = 1_000_000


def made(spark, pairs, seconds, **more):
    rows = bars.aggregate(ticks(spark, pairs, **more), seconds).orderBy("ts_us").collect()
    return [((r.ts_us - T0) // S, r.open, r.high, r.low, r.close, r.n_ticks) for r in rows]


@pytest.mark.parametrize(("pairs", "seconds", "labels"), [
    ([(0, 3300), (60, 3301), (120, 3302), (301, 3303)], 300, [0]),
    ([(450, 1), (1050, 2), (2850, 3)], 300, [300, 900]),
    ([(450, 1), (1050, 2), (2850, 3)], 1800, [0]),
    ([(0, 1), (60, 2), (1800, 3), (2100, 4)], 300, [0, 1800]),
    ([(0, 1), (60, 2), (120, 3)], 300, []),
])
def test_labels(spark, pairs, seconds, labels):
    assert [r[0] for r in made(spark, pairs, seconds)] == labels


def test_values_and_boundary_tick(spark):
    assert made(spark, [(0, 3300), (60, 3310), (120, 3295), (180, 3302), (300, 3303)], 300) == [(0, 3300, 3310, 3295, 3302, 4)]
    two = made(spark, [(0, 3300), (299, 3301), (300, 3302), (600, 3303)], 300)
    assert two[0][4] == 3301 and two[1][1] == 3302
    assert bars.aggregate(ticks(spark, [(0, 3300), (60, 3310.5), (120, 3295.5), (300, 3303)]), 300).first().range_usd_oz == 15.0


def test_ties_follow_the_input_order(spark):
    t = ticks(spark, [(0, 5), (0, 7), (10, 9), (10, 8), (300, 1)]).repartition(5, "bid")
    r = bars.aggregate(t, 300).first()
    assert (r.open, r.close) == (5, 8)


def test_removing_the_future_changes_no_closed_bar(spark):
    pairs = [(7 * i, 3300 + i % 13) for i in range(200)]
    whole = made(spark, pairs, 300)
    for cut in (50, 120, 199):
        assert made(spark, pairs[:cut], 300) == whole[: len(made(spark, pairs[:cut], 300))]


def test_each_series_closes_by_its_own_ticks(spark):
    both = ticks(spark, [(0, 1), (10, 2)], instrument="A").union(ticks(spark, [(0, 1), (400, 2)], instrument="B"))
    assert [r.instrument for r in bars.aggregate(both, 300).collect()] == ["B"]


def test_arguments_and_empty(spark):
    t = ticks(spark, [(0, 1)])
    for wrong in (lambda: bars.aggregate(t, 0), lambda: bars.aggregate(t, 60, "mid"), lambda: bars.aggregate_tf(t, "M7"), lambda: bars.aggregate(t.drop("bid"), 60)):
        with pytest.raises(ValueError):
            wrong()
    empty = bars.aggregate(t.limit(0), 60)
    assert empty.count() == 0 and empty.columns == ["instrument", "ts_us", "open", "high", "low", "close", "range_usd_oz", "n_ticks"]


def test_all_timeframes_from_ticks_in_one_scan(spark):
    t = ticks(spark, [(37 * i, 100 + (i * 7) % 11) for i in range(400)])
    every = bars.aggregate_all(t)
    for name, seconds in TIMEFRAMES.items():
        one = {tuple(r) for r in bars.aggregate(t, seconds).collect()}
        assert {tuple(r) for r in every.where(F.col("timeframe") == name).drop("timeframe").collect()} == one
    assert every._jdf.queryExecution().executedPlan().toString().count("Scan") <= 2


def test_month_edge(spark):
    t = ticks(spark, [(60 * i, i) for i in range(20)] + [(22 * 60, 99)], start=(1785542400 - 20 * 60) * S)  # 23:40 of July's last day
    july = bars.in_month(bars.aggregate(t, 300), 2026, 7).orderBy(F.desc("ts_us")).first()
    assert july.ts_us == (1785542400 - 300) * S
    assert bars.aggregate(ticks(spark, [(0, 3300), (60, 3301), (300, 3302)], spread=0.5), 300, "ask").first().open == 3300.5


def test_the_newest_label_comes_from_the_same_scan(spark, tmp_path):
    ticks(spark, [(60 * i, 3300 + i) for i in range(50)]).write.parquet(f"{tmp_path}/t")
    t = spark.read.parquet(f"{tmp_path}/t")
    for made in (bars.aggregate(t, 300), bars.aggregate_all(t), bars.both_sides(t, 300)):
        made.collect()
        assert "ReusedExchange" in made._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
