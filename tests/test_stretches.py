import random

import pytest
from pyspark.sql import functions as F

from fixtures import T0, ticks
from tickforge.functions.times import HOUR, MINUTE
from tickforge.operators import asof, sensor_spec
from tickforge.sources import sinks


def trades(spark, rows):
    return spark.createDataFrame([(k, i, T0 + round(m * MINUTE)) for k, i, m in rows], "instrument string, entry_id long, start_ts long")


def test_stretches_that_touch_are_one(spark):
    e = trades(spark, [("A", 1, 0), ("A", 2, 30), ("A", 3, 60.1), ("A", 4, 60.1), ("B", 5, 10), ("A", 6, 3000)])
    got = {r.entry_id: ((r.from_us - T0) / MINUTE, (r.to_us - T0) / MINUTE) for r in asof.stretches(e, 15).collect()}
    assert got == {1: (-15, 45), 2: (-15, 45), 3: (pytest.approx(45.1), pytest.approx(75.1)), 4: (pytest.approx(45.1), pytest.approx(75.1)), 5: (-5, 25), 6: (2985, 3015)}


def test_each_tick_is_written_once_and_every_trade_finds_its_ticks(spark, tmp_path):
    rng = random.Random(8)
    e = [("AB"[i % 2], i, rng.choice([0, 1440, 4000]) + rng.random() * 200) for i in range(40)]
    t = {k: [(s, 100 + s % 7) for s in sorted(rng.sample(range(-3600, 260_000), 900))] for k in "AB"}
    table = ticks(spark, t["A"], instrument="A").union(ticks(spark, t["B"], instrument="B"))
    sinks.write_windows(trades(spark, e), table, str(tmp_path / "w"))
    rows = spark.read.parquet(str(tmp_path / "w/ticks")).collect()
    assert len({(r.instrument, r.seq) for r in rows}) == len(rows)
    near = lambda k, s: any(x == k and abs(m * 60 - s) <= 900 for x, _, m in e)
    assert {(r.instrument, (r.ts_us - T0) // 1_000_000) for r in rows} == {(k, s) for k in "AB" for s, _ in t[k] if near(k, s)}
    held = {}
    for r in rows:
        held.setdefault((r.instrument, r.from_us), set()).add(r.ts_us)
    for r in spark.read.parquet(str(tmp_path / "w/trades")).collect():
        want = {T0 + s * 1_000_000 for s, _ in t[r.instrument] if abs(T0 + s * 1_000_000 - r.start_ts) <= 15 * MINUTE}
        assert want <= held.get((r.instrument, r.from_us), set())


def test_no_nested_loop_in_the_join(spark):
    e = trades(spark, [("A", 1, 0)])
    plan = asof.within(asof.stretches(e), ticks(spark, [(0, 1)]))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_distances_of_two_feeds(spark):
    rng = random.Random(2)
    px, pairs = 100.0, []
    for i in range(3000):
        px += rng.choice([-0.3, -0.1, 0.1, 0.3])
        pairs.append((60 * i, round(px, 2)))
    ours = ticks(spark, pairs, instrument="X")
    late = ours.withColumn("ts_us", F.col("ts_us") - 2 * HOUR)
    same = sensor_spec.cross_feed(ours, late.withColumn("bid", F.col("bid") * 2), 600).first()
    assert (same.offset_h, same.cv, same.passed) == (-2, pytest.approx(0, abs=1e-9), True) and same.minutes == 1440
    # A feed that loses most of its range in some hours does not carry over.
    calm = late.withColumn("bid", F.when(F.pmod(F.col("ts_us"), F.lit(24 * HOUR)) < 12 * HOUR, F.lit(100) + F.col("bid") / 1000).otherwise(F.col("bid")))
    assert not sensor_spec.cross_feed(ours, calm, 600).first().passed


def test_offsets_meet_in_chunks_of_an_hour(spark):
    t = ticks(spark, [(30 * i, 100 + i % 13) for i in range(300)])
    found = sensor_spec.feed_offset(t, t.withColumn("ts_us", F.col("ts_us") + 2 * HOUR))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "pmod(ts_us" in plan and "86400000000" not in plan
    assert (found.first().offset_h, found.first().n) == (2, 300)
