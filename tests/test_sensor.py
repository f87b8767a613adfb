import random

import duckdb
import pytest
from pyspark.sql import functions as F

from fixtures import T0, ticks
from tickforge.functions.times import pretty_duration
from tickforge.operators import sensor_spec, variants, windows
from tickforge.plans import sensor_queries
from tickforge.plans.queries import SQL


def walk(n, seed=3, most=40):
    rng, at, px, out = random.Random(seed), 0.0, 100.0, []
    for _ in range(n):
        at += rng.choice([0, 0.5, 3, most])
        px = round(px + rng.choice([-0.2, 0, 0.1, 0.3]), 2)
        out.append((at, px))
    return out


def test_realised_amplitude_looks_from_each_tick_to_the_horizon(spark):
    pairs = walk(400)
    t = ticks(spark, pairs)
    # Chunks of a minute, a horizon of five: each chunk needs rows of several later ones.
    got = {r.seq: r.amplitude for r in windows.realised(t, 300, chunk_us=60_000_000).collect()}
    end = pairs[-1][0]
    for i, (s, _) in enumerate(pairs):
        seen = [p for j, (at, p) in enumerate(pairs) if (at > s or (at == s and j >= i)) and at <= s + 300]
        assert got[i] == (pytest.approx(max(seen) - min(seen)) if s + 300 <= end else None)


def test_realised_amplitude_moves_no_feature(spark):
    t = ticks(spark, walk(300))
    cut = T0 + 4_000_000_000
    whole = windows.components_many(t, (10, 60)).where(F.col("ts_us") <= cut)
    early = windows.components_many(t.where(F.col("ts_us") <= cut), (10, 60))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, early.collect()))


def test_several_windows_in_one_pass_equal_each_alone(spark):
    t = ticks(spark, walk(500))
    many = {r.seq: r for r in windows.components_many(t, (10, 20, 60), chunk_us=120_000_000).collect()}
    for w in (10, 20, 60):
        for r in windows.components(t, w).collect():
            m = many[r.seq]
            assert (m[f"tr_{w}"], m[f"rg_{w}"], m[f"er_{w}"]) == (r.tr, pytest.approx(r.rg), pytest.approx(r.er, abs=1e-9))


def test_fifths_that_do_not_increase_are_told(spark):
    rows = [("up", i, float(i)) for i in range(1, 6)] + [("flat", i, 1.0) for i in range(1, 6)] + [("few", i, float(i)) for i in range(1, 5)]
    out = sensor_spec.monotone(spark.createDataFrame(rows, "k string, quintile int, mean double"), "k")
    assert {r.k: r.increasing for r in out.collect()} == {"up": True, "flat": False, "few": False}


def test_the_registered_grid():
    a = variants.stage_a()
    assert len(a) == 20 and len(variants.stage_b(a[0])) == 3 and len(variants.stage_c(a[0])) == 9
    near = variants.neighbours(a)
    assert [a[j].window_s for j in near[a.index(variants.Variant(20, "rg"))]] == [10, 30] and all(a[j].micro == a[i].micro for i, js in enumerate(near) for j in js)
    c = variants.stage_c(a[0])
    assert len(variants.neighbours(c)[4]) == 4 and len(variants.neighbours(c)[0]) == 2 and not any(variants.neighbours(variants.stage_b(a[0])))


def test_the_plateau_wins_over_the_peak():
    a = variants.stage_a()
    scores = [0.0] * 20
    for i, v in enumerate(a):
        if v.micro == "rg":
            scores[i] = 0.4  # all windows alike
        if v == variants.Variant(20, "tr"):
            scores[i] = 0.6  # alone
    plateau, best = variants.pick(a, scores)
    assert a[best].micro == "rg" and plateau[a.index(variants.Variant(20, "tr"))] == pytest.approx(0.2)
    assert variants.pick(a, [None] * 20)[1] == 0


def test_each_stage_starts_from_the_winner_before(spark):
    rows = sensor_queries.variant_grid(spark, "/root/testdata/sf0.001").collect()
    by = {s: [r for r in rows if r.stage == s] for s in ("A", "B", "C", "confirmacao", "holdout")}
    assert [len(by[s]) for s in by] == [20, 3, 9, 1, 1]
    assert all(sum(r.won for r in v) == 1 for v in by.values())
    won = {s: next(r for r in by[s] if r.won) for s in by}
    assert {(r.window_s, r.micro) for s in ("B", "C", "holdout") for r in by[s]} == {(won["A"].window_s, won["A"].micro)}
    assert {r.norm for r in by["C"]} == {won["B"].norm}
    assert (won["holdout"].alpha, won["holdout"].macro) == (won["C"].alpha, won["C"].macro)


def test_the_sweep_counts_ticks_of_one_time_as_its_sql(spark, tmp_path):
    """A join by the time lets each of p ticks meet all p in four windows and the amplitude: p ** 6 readings of that time."""
    path = tmp_path / "events.parquet"
    at = "first_value(ts) OVER (PARTITION BY CASE WHEN event_id % 9 < 3 THEN event_id // 9 ELSE -event_id END ORDER BY event_id)"
    c = duckdb.connect()
    c.execute(f"COPY (SELECT * REPLACE ({at} AS ts) FROM '/root/testdata/sf0.001/events.parquet' ORDER BY event_id) TO '{path}' (FORMAT parquet)")
    c.execute(f"CREATE VIEW events AS SELECT * FROM '{path}'")
    got = sensor_queries.variant_grid(spark, str(tmp_path))
    want = c.execute(f"SELECT {', '.join(got.columns)} FROM ({SQL['variant_grid']})").fetchall()
    key = lambda r: (r[0], r[1])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key) and max(r[9] for r in want) > 1000


@pytest.mark.parametrize(("seconds", "text"), [(0, "0s"), (45, "45s"), (75, "75s"), (-5, "0s"), (1560, "26min"), (5000, "83min"), (7800, "2h10"), (108000, "30h00"), (70176, "19h30"), (273600, "3d04h"), (None, None)])
def test_durations(spark, seconds, text):
    assert spark.range(1).select(pretty_duration(F.lit(seconds).cast("double")).alias("x")).first().x == text
