import random
import statistics

import pytest
from pyspark.sql import functions as F

from fixtures import ticks
from tickforge import jobs
from tickforge.functions.times import DAY, HOUR
from tickforge.layout import Layout
from tickforge.operators import asof, ranks, sensor_spec, study
from tickforge.schemas import InstrumentSpec
from tickforge.sources import binary, sinks

JULY = 20635 * DAY  # 2026-07-01
GOLD = InstrumentSpec("XAUUSD", 3, plausible_range=(1000.0, 10000.0))


@pytest.fixture(scope="module")
def values(spark):
    rng = random.Random(4)
    rows = [("a", float(rng.randrange(50)), i) for i in range(700)] + [("b", rng.gauss(0, 1), i) for i in range(301)] + [("a", 1e12, 900), ("b", None, 901), ("c", 2.5, 1), ("d", None, 1)]
    return spark.createDataFrame(rows, "k string, x double, i long")


def test_quantiles_equal_the_builtin_percentile(values):
    want = {r.k: (r.lo, r.hi) for r in values.where("x is not null").groupBy("k").agg(F.percentile("x", F.lit(0.05)).alias("lo"), F.percentile("x", F.lit(0.99)).alias("hi")).collect()}
    got = {r.k: (r.lo, r.hi) for r in ranks.quantiles(values, ["k"], "x", {"lo": 0.05, "hi": 0.99}).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_places_tiles_and_sums_below(values):
    rows = [r for r in values.collect() if r.x is not None]
    for r in ranks.counted(values, ["k"], "x").collect():
        mine = [v.x for v in rows if v.k == r.k]
        assert (r.n, r.n_below) == (mine.count(r.x), sum(x < r.x for x in mine))
    placed = ranks.numbered(values, ["k"], "x", "i", "place").collect()
    for k in "abcd":
        mine = sorted((r for r in placed if r.k == k), key=lambda r: r.place)
        assert [r.place for r in mine] == list(range(len(mine)))
        assert [(r.x is not None, r.x or 0, r.i) for r in mine] == sorted((r.x is not None, r.x or 0, r.i) for r in mine)
    n = values.sparkSession.range(13).select(ranks.tile(F.col("id"), F.lit(13), 5).alias("t")).collect()
    assert [r.t for r in n] == [1, 1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 5, 5]


def test_looking_forward_is_a_running_window(spark):
    t = ticks(spark, [(i, 100 + i) for i in range(10)])
    plan = asof.forward(t.select("instrument", "ts_us"), t, ["bid"])._jdf.queryExecution().executedPlan().toString()
    assert "unboundedfollowing" not in plan.lower() and "UnboundedFollowing" not in plan


def test_bootstrap_against_a_plain_one(spark):
    import hashlib

    rng = random.Random(2)
    rows = [(rng.gauss(0.3 if i % 2 else 0, 1), i % 2 == 0, 100 + i // 7) for i in range(60)]
    names = sorted({e for *_, e in rows})
    ps = []
    for r in range(50):
        drawn = [names[int(hashlib.md5(f"3|{r}|{place}".encode()).hexdigest()[:15], 16) % len(names)] for place in range(len(names))]
        sample = [(x, a) for e in drawn for x, a, own in rows if own == e]
        a, b = [x for x, is_a in sample if is_a], [x for x, is_a in sample if not is_a]
        ps.append(sum((x < y) + (x == y) / 2 for x in a for y in b) / (len(a) * len(b)))
    ps.sort()
    at = lambda q: ps[int(q * 49)] + (q * 49 % 1) * (ps[min(int(q * 49) + 1, 49)] - ps[int(q * 49)])
    got = study.bootstrap(spark.createDataFrame(rows, "x double, is_a boolean, episode long"), "x", "is_a", n=50, seed=3).first()
    assert (got.lo, got.hi, got.episodes) == (pytest.approx(at(0.025)), pytest.approx(at(0.975)), len(names))


def test_comparison_of_real_and_drawn(spark):
    real = spark.createDataFrame([(i % 4, float(i)) for i in range(12)] + [(1, None)], "episode long, h double")
    drawn = spark.createDataFrame([(i % 4, float(i) + 3) for i in range(24)] + [(2, None)] * 3, "episode long, h double")
    r, w = (study.compare(real, drawn, "h", how, n=30).first() for how in ("drop", "worst"))
    pairs = [(a, b) for a in range(12) for b in range(3, 27)]
    assert (r.p, r.n_real, r.n_drawn) == (pytest.approx(sum((a < b) + (a == b) / 2 for a, b in pairs) / len(pairs)), 12, 24) and r.lo <= r.p <= r.hi
    assert (w.n_real, w.n_drawn) == (13, 27) and w.p != r.p
    with pytest.raises(ValueError):
        study.compare(real, drawn, "h", "other")


def test_layout():
    at = Layout("s3://x/")
    assert at.logs("sensor", "t1", "ab12") == "s3://x/logs/sensor/t1/ab12" and at.logs("loader", "t1") == "s3://x/logs/loader/t1/no-account"
    with pytest.raises(ValueError):
        at.logs("", "t1")


def put(root, name, payload):
    file = root / name
    file.parent.mkdir(parents=True, exist_ok=True)
    file.write_bytes(payload)


def test_stages_of_a_month(spark, tmp_path):
    layout = Layout(str(tmp_path))
    job = jobs.Job(spark, layout, GOLD)
    day = tmp_path / "raw" / "feed" / "XAUUSD" / "2026" / "07" / "01"
    t = ticks(spark, [(30 * i, 3300 + i % 7) for i in range(500)], instrument="XAUUSD", start=JULY)
    for r in binary.pack_ticks(t, GOLD).collect():
        put(day, f"{(r.at_us - JULY) // HOUR:02d}h_ticks.bi5", r.content)
    put(day, "06h_ticks.bi5", b"")
    put(day, "07h_ticks.bi5.absent", b"")
    (row,) = jobs.run(job, "completeness", "2026-07", "2026-07")
    assert row[3:5] == ("incompleto", 744 - 5 - 2) and row[5] == "presente 5 vazio 1 ausente 1"
    assert [r[3] for r in jobs.run(job, "aggregate", "2026-07", "2026-07")] == ["sem_ticks"]
    done = jobs.run(job, "parse", "2026-06", "2026-07", recent_first=True)
    assert [(r[2], r[3], r[4]) for r in done] == [("2026-07", "parseado", 500), ("2026-06", "sem_ticks", 0)] and jobs.exit_code(done) == 0
    assert jobs.run(job, "parse", "2026-07", "2026-07")[0][3] == "ja_existe"
    assert [r[3] for r in jobs.run(job, "validate", "2026-07", "2026-07")] == ["sem_referencia"]
    m1 = jobs.run(job, "aggregate", "2026-07", "2026-07")[0]
    assert m1[3] == "agregado" and m1[4] > 249
    assert jobs.run(job, "aggregate", "2026-07", "2026-07")[0][3] == "ja_existe"
    ours = spark.read.parquet(layout.bars).where("timeframe = 'M1'").select("instrument", "ts_us", "open", "high", "low", "close", "n_ticks")
    (candles,) = binary.pack_candles(ours, GOLD).collect()
    put(tmp_path / "reference" / "feed" / "XAUUSD" / "2026" / "07" / "01", "BID_candles_min_1.bi5", candles.content)
    checked = jobs.run(job, "validate", "2026-07", "2026-07")[0]
    assert checked[3] == "comparado" and checked[4] == ours.count() and checked[5].endswith(" 0.0")
    # A month that fails is an outcome; the one after it is still done.
    put(tmp_path / "raw" / "feed" / "XAUUSD" / "2026" / "05" / "01", "00h_ticks.bi5", b"none of ours")
    rows = jobs.run(job, "parse", "2026-05", "2026-06")
    assert [r[3] for r in rows] == ["erro", "sem_ticks"] and jobs.exit_code(rows) == 1
    assert {(r.state, r.months) for r in jobs.progress(jobs.outcomes(spark, rows)).collect()} == {("erro", 1), ("sem_ticks", 1)}
    with pytest.raises(ValueError):
        jobs.run(job, "download", "2026-05", "2026-06")


def test_logs_of_two_accounts_lie_apart(spark, tmp_path):
    rows = spark.createDataFrame([tuple(sinks.envelope("r", "s", "c", "info", account_hash=a).values()) for a in ("aa", "bb", None)], ", ".join(f"{c} string" for c in sinks.LOG.fieldNames()))
    sinks.write_log(rows, f"{tmp_path}/log")
    assert {p.name for p in (tmp_path / "log" / "comp=c").iterdir() if p.is_dir()} == {"account=aa", "account=bb", "account=no-account"}


def test_weights_stand_for_rows(spark):
    from tickforge.operators import sensor_spec

    rows = [("k", float(i % 7), i, float(i * i % 11), 1 + i % 4) for i in range(23)]
    few = spark.createDataFrame(rows, "k string, x double, i long, y double, w long")
    many = few.withColumn("again", F.explode(F.sequence(F.lit(1).cast("long"), F.col("w"))))
    key = lambda r: (r.quintile, pytest.approx(r.mean), r.n)
    want = sorted(sensor_spec.quintiles(many, "x", "y", "k", "i").collect())
    assert [key(r) for r in sorted(sensor_spec.quintiles(few, "x", "y", "k", "i", "w").collect())] == [key(r) for r in want]
    a, b = sensor_spec.spearman(few, "x", "y", "k", "w").first(), sensor_spec.spearman(many, "x", "y", "k").first()
    assert (a.rho, a.n) == (pytest.approx(b.rho), b.n)


def test_cuts_of_ranks_are_read_from_a_table(spark):
    """Approximate quantiles differ with the order of their parts: computed twice, they cut buckets and sums differently."""
    rows = spark.createDataFrame([("k", float(i % 7)) for i in range(50)], "key string, v double")
    for out in (ranks.counted(rows, ["key"], "v"), ranks.numbered(rows.withColumn("o", F.col("v")), ["key"], "v", "o", "place")):
        assert "approx" not in out._jdf.queryExecution().optimizedPlan().toString().lower()


def test_average_ranks_of_weighted_pairs(spark):
    rows = spark.createDataFrame([("k", 1.0, 2.0, 3), ("k", 1.0, 5.0, 1), ("k", 4.0, 5.0, 2), ("k", 6.0, 1.0, 1)], "key string, a double, b double, pairs long")
    found = sensor_spec.spearman_counted(rows, "a", "b", "key")
    long = [(r.a, r.b) for r in rows.collect() for _ in range(r.pairs)]
    rank = lambda xs: [sum(y < x for y in xs) + (xs.count(x) + 1) / 2 for x in xs]
    a, b = rank([x for x, _ in long]), rank([y for _, y in long])
    assert (found.first().rho, found.first().n) == (pytest.approx(statistics.correlation(a, b)), 7)
