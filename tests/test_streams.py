import time

import pytest
from pyspark.sql import functions as F

from fixtures import T0, ticks
from tickforge.functions.sessions import Sessions
from tickforge.functions.times import DAY, HOUR, MINUTE
from tickforge.operators import bars, study, windows
from tickforge.session import configure
from tickforge.streaming import sessions, stateful

OPEN = Sessions(break_from=0, break_to=0, weekend=False)


class Feed:
    """A folder that a stream reads a file a trigger from; files are added one by one."""

    def __init__(self, spark, root, build, schema, trigger=None):
        configure(spark)
        self.spark, self.root, self.build, self.schema, self.n, self.trigger = spark, root, build, schema, 0, trigger
        (root / "in").mkdir()

    def start(self, like):
        stream = self.build(self.spark.readStream.schema(like.schema).option("maxFilesPerTrigger", 1).parquet(str(self.root / "in")))
        w = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{self.root}/state")
        self.query = (w.trigger(processingTime=self.trigger) if self.trigger else w).start(f"{self.root}/out")
        return self

    def put(self, rows):
        rows.coalesce(1).write.parquet(f"{self.root}/part{self.n}")
        for p in (self.root / f"part{self.n}").glob("*.parquet"):
            p.rename(self.root / "in" / f"{self.n:03d}.parquet")
        self.n += 1
        if not self.trigger:  # a clock of its own runs trigger after trigger, and is never done
            self.query.processAllAvailable()

    def rows(self):
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/out").collect()


@pytest.fixture
def feed(spark, tmp_path):
    made = []

    def make(build, schema, trigger=None):
        made.append(Feed(spark, tmp_path, build, schema, trigger))
        return made[-1]

    yield make
    for f in made:
        f.query.stop()


def at(r):
    return (r.instrument, (r.at_us - T0) // 1_000_000, (r.last_us - T0) // 1_000_000, r.feed)


def test_a_silent_feed_is_reported_without_a_tick_of_its_own(spark, feed):
    a = ticks(spark, [(10 * i, 1) for i in range(31)], instrument="A")
    b = ticks(spark, [(0, 1), (20, 1)], instrument="B")
    f = feed(lambda t: sessions.silence(t, 60, OPEN), sessions.SILENCE_SCHEMA).start(a)
    f.put(a.where("seq < 5").union(b))
    assert f.rows() == []
    f.put(a.where("seq between 5 and 20"))
    f.put(a.where("seq > 20"))
    assert [at(r) for r in f.rows()] == [("B", 80, 20, "dead")]  # once, and from A's clock alone
    f.put(ticks(spark, [(310, 1), (400, 1)], instrument="B"))
    assert sorted(at(r) for r in f.rows()) == [("A", 360, 300, "dead"), ("B", 80, 20, "dead"), ("B", 310, 20, "live"), ("B", 370, 310, "dead"), ("B", 400, 310, "live")]


def test_a_closed_market_is_quiet_and_then_dead(spark, feed):
    # T0 is a Wednesday at 14:00; the break is from 20:58 to 22:00.
    h = lambda x: round(x * 3600)
    a = ticks(spark, [(h(k / 4), 1) for k in range(60)], instrument="A")
    b = ticks(spark, [(0, 1), (h(6.9), 1)], instrument="B")  # last tick at 20:54
    f = feed(lambda t: sessions.silence(t, 3600), sessions.SILENCE_SCHEMA).start(a)
    f.put(a.where(F.col("ts_us") < T0 + 7 * HOUR).union(b))
    f.put(a.where(F.col("ts_us").between(T0 + 7 * HOUR, T0 + 10 * HOUR)))
    f.put(a.where(F.col("ts_us") > T0 + 10 * HOUR))
    got = sorted(at(r) for r in f.rows() if r.instrument == "B" and r.last_us > T0)
    assert got == [("B", h(7.9), h(6.9), "quiet"), ("B", h(9), h(6.9), "dead")]


def test_the_calendar():
    s = Sessions()
    monday = 19723 * DAY  # 2024-01-01
    assert s.reopens(monday + 12 * HOUR) is None
    assert s.reopens(monday + 21 * HOUR) == monday + 22 * HOUR
    assert s.reopens(monday + 22 * HOUR) is None
    sunday = monday + 6 * DAY + 22 * HOUR + MINUTE
    for t in (4 * DAY + 21 * HOUR, 5 * DAY, 6 * DAY + 22 * HOUR):
        assert s.reopens(monday + t) == sunday
    assert s.reopens(sunday) is None and s.reopens(monday + 4 * DAY + 20 * HOUR) is None
    assert Sessions(offset_h=3).reopens(monday + 18 * HOUR) == monday + 19 * HOUR


def test_the_wall_clock_misses_a_feed_when_all_are_silent(spark, feed):
    a = ticks(spark, [(0, 1), (1, 2)], instrument="A")
    f = feed(lambda t: sessions.silence(t, 3, OPEN, clock="processing"), sessions.SILENCE_SCHEMA, "1 second").start(a)
    f.put(a)

    def wait(n):
        until = time.time() + 60
        while time.time() < until and len(f.rows()) < n:
            time.sleep(1)
        return [r.feed for r in sorted(f.rows(), key=lambda r: r.at_us)]

    assert wait(1) == ["dead"]
    (r,) = f.rows()
    assert r.instrument == "A" and r.at_us - r.last_us == 3_000_000
    f.put(ticks(spark, [(2, 1)], instrument="A"))
    assert wait(2)[:2] == ["dead", "live"]


def entries(spark, rows):
    return spark.createDataFrame([(k, i, T0 + round(m * MINUTE), side) for k, i, m, side in rows], "instrument string, entry_id long, ts_us long, side string")


def test_episodes_end_by_side_by_gap_and_without_a_next_entry(spark, feed):
    e = lambda *rows: entries(spark, rows)
    first = e(("A", 1, 0, "buy"), ("A", 2, 5, "buy"), ("B", 3, 1, "sell"))
    f = feed(lambda x: sessions.episodes(x, 60, delay="1 hour"), sessions.EPISODE_SCHEMA).start(first)
    f.put(first)
    f.put(e(("A", 4, 10, "sell"), ("A", 5, 3, "buy"), ("A", 6, 80, "sell")))  # a turn, a late one, a gap
    f.put(e(("A", 7, 200, "sell")))
    f.put(e(("A", 8, 230, "sell")))
    got = sorted(((r.instrument, r.episode, r.side, (r.first_us - T0) // MINUTE, (r.last_us - T0) // MINUTE, r.n, r.closed_by, r.entry_id, r.late) for r in f.rows()), key=str)
    assert got == sorted([
        ("A", 1, "buy", 0, 5, 2, "side", None, False), ("A", 2, "sell", 10, 10, 1, "gap", None, False), ("A", 3, "sell", 80, 80, 1, "gap", None, False),
        ("A", None, "buy", 3, 3, 1, None, 5, True), ("B", 1, "sell", 1, 1, 1, "gap", None, False),
    ], key=str)


def test_stream_episodes_are_those_of_the_batch(spark, feed):
    rows = [("AB"[i % 2], i, i * 7 + (400 if i > 40 else 0) + (i * i) % 5, "buy" if (i // 6) % 2 else "sell") for i in range(90)]
    e = entries(spark, rows)
    f = feed(lambda x: sessions.episodes(x, 30), sessions.EPISODE_SCHEMA).start(e)
    for lo in range(0, 90, 30):
        f.put(e.where(F.col("entry_id").between(lo, lo + 29)))
    batch = study.episodes(e, 30, ["instrument"]).groupBy("instrument", "episode").agg(F.min("ts_us").alias("a"), F.max("ts_us").alias("b"), F.count("*").alias("n"), F.first("side").alias("s")).collect()
    last = {k: max(r.episode for r in batch if r.instrument == k) for k in "AB"}
    want = {(r.instrument, r.episode, r.s, r.a, r.b, r.n) for r in batch if r.episode < last[r.instrument]}
    assert {(r.instrument, r.episode, r.side, r.first_us, r.last_us, r.n) for r in f.rows()} == want


def test_the_sensor_goes_on_from_its_store_after_a_restart(spark, feed):
    t = ticks(spark, [(3 * i + i % 2, 100 + (i * 7) % 13) for i in range(160)])
    f = feed(lambda x: stateful.sensor(x, 20), stateful.SENSOR_SCHEMA).start(t)
    f.put(t.where("seq < 50"))
    f.put(t.where("seq between 50 and 99"))
    f.query.stop()
    f.start(t)
    f.put(t.where("seq >= 100"))
    late = spark.createDataFrame([("X", T0, 900, 1.0, 1.0)], t.schema)
    f.put(late)
    out = sorted((r for r in f.rows() if not r.late), key=lambda r: r.seq)
    want = windows.components(t, 20).orderBy("seq").collect()
    for r, w in zip(out, want, strict=True):
        assert (r.tr, r.rg, r.dsp, r.er, r.caminho) == pytest.approx((w.tr, w.rg, w.dsp, w.er, w.caminho))
    assert [r.seq for r in f.rows() if r.late] == [900]


def test_bars_of_many_triggers_equal_those_of_the_batch(spark, feed):
    pairs = [(i * 37 % 900 + 900 * (i // 40), 100 + i % 17) for i in range(200)]
    pairs = sorted(pairs)
    t = ticks(spark, pairs)
    f = feed(lambda x: stateful.bars(x, 300), stateful.BAR_SCHEMA).start(t)
    for lo in range(0, 200, 23):
        f.put(t.where(F.col("seq").between(lo, lo + 22)))
    keep = lambda r: (r.ts_us, r.open, r.high, r.low, r.close, r.range_usd_oz, r.n_ticks)
    assert sorted(keep(r) for r in f.rows() if not r.late) == sorted(keep(r) for r in bars.aggregate(t, 300).collect())


def test_a_trigger_has_no_more_tasks_than_keys_need(spark, monkeypatch):
    from tickforge.plans import stream_queries

    monkeypatch.setattr(stream_queries, "FILE_ROWS", 40)
    before, tasks = spark.conf.get(stream_queries.PARTITIONS), []
    t = ticks(spark, [(20 * i, 100 + i % 9) for i in range(160)])

    def build(rows):
        tasks.append(int(spark.conf.get(stream_queries.PARTITIONS)))
        return stateful.bars(rows, 300)

    spark.conf.set(stream_queries.PARTITIONS, "50")
    try:
        out = stream_queries.streamed(t, "seq", build, stateful.BAR_SCHEMA)
        assert tasks == [2] and spark.conf.get(stream_queries.PARTITIONS) == "50"
    finally:
        spark.conf.set(stream_queries.PARTITIONS, before)
    assert sorted(r.ts_us for r in out.collect()) == sorted(r.ts_us for r in bars.aggregate(t, 300).collect())
    assert stream_queries.FILE_ROWS == 40  # four triggers, and no bar is lost between them


def test_a_trigger_by_time_with_peers_is_the_batch(spark, feed):
    t = ticks(spark, [(3 * (i // 2), 100 + (i * 7) % 13) for i in range(80)]).withColumn("seq", F.pmod(F.col("seq") * 37, F.lit(80)))
    f = feed(lambda x: stateful.sensor(x, 20, by_time=True, peers=True), stateful.SENSOR_SCHEMA).start(t)
    f.put(t.where(F.col("ts_us") < T0 + 60_000_000))
    f.put(t.where(F.col("ts_us") >= T0 + 60_000_000))
    want = windows.components(t, 20, peers=True).orderBy("ts_us", "seq").collect()
    out = sorted(f.rows(), key=lambda r: (r.ts_us, r.seq))
    assert not any(r.late for r in out)
    for r, w in zip(out, want, strict=True):
        assert (r.tr, r.rg, r.dsp, r.er, r.caminho) == pytest.approx((w.tr, w.rg, w.dsp, w.er, w.caminho))
