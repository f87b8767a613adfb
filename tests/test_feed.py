import lzma
import struct

import pytest
from pyspark.sql import functions as F

from fixtures import T0
from tickforge.functions.times import DAY, HOUR
from tickforge.schemas import InstrumentSpec
from tickforge.sources import binary, feed

SPEC = InstrumentSpec("A", 2)


def payload(n, bid=10000):
    return lzma.compress(b"".join(struct.pack(">IIIff", 1000 * i, bid + i + 30, bid + i, 1.0, 2.0) for i in range(n)), lzma.FORMAT_ALONE)


def put(root, instrument, hour_us, content, marker=False):
    path = feed.hour_path(str(root), instrument, hour_us) + (feed.MARKER if marker else "")
    (root / path).parent.mkdir(parents=True, exist_ok=True)
    (root / path).write_bytes(content)


@pytest.fixture
def source(spark, tmp_path):
    feed.register(spark)
    return lambda first=T0 - DAY, end=T0 + 20 * DAY, **more: spark.read.format("tickfeed").options(path=str(tmp_path), instruments="A,B", first_us=first, last_us=end, price_decimals=2, **more).load()


def test_one_hour_opens_one_file(spark, source, tmp_path):
    put(tmp_path, "A", T0, payload(3))
    for name, hour in (("A", T0 - HOUR), ("A", T0 + HOUR), ("A", T0 + 9 * DAY), ("B", T0)):
        put(tmp_path, name, hour, b"no stream at all")
    one = feed.ticks_between(spark, str(tmp_path), ["A"], T0, T0 + HOUR, 2)
    assert one.rdd.getNumPartitions() == 1
    assert [(r.instrument, r.ts_us, r.bid, r.ask, r.bid_vol) for r in one.collect()] == [("A", T0 + 1_000_000 * i, (10000 + i) / 100, (10030 + i) / 100, 2.0) for i in range(3)]
    assert [r.seq % 10_000_000 for r in one.where(f"ts_us = {T0 + 1_000_000}").collect()] == [1]
    with pytest.raises(Exception, match="no LZMA stream"):
        source().collect()
    assert feed.ticks_between(spark, str(tmp_path), ["C"], T0, T0 + HOUR).count() == 0


def test_times_inside_an_hour_are_still_filtered(spark, tmp_path):
    put(tmp_path, "A", T0, payload(3600))
    got = feed.ticks_between(spark, str(tmp_path), ["A"], T0 + 10_500_000, T0 + 12_500_000, 2).collect()
    assert [(r.ts_us - T0) // 1_000_000 for r in got] == [11, 12]


def test_a_filter_of_one_plan_is_none_of_the_next(source, tmp_path):
    for i in range(3):
        put(tmp_path, "A", T0 + i * HOUR, payload(2))
    rows = source()
    assert [rows.count(), rows.where(F.col("ts_us") < T0 + HOUR).count(), rows.count()] == [6, 2, 6]


def test_what_became_of_each_hour(source, tmp_path):
    put(tmp_path, "A", T0, payload(3))
    put(tmp_path, "A", T0 + HOUR, b"")
    put(tmp_path, "A", T0 + 2 * HOUR, b"", marker=True)
    put(tmp_path, "B", T0, payload(5))
    hours = source(T0, T0 + 4 * HOUR, rows="hours")
    assert {(r.instrument, (r.hour_us - T0) // HOUR): (r.state, r.ticks) for r in hours.collect() if r.instrument == "A"} == {("A", 0): ("lido", 3), ("A", 1): ("vazio", 0), ("A", 2): ("ausente", 0), ("A", 3): ("falta", 0)}
    assert sorted(map(tuple, feed.counts(hours).collect())) == [("A", 2, 1, 1, 3), ("B", 1, 0, 0, 5)]


def test_landed_files_are_read_as_they_were_packed(spark, source, tmp_path):
    t = spark.createDataFrame([("A", T0 + 1000 * i * 977, i, 100 + i % 9 / 100, 100.3 + i % 9 / 100) for i in range(9000)], "instrument string, ts_us long, seq long, bid double, ask double")
    packed = binary.pack_ticks(t, SPEC)
    assert {r.instrument: r["count"] for r in feed.land(packed, str(tmp_path)).collect()} == {"A": 3}
    keep = ["instrument", "ts_us", "seq", "bid", "ask"]
    assert sorted(map(tuple, source().select(*keep).collect())) == sorted(map(tuple, binary.decode_tick_files(packed, SPEC).select(*keep).collect()))


def test_a_stream_reads_the_hours_that_have_landed_since(spark, tmp_path):
    feed.register(spark)
    root = tmp_path / "raw"
    put(root, "A", T0, payload(2))
    put(root, "B", T0 + HOUR, payload(4))

    def run():
        stream = spark.readStream.format("tickfeed").options(path=str(root), instruments="A,B", first_us=T0, last_us=T0 + 30 * DAY, price_decimals=2).load()
        q = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).start(str(tmp_path / "out"))
        q.processAllAvailable()
        q.stop()
        return sorted((r.instrument, (r.ts_us - T0) // HOUR) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    first = [("A", 0)] * 2
    assert run() == first  # of A nothing later has landed
    put(root, "A", T0 + 5 * HOUR, payload(3))
    put(root, "A", T0 + 6 * HOUR, b"", marker=True)
    assert run() == sorted(first + [("B", 1)] * 4)
    put(root, "B", T0 + 6 * HOUR, b"", marker=True)
    assert run() == sorted(first + [("B", 1)] * 4 + [("A", 5)] * 3)
    assert run() == sorted(first + [("B", 1)] * 4 + [("A", 5)] * 3)  # nothing twice
