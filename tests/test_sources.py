import json
import lzma
import struct

import pytest
from pyspark.sql import functions as F

from fixtures import T0, ticks
from tickforge.functions.times import HOUR, iso_millis, parse_server_time, pretty_duration
from tickforge.functions.values import filling_names, plain_text, same_number, short_hash, swap_usd_oz, weekday_number
from tickforge.operators import bars
from tickforge.schemas import InstrumentSpec
from tickforge.sources import binary, sinks, tables

GOLD = InstrumentSpec("XAUUSD", 3)


def packed(layout, rows, kind=lzma.FORMAT_ALONE):
    return lzma.compress(b"".join(struct.pack(layout, *r) for r in rows), format=kind)


def put(tmp_path, name, payload):
    file = tmp_path / "raw" / "XAUUSD" / "2026" / "07" / "15" / name
    file.parent.mkdir(parents=True, exist_ok=True)
    file.write_bytes(payload)
    return str(tmp_path / "raw")


def test_tick_files(spark, tmp_path):
    rows = [(1500, 3300300, 3300000, 1.5, 2.5), (100, 3301300, 3301000, 1.0, 1.0), (3599999, 3302300, 3302000, 1.0, 1.0), (100, 3305300, 3305000, 1.0, 1.0)]
    root = put(tmp_path, "13h_ticks.bi5", packed(">IIIff", rows))
    put(tmp_path, "14h_ticks.bi5", b"")
    put(tmp_path, "15h_ticks.bi5", packed(">IIIff", rows[:1], lzma.FORMAT_XZ))
    put(tmp_path, "16h_ticks.bi5.absent", b"")
    out = binary.read_ticks(spark, root, GOLD).orderBy("ts_us", "seq").collect()
    assert [(r.ts_us - (T0 - HOUR), r.bid) for r in out[:4]] == [(100000, 3301.0), (100000, 3305.0), (1500000, 3300.0), (3599999000, 3302.0)]
    assert (out[2].ask, out[2].bid_vol, out[2].ask_vol) == (3300.3, 2.5, 1.5) and len(out) == 5
    listed = {(r.hour_us - T0) // HOUR: (r.size > 0, r.has_file, r.has_absent_marker) for r in binary.list_hours(spark, root, "XAUUSD", 2026, 7).collect()}
    assert listed == {-1: (True, True, False), 0: (False, True, False), 1: (True, True, False), 2: (False, False, True)}


def test_refused_files():
    crossed = packed(">IIIff", [(i, 3300000, 3300300, 1, 1) for i in range(10)])
    for payload, match in ((crossed, "crossed"), (lzma.compress(b"12345"), "whole number"), (b"no lzma at all", "LZMA")):
        with pytest.raises(ValueError, match=match):
            binary.decode_ticks(payload, 0, "X", GOLD)
    assert binary.decode_ticks(b"", 0, "X", GOLD).empty
    good = packed(">5if", [(60, 3300000, 3300200, 3299600, 3300800, 1.0), (0, 3300000, 3300200, 3299600, 3300800, 1.0)])
    c = binary.decode_candles(good, T0, "X", GOLD)
    assert c["ts_us"].tolist() == [T0, T0 + 60_000_000] and c.iloc[0][["open", "high", "low", "close"]].tolist() == [3300.0, 3300.8, 3299.6, 3300.2]
    with pytest.raises(ValueError, match="incoherent"):
        binary.decode_candles(packed(">5if", [(0, 3300000, 3300800, 3299600, 3300200, 1.0)]), 0, "X", GOLD)


def test_partitioned_round_trip(spark, tmp_path):
    t = ticks(spark, [(60 * i, 3300 + i) for i in range(3000)], instrument="A").union(ticks(spark, [(60 * i, 1) for i in range(5)], instrument="B"))
    assert sinks.ingest(t, f"{tmp_path}/ticks") == 3005
    back = tables.read_partitioned(spark, f"{tmp_path}/ticks", "ticks", "A", "2026-07", "2026-07")
    assert back.count() == 3000 and back.agg(F.sum("bid")).first()[0] == sum(3300 + i for i in range(3000))
    assert "PartitionFilters: [isnotnull(" in back._jdf.queryExecution().executedPlan().toString()
    b = bars.aggregate_all(t)
    sinks.write_bars(b, f"{tmp_path}/bars")
    sinks.write_bars(b.where("instrument = 'A'"), f"{tmp_path}/bars")
    assert tables.read_partitioned(spark, f"{tmp_path}/bars", "bars").count() == b.count()


def test_entries_and_deals(spark, tmp_path):
    file = tmp_path / "e.csv"
    file.write_text("ts_utc,side,more\n2026-07-15T14:00:00Z, BUY ,1\n2026-07-15T14:00:01Z,sell,2\n")
    assert sorted((r.ts_us - T0, r.side) for r in tables.read_entries(spark, str(file)).collect()) == [(0, "buy"), (1_000_000, "sell")]
    file.write_text("ts_utc,side\n2026-07-15T14:00:00Z,hold\n")
    with pytest.raises(Exception, match="no entry"):
        tables.read_entries(spark, str(file)).collect()
    file.write_text("ts_utc,x\n1,2\n")
    with pytest.raises(ValueError, match="side"):
        tables.read_entries(spark, str(file))
    html = "<table><tr><th>h</th></tr><tr><td>2026.07.15 17:00:00</td><td>1</td><td>XAUUSD</td><td>buy</td><td class='hidden'></td><td>0.10</td><td>3 300.50</td></tr><tr><td>2026.07.15 17:00:00</td><td>1</td><td>XAUUSD</td><td>in</td><td>buy</td></tr></table>"
    rows = tables.html_rows(spark.createDataFrame([(1, html)], "page_id long, html string"))
    deals = tables.positions(rows, 3.0, "XAUUSD").collect()
    assert [(d.ts_us, d.side, d.volume, d.preco_abertura) for d in deals] == [(T0, "buy", 0.1, 3300.5)]
    sinks.write_deals(tables.positions(rows, 3.0), f"{tmp_path}/deals")
    assert tables.read_deals(spark, f"{tmp_path}/deals").first().ts_utc == "2026-07-15T14:00:00.000Z"


def test_specs_and_text(spark, tmp_path):
    folder = tmp_path / "t" / "acc" / "symbol-specs"
    folder.mkdir(parents=True)
    (folder / "X-latest.json").write_text(json.dumps({"schema": "symbol-specs/1", "symbol": "X", "specs": {"digits": 3}}))
    path = tables.newest_specs(spark, str(tmp_path))
    assert tables.read_specs(spark, path).first().specs.digits == 3
    (folder / "X-latest.json").write_text(json.dumps({"schema": "symbol-specs/99"}))
    with pytest.raises(Exception, match="unknown specs schema"):
        tables.read_specs(spark, path).collect()
    other = tmp_path / "u" / "acc" / "symbol-specs"
    other.mkdir(parents=True)
    (other / "X-latest.json").write_text("{}")
    with pytest.raises(ValueError, match="terminals"):
        tables.newest_specs(spark, str(tmp_path))
    for i, raw in enumerate(["é".encode("utf-16"), b"\xef\xbb\xbf" + "é".encode(), "é".encode(), "é".encode("cp1252")]):
        (tmp_path / f"f{i}.htm").write_bytes(raw)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.htm").load(str(tmp_path))
    assert [r.text for r in tables.decode_text(files).collect()] == ["é"] * 4


def test_log_and_report(spark, tmp_path):
    row = sinks.envelope("r1", "src", "parse", "info", config="c")
    assert len(row) == 11 and row["ts_srv"] is None and len(row["config_hash"]) == 8
    with pytest.raises(ValueError):
        sinks.envelope("r1", "s", "c", "debug")
    log = spark.createDataFrame([row], ", ".join(f"{k} string" for k in row))
    sinks.write_log(log, f"{tmp_path}/log")
    line = spark.read.text(f"{tmp_path}/log").first().value
    assert '"ts_srv":null' in line
    with pytest.raises(Exception, match="without a code"):
        sinks.write_log(log.withColumn("lvl", F.lit("error")).withColumn("error_code", F.lit(None).cast("string")), f"{tmp_path}/log2")
    sinks.write_report(row, spark.range(1).select(F.lit(5).alias("n")), f"{tmp_path}/report")
    assert spark.read.json(f"{tmp_path}/report").first().payload.n == 5


def test_small_functions(spark):
    one = spark.range(1)
    pick = lambda c: one.select(c.alias("x")).first().x
    assert [pick(pretty_duration(F.lit(s))) for s in (45, 1560, 7800, 273600)] == ["45s", "26min", "2h10", "3d04h"]
    assert pick(iso_millis(F.lit(T0 + 5000))) == "2026-07-15T14:00:00.005Z"
    assert pick(parse_server_time(F.lit("2026.07.15 17:00:00"), 3)) == T0 and pick(parse_server_time(F.lit("x"), 3)) is None
    assert pick(filling_names(F.lit(5))) == ["FOK", "BOC"]
    assert pick(weekday_number(F.lit("Wednesday"))) == 2 and pick(weekday_number(F.lit(None).cast("string"))) is None
    with pytest.raises(Exception, match="no weekday"):
        pick(weekday_number(F.lit("noday")))
    assert str(pick(swap_usd_oz(F.lit(0.0), F.lit(3)))) == "0.0" and pick(swap_usd_oz(F.lit(-523.8), F.lit(3))) == pytest.approx(0.5238)
    assert pick(same_number(F.lit(1.0), F.lit(1.0 + 1e-10))) and not pick(same_number(F.lit(1.0), F.lit(1.001)))
    assert len(pick(short_hash(F.lit("a")))) == 12 and pick(plain_text(F.lit("<b>a&nbsp;&amp; b</b>"))) == "a & b"


def test_deals_are_sorted_without_a_task_for_all(spark, tmp_path):
    from pyspark.sql import functions as F

    n = 30_000
    deals = spark.range(0, n, 1, 6).select(F.pmod(F.col("id") * 7919, F.lit(n)).alias("k"))
    deals = deals.select((F.col("k") * 1_000_000).alias("ts_us"), F.lit("buy").alias("side"), F.lit("X").alias("symbol"), F.lit(1.0).alias("volume"), F.lit(2.0).alias("preco_abertura"), F.lit("t").alias("ts_servidor"))
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would be put together
    try:
        sinks.write_deals(deals, f"{tmp_path}/deals")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    files = sorted((tmp_path / "deals").glob("part-*.csv"))
    lines = [f.read_text().splitlines()[1:] for f in files]
    assert len(files) > 1 and max(map(len, lines)) < n / 2
    times = [x.split(",")[0] for part in lines for x in part]
    assert len(times) == n and times == sorted(times)
    assert tables.read_deals(spark, f"{tmp_path}/deals").count() == n
