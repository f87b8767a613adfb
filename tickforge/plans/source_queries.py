"""Registered queries through the landing zone as a data source."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickforge.sources import binary, feed, sinks, tables

from .queries import _PACKED, DAY, HOUR, JANUARY, SPEC, TICKS, _folder, _ticks, query

NAMES = ("click", "error", "purchase", "signup", "view")


def _landed(spark, sf_dir):
    """All ticks as hourly files; every seventh hour's file of `error` is there without ticks, every eleventh has a marker instead."""
    feed.register(spark)
    root = _folder(spark, "raw")
    packed = binary.pack_ticks(_ticks(spark, sf_dir), SPEC)
    hour, error = F.floor(F.col("at_us") / HOUR), F.col("instrument") == "error"
    content = F.when(error & (hour % 11 == 0), F.lit(None)).when(error & (hour % 7 == 0), F.lit(b"")).otherwise(F.col("content"))
    feed.land(packed.withColumn("content", content), root).collect()  # a row an instrument
    return spark.read.format("tickfeed").options(path=root, instruments=",".join(NAMES), first_us=JANUARY[0], last_us=JANUARY[1], price_decimals=SPEC.price_decimals)


@query(
    _PACKED + f", s AS (SELECT instrument, ms_us AS ts_us, (ms_us // {HOUR}) * 10000000 + row_number() OVER (PARTITION BY instrument, ms_us // {HOUR} ORDER BY ts_us, seq) - 1 AS seq, bid, ask, 1.0::FLOAT AS bid_vol, 1.0::FLOAT AS ask_vol FROM k) "
    f"SELECT * FROM s WHERE NOT (instrument = 'error' AND (ts_us // {HOUR} % 11 = 0 OR ts_us // {HOUR} % 7 = 0))"
)
def feed_source(spark, sf_dir):
    """All landed files, read through the source."""
    return _landed(spark, sf_dir).load()


@query(
    f"WITH {TICKS}, h AS (SELECT instrument, ts_us // {HOUR} AS hour, count(*) AS n FROM t GROUP BY ALL), s AS (SELECT instrument, n, instrument = 'error' AND hour % 11 = 0 AS gone, instrument = 'error' AND hour % 11 <> 0 AND hour % 7 = 0 AS bare FROM h) "
    "SELECT instrument, count(*) FILTER (NOT gone) AS horas_lidas, count(*) FILTER (bare) AS horas_vazias, count(*) FILTER (gone) AS horas_ausentes, CAST(sum(CASE WHEN gone OR bare THEN 0 ELSE n END) AS BIGINT) AS ticks FROM s GROUP BY 1"
)
def feed_hours(spark, sf_dir):
    """Hours read, empty and absent, as the parse of a month counts them."""
    return feed.counts(_landed(spark, sf_dir).option("rows", "hours").load())


@query(
    "SELECT strftime(o_orderdate, '%Y.%m.%d') || ' 10:20:30' AS ts_servidor, epoch_us(o_orderdate) + 26430000000 AS ts_us, CASE WHEN o_orderkey % 3 = 0 THEN 'GOLD' ELSE 'SILVER.x' END AS symbol, "
    "CASE WHEN o_orderkey % 2 = 0 THEN 'buy' ELSE 'sell' END AS side, o_orderkey % 50 + 0.5::DOUBLE AS volume, CAST(o_totalprice AS DOUBLE) AS preco_abertura FROM orders WHERE o_orderkey % 3 = 0"
)
def terminal_positions(spark, sf_dir):
    """The positions of one symbol, read from reports that terminals would write of all orders; titles and balance rows stand among them."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    key, cell = F.col("o_orderkey"), lambda *c: F.concat(F.lit("<td>"), *c, F.lit("</td>"))
    even = F.pmod(key, F.lit(2)) == 0
    price = F.format_number("o_totalprice", 2)
    cells = [cell(F.date_format("o_orderdate", "yyyy.MM.dd"), F.lit(" 10:20:30")), cell(F.lit("")), cell(key.cast("string")), cell(F.when(F.pmod(key, F.lit(3)) == 0, F.lit("GOLD")).otherwise(F.lit("SILVER.x")))]
    cells += [cell(F.when(even, F.lit("Buy")).otherwise(F.lit("SELL"))), cell((F.pmod(key, F.lit(50)) + 0.5).cast("string")), cell(F.translate(price, ",", " "))]
    other = F.when(even, F.lit("<tr><th>Time</th><th>Position</th></tr>")).otherwise(F.lit("<tr><td>2024.01.01 00:00:00</td><td>1</td><td>-</td><td>balance</td><td>5</td><td>6</td></tr>"))
    pages = o.select(key.alias("no"), F.concat(F.lit("<table>"), other, F.lit("<tr>"), *cells, F.lit("</tr></table>")).alias("html"))
    return tables.positions(tables.html_rows(pages, "no"), 3, "GOLD").select("ts_servidor", "ts_us", "symbol", "side", "volume", "preco_abertura")


@query(f"WITH {TICKS} SELECT 'run-1' AS run_id, instrument, count(*) AS n, min(ts_us) AS first_us, max(ts_us) AS last_us, max(bid) AS top FROM t GROUP BY instrument")
def report_file(spark, sf_dir):
    """A JSON report with its envelope, what all ticks of each series come to, written and read back."""
    each = _ticks(spark, sf_dir).groupBy("instrument").agg(F.count("*").alias("n"), F.min("ts_us").alias("first_us"), F.max("ts_us").alias("last_us"), F.max("bid").alias("top"))
    body = each.agg(F.sort_array(F.collect_list(F.struct(*each.columns))).alias("series"))  # a row a series
    path = _folder(spark, "report")
    sinks.write_report({"run_id": "run-1"}, body, path)
    kinds = ", ".join(f"{c}: {t}" for c, t in each.dtypes)
    read = spark.read.schema(f"run_id string, payload struct<series: array<struct<{kinds}>>>").json(path)
    return read.select("run_id", F.explode("payload.series").alias("s")).select("run_id", "s.*")
