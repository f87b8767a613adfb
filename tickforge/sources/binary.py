"""Hourly tick files and daily candle files: LZMA of packed big-endian records.

Files are read by Spark's binaryFile source, so any store that Spark reaches works; only the codec and the record
layout need Python. The hour (or day) and the instrument come from the path .../<instrument>/YYYY/MM/DD/HHh_ticks.bi5
with local months from 1.
"""

from __future__ import annotations

import lzma
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.functions.times import HOUR, floor_to
from tickforge.schemas import CANDLE, TICK, InstrumentSpec

#: Fixed record layouts.
TICK_RECORD = np.dtype([("ms", ">u4"), ("ask", ">u4"), ("bid", ">u4"), ("ask_vol", ">f4"), ("bid_vol", ">f4")])
CANDLE_RECORD = np.dtype([("secs", ">i4"), ("open", ">i4"), ("close", ">i4"), ("low", ">i4"), ("high", ">i4"), ("volume", ">f4")])
TICK_PATH = r"([^/]+)/(\d{4})/(\d{2})/(\d{2})/(\d{2})h_ticks\.bi5$"
CANDLE_PATH = r"([^/]+)/(\d{4})/(\d{2})/(\d{2})/[^/]*candles[^/]*\.bi5$"


def decompress(payload: bytes) -> bytes:
    """LZMA in either container; streams without an end marker give what they hold."""
    if not payload:
        return b""
    for kind in (lzma.FORMAT_AUTO, lzma.FORMAT_ALONE):
        try:
            return lzma.LZMADecompressor(format=kind).decompress(payload)
        except lzma.LZMAError as e:
            error = e
    raise ValueError(f"no LZMA stream: {error}")


def records(payload: bytes, layout: np.dtype) -> np.ndarray:
    raw = decompress(payload)
    if len(raw) % layout.itemsize:
        raise ValueError(f"{len(raw)} bytes are no whole number of {layout.itemsize}-byte records")
    return np.frombuffer(raw, layout)


def decode_ticks(payload: bytes, hour_us: int, instrument: str, spec: InstrumentSpec) -> pd.DataFrame:
    """One hour's ticks in stable time order; refused if more than half of them are crossed."""
    r = records(payload, TICK_RECORD)
    crossed = int((r["ask"] < r["bid"]).sum())
    if crossed > len(r) // 2:
        raise ValueError(f"{crossed} of {len(r)} ticks are crossed: the columns are not what they are taken for")
    r = r[np.argsort(r["ms"], kind="stable")]
    ts = hour_us + r["ms"].astype(np.int64) * 1000
    return pd.DataFrame({
        "instrument": instrument, "ts_us": ts, "seq": (hour_us // HOUR) * 10_000_000 + np.arange(len(r)), "bid": r["bid"] / spec.divisor, "ask": r["ask"] / spec.divisor,
        "bid_vol": r["bid_vol"].astype(np.float32), "ask_vol": r["ask_vol"].astype(np.float32),
    })


def decode_candles(payload: bytes, day_us: int, instrument: str, spec: InstrumentSpec) -> pd.DataFrame:
    """One day's reference candles, times counted from the day's start; refused if over a hundredth is incoherent."""
    r = records(payload, CANDLE_RECORD)
    top, low = np.maximum(r["open"], r["close"]), np.minimum(r["open"], r["close"])
    bad = int(((r["high"] < top) | (r["low"] > low)).sum())
    if bad > len(r) // 100:
        raise ValueError(f"{bad} of {len(r)} candles are incoherent")
    r = r[np.argsort(r["secs"], kind="stable")]
    cols = {c: r[c] / spec.divisor for c in ("open", "high", "low", "close")}
    return pd.DataFrame({"instrument": instrument, "ts_us": day_us + r["secs"].astype(np.int64) * 1_000_000, **cols, "volume": r["volume"].astype(np.float32)})


def _located(spark: SparkSession, path: str, pattern: str, parts: int) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    part = [F.regexp_extract("path", pattern, i) for i in range(1, parts + 1)]
    days = F.datediff(F.make_date(part[1].cast("int"), part[2].cast("int"), part[3].cast("int")), F.lit("1970-01-01").cast("date")).cast("long") * (24 * HOUR)
    at = days + (part[4].cast("long") * HOUR if parts > 4 else F.lit(0))
    return files.where(F.col("path").rlike(pattern)).select("path", "length", "content", part[0].alias("instrument"), at.alias("at_us"))


def _decoded(files: DataFrame, decode, spec: InstrumentSpec, schema) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content, instrument, at in zip(batch["path"], batch["content"], batch["instrument"], batch["at_us"], strict=True):
                try:
                    yield decode(bytes(content), int(at), instrument, spec)
                except ValueError as e:
                    raise ValueError(f"{path}: {e}") from e

    return files.select("path", "content", "instrument", "at_us").mapInPandas(run, schema)


def decode_tick_files(files: DataFrame, spec: InstrumentSpec) -> DataFrame:
    """files: path, content, instrument, at_us (the hour)."""
    return _decoded(files, decode_ticks, spec, TICK)


def decode_candle_files(files: DataFrame, spec: InstrumentSpec) -> DataFrame:
    """files: path, content, instrument, at_us (the day)."""
    return _decoded(files, decode_candles, spec, CANDLE)


def _packed(rows: DataFrame, at: Column, layout: np.dtype, columns: dict[str, Column], order: list[str]) -> DataFrame:
    """path, content, instrument, at_us: a file's bytes for each instrument and `at`; rows in the given order."""
    names = list(columns)
    laid = rows.select("instrument", at.alias("at_us"), *(c.alias(n) for n, c in columns.items()), *(F.col(c).alias(f"__{c}") for c in order))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([f"__{c}" for c in order], kind="stable")
        out = np.zeros(len(pdf), layout)
        for n in names:
            out[n] = pdf[n].to_numpy()
        head = pdf.iloc[0]
        return pd.DataFrame({"path": [f"{head['instrument']}/{head['at_us']}"], "content": [lzma.compress(out.tobytes(), lzma.FORMAT_ALONE)], "instrument": [head["instrument"]], "at_us": [head["at_us"]]})

    return laid.groupBy("instrument", "at_us").applyInPandas(run, "path string, content binary, instrument string, at_us long")


def pack_ticks(ticks: DataFrame, spec: InstrumentSpec) -> DataFrame:
    """Ticks as hourly files' bytes, the inverse of `decode_tick_files` up to milliseconds and the price's decimals."""
    whole = lambda c: F.round(F.col(c) * spec.divisor).cast("long")
    volume = lambda c: (F.col(c) if c in ticks.columns else F.lit(1.0)).cast("float")
    cols = {"ms": F.floor(F.pmod("ts_us", F.lit(HOUR)) / 1000), "ask": whole("ask"), "bid": whole("bid"), "ask_vol": volume("ask_vol"), "bid_vol": volume("bid_vol")}
    return _packed(ticks, floor_to(F.col("ts_us"), 3600), TICK_RECORD, cols, ["ts_us", "seq"])


def pack_candles(bars: DataFrame, spec: InstrumentSpec) -> DataFrame:
    """Bars as daily files' bytes; their tick counts are the volumes."""
    whole = lambda c: F.round(F.col(c) * spec.divisor).cast("int")
    cols = {"secs": F.floor(F.pmod("ts_us", F.lit(24 * HOUR)) / 1_000_000)} | {c: whole(c) for c in ("open", "close", "low", "high")} | {"volume": F.col("n_ticks").cast("float")}
    return _packed(bars, floor_to(F.col("ts_us"), 86400), CANDLE_RECORD, cols, ["ts_us"])


def read_month(spark: SparkSession, path: str, spec: InstrumentSpec, year: int, month: int) -> DataFrame:
    """One instrument's month of tick files; hours without a file are skipped, a month without a folder is an error."""
    return read_ticks(spark, f"{path}/{spec.name}/{year:04d}/{month:02d}", spec)


def read_ticks(spark: SparkSession, path: str, spec: InstrumentSpec) -> DataFrame:
    """All hourly files below path as ticks. Empty files give no rows."""
    return _decoded(_located(spark, path, TICK_PATH, 5), decode_ticks, spec, TICK)


def read_candles(spark: SparkSession, path: str, spec: InstrumentSpec) -> DataFrame:
    return _decoded(_located(spark, path, CANDLE_PATH, 4), decode_candles, spec, CANDLE)


HOURS = "instrument string, hour_us long, size long, has_file boolean, has_absent_marker boolean"


def no_hours(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], HOURS)


def list_hours(spark: SparkSession, path: str, instrument: str, year: int, month: int) -> DataFrame:
    """The landing zone of a month: instrument, hour_us, size, has_file, has_absent_marker (an `.absent` file beside the hour's).

    Scans leave out files without bytes, so names come from the source's file index and sizes from the scan. A month
    has 744 hours at most, so the names that pass through the driver are bounded.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{path}/{instrument}/{year:04d}/{month:02d}")
    pattern = TICK_PATH.replace(r"\.bi5$", r"\.bi5(\.absent)?$")
    # Both sides write the store's name in their own way; the end of the path is the same.
    end = F.regexp_extract("path", pattern, 0).alias("path")
    names = spark.createDataFrame([(x,) for x in files.inputFiles()], "path string").select(end).join(files.select(end, "length"), "path", "left")
    part = [F.regexp_extract("path", pattern, i) for i in range(1, 7)]
    days = F.datediff(F.make_date(part[1].cast("int"), part[2].cast("int"), part[3].cast("int")), F.lit("1970-01-01").cast("date")).cast("long") * (24 * HOUR)
    rows = names.where(F.col("path").rlike(pattern)).select(part[0].alias("instrument"), (days + part[4].cast("long") * HOUR).alias("hour_us"), F.coalesce("length", F.lit(0)).alias("length"), (part[5] != "").alias("marker"))
    return rows.groupBy("instrument", "hour_us").agg(
        F.sum(F.when(~F.col("marker"), F.col("length")).otherwise(0)).alias("size"), F.bool_or(~F.col("marker")).alias("has_file"), F.bool_or("marker").alias("has_absent_marker")
    )
