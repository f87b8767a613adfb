"""Ticks, bars, entries, deals, documents: readers with fixed schemas."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.functions.times import DAY, micros, parse_server_time
from tickforge.functions.values import plain_text
from tickforge.schemas import BAR, DEAL, SPECS, SPECS_ID, TICK, FeedConfig, InstrumentSpec


def read_partitioned(spark: SparkSession, path: str, kind: str, instrument: str | None = None, first: str | None = None, last: str | None = None, required: bool = False) -> DataFrame:
    """Ticks or bars written by `sinks`, between two months 'YYYY-MM' (inclusive). Partition and time filters reach the scan. required: an error if there are none."""
    base = {"ticks": TICK, "bars": BAR}[kind]
    rows = spark.read.schema(T.StructType([*base.fields, T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())])).parquet(path)
    number = F.col("year") * 12 + F.col("month")
    for bound, keep in ((first, number.__ge__), (last, number.__le__)):
        if bound:
            y, m = map(int, bound.split("-"))
            rows = rows.where(keep(y * 12 + m))
    rows = rows.where(F.col("instrument") == instrument) if instrument else rows
    return require_rows(rows, f"{kind} of {instrument or 'all'} from {first} to {last}") if required else rows


def month_bounds(year: int, month: int) -> tuple[int, int]:
    """[first, end) of a month in microseconds."""
    days = lambda y, m: (date(y, m, 1) - date(1970, 1, 1)).days
    return days(year, month) * DAY, days(year + month // 12, month % 12 + 1) * DAY


def require_rows(rows: DataFrame, what: str) -> DataFrame:
    """`rows`, or an error if there are none: an empty range is a wrong one."""
    if rows.isEmpty():
        raise ValueError(f"nothing to read: {what}")
    return rows


def month_with_overlap(ticks: DataFrame, year: int, month: int, overlap_h: float = 72.0) -> DataFrame:
    """A month's ticks and the first hours of the next month: one filter on the continuous series."""
    start, end = month_bounds(year, month)
    return ticks.where((F.col("ts_us") >= start) & (F.col("ts_us") < end + int(overlap_h * 3_600_000_000)))


def ticks_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The testing table `events` as ticks: a series per event type, ask from the number in `props`."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    k = F.get_json_object("props", "$.k").cast("double")
    return e.select(F.col("event_type").alias("instrument"), micros(F.col("ts")).alias("ts_us"), F.col("event_id").alias("seq"), F.col("value").alias("bid"), (F.col("value") + F.lit(0.01) * k).alias("ask"))


def entries_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases as entries; the side follows from the parity of the id."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").where("event_type = 'purchase'")
    side = F.when(F.col("event_id") % 2 == 0, "buy").otherwise("sell")
    return e.select(F.col("event_id").alias("entry_id"), micros(F.col("ts")).alias("ts_us"), side.alias("side"), F.col("event_type").alias("instrument"))


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with ts_utc and side (others ignored): entry_id, ts_us, side. A side other than buy and sell, or a bad time, is an error."""
    raw = spark.read.option("header", True).csv(path)
    missing = {"ts_utc", "side"} - set(raw.columns)
    if missing:
        raise ValueError(f"columns missing: {sorted(missing)}")
    side = F.lower(F.trim("side"))
    ts = micros(F.try_to_timestamp(F.regexp_replace(F.trim("ts_utc"), "Z$", "")).cast("timestamp_ntz"))
    checked = F.when(side.isin("buy", "sell") & ts.isNotNull(), side).otherwise(F.raise_error(F.concat(F.lit("no entry: "), F.coalesce("ts_utc", F.lit("?")), F.lit(" "), F.coalesce("side", F.lit("?")))).cast("string"))
    return raw.select(F.xxhash64("ts_utc", "side", F.monotonically_increasing_id()).alias("entry_id"), ts.alias("ts_us"), checked.alias("side"))


def read_specs(spark: SparkSession, path: str) -> DataFrame:
    """Symbol specs (JSON, fixed schema), refused unless their schema id is known."""
    rows = spark.read.schema(SPECS).option("multiLine", True).json(path)
    known = F.col("schema").eqNullSafe(F.lit(SPECS_ID))
    return rows.where(F.when(known, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("unknown specs schema: "), F.coalesce("schema", F.lit("none")))).cast("boolean")))


def newest_specs(spark: SparkSession, root: str) -> str:
    """The path of the latest *-latest.json below root; an error if they lie in more than one folder or there is none."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*-latest.json").load(root)
    r = files.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path"), F.count_distinct(F.regexp_extract("path", r"^(.*)/[^/]*/[^/]*$", 1)).alias("parents")).first()
    if r.path is None:
        raise FileNotFoundError(f"no specs below {root}")
    if r.parents > 1:
        raise ValueError(f"specs of {r.parents} terminals below {root}: name one")
    return r.path


def load_yaml(spark: SparkSession, path: str) -> dict:
    """A small configuration document, through Spark's reader so that any store works."""
    import yaml

    return yaml.safe_load(spark.read.text(path, wholetext=True).first().value)


def instrument_spec(document: dict) -> InstrumentSpec:
    low, high = document["plausible_range"]
    return InstrumentSpec(document["name"], int(document["price_decimals"]), document.get("unit", "usd_oz"), (float(low), float(high)))


def feed_config(document: dict) -> FeedConfig:
    """Times in `history_starts` are ISO dates; here microseconds."""
    starts = {k: (date.fromisoformat(str(v)[:10]) - date(1970, 1, 1)).days * DAY for k, v in (document.get("history_starts") or {}).items()}
    return FeedConfig(document["base_url"], document["path_template"], starts)


def html_rows(pages: DataFrame, key: str = "page_id", html: str = "html", row: str = "tr", cell: str = "t[dh]") -> DataFrame:
    """(key, row_no, cells): the elements `row` of pages and the plain text of their elements `cell` (both regular expressions)."""
    found = lambda column, tag: F.regexp_extract_all(column, F.lit(rf"(?is)<(?:{tag})\b[^>]*>(.*?)</(?:{tag})>"), 1)
    rows = pages.select(key, F.posexplode(found(F.col(html), row)).alias("row_no", "row"))
    return rows.select(key, "row_no", F.transform(found(F.col("row"), cell), plain_text).alias("cells"))


def positions(rows: DataFrame, offset_hours: float, symbol: str | None = None) -> DataFrame:
    """Deals of a report's rows, told by shape: a time first, then (blank cells skipped) number and symbol, then buy or sell, then volume and price.

    Columns as in the deals table, with ts_us.
    """
    c = F.filter("cells", lambda x: x != "")
    number = lambda x: F.regexp_replace(x, r"[ ,]", "").try_cast("double")
    shaped = rows.select(
        F.try_element_at(c, F.lit(1)).alias("ts_servidor"), F.try_element_at(c, F.lit(3)).alias("symbol"), F.lower(F.try_element_at(c, F.lit(4))).alias("side"),
        number(F.try_element_at(c, F.lit(5))).alias("volume"), number(F.try_element_at(c, F.lit(6))).alias("preco_abertura"),
    ).where(F.col("side").isin("buy", "sell") & F.col("volume").isNotNull() & F.col("preco_abertura").isNotNull() & F.col("ts_servidor").rlike(r"^\d{4}\.\d{2}\.\d{2} \d{2}:\d{2}:\d{2}$"))
    shaped = shaped.withColumn("ts_us", parse_server_time(F.col("ts_servidor"), offset_hours))
    return shaped.where(F.col("symbol") == symbol) if symbol else shaped


#: What Windows-1252 has where Latin-1 has control characters.
_C1 = {chr(b): bytes([b]).decode("cp1252") for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}


def decode_text(files: DataFrame) -> DataFrame:
    """binaryFile rows with `text`: UTF-16 by its mark, else UTF-8 with or without mark, else Windows-1252."""
    utf16 = F.hex(F.substring("content", 1, 2)).isin("FFFE", "FEFF")
    utf8 = F.when(F.expr("is_valid_utf8(cast(content as string))"), F.col("content").cast("string"))
    western = F.translate(F.decode("content", "iso-8859-1"), "".join(_C1), "".join(_C1.values()))
    text = F.when(utf16, F.decode("content", "utf-16")).otherwise(F.coalesce(F.regexp_replace(utf8, "^\ufeff", ""), western))
    return files.withColumn("text", text)


def read_deals(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DEAL).option("header", True).option("mode", "FAILFAST").csv(path)

