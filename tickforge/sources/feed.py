"""The landing zone of a feed as a Spark data source: `spark.read.format("tickfeed")` and `spark.readStream`.

Hours are paths, so what is asked for decides which files exist for the plan: a partition is a week of an instrument (some
megabytes of a busy one), cut to the hours that are asked for, and nothing else is opened. They are asked for by options
(`ticks_between` sets them and filters what is left inside the outer hours), not by Spark's pushed filters: Spark 4.1.2
keeps those in the relation, and a later plan without filters over the same DataFrame misses rows. Options:

* path: the root of <instrument>/YYYY/MM/DD/HHh_ticks.bi5, on any store that Arrow opens (a local path, file:, hdfs:, s3:, gs:)
* instruments: names with commas between; first_us, last_us: the hours from the one to before the other
* price_decimals
* rows: `ticks`, or `hours`: what became of each hour, `lido` (with its ticks), `vazio`, `ausente` (a marker) or `falta`

As a stream, offsets are hours: a trigger reads the hours that have landed since. An hour has landed when every instrument
has a file or a marker for it or for a later one, so no instrument's hour is passed over because another's came first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, timedelta

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tickforge.functions.times import DAY, HOUR
from tickforge.schemas import LONG, STR, TICK, InstrumentSpec, _struct

from .binary import decode_ticks

HOURS_SCHEMA = _struct(instrument=STR, hour_us=LONG, state=STR, ticks=LONG)
#: What became of an hour.
READ, EMPTY, ABSENT, MISSING = "lido", "vazio", "ausente", "falta"
MARKER = ".absent"
WEEK = 7 * DAY


def store(root: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(root) if ":/" in root else (fs.LocalFileSystem(), root)


def hour_path(root: str, instrument: str, hour_us: int) -> str:
    day = date(1970, 1, 1) + timedelta(days=hour_us // DAY)
    return f"{root.rstrip('/')}/{instrument}/{day:%Y/%m/%d}/{hour_us % DAY // HOUR:02d}h_ticks.bi5"


@dataclass
class Hours(InputPartition):
    instrument: str
    first_us: int
    end_us: int


class _Files:
    """Options, and the reading of a partition."""

    def __init__(self, options: dict, schema: StructType):
        self.root, self.schema = options["path"], schema
        self.instruments = [x.strip() for x in options["instruments"].split(",") if x.strip()]
        self.first_us, self.end_us = (-(-int(options[k]) // HOUR) * HOUR if k == "last_us" else int(options[k]) // HOUR * HOUR for k in ("first_us", "last_us"))
        self.spec = InstrumentSpec("", int(options.get("price_decimals", 3)))
        self.hours = options.get("rows", "ticks") == "hours"

    def cut(self, first_us: int, end_us: int) -> list[Hours]:
        """A partition for each instrument and week."""
        out = []
        for name in self.instruments:
            at = first_us
            while at < end_us:
                end = min(end_us, at // WEEK * WEEK + WEEK)
                out.append(Hours(name, at, end))
                at = end
        return out

    def read(self, partition: Hours) -> Iterator[pa.RecordBatch]:
        files, root = store(self.root)
        schema = to_arrow_schema(self.schema)
        for hour in range(partition.first_us, partition.end_us, HOUR):
            path = hour_path(root, partition.instrument, hour)
            held, mark = files.get_file_info([path, path + MARKER])
            there = held.type == fs.FileType.File
            ticks = None
            if there:
                try:
                    with files.open_input_stream(path) as f:
                        ticks = decode_ticks(f.read(), hour, partition.instrument, self.spec)
                except ValueError as e:
                    raise ValueError(f"{path}: {e}") from e
            if self.hours:
                state = (READ if len(ticks) else EMPTY) if there else ABSENT if mark.type == fs.FileType.File else MISSING
                yield pa.RecordBatch.from_pydict({"instrument": [partition.instrument], "hour_us": [hour], "state": [state], "ticks": [len(ticks) if there else 0]}, schema=schema)
            elif there and len(ticks):
                yield pa.RecordBatch.from_pandas(ticks[schema.names], schema=schema, preserve_index=False)


class FeedReader(_Files, DataSourceReader):
    def partitions(self) -> list[Hours]:
        return self.cut(self.first_us, self.end_us) or [Hours("", 0, 0)]


class FeedStream(_Files, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"hour_us": self.first_us}

    def newest(self, instrument: str) -> int:
        """The end of an instrument's newest hour with a file or a marker, looked for backwards by day."""
        files, root = store(self.root)
        for day in range((self.end_us - 1) // DAY * DAY, self.first_us // DAY * DAY - 1, -DAY):
            folder = hour_path(root, instrument, day).rsplit("/", 1)[0]
            names = [i.base_name for i in files.get_file_info(fs.FileSelector(folder, allow_not_found=True))]
            seen = [int(n[:2]) for n in names if n[2:] in ("h_ticks.bi5", "h_ticks.bi5" + MARKER)]
            if seen:
                return day + (max(seen) + 1) * HOUR
        return self.first_us

    def latestOffset(self) -> dict:
        landed = min(map(self.newest, self.instruments), default=self.first_us)
        return {"hour_us": min(self.end_us, max(self.first_us, landed))}

    def partitions(self, start: dict, end: dict) -> list[Hours]:
        return self.cut(start["hour_us"], end["hour_us"])


class TickFeed(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tickfeed"

    def schema(self) -> StructType:
        return HOURS_SCHEMA if self.options.get("rows", "ticks") == "hours" else TICK

    def reader(self, schema: StructType) -> FeedReader:
        return FeedReader(dict(self.options), schema)

    def streamReader(self, schema: StructType) -> FeedStream:
        return FeedStream(dict(self.options), schema)


def register(spark: SparkSession) -> SparkSession:
    """Makes the source known to the session."""
    spark.dataSource.register(TickFeed)
    return spark


def ticks_between(spark: SparkSession, path: str, instruments: list[str], first_us: int, end_us: int, price_decimals: int = 3) -> DataFrame:
    """The ticks of [first_us, end_us): only the files of those hours are planned and opened."""
    source = register(spark).read.format("tickfeed").options(path=path, instruments=",".join(instruments), first_us=first_us, last_us=end_us, price_decimals=price_decimals)
    return source.load().where((F.col("ts_us") >= first_us) & (F.col("ts_us") < end_us))


def counts(hours: DataFrame) -> DataFrame:
    """Per instrument, of the rows `hours`: horas_lidas (files read, empty ones too), horas_vazias, horas_ausentes, ticks."""
    state = F.col("state")
    return hours.groupBy("instrument").agg(
        F.count_if(state.isin(READ, EMPTY)).alias("horas_lidas"), F.count_if(state == EMPTY).alias("horas_vazias"), F.count_if(state == ABSENT).alias("horas_ausentes"), F.sum("ticks").alias("ticks")
    )


def land(files: DataFrame, root: str) -> DataFrame:
    """Writes packed files (instrument, at_us, content; null content: an absent marker) to their paths: instrument, n. A file is
    written whole under another name first, so a task that runs twice leaves the same files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, base = store(root)
        for batch in batches:
            for name, hour, content in zip(*(batch.column(c).to_pylist() for c in ("instrument", "at_us", "content")), strict=True):
                path = hour_path(base, name, hour) + (MARKER if content is None else "")
                target.create_dir(path.rsplit("/", 1)[0], recursive=True)
                with target.open_output_stream(f"{path}.part") as f:
                    f.write(content or b"")
                target.move(f"{path}.part", path)
            yield pa.RecordBatch.from_arrays([batch.column("instrument")], names=["instrument"])

    return files.select("instrument", "at_us", "content").mapInArrow(run, "instrument string").groupBy("instrument").count()
