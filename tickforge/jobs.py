"""Stages over months, each a job of its own: completeness, parse, aggregate, validate. They are never chained.

A stage skips months whose result is there (unless forced), and a month that fails costs no other: its outcome says so
and the exit code tells. Months are a bounded list from the calendar; the work of each is one Spark job over its files.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.functions.times import months_between
from tickforge.layout import Layout
from tickforge.operators import bars, quality, validate
from tickforge.schemas import TIMEFRAMES, InstrumentSpec
from tickforge.sources import binary, sinks, tables
from tickforge.staging import hadoop_path, staged

OUTCOME = "stage string, instrument string, month string, state string, n long, note string"


@dataclass(frozen=True)
class Job:
    spark: SparkSession
    layout: Layout
    spec: InstrumentSpec
    feed: str = "feed"
    force: bool = False

    def exists(self, path: str) -> bool:
        fs, at = hadoop_path(self.spark, path)
        return fs.exists(at)

    def month_of(self, files: str, year: int, month: int) -> str:
        return f"{files}/{self.spec.name}/{year:04d}/{month:02d}"

    def partition(self, base: str, year: int, month: int, timeframe: str = "") -> str:
        return "/".join([base, f"instrument={self.spec.name}", *([f"timeframe={timeframe}"] if timeframe else []), f"year={year}", f"month={month}"])


def completeness(job: Job, year: int, month: int) -> tuple[str, int, str]:
    """The four states of the month's hours; `completo` if none failed. n: hours that call for action."""
    first, end = tables.month_bounds(year, month)
    raw = job.layout.raw(job.feed)
    listing = binary.list_hours(job.spark, raw, job.spec.name, year, month) if job.exists(job.month_of(raw, year, month)) else binary.no_hours(job.spark)
    states = quality.completeness(quality.hour_calendar(job.spark, first, end), listing.drop("instrument"))
    r = quality.completeness_counts(states).first()
    return ("completo" if r.complete else "incompleto"), r.falhou, f"presente {r.presente} vazio {r.vazio} ausente {r.ausente}"


def parse(job: Job, year: int, month: int) -> tuple[str, int, str]:
    if job.exists(job.partition(job.layout.ticks, year, month)) and not job.force:
        return "ja_existe", 0, ""
    if not job.exists(job.month_of(job.layout.raw(job.feed), year, month)):
        return "sem_ticks", 0, ""
    ticks = binary.read_month(job.spark, job.layout.raw(job.feed), job.spec, year, month)
    n = sinks.ingest(quality.require_scale(ticks, job.spec), job.layout.ticks)
    return ("parseado" if n else "sem_ticks"), n, ""


def aggregate(job: Job, year: int, month: int) -> tuple[str, int, str]:
    """All timeframes of the month from one scan; the next month's first hours close the last bars."""
    if all(job.exists(job.partition(job.layout.bars, year, month, tf)) for tf in TIMEFRAMES) and not job.force:
        return "ja_existe", 0, ""
    if not job.exists(job.layout.ticks):
        return "sem_ticks", 0, ""
    nxt = (year + month // 12, month % 12 + 1)
    ticks = tables.read_partitioned(job.spark, job.layout.ticks, "ticks", job.spec.name, f"{year:04d}-{month:02d}", f"{nxt[0]:04d}-{nxt[1]:02d}")
    ticks = tables.month_with_overlap(ticks, year, month)
    if ticks.where(F.col("ts_us") < tables.month_bounds(year, month)[1]).isEmpty():
        return "sem_ticks", 0, ""
    made = staged(bars.in_month(bars.aggregate_all(ticks), year, month), "bars")
    sinks.write_bars(made, job.layout.bars)
    return "agregado", made.count(), ""


def check(job: Job, year: int, month: int) -> tuple[str, int, str]:
    """The month's M1 bars against the feed's own candles. Nothing compared is no agreement: it is an error."""
    path = job.month_of(job.layout.reference(job.feed), year, month)
    if not job.exists(path):
        return "sem_referencia", 0, ""
    if not job.exists(job.partition(job.layout.bars, year, month, "M1")):
        return "sem_barras", 0, ""
    ours = tables.read_partitioned(job.spark, job.layout.bars, "bars", job.spec.name, f"{year:04d}-{month:02d}", f"{year:04d}-{month:02d}").where("timeframe = 'M1'")
    r = validate.require_comparison(validate.compare(ours, binary.read_candles(job.spark, path, job.spec), ("instrument", "ts_us"))).first()
    return "comparado", r.comuns, f"worst {r.worst_field} {r.worst}"


STAGES: dict[str, Callable[[Job, int, int], tuple[str, int, str]]] = {"completeness": completeness, "parse": parse, "aggregate": aggregate, "validate": check}


def run(job: Job, stage: str, first: str, last: str, recent_first: bool = False) -> list[tuple]:
    """Outcome rows of a stage over the months 'YYYY-MM' first to last, both included."""
    if stage not in STAGES:
        raise ValueError(f"stage is one of {list(STAGES)}, not {stage}")
    months = months_between(first, last)
    out = []
    for year, month in reversed(months) if recent_first else months:
        try:
            state, n, note = STAGES[stage](job, year, month)
        except Exception as e:  # a month that fails costs no other; the outcome keeps what happened
            state, n, note = "erro", 0, f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"
        out.append((stage, job.spec.name, f"{year:04d}-{month:02d}", state, int(n), note))
    return out


def outcomes(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, OUTCOME)


def exit_code(rows: list[tuple]) -> int:
    return int(any(r[3] == "erro" for r in rows))


def progress(rows: DataFrame) -> DataFrame:
    """How many months came to which state, by stage and instrument."""
    return rows.groupBy("stage", "instrument", "state").agg(F.count("*").alias("months"), F.sum("n").alias("n"))
