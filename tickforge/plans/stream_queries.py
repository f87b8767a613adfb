"""Registered queries that run as streams: the table is written as files of bounded size in the order of a feed, and a
trigger reads one of them, so state is carried from trigger to trigger."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.functions.sessions import Sessions
from tickforge.staging import hadoop_path
from tickforge.streaming import sessions, stateful

from .queries import _LATE, _SENSOR, _W, DAY, HOUR, TICKS, _closed_sql, _disordered, _folder, _rounded, _ticks, query

#: Rows of a file (what a trigger holds: some 100 MB of Python even if all are of one key), and the least number of files.
FILE_ROWS, LEAST_FILES = 1_000_000, 3
PARTITIONS = "spark.sql.shuffle.partitions"


def streamed(rows: DataFrame, order: str, build: Callable[[DataFrame], DataFrame], schema: str) -> DataFrame:
    """What `build` makes of `rows` as a stream, in the order of a column: written by a file sink, read again.

    A trigger costs a task for each partition of the state, whatever it reads. So files hold many rows, and the state has
    no more partitions than twice its keys (instruments): others would stay empty in every trigger.
    """
    spark = rows.sparkSession
    root = _folder(spark, "stream")
    files = max(LEAST_FILES, -(-rows.count() // FILE_ROWS))
    rows.repartitionByRange(files, order).write.parquet(f"{root}/in")
    # A file stream takes files by their age: that of a range of rows is its place.
    fs, at = hadoop_path(spark, f"{root}/in")
    names = sorted((s.getPath() for s in fs.listStatus(at) if s.getPath().getName().startswith("part-")), key=lambda p: p.getName())
    began = int(time.time() * 1000) - 10 * len(names)
    for i, path in enumerate(names):
        fs.setTimes(path, began + 10 * i, -1)
    fs, out = hadoop_path(spark, f"{root}/out")
    fs.mkdirs(out)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    configured = spark.conf.get(PARTITIONS)
    spark.conf.set(PARTITIONS, max(1, min(int(configured), 2 * rows.select("instrument").distinct().count())))
    try:
        run = build(stream).writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start(f"{root}/out")
        run.awaitTermination()
    finally:
        spark.conf.set(PARTITIONS, configured)
    return spark.read.schema(schema).parquet(f"{root}/out")


@query(f"WITH {TICKS}, {_closed_sql(HOUR)} SELECT * FROM b")
def stream_bars(spark, sf_dir):
    """The stream's bars: equal to the batch's. Time orders the feed, the event's number breaks ties."""
    ticks = _ticks(spark, sf_dir).select("instrument", "ts_us", "seq", "bid")
    return streamed(ticks, "ts_us", lambda t: stateful.bars(t, 3600, by_time=True), stateful.BAR_SCHEMA).where("not late").drop("late")


@query(_LATE + ", o AS (SELECT *, max(ts_us) OVER (PARTITION BY instrument ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM d) SELECT instrument, ts_us, bid AS close FROM o WHERE ts_us < newest")
def stream_late_rows(spark, sf_dir):
    """What a stream sets apart: ticks before the newest one of their series."""
    out = streamed(_disordered(spark, sf_dir), "seq", lambda t: stateful.bars(t, 3600), stateful.BAR_SCHEMA)
    return out.where("late").select("instrument", "ts_us", "close")


@query(_SENSOR)
def stream_sensor(spark, sf_dir):
    """The rolling sensor as a stream, equal to the batch's."""
    out = streamed(_ticks(spark, sf_dir), "ts_us", lambda t: stateful.sensor(t, _W, by_time=True, peers=True), stateful.SENSOR_SCHEMA)
    return _rounded(out.where("not late").drop("late"))


_LIMIT, _GAP = 600, 60
_MINUTE = 60_000_000
_S = Sessions()


def _reopens(x: str) -> str:
    day, wd, minute = f"({x} // {DAY})", f"(({x} // {DAY} + 3) % 7)", f"({x} % {DAY} // {_MINUTE})"
    return (
        f"CASE WHEN ({wd} = 4 AND {minute} >= {_S.week_close}) OR {wd} = 5 OR ({wd} = 6 AND {minute} < {_S.week_open}) THEN ({day} + 6 - {wd}) * {DAY} + {_S.week_open * _MINUTE} "
        f"WHEN {wd} < 4 AND {minute} >= {_S.break_from} AND {minute} < {_S.break_to} THEN {day} * {DAY} + {_S.break_to * _MINUTE} END"
    )


@query(
    f"WITH {TICKS}, g AS (SELECT instrument, ts_us AS last_us, lead(ts_us) OVER (PARTITION BY instrument ORDER BY ts_us) AS next_us, ts_us + {_LIMIT * 1_000_000} AS e1, max(ts_us) OVER () AS ended FROM t), "
    f"b AS (SELECT *, {_reopens('e1')} AS back, coalesce(next_us, ended // 1000 * 1000) AS until FROM g) "
    "SELECT instrument, e1 AS at_us, last_us, CASE WHEN back IS NULL THEN 'dead' ELSE 'quiet' END AS feed FROM b WHERE e1 < until "
    f"UNION ALL SELECT instrument, back + {_LIMIT * 1_000_000}, last_us, 'dead' FROM b WHERE back + {_LIMIT * 1_000_000} < until "
    "UNION ALL SELECT instrument, next_us, last_us, 'live' FROM b WHERE e1 < next_us"
)
def stream_silence(spark, sf_dir):
    """Feeds without a tick for ten minutes, reported by timers: quiet while the market is closed, else dead."""
    return streamed(_ticks(spark, sf_dir), "ts_us", lambda t: sessions.silence(t, _LIMIT), sessions.SILENCE_SCHEMA)


@query(
    f"WITH e AS (SELECT event_type AS instrument, epoch_us(ts) AS ts_us, event_id AS entry_id, CASE WHEN event_id % 2 = 0 THEN 'buy' ELSE 'sell' END AS side FROM events), "
    f"l AS (SELECT *, lag(ts_us) OVER w AS pt, lag(side) OVER w AS ps FROM e WINDOW w AS (PARTITION BY instrument ORDER BY ts_us, entry_id)), s AS (SELECT *, pt IS NULL OR ps <> side OR ts_us - pt > {_GAP * _MINUTE} AS starts FROM l), "
    "n AS (SELECT *, CAST(sum(starts::INTEGER) OVER (PARTITION BY instrument ORDER BY ts_us, entry_id) AS BIGINT) AS episode FROM s), "
    "x AS (SELECT instrument, episode, any_value(side) AS side, min(ts_us) AS first_us, max(ts_us) AS last_us, count(*) AS n FROM n GROUP BY ALL), "
    "y AS (SELECT *, lead(first_us) OVER (PARTITION BY instrument ORDER BY episode) AS next_us, (SELECT max(ts_us) FROM e) // 1000 * 1000 AS ended FROM x) "
    f"SELECT instrument, episode, side, first_us, last_us, n, CASE WHEN coalesce(next_us, ended) - last_us > {_GAP * _MINUTE} THEN 'gap' ELSE 'side' END AS closed_by FROM y WHERE next_us IS NOT NULL OR ended - last_us > {_GAP * _MINUTE}"
)
def stream_episodes(spark, sf_dir):
    """All events as entries: the episodes that have ended, found as they end."""
    e = _ticks(spark, sf_dir).select("instrument", "ts_us", F.col("seq").alias("entry_id"), F.when(F.col("seq") % 2 == 0, "buy").otherwise("sell").alias("side"))
    return streamed(e, "ts_us", lambda x: sessions.episodes(x, _GAP), sessions.EPISODE_SCHEMA).where("not late").drop("late", "entry_id")
