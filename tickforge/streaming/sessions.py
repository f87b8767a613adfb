"""Stream operators with timers: feeds that fall silent, and episodes of entries that end.

State lives in the RocksDB store, a few numbers a key. A timer makes a row without any input of its key: of event time,
which all keys move on (results are those of a batch, whatever the triggers), or of the wall clock, for a live stream.
One timer a key is pending; when it is due too early, it is set again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from tickforge.functions.sessions import Sessions
from tickforge.session import with_rocksdb

SILENCE_SCHEMA = "instrument string, at_us long, last_us long, feed string"
EPISODE_SCHEMA = "instrument string, episode long, side string, first_us long, last_us long, n long, closed_by string, entry_id long, late boolean"
CLOCKS = {"event": "eventTime", "processing": "processingTime"}


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])


def _ms(us: int) -> int:
    """The first whole millisecond after us."""
    return us // 1000 + 1


class _Timed(StatefulProcessor):
    """What both operators share: the clock, and a state that ends with the pending timer (ms, 0 if none)."""

    def __init__(self, clock: str):
        self.clock = clock

    def now(self, timers: TimerValues) -> int:
        ms = timers.getCurrentWatermarkInMs() if self.clock == "event" else timers.getCurrentProcessingTimeInMs()
        return ms * 1000

    def alarm(self, at_us: int | None, pending: int) -> int:
        """Sees to it that a timer is due by at_us; what is pending then."""
        if at_us is None or pending:
            return pending
        self.handle.registerTimer(_ms(at_us))
        return _ms(at_us)


class Silence(_Timed):
    def __init__(self, limit_us: int, sessions: Sessions, clock: str):
        super().__init__(clock)
        self.limit_us, self.sessions = limit_us, sessions

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("feed", "last_us long, told_us long, pending_ms long")

    def reports(self, last: int) -> list[tuple[int, str]]:
        """What is said, and when, of a feed whose last tick came at `last`, if none follows: quiet while the market is closed, then dead."""
        out, at = [], last + self.limit_us
        while (back := self.sessions.reopens(at)) is not None:
            out.append((at, "quiet"))
            at = back + self.limit_us
        return [*out, (at, "dead")]

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        ts = np.sort(np.concatenate([f["ts_us"].to_numpy(np.int64) for f in rows]))
        held = self.state.get()
        last, told, pending = held if held else (None, -1, 0)
        out = []
        if self.clock == "processing":  # a live tick comes when it comes; gaps in its own times say nothing of the feed
            ts = np.array([self.now(timerValues)])
        known = ts[:0] if last is None else np.array([last])
        path = np.concatenate([known, ts[ts > last] if last is not None else ts])
        for i in np.flatnonzero(np.diff(path) > self.limit_us):
            before, after = int(path[i]), int(path[i + 1])
            said = [(at, feed) for at, feed in self.reports(before) if at < after]
            out += [(key[0], at, before, feed) for at, feed in said if before != last or at > told]
            if said:
                out.append((key[0], after, before, "live"))
        newest = int(path[-1])
        told = told if newest == last else -1
        due = next((at for at, _ in self.reports(newest) if at > told), None)
        self.state.update((newest, told, self.alarm(due, pending)))
        yield _frame(out, SILENCE_SCHEMA)

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        last, told, _ = self.state.get()
        now = self.now(timerValues)
        ahead = [(at, feed) for at, feed in self.reports(last) if at > told]
        said = [(at, feed) for at, feed in ahead if at < now]
        told = said[-1][0] if said else told
        due = next((at for at, _ in ahead if at >= now), None)
        self.state.update((last, told, self.alarm(due, 0)))
        yield _frame([(key[0], at, last, feed) for at, feed in said], SILENCE_SCHEMA)


def _clocked(rows: DataFrame, clock: str, delay: str) -> DataFrame:
    if clock not in CLOCKS:
        raise ValueError(f"clock is one of {list(CLOCKS)}")
    with_rocksdb(rows.sparkSession)
    return rows.withColumn("event_time", F.timestamp_micros("ts_us")).withWatermark("event_time", delay) if clock == "event" else rows


def silence(ticks: DataFrame, limit_s: float, sessions: Sessions = Sessions(), clock: str = "event", delay: str = "0 seconds") -> DataFrame:
    """A row each time a feed (instrument) has had no tick for limit_s: `quiet` if the market is closed then, and again
    limit_s after it has opened; else `dead`, once; `live` with the tick that ends it. at_us: when; last_us: the tick before.

    clock `event`: time is what the ticks of all feeds say, so a feed is missed when others go on. `processing`: the wall
    clock, on which a feed is missed even if all fall silent. Ticks later than `delay` behind the newest count for nothing.
    """
    if limit_s <= 0:
        raise ValueError("the limit must be positive")
    keyed = _clocked(ticks.select("instrument", "ts_us"), clock, delay).groupBy("instrument")
    return keyed.transformWithStateInPandas(Silence(int(limit_s * 1_000_000), sessions, clock), SILENCE_SCHEMA, "Append", CLOCKS[clock])


class Episodes(_Timed):
    def __init__(self, gap_us: int, clock: str):
        super().__init__(clock)
        self.gap_us = gap_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        #: The open episode; n is 0 after one has ended.
        self.state = handle.getValueState("open", "no long, side string, first_us long, last_us long, last_id long, n long, pending_ms long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows)).sort_values(["ts_us", "entry_id"], kind="stable")
        held = self.state.get()
        no, side, first, last, last_id, n, pending = held if held else (0, None, 0, None, 0, 0, 0)
        ts, ids = new["ts_us"].to_numpy(np.int64), new["entry_id"].to_numpy(np.int64)
        late = np.zeros(len(new), bool) if last is None else (ts < last) | ((ts == last) & (ids < last_id))
        out = [(key[0], None, s, t, t, 1, None, i, True) for s, t, i in zip(new["side"][late], ts[late].tolist(), ids[late].tolist(), strict=True)]
        ts, ids, sides = ts[~late], ids[~late], new["side"].to_numpy(object)[~late]
        if len(ts):
            before_ts = np.concatenate([[ts[0] if last is None else last], ts[:-1]])
            before_side = np.concatenate([[side], sides[:-1]])
            gap = ts - before_ts > self.gap_us
            starts = gap | (before_side != sides)
            starts[0] |= n == 0
            at = np.flatnonzero(starts)
            # Stretches: what goes on with the open episode (if anything), then one from each start.
            bounds = np.concatenate([[0], at, [len(ts)]])
            for j in range(len(bounds) - 1):
                lo, hi = int(bounds[j]), int(bounds[j + 1])
                if j:
                    if n:
                        out.append((key[0], no, side, first, last, n, "gap" if gap[lo] else "side", None, False))
                    no, side, first, n = no + 1, sides[lo], int(ts[lo]), 0
                if hi > lo:
                    last, last_id, n = int(ts[hi - 1]), int(ids[hi - 1]), n + hi - lo
        self.state.update((no, side, first, last, last_id, n, self.alarm(last + self.gap_us if n else None, pending)))
        yield _frame(out, EPISODE_SCHEMA)

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        no, side, first, last, last_id, n, _ = self.state.get()
        over = bool(n) and self.now(timerValues) > last + self.gap_us
        self.state.update((no, side, first, last, last_id, 0 if over else n, self.alarm(last + self.gap_us if n and not over else None, 0)))
        yield _frame([(key[0], no, side, first, last, n, "gap", None, False)] if over else [], EPISODE_SCHEMA)


def episodes(entries: DataFrame, gap_min: float, clock: str = "event", delay: str = "0 seconds") -> DataFrame:
    """The episodes of `study.episodes` as a stream (instrument, entry_id, ts_us, side in), a row when one has ended: by the
    next entry's `side`, or by a `gap` beyond gap_min, which a timer finds without a next entry. Numbers count per instrument.

    An entry before its instrument's last one changes no episode: it is a row of its own, `late`. Entries later than
    `delay` behind the newest of all never get here: Spark leaves them out.
    """
    if gap_min < 0:
        raise ValueError("the gap can't be negative")
    keyed = _clocked(entries.select("instrument", "entry_id", "ts_us", "side"), clock, delay).groupBy("instrument")
    return keyed.transformWithStateInPandas(Episodes(int(gap_min * 60_000_000), clock), EPISODE_SCHEMA, "Append", CLOCKS[clock])
