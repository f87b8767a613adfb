"""Calendar arithmetic on microseconds since the epoch."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND, MINUTE, HOUR, DAY = 1_000_000, 60_000_000, 3_600_000_000, 86_400_000_000


def floor_to(ts: Column, seconds: int | Column) -> Column:
    """The start of the epoch-anchored interval that holds ts."""
    step = (F.lit(seconds) if isinstance(seconds, int) else seconds).cast("long") * SECOND
    return ts - F.pmod(ts, step)


def hour_of(ts: Column) -> Column:
    return F.floor(F.pmod(ts, F.lit(DAY)) / HOUR).cast("int")


def day_of(ts: Column) -> Column:
    """Days since the epoch."""
    return F.floor((ts - F.pmod(ts, F.lit(DAY))) / DAY).cast("int")


def weekday_of(ts: Column) -> Column:
    """Monday is 0; the epoch was a Thursday."""
    return F.pmod(day_of(ts) + 3, F.lit(7)).cast("int")


def minute_of_day(ts: Column) -> Column:
    return F.floor(F.pmod(ts, F.lit(DAY)) / MINUTE).cast("int")


def date_of(ts: Column) -> Column:
    return F.date_add(F.lit("1970-01-01").cast("date"), day_of(ts))


def month_of(ts: Column) -> Column:
    return F.date_format(date_of(ts), "yyyy-MM")


def micros(ts: Column) -> Column:
    """From a timestamp without zone that means UTC."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts.cast("timestamp_ntz"))


def parse_server_time(text: Column, offset_hours: float = 0) -> Column:
    """'YYYY.MM.DD HH:MM:SS' of a server at a fixed offset from UTC, as microseconds; null where it doesn't parse."""
    return micros(F.try_to_timestamp(text, F.lit("yyyy.MM.dd HH:mm:ss")).cast("timestamp_ntz")) - int(offset_hours * HOUR)


def iso_millis(ts: Column) -> Column:
    """'2026-07-15T14:00:00.000Z'."""
    of_day = F.pmod(ts, F.lit(DAY))
    part = lambda unit, size: F.floor(F.pmod(of_day, F.lit(size)) / unit).cast("int")
    return F.format_string("%sT%02d:%02d:%02d.%03dZ", date_of(ts).cast("string"), part(HOUR, DAY), part(MINUTE, HOUR), part(SECOND, MINUTE), part(1000, SECOND))


def pretty_duration(seconds: Column) -> Column:
    """45s below 90 seconds, 26min below 90 minutes, 2h10 below two days, else 3d04h; what is left of a unit is rounded, halves to even."""
    s = F.greatest(F.lit(0.0), seconds.cast("double"))
    minutes, hours = (F.bround(s / unit).cast("long") for unit in (60, 3600))
    part = lambda x, n: F.pmod(x, F.lit(n)).cast("int")
    return (
        F.when(s.isNull() | seconds.isNull(), F.lit(None).cast("string"))
        .when(s < 90, F.format_string("%ds", F.bround(s).cast("long")))
        .when(s < 5400, F.format_string("%dmin", minutes))
        .when(s < 172800, F.format_string("%dh%02d", F.floor(minutes / 60), part(minutes, 60)))
        .otherwise(F.format_string("%dd%02dh", F.floor(hours / 24), part(hours, 24)))
    )


def month_start(ts: Column) -> Column:
    return micros(F.trunc(date_of(ts), "month"))


def last_complete_month(now: Column) -> Column:
    """struct(first_us, end_us): the last whole month before `now`, its end left out."""
    end = month_start(now)
    return F.struct(month_start(end - 1).alias("first_us"), end.alias("end_us"))


def least_time_left(pending: Column, interval_s: float) -> Column:
    """The least a queue can take, as text: what is pending times the interval between requests."""
    return pretty_duration(pending * F.lit(float(interval_s)))


def months_between(first: str, last: str) -> list[tuple[int, int]]:
    """(year, month) from 'YYYY-MM' to 'YYYY-MM', both inclusive."""
    try:
        (y0, m0), (y1, m1) = (tuple(map(int, x.split("-"))) for x in (first, last))
    except ValueError as e:
        raise ValueError(f"months are written YYYY-MM: {first}, {last}") from e
    if not (1 <= m0 <= 12 and 1 <= m1 <= 12):
        raise ValueError(f"no such month: {first}, {last}")
    a, b = y0 * 12 + m0 - 1, y1 * 12 + m1 - 1
    if a > b:
        raise ValueError(f"{first} is after {last}")
    return [(k // 12, k % 12 + 1) for k in range(a, b + 1)]
