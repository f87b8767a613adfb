"""When a market is closed: a daily break and the weekend, by the clock of the server."""

from __future__ import annotations

from dataclasses import dataclass

from .times import DAY, MINUTE


@dataclass(frozen=True)
class Sessions:
    """Minutes of the day. The break is taken from Monday to Thursday; the week closes on Friday and opens on Sunday, unless
    there is no weekend. offset_h: the server's clock against UTC."""

    break_from: int = 20 * 60 + 58
    break_to: int = 22 * 60
    week_close: int = 20 * 60 + 58
    week_open: int = 22 * 60 + 1
    offset_h: float = 0.0
    weekend: bool = True

    def reopens(self, ts_us: int) -> int | None:
        """When the market opens again, if it is closed at ts_us."""
        local = ts_us + int(self.offset_h * 60 * MINUTE)
        day, minute = local // DAY, local % DAY // MINUTE
        weekday = (day + 3) % 7
        if self.weekend and ((weekday == 4 and minute >= self.week_close) or weekday == 5 or (weekday == 6 and minute < self.week_open)):
            return ts_us - local + (day + 6 - weekday) * DAY + self.week_open * MINUTE
        if weekday < 4 and self.break_from <= minute < self.break_to:
            return ts_us - local + day * DAY + self.break_to * MINUTE
        return None
