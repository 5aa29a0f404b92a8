"""Epoch conversion and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def from_epoch_ms(ms: Column) -> Column:
    """Epoch milliseconds to a timestamp; NULL stays NULL."""
    return F.timestamp_millis(ms)


def from_epoch_ms_whole_seconds(ms: Column) -> Column:
    """Epoch milliseconds to a timestamp with the milliseconds dropped."""
    return F.timestamp_seconds(whole_seconds(ms))


def whole_seconds(ms: Column) -> Column:
    """Integer division of epoch milliseconds by 1000."""
    return F.call_function("div", ms, F.lit(1000))


def weekday_monday0(ts: Column) -> Column:
    return F.weekday(ts)


def weekday_sunday0(ts: Column) -> Column:
    return F.dayofweek(ts) - 1


def calendar_parts(ts: Column, week_starts: str = "monday") -> dict[str, Column]:
    """hour, day, ISO week, month, year and weekday (0 is the named first day)."""
    weekday = {"monday": weekday_monday0, "sunday": weekday_sunday0}[week_starts]
    return {
        "hour": F.hour(ts),
        "day": F.dayofmonth(ts),
        "week": F.weekofyear(ts),
        "month": F.month(ts),
        "year": F.year(ts),
        "weekday": weekday(ts),
    }


def time_of_day(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm:ss.SSS")


def parse_date(text: Column, pattern: str = "yyyy-MM-dd") -> Column:
    """Text to date; NULL where the text does not match."""
    return F.try_to_date(text, pattern)


def month_start(year: Column, month: Column) -> Column:
    """First day of the month; NULL where the numbers name no month."""
    y, m = year.try_cast("int"), month.try_cast("int")
    return F.when(y.between(1, 9999) & m.between(1, 12), F.make_date(y, m, F.lit(1)))


def load_stamp() -> dict[str, Column]:
    """Current time and its epoch seconds, for marking a load."""
    return {"loaded_at": F.current_timestamp(), "loaded_epoch": F.unix_timestamp()}
