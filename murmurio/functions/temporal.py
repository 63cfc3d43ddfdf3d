"""Dates, timestamps and the period grid. The session time zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col

LOCAL_ZONE = "America/Sao_Paulo"

_ISO = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
    r"([T ][0-9]{2}(:[0-9]{2}(:[0-9]{2}([.,][0-9]{1,9})?)?)?(Z|[+-][0-9]{2}(:?[0-9]{2})?)?)?$"
)


def objectid_time(c: Column | str) -> Column:
    """Creation time in the first four bytes of a 24-digit hex id; other values -> null."""
    c = _col(c)
    seconds = F.conv(F.substring(c, 1, 8), 16, 10).cast("bigint")
    return F.when(c.rlike("^[0-9a-fA-F]{24}$"), F.timestamp_seconds(seconds))


def parse_iso(c: Column | str) -> Column:
    """ISO date or date-time; without an offset it is UTC, anything unreadable -> null."""
    c = _col(c).cast("string")
    text = F.replace(c, F.lit(","), F.lit("."))
    # hh and hh:mm are filled up to hh:mm:ss, an offset +hhmm or +hh to +hh:mm
    text = F.regexp_replace(text, r"^(.{10}[T ][0-9]{2})($|Z$|[+-])", "$1:00$2")
    text = F.regexp_replace(text, r"^(.{10}[T ][0-9]{2}:[0-9]{2})($|Z$|[+-])", "$1:00$2")
    text = F.regexp_replace(text, r"([T ].*[+-][0-9]{2})([0-9]{2})$", "$1:$2")
    text = F.regexp_replace(text, r"([T ].*[+-][0-9]{2})$", "$1:00")
    return F.when(c.rlike(_ISO), F.try_to_timestamp(text))


def parse_epoch(c: Column | str) -> Column:
    """Whole epoch seconds, fractions cut off; anything unreadable -> null."""
    number = _col(c).cast("string").try_cast("decimal(38,9)")
    return F.timestamp_seconds(F.when(number >= 0, F.floor(number)).otherwise(F.ceil(number)).cast("bigint"))


def utc_day(c: Column | str) -> Column:
    return F.to_date(_col(c))


def day_or_unknown(c: Column | str) -> Column:
    return F.coalesce(F.date_format(_col(c), "yyyy-MM-dd"), F.lit("unknown"))


def local_day(c: Column | str, zone: str = LOCAL_ZONE) -> Column:
    return F.to_date(F.from_utc_timestamp(_col(c), zone))


def _epoch(epoch: str | Column) -> Column:
    return F.to_date(F.lit(epoch)) if isinstance(epoch, str) else epoch


def period_start(day: Column | str, days: int, epoch: str | Column) -> Column:
    """Start of the period that holds the day, on a grid anchored at the epoch (also before it)."""
    day = _col(day)
    return F.date_sub(day, F.pmod(F.datediff(day, _epoch(epoch)), F.lit(days)))


def last_closed_period(day: Column | str, days: int, epoch: str | Column) -> Column:
    return F.date_sub(period_start(day, days, epoch), days)


def is_period_boundary(day: Column | str, days: int, epoch: str | Column) -> Column:
    return F.pmod(F.datediff(_col(day), _epoch(epoch)), F.lit(days)) == 0


def window_end(start: Column | str, weekly: Column) -> Column:
    """A day window ends the same day, a week window six days later."""
    start = _col(start)
    return F.when(weekly, F.date_add(start, 6)).otherwise(start)


def previous_day(as_of: Column | str) -> Column:
    return F.date_sub(F.to_date(_col(as_of)), 1)


def month_windows(start: Column | str, end: Column | str) -> Column:
    """[start, end) cut at month starts, as an array of (after, before) epoch seconds."""
    start, end = F.to_date(_col(start)), F.to_date(_col(end))
    months = F.sequence(F.trunc(start, "MM"), end, F.expr("interval 1 month"))
    windows = F.transform(
        months,
        lambda m: F.struct(
            F.unix_timestamp(F.greatest(m, start).cast("timestamp")).alias("after"),
            F.unix_timestamp(F.least(F.add_months(m, 1), end).cast("timestamp")).alias("before"),
        ),
    )
    return F.when(start < end, F.filter(windows, lambda w: w["after"] < w["before"])).otherwise(
        F.filter(windows, lambda w: F.lit(False))
    )


def slice_is_due(slice_start: Column | str, today: Column) -> Column:
    """A past day is collected by its 00h slice only, today by every slice."""
    slice_start = _col(slice_start)
    return (F.to_date(slice_start) == today) | (F.hour(slice_start) == 0)


def in_iso_window(c: Column | str, first_day: str, last_day: str) -> Column:
    """Compare ISO text with [first day 00:00:00, last day 23:59:59] as text."""
    return _col(c).between(f"{first_day}T00:00:00Z", f"{last_day}T23:59:59Z")


def on_day(c: Column | str, day: str, mode: str = "half_open") -> Column:
    """Rows of one day. ``whole_seconds`` ends at 23:59:59 sharp and so leaves out what was
    collected within the last second; ``half_open`` ends before the next midnight."""
    c = _col(c).cast("timestamp")
    start = F.lit(day).cast("date")
    if mode == "whole_seconds":
        return c.between(start.cast("timestamp"), F.lit(f"{day} 23:59:59").cast("timestamp"))
    if mode == "half_open":
        return (c >= start.cast("timestamp")) & (c < F.date_add(start, 1).cast("timestamp"))
    raise ValueError(f"unknown mode {mode!r}")


def is_short_video(duration: Column | str) -> Column:
    """ISO-8601 duration without minutes or hours."""
    d = F.coalesce(_col(duration), F.lit("PT0S"))
    return ~d.contains("M") & ~d.contains("H")
