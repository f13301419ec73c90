"""Date and time expressions. Zone-free timestamps are read as UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros(c: str | Column) -> Column:
    """Epoch microseconds of a timestamp with or without zone."""
    return F.unix_micros(_col(c).cast("timestamp"))


def millis(c: str | Column) -> Column:
    """Epoch milliseconds (floor)."""
    return F.unix_millis(_col(c).cast("timestamp"))


def from_millis(c: str | Column) -> Column:
    """Epoch milliseconds to timestamp."""
    return F.timestamp_millis(_col(c))


def from_micros(c: str | Column) -> Column:
    """Epoch microseconds to timestamp."""
    return F.timestamp_micros(_col(c))


def micros_text(c: str | Column) -> Column:
    """Epoch microseconds as ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(from_micros(c), "yyyy-MM-dd HH:mm:ss")


def date_key(c: str | Column) -> Column:
    """``yyyymmdd`` as an integer, from arithmetic rather than text formatting."""
    d = _col(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def iso_weekday(c: str | Column) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return F.weekday(_col(c)) + 1


def sunday_week(c: str | Column) -> Column:
    """Week of the year, weeks starting on Sunday, days before the first Sunday in week 0."""
    d = _col(c)
    return F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7).cast("int")


def iso_week_label(c: str | Column) -> Column:
    """Calendar year and ISO week, ``2024-W05``."""
    d = _col(c)
    return F.concat(F.year(d).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(d).cast("string"), 2, "0"))


def weekday_hour_label(c: str | Column) -> Column:
    """``Monday_09``."""
    return F.date_format(_col(c), "EEEE_HH")


def day_name(c: str | Column) -> Column:
    return F.date_format(_col(c), "EEEE")


def whole_days_between(start: Column, end: str | Column) -> Column:
    """Elapsed full days (floor), not calendar days."""
    return F.floor((micros(end) - micros(start)) / MICROS_PER_DAY).cast("long")


def partition_parts(c: str | Column) -> dict[str, Column]:
    """Zero-padded year, month and day for lake paths."""
    t = _col(c)
    return {
        "year": F.date_format(t, "yyyy"),
        "month": F.date_format(t, "MM"),
        "day": F.date_format(t, "dd"),
    }
