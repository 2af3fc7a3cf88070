"""Instants: whole-unit differences, text forms, month keys."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(value: dt.datetime | str) -> Column:
    """A UTC instant literal. Naive datetimes and bare text are taken as UTC."""
    if isinstance(value, dt.datetime):
        if value.tzinfo is not None:
            value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
        value = value.isoformat(sep=" ")
    return F.lit(f"{value}").cast("timestamp")


def utc(micros: int | None) -> dt.datetime | None:
    """The instant so many microseconds after 1970, as Python has it."""
    return None if micros is None else dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(microseconds=micros)


def days_before(as_of: dt.datetime | str, days: int) -> dt.datetime:
    day = dt.datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    return day - dt.timedelta(days=days)


def whole(unit: str, start: Column, end: Column) -> Column:
    """Whole elapsed units from start to end, truncated toward zero."""
    return F.timestamp_diff(unit, start, end)


def rfc3339(ts: Column) -> Column:
    """UTC text with offset; microseconds appear only when there are any."""
    has_fraction = F.pmod(F.unix_micros(ts), F.lit(1_000_000)) != 0
    return F.when(has_fraction, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")).otherwise(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")
    )


def to_seconds_text(ts: Column) -> Column:
    """UTC text cut to the second, without offset."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def month_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def chunk_key(start: Column, end: Column) -> Column:
    """File-name form of a time range, to the second.

    Ranges under two seconds are named to the microsecond, as several may
    share their seconds; longer ones that do not overlap cannot.
    """
    short = F.unix_micros(end) - F.unix_micros(start) < 2_000_000

    def named(stamp: str) -> Column:
        return F.concat(F.date_format(start, stamp), F.lit("__"), F.date_format(end, stamp), F.lit(".parquet"))

    return F.when(short, named("yyyyMMdd'T'HHmmss.SSSSSS")).otherwise(named("yyyyMMdd'T'HHmmss"))
