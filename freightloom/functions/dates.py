"""Dates and timestamps without time zone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from freightloom.functions.keys import _col


def moment(value: datetime | str) -> Column:
    """A point in time as a zone-free literal. Stands in for the wall clock."""
    text = value if isinstance(value, str) else value.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def parse_moment(c: Column | str) -> Column:
    """ISO-8601 text to a zone-free timestamp, NULL when it is none."""
    return _col(c).try_cast("timestamp_ntz")


def date_key(c: Column | str) -> Column:
    """Day as the integer ``YYYYMMDD``."""
    day = _col(c)
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def date_parts(c: Column | str) -> dict[str, Column]:
    """The attributes of a calendar day, Sunday being weekday 1."""
    day = _col(c)
    return {
        "date_sk": date_key(day),
        "full_date": day.cast("date"),
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "week_of_year": F.weekofyear(day),
        "day_of_month": F.dayofmonth(day),
        "day_of_week": F.dayofweek(day),
        "day_name": F.date_format(day, "EEEE"),
        "is_weekend": F.dayofweek(day).isin(1, 7),
    }


def display_moment(c: Column | str) -> Column:
    """``dd.MM.yyyy HH:mm`` for documents, a dash when missing."""
    return F.coalesce(F.date_format(_col(c), "dd.MM.yyyy HH:mm"), F.lit("–"))


def epoch_seconds(c: Column | str) -> Column:
    """Whole seconds since 1970 of a zone-free timestamp read as UTC."""
    return F.floor(F.unix_micros(_col(c).cast("timestamp")) / F.lit(1_000_000)).cast("long")


def plus_seconds(c: Column | str, seconds: Column | int) -> Column:
    """Timestamp shifted by a number of seconds."""
    shift = seconds if isinstance(seconds, Column) else F.lit(seconds)
    return (_col(c) + F.make_dt_interval(secs=shift)).cast("timestamp_ntz")
