"""Timestamps: parsing, shifting, differences, ages, key texts. The session zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# A time without an offset is ambiguous and does not fit.
OFFSET_TIME = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:?\d{2})$"


def offset_timestamp(text: Column, local_tz: str | None = None, strict: bool = True) -> Column:
    """ISO time with a ``+0100``, ``+01:00`` or ``Z`` offset as naive UTC (or naive local) time.

    Other text raises; with ``strict=False`` it gives null. Null stays null.
    """
    parsed = F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX][XX]"))
    utc = F.when(text.rlike(OFFSET_TIME), parsed)
    if strict:
        wrong = F.raise_error(F.concat(F.lit("not a time with an offset: "), text)).cast("timestamp")
        utc = F.when(text.isNotNull() & utc.isNull(), wrong).otherwise(utc)
    return F.from_utc_timestamp(utc, local_tz) if local_tz else utc


def us_timestamp(date: Column, time: Column) -> Column:
    """``3/7/2020`` and ``1:05:09 PM``; wrong text raises, a missing part gives null."""
    return F.to_timestamp(F.concat(date, F.lit("_"), time), "M/d/yyyy_h:mm:ss a")


def iso_timestamp(date: Column, time: Column) -> Column:
    """``2020-03-07`` and ``13:05:09``; wrong text raises, a missing part gives null."""
    return F.to_timestamp(F.concat(date, F.lit("_"), time), "yyyy-MM-dd_HH:mm:ss")


def german_timestamp(text: Column) -> Column:
    """``07.03.2020 13:05:09``; wrong text gives null."""
    return F.try_to_timestamp(text, F.lit("d.M.yyyy H:m:s"))


def german_date(text: Column) -> Column:
    """``07.03.2020`` as midnight; wrong text gives null."""
    return F.try_to_timestamp(text, F.lit("d.M.yyyy"))


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds from start to end with their fraction."""
    return (micros(end) - micros(start)) / F.lit(1e6)


def minutes_between(start: Column, end: Column) -> Column:
    return seconds_between(start, end) / F.lit(60.0)


def embedded_clock_time(code: Column, ts: Column, pattern: str) -> Column:
    """Day of ``ts`` plus the HHMM after the first dot of a code matching ``pattern``.

    Hours from 24 and minutes from 60 roll over. Other codes keep ``ts``.
    """
    digits = F.get(F.split(code, r"\.", 2), F.lit(1))
    shift = F.make_dt_interval(
        hours=F.substring(digits, 1, 2).try_cast("int"),
        mins=F.substring(digits, 3, 2).try_cast("int"),
    )
    clock = (F.date_trunc("day", ts) + shift).cast("timestamp")
    return F.when(code.rlike(pattern), clock).otherwise(ts.cast("timestamp"))


def on_quarter_hour(ts: Column) -> Column:
    return F.minute(ts) % 15 == 0


def date_unless_year(date: Column, fallback: Column, year: int) -> Column:
    """``date``, or ``fallback`` where ``date`` is only a placeholder of that year."""
    return F.when(F.year(date) == year, fallback).otherwise(date)


def age_in_years(age: Column, birth: Column, at: Column) -> Column:
    """The given age, else the days since birth in years of 365.25 days, half-even."""
    years = F.bround(F.datediff(at, birth) / F.lit(365.25), 0).cast("long")
    return F.coalesce(age.cast("long"), years)


def age_decade(age: Column) -> Column:
    return F.ceil(age / 10)


def anchor_key(case: Column, ts: Column) -> Column:
    """Text key ``<case>+<yyyy-MM-dd_HH:mm:ss>``, null if a part is."""
    return F.concat(case.cast("string"), F.lit("+"), F.date_format(ts, "yyyy-MM-dd_HH:mm:ss"))


def window_label(i: int, hours: int) -> str:
    return f"{i * hours}-{(i + 1) * hours}h"
