"""Timestamps in and out of text, local days and regular time axes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# English month abbreviations, in calendar order.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")

#: Steps of a time axis that one array holds.
BLOCK = 10_000

ISO_Z = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _as_timestamp(text: Column, strict: bool) -> Column:
    return text.cast("timestamp") if strict else text.try_cast("timestamp")


def month_number(text: Column) -> Column:
    """Two-digit month of the first calendar month named in the text, else ``01``."""
    found = F.lit(None)
    for number, name in reversed(list(enumerate(MONTHS, start=1))):
        found = F.when(text.contains(name), F.lit(f"{number:02d}")).otherwise(found)
    return F.coalesce(found, F.lit("01"))


def parse_played_at(text: Column, strict: bool = False) -> Column:
    """``'08 Dec 2025, 05:31'`` to a UTC timestamp.

    The parts are searched for one by one, so odd text can still parse: the year is the
    first run of four digits, the day one or two leading digits, the time the first
    ``dd:dd``. A missing part gives NULL. A date that does not exist gives NULL too, or
    an error with ``strict``.
    """
    return _as_timestamp(
        F.concat(
            F.regexp_substr(text, F.lit(r"\d{4}")),
            F.lit("-"),
            month_number(text),
            F.lit("-"),
            F.lpad(F.regexp_substr(text, F.lit(r"^\d{1,2}")), 2, "0"),
            F.lit(" "),
            F.regexp_substr(text, F.lit(r"\d{2}:\d{2}")),
            F.lit(":00"),
        ),
        strict,
    )


def parse_iso(text: Column, source_zone: str | None = None, strict: bool = False) -> Column:
    """ISO text to a UTC timestamp; ``source_zone`` re-reads a wall clock stamped as UTC.

    The text must start with a full date: Spark alone would take today for a bare time of day.
    With ``strict`` any other text raises, as an impossible date does; NULL stays NULL.
    """
    undated = F.concat(F.lit("undated "), text) if strict else F.lit(None)
    dated = F.when(F.btrim(text).rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), text).otherwise(undated)
    stamp = _as_timestamp(dated, strict)
    return F.to_utc_timestamp(stamp, source_zone) if source_zone else stamp


def iso_z(stamp: Column) -> Column:
    return F.date_format(stamp, ISO_Z)


def epoch_timestamp(text: Column) -> Column:
    """Epoch seconds held as text to a timestamp."""
    return F.timestamp_seconds(text.try_cast("bigint"))


def duration_minutes(milliseconds: Column) -> Column:
    return F.round(milliseconds / F.lit(60000), 2)


def local_day_bounds(day: dt.date | str | Column, zone: str) -> tuple[Column, Column]:
    """First and last epoch second of a local calendar day (23, 24 or 25 hours long).

    For a fixed day both are constants to the optimizer, so a filter reaches the scan.
    """
    if not isinstance(day, Column):
        day = F.lit(str(day)).cast("date")

    def midnight(d: Column) -> Column:
        return F.unix_timestamp(F.to_utc_timestamp(d.cast("timestamp"), zone))

    return midnight(day), midnight(F.date_add(day, 1)) - 1


def in_local_day(epoch_seconds: Column, day: dt.date | str | Column, zone: str) -> Column:
    first, last = local_day_bounds(day, zone)
    return epoch_seconds.between(first, last)


def local_date(stamp: Column, zone: str) -> Column:
    """The calendar day a UTC timestamp falls on in ``zone``."""
    return F.to_date(F.from_utc_timestamp(stamp, zone))


def time_axis(df: DataFrame, start: str, end: str, step: str, name: str) -> DataFrame:
    """One row per step from ``start`` up to but without ``end`` (epoch seconds columns).

    Blocks of steps come first, then the steps of each block, so no row ever holds more than a
    block or the list of blocks, however fine the step.
    """
    lo, hi, by = F.col(start), F.col(end), F.col(step)
    wide = by * BLOCK
    blocks = df.where(hi > lo).select("*", F.explode(F.sequence(lo, hi - 1, wide)).alias(name))
    first = F.col(name)
    ticks = F.sequence(first, F.least(first + wide, hi) - 1, by)
    return blocks.withColumn(name, F.explode(ticks)).withColumn(name, F.timestamp_seconds(name))
