"""Date and time expressions.  Stored times carry no zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from wireloom import fixed_values as fv


def newsroom_time(iso_text: Column, hours: int = fv.PUBLISH_OFFSET_HOURS) -> Column:
    """ISO text to a zone-less timestamp: the offset is dropped, then hours are added.

    NULL where the text is not a timestamp.
    """
    return iso_text.try_cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(hours))


def tomorrow(zone: str = fv.NEWSROOM_TIME_ZONE, utc: Column | None = None) -> Column:
    """The day after today in a zone; ``utc`` is a clock without a zone that stands for now."""
    source = None if utc is None else F.lit("UTC")
    clock = F.convert_timezone(source, F.lit(zone), F.localtimestamp() if utc is None else utc)
    return F.date_add(F.to_date(clock), 1)


def anniversaries(as_of: Column, first_year: int = fv.FIRST_ARCHIVE_YEAR) -> Column:
    """Array of the same month and day in each year from ``first_year`` to the year before.

    29 February becomes 28 February in common years.
    """
    year = F.year(as_of)
    years = F.when(year > first_year, F.sequence(F.lit(first_year), year - 1)).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(years, lambda past: F.add_months(as_of, (past - year) * 12))


def anniversary_days(as_of: dt.date, first_year: int = fv.FIRST_ARCHIVE_YEAR) -> list[dt.date]:
    """The same list for one known day, to be used as literals in a pushed-down filter."""
    leap_day = (as_of.month, as_of.day) == (2, 29)

    def in_year(year: int) -> dt.date:
        common = leap_day and (year % 4 != 0 or (year % 100 == 0 and year % 400 != 0))
        return dt.date(year, 2, 28) if common else as_of.replace(year=year)

    return [in_year(year) for year in range(first_year, as_of.year)]


def on_days(time: Column, days: list[dt.date]) -> Column:
    """True where a zone-less timestamp falls on one of the days.

    Written as half-open ranges, which the Parquet reader can use to skip row groups.
    """
    hit = F.lit(False)
    for day in sorted(set(days)):
        # Text literals: a Python datetime would pass through the machine's own zone.
        start = F.lit(day.isoformat()).cast("timestamp_ntz")
        end = F.lit((day + dt.timedelta(days=1)).isoformat()).cast("timestamp_ntz")
        hit = hit | ((time >= start) & (time < end))
    return hit


def micros(time: Column) -> Column:
    """Microseconds of a zone-less timestamp since 1970, whatever the session's zone.

    Put together from its fields; the built-in differences would first read it as
    a local time, which daylight saving makes ambiguous.
    """
    minutes = (F.unix_date(F.to_date(time)).cast("bigint") * 24 + F.hour(time)) * 60 + F.minute(time)
    seconds = F.date_part(F.lit("SECOND"), time)
    return minutes * 60_000_000 + (seconds * 1_000_000).cast("bigint")


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Whole seconds between two zone-less timestamps."""
    return F.floor((micros(end) - micros(start)) / 1_000_000)
