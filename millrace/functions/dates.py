"""Date helpers.  Dates that depend on "today" take it as an argument."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

YEAR_FIRST = "yyyy-MM-dd"
DAY_FIRST = "dd-MM-yyyy"
CLOCK = "HHmm"


def as_of_date(as_of: dt.date | Column | None) -> Column:
    """A date column: the given day, or the current date of the query."""
    if as_of is None:
        return F.current_date()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")


def as_of_time(now: dt.datetime | Column | None) -> Column:
    """A timestamp column: the given moment, or the query's own.

    A moment without an offset is meant in the session's time zone.
    """
    if now is None:
        return F.current_timestamp()
    return now if isinstance(now, Column) else F.lit(now.isoformat()).cast("timestamp")


def parse_day(text: Column, pattern: str = YEAR_FIRST) -> Column:
    """Parse a day written in a fixed pattern; NULL when it does not match."""
    return F.try_to_timestamp(text, F.lit(pattern)).cast("date")


def parse_iso_day(text: Column) -> Column:
    """Day of an ISO date or timestamp text; NULL when it is neither."""
    return text.try_cast("date")


def clock_text(moment: Column, pattern: str = CLOCK) -> Column:
    return F.date_format(moment, pattern)


def age_in_years(born: Column, as_of: Column) -> Column:
    """Days lived divided by 365, rounded half up; leap days are ignored."""
    return F.round(F.datediff(as_of, born) / F.lit(365)).cast("int")


def age_flag(computed: Column, stated: Column) -> Column:
    return F.when(computed == stated, F.lit("valid")).otherwise(F.lit("invalid"))
