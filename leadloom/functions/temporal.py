"""Dates, durations and pick-the-first helpers on zone-less timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NTZ = "timestamp_ntz"


def iso_week(c: Column) -> Column:
    """ISO-8601 week, 1 to 53; only meaningful together with iso_year."""
    return F.extract(F.lit("WEEK"), c).cast("int")


def iso_year(c: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), c).cast("int")


def days_between(later: Column, earlier: Column) -> Column:
    """Whole 24-hour days, truncated toward zero (not a calendar difference)."""
    return F.extract(F.lit("DAY"), later - earlier).cast("int")


def first_non_null(*cols: Column) -> Column:
    return F.coalesce(*cols)


def last_activity(*cols: Column) -> Column:
    """Latest of the given timestamps; 1970-01-01 when all of them are NULL."""
    epoch = F.lit("1970-01-01 00:00:00").cast(NTZ)
    return F.greatest(*[F.coalesce(c.cast(NTZ), epoch) for c in cols])


def minutes_2dp(seconds: Column) -> Column:
    """Seconds as minutes, rounded half away from zero to two decimals."""
    return F.round(seconds.cast("decimal(38,6)") / F.lit(60).cast("decimal(2,0)"), 2)
