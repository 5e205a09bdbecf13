"""Time windows of the article and behaviour jobs.

Every window is computed from an ``as_of`` column (a literal, or a scalar
subquery such as ``max(article_time)``), never from the wall clock, so a job
re-run over the same input gives the same rows.  Bounds are half-open
``[start, end)`` unless stated.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the reference's schedule.
# hourly job: the window ends at minute 30 of the current hour and spans 2 hours
HOURLY_END_MINUTE = 30
HOURLY_SPAN_HOURS = 2
# similarity job: "new" articles are from the last 2 hours, history the last 30 days
NEW_ARTICLE_HOURS = 2
HISTORY_DAYS = 30
# recall job: behaviour from the last 60 days
BEHAVIOUR_DAYS = 60


def as_of_literal(value: str | dt.datetime) -> Column:
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(value).cast("timestamp_ntz")


def latest(df: DataFrame, col: str) -> Column:
    """``max(col)`` of a DataFrame as a scalar subquery column (no collect)."""
    return df.select(F.max(col)).scalar()


def _minutes(n: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(n))


def hourly_window(as_of: Column) -> tuple[Column, Column]:
    """[end - 2h, end) with end = the as_of hour at minute 30."""
    end = F.date_trunc("hour", as_of) + _minutes(HOURLY_END_MINUTE)
    return end - _minutes(HOURLY_SPAN_HOURS * 60), end


def day_window(as_of: Column, days: int = 1) -> tuple[Column, Column]:
    """[d - days, d) with d = midnight of the as_of day."""
    end = F.date_trunc("day", as_of)
    return end - F.make_dt_interval(F.lit(days)), end


def since_hours(as_of: Column, hours: int) -> Column:
    """Hour-aligned lower bound: trunc_hour(as_of) - hours."""
    return F.date_trunc("hour", as_of) - _minutes(hours * 60)


def since_days(as_of: Column, days: int) -> Column:
    return F.date_trunc("hour", as_of) - F.make_dt_interval(F.lit(days))


def behaviour_date_limit(as_of: Column, days: int = BEHAVIOUR_DAYS) -> Column:
    """'yyyy-MM-dd' text of (trunc_hour(as_of) - days); rows need dt > it."""
    return F.date_format(since_days(as_of, days), "yyyy-MM-dd")


def in_window(c: Column, bounds: tuple[Column, Column]) -> Column:
    start, end = bounds
    return (c >= start) & (c < end)
