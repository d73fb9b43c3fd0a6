"""Day, week and month keys, date filters and exact time arithmetic.

Dates are ``yyyy-MM-dd`` strings, which order like the days they name.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Name of the period column by period, reporting time zone and delay in days.
PERIOD_COLUMNS = {"day": "date", "week": "week_of_monday", "month": "year_month"}
REPORT_ZONE = "Asia/Tokyo"
REPORT_DELAY_DAYS = 8


def week_label(date: Column, week_start: str = "sunday") -> Column:
    """Monday that labels the week of ``date``, as a string.

    With ``week_start="sunday"`` weeks run Sunday to Saturday and carry the Monday inside them,
    so a Sunday gets the *following* day. ``"iso"`` gives weeks that run Monday to Sunday.
    """
    day = date.cast("date")
    if week_start == "sunday":
        monday = F.date_add(day, 2 - F.dayofweek(day))
    elif week_start == "iso":
        monday = F.trunc(day, "week")
    else:
        raise ValueError(f"week_start must be 'sunday' or 'iso', not {week_start!r}")
    return monday.cast("string")


def month_label(when: Column) -> Column:
    """``yyyy-MM`` of a date, timestamp or date string."""
    return F.substring(when.cast("date").cast("string"), 1, 7)


def month_start(date: Column) -> Column:
    """First day of the month of ``date``, as a string."""
    return F.trunc(date.cast("date"), "month").cast("string")


def with_period(visits: DataFrame, period: str, week_start: str = "sunday") -> DataFrame:
    """Add the period column, unless it is there. Days and weeks follow ``date``, months ``datetime``."""
    if PERIOD_COLUMNS.get(period) in visits.columns:
        return visits
    if period == "week":
        return visits.withColumn(PERIOD_COLUMNS["week"], week_label(F.col("date"), week_start))
    if period == "month":
        return visits.withColumn(PERIOD_COLUMNS["month"], month_label(F.col("datetime")))
    raise ValueError(f"period must be one of {sorted(PERIOD_COLUMNS)}, not {period!r}")


def on_days(
    df: DataFrame,
    start: str | None = None,
    end: str | None = None,
    days: Iterable[str] | None = None,
) -> DataFrame:
    """Rows whose ``date`` lies in ``[start, end]`` and, if given, in ``days``.

    Plain comparisons with literals, so they prune partitions and reach the scan.
    """
    if start is not None:
        df = df.where(F.col("date") >= start)
    if end is not None:
        df = df.where(F.col("date") <= end)
    if days is not None:
        df = df.where(F.col("date").isin(sorted(set(days))))
    return df


def bounds(
    start: str | None = None, end: str | None = None, days: Iterable[str] | None = None
) -> tuple[str | None, str | None]:
    """First and last day that :func:`on_days` can let through; ``None`` is no bound."""
    chosen = sorted(set(days)) if days is not None else []
    firsts = [day for day in (start, *chosen[:1]) if day is not None]
    lasts = [day for day in (end, *chosen[-1:]) if day is not None]
    return max(firsts, default=None), min(lasts, default=None)


def whole_periods(period: str, start: str, end: str) -> tuple[str, str]:
    """First and last day of the days, Sunday weeks or months that ``start`` to ``end`` touches."""
    first, last = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    if period == "week":
        first -= dt.timedelta(days=first.isoweekday() % 7)
        last += dt.timedelta(days=6 - last.isoweekday() % 7)
    elif period == "month":
        first = first.replace(day=1)
        last = (last.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)
    elif period != "day":
        raise ValueError(f"period must be one of {sorted(PERIOD_COLUMNS)}, not {period!r}")
    return first.isoformat(), last.isoformat()


def month_starts(start: str, end: str) -> list[str]:
    """First days of the months from that of ``start`` to that of ``end``."""
    months, month = [], dt.date.fromisoformat(start).replace(day=1)
    while month.isoformat() <= end:
        months.append(month.isoformat())
        month = (month + dt.timedelta(days=32)).replace(day=1)
    return months


def micros(df: DataFrame, column: str) -> Column:
    """Microseconds since 1970 of a timestamp column.

    A timestamp without time zone is read from its own calendar fields, so the result depends
    neither on the session time zone nor on daylight-saving changes.
    """
    when = F.col(column)
    if not isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return F.unix_micros(when)
    minutes = F.unix_date(when.cast("date")).cast("long") * 1440 + F.hour(when) * 60 + F.minute(when)
    second = F.extract(F.lit("SECOND"), when) * 1_000_000
    return minutes * 60_000_000 + second.cast("long")


def report_day(
    now: dt.datetime | None = None, zone: str = REPORT_ZONE, delay_days: int = REPORT_DELAY_DAYS
) -> str:
    """Default run date: the local day ``delay_days`` ago, when late contacts have arrived."""
    now = now or dt.datetime.now(dt.timezone.utc)
    return (now.astimezone(ZoneInfo(zone)) - dt.timedelta(days=delay_days)).strftime("%Y-%m-%d")
