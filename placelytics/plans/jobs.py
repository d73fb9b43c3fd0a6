"""The reports as jobs: operators plus the folders and partitions their results go to.

Each job takes its inputs as DataFrames and writes under ``out``, a folder all executors share.
Days and places are ranges and lists of one job, not runs of their own. The visits are read
once per job; what several reports need of them is kept in the cluster's checkpoint folder and
removed when the job ends. Every job returns the folders it wrote.

A job replaces the days (weeks, months) and places it is asked for and nothing else: results it finds
no more are withdrawn, and results of other days stay as they are. Results by month need whole months.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placelytics.functions.time import PERIOD_COLUMNS, month_starts, on_days, report_day, week_label, whole_periods
from placelytics.operators import bitmaps, buyers, movement, overlap, poslink, profiles, repeat, skew, visits
from placelytics.sources import arrivals
from placelytics.sources.readers import PARTITIONS, read_linked
from placelytics.sources.sinks import publish, with_partitions

# Folders of the results. Daily movement, which would share one, has a folder of its own.
PERIOD_FOLDERS = {"day": "daily", "week": "weekly", "month": "monthly"}
MOVEMENT_FOLDERS = {"month": "moving", "day": "moving_daily"}


@contextmanager
def _computed_once(df: DataFrame) -> Iterator[DataFrame]:
    """``df``, computed into the cluster's checkpoint folder and removed from there at the end.

    It holds device ids, so it never goes under the published folder: a cluster that names no
    checkpoint folder is refused.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.getCheckpointDir()
    if shared is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = f"{shared}/job-{uuid.uuid4().hex}"
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _within(first: str | None, last: str | None) -> Callable[[str], bool]:
    return lambda name: (first is None or first <= name) and (last is None or name <= last)


def _places(places: DataFrame) -> Callable[[str], bool]:
    """Whether a place is in a place list; the names of a list, not of visits, are collected."""
    return {str(row[0]) for row in places.select("place_id").distinct().collect()}.__contains__


def _whole_months(start: str, end: str) -> None:
    if (start, end) != whole_periods("month", start, end):
        raise ValueError(f"results by month need whole months, not {start} to {end}")


def overlap_reports(
    visits_table: DataFrame,
    config: DataFrame,
    out: str,
    *,
    start: str | None = None,
    end: str | None = None,
    days: Iterable[str] | None = None,
    periods: Iterable[str] = tuple(PERIOD_FOLDERS),
    format: str = "parquet",
) -> list[str]:
    """Place overlap per day, week and month up to ``end``, by place and period.

    With ``start`` only the days, weeks and months that ``start`` to ``end`` touches are computed, each
    of them whole; with ``days`` only those that a listed day lies in; without either all since the places
    opened.
    """
    end, periods = end or report_day(), list(periods)
    if days is not None and start is not None:
        raise ValueError("give start or days, not both")
    if days is not None:
        whole = {p: _whole_days(p, days, end) for p in periods}
        spans = {p: (None, end, chosen) for p, chosen in whole.items()}
        chosen_labels = {p: {_label(p, day) for day in chosen} for p, chosen in whole.items()}
        read = {"end": end, "days": sorted(set().union(*whole.values()))}
    else:
        spans = {p: whole_periods(p, start, end) if start else (None, end) for p in periods}
        first = min(s for s, _ in spans.values()) if start else None
        read = {"start": first, "end": max(e for _, e in spans.values())}
    monitored = visits.monitored_days(visits_table, config, **read)
    listed = _places(config)
    written = []
    with _computed_once(monitored) as seen:
        for period, span in spans.items():
            pairs = overlap.overlap(visits.in_period(on_days(seen, *span), period), period)
            folder, key = f"{out}/duplication/{PERIOD_FOLDERS[period]}", PERIOD_COLUMNS[period]
            order = ["competitor_id", "duplication_place_id", "duplication_competitor_id"]
            if days is not None:
                in_scope = chosen_labels[period].__contains__
            else:
                in_scope = _within(*_labels(seen.sparkSession, period, *span))
            scope = {"place_id": listed, key: in_scope}
            publish(pairs, folder, ["place_id", key], sort_by=order, format=format, scope=scope)
            written.append(folder)
    return written


def _whole_days(period: str, days: Iterable[str], end: str) -> list[str]:
    """Every day up to ``end`` of the days, weeks or months that ``days`` lie in."""
    every = set()
    for first, last in {whole_periods(period, day, day) for day in days}:
        day, last = dt.date.fromisoformat(first), min(last, end)
        while day.isoformat() <= last:
            every.add(day.isoformat())
            day += dt.timedelta(days=1)
    return sorted(every)


def _label(period: str, day: str) -> str:
    """Label of the period of a day: the day, the Monday in its Sunday week, or its month."""
    if period == "week":
        return (dt.date.fromisoformat(whole_periods("week", day, day)[0]) + dt.timedelta(days=1)).isoformat()
    return day[:7] if period == "month" else day


def refresh(visits_table: DataFrame, state: str, report: Callable[[list[str]], list[str]]) -> list[str]:
    """Run ``report`` for the days that files touched which arrived since the last run; return what it wrote.

    How far arrivals have been worked off is kept in ``state``, one file, and moves on only after
    the report has been published: a run that fails is made up for by the next. The first run takes all
    days. A file whose time of writing lies before that of the last run, such as one copied with its
    old time, goes unnoticed. ``visits_table`` must be a scan of files.
    """
    spark, path = visits_table.sparkSession, f"{state}/arrivals"
    until = arrivals.latest_arrival(visits_table)
    after = spark.read.parquet(path).first()["until"] if _exists(spark, path) else None
    if until is None or until == after:
        return []
    days = arrivals.touched_days(visits_table, after, until)
    written = report(days) if days else []
    spark.createDataFrame([(until,)], "until timestamp").coalesce(1).write.mode("overwrite").parquet(path)
    return written


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def refresh_overlap_reports(
    visits_table: DataFrame, config: DataFrame, out: str, state: str, *, end: str | None = None, **options
) -> list[str]:
    """:func:`overlap_reports` of the periods alone that newly arrived files touch."""
    end = end or report_day()

    def report(days: list[str]) -> list[str]:
        due = [day for day in days if day <= end]
        return overlap_reports(visits_table, config, out, end=end, days=due, **options) if due else []

    return refresh(visits_table, state, report)


def update_overlap_state(
    visits_table: DataFrame,
    config: DataFrame,
    state: str,
    *,
    start: str | None = None,
    end: str | None = None,
    days: Iterable[str] | None = None,
    periods: Iterable[str] = tuple(PERIOD_FOLDERS),
) -> None:
    """Add days to the bitmaps of devices by place and period under ``state``.

    Only the added days are read of the visits, and only the periods they lie in are rewritten. Adding a
    day again changes nothing, so a run that failed is simply repeated. Devices are never taken out: if rows
    of a day were withdrawn, build its periods anew under another ``state``. One run at a time.
    """
    spark = visits_table.sparkSession
    devices_path = f"{state}/devices"
    with _computed_once(visits.monitored_days(visits_table, config, start=start, end=end, days=days)) as seen:
        known = spark.read.schema(bitmaps.DEVICES).parquet(devices_path) if _exists(spark, devices_path) else None
        last = known.agg(F.max("number").alias("last")).first()["last"] if known is not None else None
        fresh = bitmaps.new_devices(seen, known, 0 if last is None else last + 1)
        fresh.write.mode("append").parquet(devices_path)
        devices = spark.read.schema(bitmaps.DEVICES).parquet(devices_path)
        for period in periods:
            key, folder = PERIOD_COLUMNS[period], f"{state}/{PERIOD_FOLDERS[period]}"
            new = bitmaps.device_bitmaps(seen, devices, period)
            if _exists(spark, folder):
                old = _state(spark, folder, key, new)
                new = bitmaps.merged(new, old.join(new.select(key).distinct(), key, "left_semi"))
            with _computed_once(new) as complete:
                publish(complete, folder, [key])


def _state(spark: SparkSession, folder: str, key: str, like: DataFrame) -> DataFrame:
    """Stored bitmaps with their period as text."""
    return spark.read.schema(like.schema).parquet(folder).select(*like.columns)


def overlap_state(spark: SparkSession, state: str, period: str) -> DataFrame:
    """The stored bitmaps of a period, for :mod:`operators.bitmaps` to count."""
    key = PERIOD_COLUMNS[period]
    columns = f"place_id string, competitor_id int, bucket long, bitmap binary, {key} string"
    return spark.read.schema(columns).parquet(f"{state}/{PERIOD_FOLDERS[period]}")


def _labels(spark: SparkSession, period: str, first: str | None, last: str) -> tuple[str | None, str]:
    """Labels of the first and last period of a span."""
    if period == "day":
        return first, last
    if period == "month":
        return first and first[:7], last[:7]
    span = spark.range(1).select(week_label(F.lit(first)).alias("first"), week_label(F.lit(last)).alias("last")).first()
    return span["first"], span["last"]


def profile_reports(
    visits_table: DataFrame,
    config: DataFrame,
    home_work: DataFrame,
    topics: DataFrame,
    cohorts: DataFrame,
    out: str,
    *,
    start: str | None = None,
    end: str | None = None,
    days: Iterable[str] | None = None,
    prefectures: Iterable[str] = profiles.PREFECTURES,
    category: str = profiles.INTEREST_CATEGORY,
    slotted: bool = False,
    format: str = "parquet",
) -> list[str]:
    """Home and work areas, topics, and cohorts by topic, by day; by default of one day.

    ``slotted`` is for device tables of long histories.
    """
    if start is None and end is None and days is None:
        days = [report_day()]
    days = days if days is None else sorted(set(days))
    span = {"start": start, "end": end, "days": days}
    in_span = _within(start, end)
    scope = {"date": lambda name: in_span(name) and (days is None or name in days)}
    with _computed_once(visits.device_days(visits_table, config, **span)) as own, _skew_joins(own.sparkSession):
        hot = skew.hot_cells(own, ["adid"])
        configured = visits.configured_only(own, config)
        reports = {
            "location": profiles.profile_location(own, home_work, prefectures=prefectures, slotted=slotted, **span),
            "topic": profiles.profile_topic(configured, topics, hot=hot),
            "topic_to_cohort": profiles.profile_cohort(own, cohorts, topics, category=category, hot=hot, slotted=slotted, **span),
        }
        for name, report in reports.items():
            keys = [c for c in report.columns if c not in ("date", "count")]
            publish(report, f"{out}/{name}", ["date"], sort_by=keys, format=format, scope=scope)
    return [f"{out}/{name}" for name in reports]


@contextmanager
def _skew_joins(spark: SparkSession) -> Iterator[None]:
    """Split devices that are hot in a device table also in a join that another follows; restored at the end."""
    key = "spark.sql.adaptive.forceOptimizeSkewedJoin"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def movement_report(
    visits_table: DataFrame,
    config: DataFrame,
    device_spots: DataFrame,
    catalog: DataFrame,
    categories: DataFrame,
    out: str,
    *,
    grain: str = "month",
    start: str | None = None,
    end: str | None = None,
    prefectures: Iterable[str] = profiles.PREFECTURES,
    format: str = "parquet",
) -> list[str]:
    """Co-visited spots of all places at once, by place and month or by place and day.

    By month, ``start`` and ``end`` are required and must be whole months; by day, the default is the
    report day. Spots valid from before the first month are reported under the month they are valid
    from, as the counts are by spot period; only months of the span are replaced or withdrawn.
    """
    daily = grain == "day"
    if daily:
        start = start or report_day()
        end = end or start
    elif start is None or end is None:
        raise ValueError("results by month need start and end")
    else:
        _whole_months(start, end)
    span = {"start": start, "end": end}
    seen = visits.tenant_device_days(visits_table, config, **span)
    counts = movement.covisited_spots(
        seen, device_spots, catalog, categories, grain=grain, prefectures=prefectures, **span
    )
    labelled = with_partitions(counts, date="date" if daily else "start_date", day=daily)
    partitions = PARTITIONS if daily else PARTITIONS[:-1]
    folder = f"{out}/{MOVEMENT_FOLDERS[grain]}"
    order = ["competitor_id", "cohort_caption", "spot"]
    scope = {"place": _places(config)}
    scope |= {"dt": _within(start, end)} if daily else {"month": _within(start[:7], end[:7])}
    publish(labelled, folder, partitions, sort_by=order, format=format, scope=scope)
    return [folder]


def link_job(
    visits_table: DataFrame,
    pos: DataFrame,
    shops: DataFrame,
    out: str,
    *,
    start: str,
    end: str,
    tolerance: dt.timedelta = poslink.TOLERANCE,
) -> list[str]:
    """Link sales to visits and write the intermediate the buyer reports read."""
    at_shops = visits.listed(visits_table, shops, "place_id")
    linked = poslink.link_sales(at_shops, poslink.pos_sales(pos, shops), tolerance, start=start, end=end)
    folder = f"{out}/intermediate"
    scope = {"place": _places(shops), "dt": _within(start, end)}
    publish(with_partitions(linked), folder, PARTITIONS, scope=scope)
    return [folder]


def _linked(spark: SparkSession, intermediate: str, start: str, end: str) -> DataFrame:
    """The intermediate of the days alone: its folders of other days are not read."""
    return read_linked(spark, intermediate).where(F.col("dt").between(start, end)).drop(*PARTITIONS)


def buyer_reports(
    spark: SparkSession,
    intermediate: str,
    visits_table: DataFrame,
    age_gender: DataFrame,
    home_work: DataFrame,
    topics: DataFrame,
    min_counts: DataFrame,
    out: str,
    *,
    start: str,
    end: str,
    format: str = "parquet",
) -> list[str]:
    """Estimated buyers, who they are, and which competitors they visit, from the intermediate.

    A sale takes the age, gender and areas of the snapshot of its own month.
    """
    linked, months = _linked(spark, intermediate, start, end), month_starts(start, end)
    reports = {
        "devices": poslink.linked_devices(linked),
        "visitor": poslink.linked_visitors(linked),
        "agegender": buyers.linked_age_gender(linked, age_gender, months, min_counts),
        "location": buyers.linked_location(linked, home_work, months, min_counts),
        "topic": buyers.linked_topic(linked, topics, min_counts, hot=skew.hot_cells(linked, ["adid"])),
        "duplication": buyers.linked_overlap(linked, visits_table, min_counts, start=start, end=end),
    }
    for name, report in reports.items():
        keys = [c for c in report.columns if c not in ("place_id", "date", "count", "own_count")]
        scope = {"dt": _within(start, end)}
        publish(with_partitions(report), f"{out}/{name}", PARTITIONS, sort_by=keys, format=format, scope=scope)
    return [f"{out}/{name}" for name in reports]


def repeat_report(
    spark: SparkSession,
    intermediate: str,
    visits_table: DataFrame,
    shops: DataFrame,
    out: str,
    *,
    start: str,
    end: str,
    lookback_from: str | None = None,
    format: str = "parquet",
) -> list[str]:
    """Repeat visits by item, by place and month; ``start`` to ``end`` must be whole months.

    Visits before ``start`` count towards the repeats only if ``lookback_from`` loads them.
    """
    _whole_months(start, end)
    seen = visits.place_device_days(visits_table, shops, start=lookback_from or start, end=end)
    rolling = repeat.rolling_visits(seen, report_from=start)
    counts = repeat.repeat_by_item(rolling, _linked(spark, intermediate, start, end))
    folder = f"{out}/repeater"
    labelled = with_partitions(counts, day=False)
    scope = {"place": _places(shops), "month": _within(start[:7], end[:7])}
    publish(labelled, folder, PARTITIONS[:-1], sort_by=["date"], format=format, scope=scope)
    return [folder]
