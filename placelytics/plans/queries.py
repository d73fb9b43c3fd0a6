"""Every operator as a query over the driver's tables, all days and all places."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placelytics import fixtures
from placelytics.fixtures import Tables
from placelytics.operators import bitmaps, buyers, movement, overlap, poslink, profiles, repeat, skew, visits

Query = Callable[[SparkSession, str], DataFrame]


def _unique(period: str) -> Callable[[Tables], DataFrame]:
    return lambda t: visits.unique_devices(
        visits.device_periods(t.visits, t.place_config, period), period
    )


def _overlap(period: str, **span) -> Callable[[Tables], DataFrame]:
    return lambda t: overlap.overlap(
        visits.monitored_visits(t.visits, t.place_config, period, **span), period
    )


def _bitmaps_of_halves(t: Tables, period: str) -> DataFrame:
    """State of the first days and of the others, each built on its own, and merged."""
    halves = [{"end": "2024-01-14"}, {"start": "2024-01-15"}]
    days = [visits.monitored_days(t.visits, t.place_config, **half) for half in halves]
    return bitmaps.merged(*[bitmaps.device_bitmaps(seen, t.device_numbers, period) for seen in days])


def _device_days(t: Tables, **options) -> DataFrame:
    return visits.device_days(t.visits, t.place_config, **options)


def _all_days(t: Tables) -> DataFrame:
    return visits.tenant_device_days(t.visits, t.place_config)


def _location(**options) -> Callable[[Tables], DataFrame]:
    return lambda t: profiles.profile_location(
        _device_days(t), t.home_work, prefectures=fixtures.PREFECTURES, **options
    )


def _cohort(**options) -> Callable[[Tables], DataFrame]:
    return lambda t: profiles.profile_cohort(
        _device_days(t), t.cohorts, t.topics, category=fixtures.CATEGORY, **options
    )


def _split_cohort(t: Tables) -> DataFrame:
    days = _device_days(t)
    hot = skew.hot_cells(days, ["adid"])
    return profiles.profile_cohort(days, t.cohorts, t.topics, category=fixtures.CATEGORY, min_count=2, hot=hot)


def _covisited(grain: str, **options) -> Callable[[Tables], DataFrame]:
    return lambda t: movement.covisited_spots(
        _all_days(t),
        t.device_spots,
        t.spot_catalog,
        t.categories,
        grain=grain,
        prefectures=fixtures.PREFECTURES,
        **options,
    )


def _sales(t: Tables) -> DataFrame:
    return poslink.pos_sales(t.pos, t.shops)


def _sales_as_text(t: Tables) -> DataFrame:
    return _sales(t).withColumn("datetime", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def _link(tolerance: dt.timedelta = fixtures.LINK) -> Callable[[Tables], DataFrame]:
    return lambda t: poslink.link_sales(t.visits, _sales(t), tolerance)


def _pairs(t: Tables) -> DataFrame:
    pairs = poslink.link_pairs(t.visits, _sales(t))
    text = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in ("datetime", "sold_at")}
    return pairs.withColumns(text)


_linked = _link()


def _shop_days(t: Tables) -> DataFrame:
    return visits.place_device_days(t.visits, t.shops)


def _repeat(**options) -> Callable[[Tables], DataFrame]:
    return lambda t: repeat.repeat_by_item(repeat.rolling_visits(_shop_days(t)), _linked(t), **options)


_PLANS: dict[str, Callable[[Tables], DataFrame]] = {
    "unique_devices_daily": _unique("day"),
    "unique_devices_weekly": _unique("week"),
    "unique_devices_monthly": _unique("month"),
    "overlap_daily": _overlap("day"),
    "overlap_weekly": _overlap("week"),
    "overlap_monthly": _overlap("month"),
    "overlap_weekly_range": _overlap("week", start="2024-01-07", end="2024-01-20"),
    "unique_devices_weekly_halves": lambda t: bitmaps.unique_devices(_bitmaps_of_halves(t, "week"), "week"),
    "overlap_monthly_halves": lambda t: bitmaps.overlap(_bitmaps_of_halves(t, "month"), "month"),
    "device_days": _device_days,
    "device_days_all": _all_days,
    "profile_location": _location(),
    "profile_location_unsuppressed": _location(min_count=None),
    "profile_location_slotted": _location(min_count=None, slotted=True),
    "profile_topic": lambda t: profiles.profile_topic(_device_days(t, require_config=True), t.topics),
    "profile_cohort": _cohort(),
    "profile_cohort_min2": _cohort(min_count=2),
    "profile_cohort_split": _split_cohort,
    "covisited_monthly": _covisited("month"),
    "covisited_monthly_slotted": _covisited("month", slotted=True),
    "covisited_daily": _covisited("day"),
    "topic_versions": lambda t: profiles.topic_versions(t.topics),
    "pos_sales": _sales_as_text,
    "link_sales_1m": _link(poslink.TOLERANCE),
    "link_sales_10m": _link(dt.timedelta(minutes=10)),
    "link_sales_30m": _linked,
    "link_pairs_3m": _pairs,
    "linked_devices": lambda t: poslink.linked_devices(_linked(t)),
    "linked_visitors": lambda t: poslink.linked_visitors(_linked(t)),
    "linked_age_gender": lambda t: buyers.linked_age_gender(
        _linked(t), t.age_gender, fixtures.SNAPSHOT, t.min_counts
    ),
    "linked_age_gender_months": lambda t: buyers.linked_age_gender(
        _linked(t), t.age_gender, [start for start, _ in fixtures.MONTHS], t.min_counts
    ),
    "linked_age_gender_fixed": lambda t: buyers.linked_age_gender(
        _linked(t), t.age_gender, fixtures.SNAPSHOT, 2
    ),
    "linked_location": lambda t: buyers.linked_location(
        _linked(t), t.home_work, fixtures.SNAPSHOT, t.min_counts
    ),
    "linked_topic": lambda t: buyers.linked_topic(_linked(t), t.topics, t.min_counts),
    "linked_overlap": lambda t: buyers.linked_overlap(_linked(t), t.visits, t.min_counts),
    "visit_gap": lambda t: repeat.visit_history(_shop_days(t)),
    "rolling_visits": lambda t: repeat.rolling_visits(_shop_days(t)),
    "rolling_visits_cap5": lambda t: repeat.rolling_visits(_shop_days(t), cap=5),
    "repeat_by_item": _repeat(),
    "repeat_by_item_own": _repeat(own_only=True),
}


def _query(plan: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(Tables(spark, sf_dir))


QUERIES: dict[str, Query] = {name: _query(plan) for name, plan in _PLANS.items()}
