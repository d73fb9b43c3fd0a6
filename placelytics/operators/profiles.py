"""Who the visitors are: home and work areas, topics, interest cohorts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placelytics import schemas
from placelytics.functions.time import bounds, on_days
from placelytics.operators.dimensions import COPIES, collapse, counted, valid_between, valid_on
from placelytics.operators.skew import split_hot
from placelytics.operators.suppress import suppress
from placelytics.operators.visits import PLACE

# Fixed values of the reports.
PREFECTURES = ("東京都", "神奈川県", "埼玉県", "群馬県", "千葉県")
TOPIC_VERSION = "2025-01-01"
TOPIC_NUMBER = "10"
TOPIC_PATTERN = "preference"
INTEREST_CATEGORY = "興味関心"
LOCATION_MIN_COUNT = 2
COHORT_MIN_COUNT = 10

TOPIC = ["topic_id", "pattern", "topic_number"]
AREA = ["time_category", "prefecture", "city", "block"]


def topic_versions(topics: DataFrame) -> DataFrame:
    """Model versions that the topic table holds."""
    return schemas.check(topics, schemas.TOPICS, "topics", ["ver"]).select("ver").distinct()


def select_topics(
    topics: DataFrame, version: str, number: str, pattern: str | None = None
) -> DataFrame:
    """Device topics of one model version and topic count, collapsed; one pattern or all."""
    schemas.check(topics, schemas.TOPICS, "topics")
    chosen = topics.where((F.col("ver") == version) & (F.col("topic_number") == number))
    if pattern is not None:
        chosen = chosen.where(F.col("pattern") == pattern)
    return collapse(chosen, "adid", *TOPIC)


def profile_location(
    device_days: DataFrame,
    home_work: DataFrame,
    *,
    prefectures: Iterable[str] = PREFECTURES,
    min_count: int | None = LOCATION_MIN_COUNT,
    distinct_devices: bool = False,
    start: str | None = None,
    end: str | None = None,
    days: Iterable[str] | None = None,
    slotted: bool = False,
) -> DataFrame:
    """Visitors per day, place and home or work area that was valid on the day.

    ``start``, ``end`` and ``days`` limit the days, and with them the rows read of ``home_work``.
    ``slotted`` is for long histories of areas, see :func:`valid_on`.
    """
    schemas.check(device_days, schemas.DEVICE_DAYS, "device_days")
    schemas.check(home_work, schemas.HOME_WORK, "home_work")
    device_days = on_days(device_days, start, end, days)
    in_force = valid_between(home_work, *bounds(start, end, days))
    areas = collapse(
        in_force.where(F.col("prefecture").isin(list(prefectures))),
        *["adid", *AREA, "start_date", "end_date"],
    )
    counts = (
        valid_on(device_days, areas, slotted=slotted)
        .groupBy("date", *PLACE, *AREA)
        .agg(counted(distinct_devices))
    )
    return suppress(counts, min_count)


def profile_topic(
    device_days: DataFrame,
    topics: DataFrame,
    *,
    version: str = TOPIC_VERSION,
    number: str = TOPIC_NUMBER,
    pattern: str | None = TOPIC_PATTERN,
    min_count: int | None = None,
    distinct_devices: bool = False,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Visitors per day, place and behaviour topic. Not suppressed unless asked for.

    Devices of very many days are split within the join if ``hot``, their :func:`skew.hot_cells`, is given.
    """
    schemas.check(device_days, schemas.DEVICE_DAYS, "device_days")
    seen, (chosen,), on = split_hot(device_days, [select_topics(topics, version, number, pattern)], hot)
    counts = (
        seen.join(chosen, on)
        .groupBy(*PLACE, "date", *TOPIC)
        .agg(counted(distinct_devices))
    )
    return suppress(counts, min_count)


def profile_cohort(
    device_days: DataFrame,
    cohorts: DataFrame,
    topics: DataFrame,
    *,
    category: str = INTEREST_CATEGORY,
    version: str = TOPIC_VERSION,
    number: str = TOPIC_NUMBER,
    pattern: str | None = TOPIC_PATTERN,
    min_count: int | None = COHORT_MIN_COUNT,
    distinct_devices: bool = False,
    hot: DataFrame | None = None,
    start: str | None = None,
    end: str | None = None,
    days: Iterable[str] | None = None,
    slotted: bool = False,
) -> DataFrame:
    """Visitors per day, place, interest cohort and topic.

    ``start``, ``end`` and ``days`` limit the days, and with them the rows read of ``cohorts``.

    Each device counts once per cohort and topic row. Devices with an empty or missing cohort
    list drop out. The lists are unrolled before they are collapsed, so an id that recurs with
    many different lists still brings each cohort to the join only once. ``hot`` splits
    devices of very many days, once for both joins. ``slotted`` is for long histories of cohorts, see
    :func:`valid_on`.
    """
    schemas.check(device_days, schemas.DEVICE_DAYS, "device_days")
    schemas.check(cohorts, schemas.COHORTS, "cohorts")
    device_days = on_days(device_days, start, end, days)
    in_force = valid_between(cohorts, *bounds(start, end, days))
    unrolled = in_force.where(F.col("visit_category") == category).withColumn(
        "cohort", F.explode("cohortlist")
    )
    interests = collapse(unrolled, "adid", "visit_category", "cohort", "start_date", "end_date")
    behaviour = select_topics(topics, version, number, pattern).withColumnRenamed(COPIES, "topic_copies")
    seen, (interests, behaviour), on = split_hot(device_days, [interests, behaviour], hot)
    counts = (
        valid_on(seen, interests, on, slotted=slotted)
        .join(behaviour, on)
        .groupBy(*PLACE, "date", "visit_category", "cohort", *TOPIC)
        .agg(counted(distinct_devices, F.col(COPIES) * F.col("topic_copies")))
    )
    return suppress(counts, min_count)
