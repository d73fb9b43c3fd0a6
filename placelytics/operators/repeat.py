"""Repeat visits: gaps, rolling counts, and repeats by item bought.

Input is the distinct device-days of :func:`place_device_days`, so a window holds at most one
row per day of the period for one device at one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placelytics import schemas
from placelytics.operators.suppress import suppress
from placelytics.operators.visits import OWN_STORE

# Days looked back, most repeat visits reported, previous date of a first visit.
ROLLING_DAYS = 30
MAX_REPEATS = 15
NO_VISIT = "0"

DEVICE_AT_PLACE = ["user_id", "place_id", "competitor_id", "adid"]


def visit_history(device_days: DataFrame) -> DataFrame:
    """Previous visit date of the device at the place, and days since; a first visit has 0."""
    schemas.check(device_days, schemas.TENANT_DEVICE_DAYS, "device_days")
    in_order = Window.partitionBy(*DEVICE_AT_PLACE).orderBy("date")
    before = F.lag("date").over(in_order)
    gap = F.datediff(F.col("date").cast("date"), F.col("before").cast("date"))
    return device_days.withColumn("before", before).select(
        *DEVICE_AT_PLACE,
        "date",
        F.coalesce("before", F.lit(NO_VISIT)).alias("before"),
        F.coalesce(gap, F.lit(0)).alias("interval"),
    )


def rolling_visits(
    device_days: DataFrame,
    *,
    days: int | None = ROLLING_DAYS,
    cap: int | None = MAX_REPEATS,
    report_from: str | None = None,
) -> DataFrame:
    """Visit days in the last ``days`` days, the day itself and both ends included; all if ``None``.

    ``visited_30days`` is the number of repeat visits, one less. Device-days with more than
    ``cap`` are not reported. Load ``days`` days before the reporting period and pass its first
    day as ``report_from`` for full counts at its start.
    """
    schemas.check(device_days, schemas.TENANT_DEVICE_DAYS, "device_days")
    day = F.unix_date(F.col("date").cast("date"))
    first = Window.unboundedPreceding if days is None else -days
    recent = Window.partitionBy(*DEVICE_AT_PLACE).orderBy(day).rangeBetween(first, Window.currentRow)
    counts = device_days.withColumn("visit_count_in_30days", F.count("adid").over(recent)).withColumn(
        "visited_30days", F.col("visit_count_in_30days") - 1
    )
    if cap is not None:
        counts = counts.where(F.col("visited_30days") <= cap)
    if report_from is not None:
        counts = counts.where(F.col("date") >= report_from)
    return counts.select(*DEVICE_AT_PLACE, "date", "visit_count_in_30days", "visited_30days")


def repeat_by_item(
    rolling: DataFrame, linked: DataFrame, *, own_only: bool = False, min_count: int | None = None
) -> DataFrame:
    """Linked sales per day, item and number of repeat visits.

    The join leaves the competitor id out, so a visit to a competitor of the place on the same
    day adds a row of its own; ``own_only`` keeps the client's stores alone.
    """
    schemas.check(linked, schemas.LINKED, "linked")
    if own_only:
        rolling = rolling.where(F.col("competitor_id") == OWN_STORE)
    same_day = ["user_id", "place_id", "adid", "date"]
    bought = linked.select(*same_day, "caption", "item_name")
    counts = (
        rolling.select(*same_day, "visited_30days")
        .join(bought, same_day)
        .groupBy("date", "user_id", "place_id", "visited_30days", "caption", "item_name")
        .count()
    )
    return suppress(counts, min_count)
