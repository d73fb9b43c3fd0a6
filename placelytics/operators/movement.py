"""Where else the visitors go: co-visited spots by category."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placelytics import schemas
from placelytics.functions.time import bounds, month_start, month_starts, on_days
from placelytics.operators.dimensions import collapse, counted, valid_between, valid_on
from placelytics.operators.profiles import PREFECTURES
from placelytics.operators.suppress import suppress
from placelytics.operators.visits import PLACE

SPOT = ["spot", "prefecture", "city", "address"]


def covisited_spots(
    device_days: DataFrame,
    device_spots: DataFrame,
    catalog: DataFrame,
    categories: DataFrame,
    *,
    grain: str = "month",
    prefectures: Iterable[str] = PREFECTURES,
    min_count: int | None = None,
    start: str | None = None,
    end: str | None = None,
    days: Iterable[str] | None = None,
    slotted: bool = False,
) -> DataFrame:
    """Visits of a place's visitors to other spots of the allowed categories.

    ``start``, ``end`` and ``days`` limit the days, and with them the rows read of ``device_spots``.

    ``device_days`` comes from :func:`tenant_device_days`. With ``grain="month"`` the counts are
    device-days per spot and spot period: a device on three days at the place counts three
    times. With ``grain="day"`` only the spot rows of the visit's own month apply and the counts
    are per day. A spot in several allowed categories gives one row for each.

    Spots outside the areas and categories are dropped before the join with the visits. ``slotted`` is for
    long histories of spots by month, see :func:`valid_on`; by day the month is part of the join's key.
    """
    schemas.check(device_days, schemas.TENANT_DEVICE_DAYS, "device_days")
    schemas.check(device_spots, schemas.DEVICE_SPOTS, "device_spots")
    schemas.check(catalog, schemas.SPOT_CATALOG, "spot_catalog")
    schemas.check(categories, schemas.CATEGORIES, "categories")
    areas = F.col("prefecture").isin(list(prefectures))
    device_days = on_days(device_days, start, end, days)
    first, last = bounds(start, end, days)
    device_spots = valid_between(device_spots, first, last)
    if grain == "day" and first is not None and last is not None:
        device_spots = device_spots.where(F.col("start_date").isin(month_starts(first, last)))
    # A spot's captions travel with it from here on, so the catalogue is joined once.
    allowed = (
        catalog.where(areas)
        .join(categories, "cohort_caption", "left_semi")
        .groupBy(*SPOT)
        .agg(F.sort_array(F.collect_list("cohort_caption")).alias("captions"))
    )
    spots = collapse(
        device_spots.where(areas).join(allowed, SPOT),
        *["adid", *SPOT, "start_date", "end_date", "captions"],
    )
    if grain == "month":
        period = "start_date"
        together = valid_on(device_days, spots, slotted=slotted)
    elif grain == "day":
        period = "date"
        monthly = spots.withColumnRenamed("start_date", "month_start")
        together = (
            device_days.withColumn("month_start", month_start(F.col("date")))
            .join(monthly, ["adid", "month_start"])
            .where(F.col("date") <= F.col("end_date"))
        )
    else:
        raise ValueError(f"grain must be 'month' or 'day', not {grain!r}")
    counts = together.groupBy(*PLACE, *SPOT, period).agg(counted(), F.first("captions").alias("captions"))
    return suppress(counts, min_count).select(
        *SPOT, *PLACE, period, "count", F.explode("captions").alias("cohort_caption")
    )
