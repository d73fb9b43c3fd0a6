"""Deduplicated visits: device-days and device-periods.

Place lists come in as DataFrames and are joined, never collected. A list is reduced to its distinct
keys and counted first: up to ``LISTED_KEYS`` keys it is broadcast, so that a list without a size
estimate never makes Spark shuffle all visits by place; a longer one is joined as Spark chooses.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placelytics import schemas
from placelytics.functions.time import PERIOD_COLUMNS, on_days, with_period
from placelytics.operators.suppress import suppress

PLACE = ["place_id", "competitor_id"]

# Most keys of a list that is broadcast: about 10 MB of ids.
LISTED_KEYS = 100_000
OWN_STORE = 0

# Partition columns of a visit table that repeat a key; filtering on them skips whole folders.
_PARTITION_COPY = {"user_id": "usr", "place_id": "place"}


def small_list(keys: DataFrame) -> DataFrame:
    """``keys``, distinct rows of a place list, to be broadcast if there are few enough of them."""
    return F.broadcast(keys) if _few(keys) else keys


def _few(keys: DataFrame) -> bool:
    return keys.limit(LISTED_KEYS + 1).count() <= LISTED_KEYS


def listed(visits: DataFrame, keys: DataFrame, column: str, few: bool | None = None) -> DataFrame:
    """Visits whose ``column`` occurs in ``keys``, matched on its partition copy if there is one.

    ``few`` says whether the distinct keys are known to be few enough for a broadcast; without it they
    are counted.

    A copy of another type than the key, such as a folder name read as a number, is not used.
    Spark prunes partitions through a join only when the small side carries a filter. That is
    what the test for blank ids is for; a partition cannot have a blank name anyway.
    """
    copy = _PARTITION_COPY.get(column)
    if copy not in visits.columns or visits.schema[copy].dataType != keys.schema[column].dataType:
        names, copy = keys.select(column).distinct(), column
    else:
        names = keys.select(F.col(column).alias(copy)).where(F.length(copy) > 0).distinct()
    few = _few(names) if few is None else few
    return visits.join(F.broadcast(names) if few else names, copy, "left_semi")


def device_days(
    visits: DataFrame,
    config: DataFrame,
    *,
    require_config: bool = False,
    start: str | None = None,
    end: str | None = None,
    days: Iterable[str] | None = None,
) -> DataFrame:
    """Distinct (place, competitor, device, day) at the client's own stores.

    The place must be in ``config``, as own store or as competitor. With ``require_config`` the
    own store itself must be.
    """
    schemas.check(visits, schemas.VISITS, "visits", ["adid", "date", *PLACE])
    schemas.check(config, schemas.PLACE_CONFIG, "place_config", PLACE)
    own = on_days(visits, start, end, days).where(F.col("competitor_id") == OWN_STORE)
    own = listed(own, config, "place_id").select(*PLACE, "adid", "date")
    return (configured_only(own, config) if require_config else own).dropDuplicates()


def configured_only(device_days: DataFrame, config: DataFrame) -> DataFrame:
    """Device-days whose (place, competitor) is itself configured."""
    return device_days.join(small_list(config.select(*PLACE).distinct()), PLACE, "left_semi")


def tenant_device_days(
    visits: DataFrame,
    config: DataFrame,
    *,
    start: str | None = None,
    end: str | None = None,
    days: Iterable[str] | None = None,
) -> DataFrame:
    """Distinct (tenant, place, competitor, device, day) at own stores and competitors.

    Tenant, place and competitor are looked up in three separate lists, so a combination that
    ``config`` does not hold passes as long as each part occurs somewhere.
    """
    schemas.check(visits, schemas.VISITS, "visits", ["user_id", "adid", "date", *PLACE])
    schemas.check(config, schemas.PLACE_CONFIG, "place_config")
    found = on_days(visits, start, end, days)
    # A configuration of few distinct rows has few distinct keys of each kind: one count for all lists.
    few = _few(config.select("user_id", *PLACE).distinct()) or None
    for column in ("user_id", "place_id", "competitor_id"):
        found = listed(found, config, column, few)
    return found.select("user_id", *PLACE, "adid", "date").dropDuplicates()


def place_device_days(
    visits: DataFrame,
    places: DataFrame,
    *,
    start: str | None = None,
    end: str | None = None,
    days: Iterable[str] | None = None,
) -> DataFrame:
    """Distinct (tenant, place, competitor, device, day) at the places of ``places``.

    Any tenant and any competitor passes; the repeat-visit operators start from this.
    """
    schemas.check(visits, schemas.VISITS, "visits", ["user_id", "adid", "date", *PLACE])
    found = listed(on_days(visits, start, end, days), places, "place_id")
    return found.select("user_id", *PLACE, "adid", "date").dropDuplicates()


def _monitored(
    visits: DataFrame,
    config: DataFrame,
    start: str | None,
    end: str | None,
    days: Iterable[str] | None,
) -> DataFrame:
    schemas.check(visits, schemas.VISITS, "visits", ["adid", "date", "datetime", *PLACE])
    schemas.check(config, schemas.PLACE_CONFIG_FROM, "place_config", [*PLACE, "start_date"])
    opened = small_list(config.groupBy(*PLACE).agg(F.min("start_date").alias("start_date")))
    seen = on_days(visits, start, end, days)
    if _PARTITION_COPY["place_id"] in visits.columns:
        seen = listed(seen, config, "place_id")
    return seen.join(opened, PLACE).where(F.col("date") >= F.col("start_date"))


def monitored_visits(
    visits: DataFrame,
    config: DataFrame,
    period: str,
    *,
    start: str | None = None,
    end: str | None = None,
    days: Iterable[str] | None = None,
    week_start: str = "sunday",
) -> DataFrame:
    """Visits at configured (place, competitor) pairs from each pair's start date to ``end``.

    ``start`` and ``days`` limit the days further; a period that is only partly read counts only
    what is read. Returns place, competitor, device and period, one row per contact. Duplicate configuration
    rows count once and the earliest start date wins.
    """
    return in_period(_monitored(visits, config, start, end, days), period, week_start)


def monitored_days(
    visits: DataFrame,
    config: DataFrame,
    *,
    start: str | None = None,
    end: str | None = None,
    days: Iterable[str] | None = None,
) -> DataFrame:
    """Distinct device-days of :func:`monitored_visits` with the month of their contacts.

    One pass over the visits from which :func:`in_period` gives days, weeks and months alike.
    """
    seen = with_period(_monitored(visits, config, start, end, days), "month")
    return seen.select(*PLACE, "adid", "date", PERIOD_COLUMNS["month"]).dropDuplicates()


def in_period(seen: DataFrame, period: str, week_start: str = "sunday") -> DataFrame:
    """Place, competitor, device and period of monitored visits."""
    return with_period(seen, period, week_start).select(*PLACE, "adid", PERIOD_COLUMNS[period])


def device_periods(
    visits: DataFrame,
    config: DataFrame,
    period: str,
    *,
    start: str | None = None,
    end: str | None = None,
    days: Iterable[str] | None = None,
    week_start: str = "sunday",
) -> DataFrame:
    """Distinct (place, competitor, device, period) of :func:`monitored_visits`."""
    span = {"start": start, "end": end, "days": days, "week_start": week_start}
    return monitored_visits(visits, config, period, **span).dropDuplicates()


def unique_devices(periods: DataFrame, period: str, *, min_count: int | None = None) -> DataFrame:
    """Devices per place and period, from the rows of :func:`device_periods`.

    A device id that is null makes a group appear but is not counted.
    """
    counts = periods.groupBy(*PLACE, PERIOD_COLUMNS[period]).agg(F.count("adid").alias("own_count"))
    return suppress(counts, min_count, "own_count")
