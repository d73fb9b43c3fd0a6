"""Who the linked buyers are, and which competitors they also visit.

Thresholds come as a table per shop or as one number for all. ``by`` names the sale columns to count by. Leaving ``item_name`` out gives the older reports
per shop; pass a ``linked`` that is distinct without it in that case.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placelytics import schemas
from placelytics.functions.time import month_start, on_days
from placelytics.operators.dimensions import collapse, counted, snapshot
from placelytics.operators.profiles import AREA, TOPIC, TOPIC_NUMBER, TOPIC_VERSION, select_topics
from placelytics.operators.skew import split_hot
from placelytics.operators.suppress import suppress, suppress_by_shop
from placelytics.operators.visits import OWN_STORE, listed

SALE = ("caption", "shop_code", "item_name")


def linked_age_gender(
    linked: DataFrame,
    age_gender: DataFrame,
    month: str | Sequence[str],
    min_counts: DataFrame | int,
    *,
    by: Sequence[str] = SALE,
) -> DataFrame:
    """Buyers per day, shop, item, age and gender, from the snapshot of ``month``.

    With several months, given by their first days, a sale takes the snapshot of its own month; sales
    of other months have none.
    """
    schemas.check(age_gender, schemas.AGE_GENDER, "age_gender")
    group = ["user_id", "place_id", "date", *by, "age", "gender"]
    return _snapshot_buyers(linked, age_gender, ["age", "gender"], month, group, min_counts)


def linked_location(
    linked: DataFrame,
    home_work: DataFrame,
    month: str | Sequence[str],
    min_counts: DataFrame | int,
    *,
    by: Sequence[str] = SALE,
) -> DataFrame:
    """Buyers per day, shop, item and home or work area, from the snapshot of ``month``.

    Several months work as in :func:`linked_age_gender`.
    """
    schemas.check(home_work, schemas.HOME_WORK, "home_work")
    group = ["user_id", "place_id", "date", *by, *AREA]
    return _snapshot_buyers(linked, home_work, AREA, month, group, min_counts)


def linked_topic(
    linked: DataFrame,
    topics: DataFrame,
    min_counts: DataFrame | int,
    *,
    version: str = TOPIC_VERSION,
    number: str = TOPIC_NUMBER,
    by: Sequence[str] = SALE,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Buyers per day, place, shop, item and topic, for every pattern of the model version.

    Devices of very many sales are split within the join if ``hot``, their :func:`skew.hot_cells`, is given.
    """
    group = ["user_id", "place_id", "competitor_id", "date", *by, *TOPIC]
    seen, (chosen,), on = split_hot(linked, [select_topics(topics, version, number)], hot)
    return _buyers(seen, chosen, group, min_counts, on)


def _snapshot_buyers(
    linked: DataFrame,
    dimension: DataFrame,
    columns: Sequence[str],
    month: str | Sequence[str],
    group: Sequence[str],
    min_counts: DataFrame | int,
) -> DataFrame:
    if isinstance(month, str):
        return _buyers(linked, collapse(snapshot(dimension, month), "adid", *columns), group, min_counts)
    taken = dimension.where(F.col("start_date").isin(sorted(set(month))))
    snapshots = collapse(taken, "adid", "start_date", *columns)
    dated = linked.withColumn("start_date", month_start(F.col("date")))
    return _buyers(dated, snapshots, group, min_counts, ["adid", "start_date"])


def _buyers(
    linked: DataFrame,
    dimension: DataFrame,
    group: Sequence[str],
    min_counts: DataFrame | int,
    on: Sequence[str] = ("adid",),
) -> DataFrame:
    schemas.check(linked, schemas.LINKED, "linked", ["adid", *set(group) & set(linked.columns)])
    counts = linked.join(dimension, list(on)).groupBy(*group).agg(counted())
    return _suppressed(counts, min_counts)


def _suppressed(counts: DataFrame, min_counts: DataFrame | int) -> DataFrame:
    if isinstance(min_counts, int):
        return suppress(counts, min_counts)
    return suppress_by_shop(counts, min_counts)


def linked_overlap(
    linked: DataFrame,
    visits: DataFrame,
    min_counts: DataFrame,
    *,
    start: str | None = None,
    end: str | None = None,
    days: Iterable[str] | None = None,
    by: Sequence[str] = SALE,
) -> DataFrame:
    """Buyers' contacts at competitors of the same place on the same day, with the buyers' count.

    Contacts are counted one by one, so ``count`` can exceed ``own_count``. They are summed per
    device, day and competitor before they meet the linked sales, and each linked sale then
    yields one row for itself and one per competitor. Both counts come out of that one pass:
    ``linked`` is the costliest input and is read once. Shops without a threshold report nothing, so
    contacts at other places than those of ``min_counts`` are not read.
    """
    schemas.check(linked, schemas.LINKED, "linked")
    schemas.check(visits, schemas.VISITS, "visits", ["user_id", "place_id", "competitor_id", "adid", "date"])
    device_day = ["user_id", "place_id", "adid", "date"]
    group = ["user_id", "place_id", "competitor_id", "date", *by]
    rival = F.col("competitor_id").cast("int").alias("rival")
    rivals = (
        listed(on_days(visits, start, end, days), min_counts, "place_id")
        .where((F.col("competitor_id") != OWN_STORE) & F.col("adid").isNotNull())
        .groupBy(*device_day, rival)
        .agg(F.count(F.lit(1)).alias("contacts"))
        .groupBy(*device_day)
        .agg(F.collect_list(F.struct("rival", "contacts")).alias("rivals"))
    )
    itself = F.struct(
        F.lit(None).cast("int").alias("rival"),
        F.when(F.col("adid").isNotNull(), 1).otherwise(0).cast("long").alias("contacts"),
    )
    seen = F.explode(F.concat(F.array(itself), F.coalesce("rivals", F.array())))
    own = F.max(F.when(F.col("rival").isNull(), F.col("count"))).over(Window.partitionBy(*group))
    counts = (
        linked.join(rivals, device_day, "left")
        .select(*group, seen.alias("seen"))
        .groupBy(*group, F.col("seen.rival").alias("rival"))
        .agg(F.sum("seen.contacts").alias("count"))
        .withColumn("own_count", own)
        .where(F.col("rival").isNotNull())
        .select(
            *group,
            F.col("place_id").alias("duplication_place_id"),
            F.col("rival").alias("duplication_competitor_id"),
            "count",
            "own_count",
        )
    )
    return suppress_by_shop(counts, min_counts)
