"""Place overlap: how many devices of one place were also at another in the same period."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placelytics import schemas
from placelytics.functions.time import PERIOD_COLUMNS
from placelytics.operators.suppress import suppress
from placelytics.operators.visits import PLACE

# Places of one device that one row spreads over; longer lists are split over several rows.
BLOCK = 128


def overlap(visits: DataFrame, period: str, *, min_count: int | None = None) -> DataFrame:
    """Shared devices of every ordered pair of different places, with the first place's total.

    ``visits`` holds place, competitor, device and period, as :func:`monitored_visits` or
    :func:`device_periods` return them; repeated rows change nothing. The same place under
    another competitor id is a different place. Pairs without a common device give no row.

    The devices are never joined with themselves. One aggregation, combined before its shuffle,
    gives the set of places of each device and period. Devices with the same set are counted
    before pairs are formed, so pairs are built once per distinct set, for one order only, and
    mirrored after they have been summed. The totals come from the same counted sets. A set of more than ``BLOCK`` places is cut into
    blocks and its pairs of blocks are spread by the same shuffle that counts equal sets, so a
    device seen everywhere is no single task.
    """
    key = PERIOD_COLUMNS[period]
    schemas.check(visits, schemas.DEVICE_DAYS, "visits", [*PLACE, "adid"])
    blocks = _blocks(_place_sets(visits, key), key)
    pairs = suppress(_shared(blocks, key), min_count, "duplication_count")
    return pairs.join(_own(blocks, key), [key, *PLACE])


def _place_sets(visits: DataFrame, key: str) -> DataFrame:
    """Sorted distinct places per device and period; at most as many as are configured."""
    places = F.sort_array(F.collect_set(F.struct(*PLACE)))
    return visits.where(F.col("adid").isNotNull()).groupBy("adid", key).agg(places.alias("places"))


def _blocks(sets: DataFrame, key: str) -> DataFrame:
    """Devices per period and pair of blocks of places; a null partner is the block itself."""
    last = F.size("places") - 1
    starts = F.sequence(F.lit(0), last, F.lit(BLOCK))
    partner_starts = F.sequence(F.col("first"), last, F.lit(BLOCK))
    partner = F.slice("places", F.col("second") + 1, F.lit(BLOCK))
    return (
        sets.select(key, "places", F.explode(starts).alias("first"))
        .select(key, "places", "first", F.explode(partner_starts).alias("second"))
        .select(
            key,
            F.slice("places", F.col("first") + 1, F.lit(BLOCK)).alias("block"),
            F.when(F.col("second") > F.col("first"), partner).alias("partner"),
        )
        .groupBy(key, "block", "partner")
        .agg(F.count(F.lit(1)).alias("devices"))
    )


def _shared(blocks: DataFrame, key: str) -> DataFrame:
    """Devices per period and ordered pair of different places."""
    rest_of_block = F.slice("block", F.col("at") + 2, F.size("block"))
    pairs = (
        blocks.select(key, "devices", "block", "partner", F.posexplode("block").alias("at", "place"))
        .select(key, "devices", "place", F.explode(F.coalesce("partner", rest_of_block)).alias("other"))
        .groupBy(key, "place", "other")
        .agg(F.sum("devices").alias("devices"))
    )
    as_is = F.struct("place", "other")
    swapped = F.struct(F.col("other").alias("place"), F.col("place").alias("other"))
    return pairs.select(key, "devices", F.explode(F.array(as_is, swapped)).alias("pair")).select(
        key,
        "pair.place.place_id",
        "pair.place.competitor_id",
        F.col("pair.other.place_id").alias("duplication_place_id"),
        F.col("pair.other.competitor_id").alias("duplication_competitor_id"),
        F.col("devices").alias("duplication_count"),
    )


def _own(blocks: DataFrame, key: str) -> DataFrame:
    """Devices per period and place.

    Every block occurs once without a partner, and only then it counts. The others are weighted
    with null instead of filtered out: both uses of ``blocks`` then need the very same shuffle
    and Spark runs it once.
    """
    alone = F.when(F.col("partner").isNull(), F.col("devices"))
    return (
        blocks.select(key, alone.alias("devices"), F.explode("block").alias("place"))
        .groupBy(key, "place.place_id", "place.competitor_id")
        .agg(F.sum("devices").alias("own_count"))
    )
