"""Device-periods as bitmaps, so that counts of devices and overlaps can be kept up day by day.

A device gets a number once, in a dictionary that only grows. The devices of a place and period are bits of
bitmaps of 32,768 numbers each, at most one per place, period and 32,768 devices. Bitmaps of the same
place and period from different days are merged by a bitwise or, which is the same whichever day came
first and however often it comes. Counts are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placelytics.functions.time import PERIOD_COLUMNS
from placelytics.operators.suppress import suppress
from placelytics.operators.visits import PLACE, in_period

DEVICES = T.StructType([T.StructField("adid", T.StringType()), T.StructField("number", T.LongType())])


def new_devices(seen: DataFrame, known: DataFrame | None, first: int = 0) -> DataFrame:
    """``(adid, number)`` of the devices of ``seen`` that ``known`` has not, numbered from ``first`` on.

    Numbers differ but have gaps, at most one for each task. They are given out anew each time this is
    computed: write the result once and use what was written.
    """
    devices = seen.select("adid").where(F.col("adid").isNotNull()).distinct()
    if known is not None:
        devices = devices.join(known, "adid", "left_anti")
    return devices.select("adid", (F.lit(first) + F.monotonically_increasing_id()).alias("number"))


def device_bitmaps(seen: DataFrame, devices: DataFrame, period: str) -> DataFrame:
    """``(place, competitor, period, bucket, bitmap)`` of the rows of :func:`visits.monitored_days`.

    A null device makes its place and period appear, with an empty bitmap.
    """
    key = PERIOD_COLUMNS[period]
    numbered = in_period(seen, period).join(devices, "adid", "left")
    bucket = F.coalesce(F.bitmap_bucket_number("number"), F.lit(1).cast("long"))
    return numbered.groupBy(*PLACE, key, bucket.alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap")
    )


def merged(*parts: DataFrame) -> DataFrame:
    """One bitmap of each place, period and bucket of ``parts``."""
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    keys = [c for c in every.columns if c != "bitmap"]
    return every.groupBy(*keys).agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def unique_devices(bitmaps: DataFrame, period: str, *, min_count: int | None = None) -> DataFrame:
    """Devices per place and period, as :func:`visits.unique_devices` counts them."""
    counts = bitmaps.groupBy(*PLACE, PERIOD_COLUMNS[period]).agg(F.sum(F.bitmap_count("bitmap")).alias("own_count"))
    return suppress(counts, min_count, "own_count")


def overlap(bitmaps: DataFrame, period: str, *, min_count: int | None = None) -> DataFrame:
    """Shared devices of every ordered pair of different places, as :func:`overlap.overlap` counts them.

    Bitmaps of two places meet by period and bucket, in one order; what they share is the sum of both counts
    less that of their union. The join brings together what the configured places make, not the devices.
    """
    key = PERIOD_COLUMNS[period]
    sides = [
        bitmaps.select(key, "bucket", F.struct(*PLACE).alias(place), F.col("bitmap").alias(bits), F.bitmap_count("bitmap").alias(n))
        for place, bits, n in (("place", "bits", "n"), ("other", "other_bits", "other_n"))
    ]
    pairs = (
        sides[0].join(sides[1], [key, "bucket"]).where((F.col("place") < F.col("other")) & (F.col("n") > 0) & (F.col("other_n") > 0))
    )
    both = pairs.select(
        key, "bucket", "place", "other", (F.col("n") + F.col("other_n")).alias("n"), F.explode(F.array("bits", "other_bits")).alias("bits")
    )
    union = both.groupBy(key, "bucket", "place", "other", "n").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("any"))
    shared = union.groupBy(key, "place", "other").agg(F.sum(F.col("n") - F.col("any")).alias("devices")).where("devices > 0")
    ways = F.array(F.struct("place", "other"), F.struct(F.col("other").alias("place"), F.col("place").alias("other")))
    counts = shared.select(key, "devices", F.explode(ways).alias("pair")).select(
        key,
        "pair.place.place_id",
        "pair.place.competitor_id",
        F.col("pair.other.place_id").alias("duplication_place_id"),
        F.col("pair.other.competitor_id").alias("duplication_competitor_id"),
        F.col("devices").alias("duplication_count"),
    )
    return suppress(counts, min_count, "duplication_count").join(unique_devices(bitmaps, period), [key, *PLACE])
