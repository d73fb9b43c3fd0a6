"""Point-of-sale rows and the visits they can be linked to."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placelytics import schemas
from placelytics.functions.codes import shop_code
from placelytics.functions.time import micros, on_days
from placelytics.operators.skew import split_both
from placelytics.operators.suppress import suppress
from placelytics.operators.visits import OWN_STORE

# Link tolerances and smallest published number of estimated buyers.
TOLERANCE = dt.timedelta(minutes=1)
PAIR_TOLERANCE = dt.timedelta(minutes=3)
VISITORS_MIN_COUNT = 2

ITEM = ["shop_code", "caption", "item_name"]


def pos_sales(pos: DataFrame, shops: DataFrame) -> DataFrame:
    """Sold lines with the place of their shop. Lines without an item name drop out."""
    schemas.check(pos, schemas.POS, "pos")
    schemas.check(shops, schemas.SHOPS, "shops")
    lines = pos.where(F.col("item_name").isNotNull()).withColumn("shop_code", shop_code(pos, "shop_code"))
    return lines.join(shops.select("shop_code", "place_id", "caption"), "shop_code").select(
        "shop_code", "place_id", "caption", "item_name", "datetime"
    )


def link_sales(
    visits: DataFrame,
    sales: DataFrame,
    tolerance: dt.timedelta = TOLERANCE,
    *,
    start: str | None = None,
    end: str | None = None,
    days: Iterable[str] | None = None,
) -> DataFrame:
    """Own-store device-days with the items sold within ``tolerance`` of a contact, distinct.

    A sale matches every device in the store in that window, since sales carry no device id.

    Time is cut into slots as long as the tolerance. A contact matches an item if

    * the item was sold in its own slot, at whatever time, or late enough in the slot before:
      it then lies at or before the latest such sale plus the tolerance (``until``), or
    * the item was sold early enough in the slot after: it then lies at or after the earliest
      such sale minus the tolerance (``since``).

    So two times per item and slot stand for all its sales, and the first and last contact of a
    device in a slot stand for all its contacts. Both sides are reduced to those before they
    are shuffled on place and slot, and no single sale ever meets a single contact.
    """
    schemas.check(visits, schemas.VISITS, "visits")
    schemas.check(sales, schemas.SALES, "sales")
    reach = tolerance // dt.timedelta(microseconds=1)
    if reach < 0:
        raise ValueError("tolerance must not be negative")
    width = max(reach, 1)
    time = F.col("at")
    slot = time - F.pmod(time, F.lit(width))

    own = on_days(visits, start, end, days).where(F.col("competitor_id") == OWN_STORE)
    contacts = (
        own.withColumn("at", micros(visits, "datetime"))
        .groupBy("user_id", "place_id", "competitor_id", "adid", "date", slot.alias("slot"))
        .agg(F.min("at").alias("first_at"), F.max("at").alias("last_at"))
    )

    until, since, no_time = time + reach, time - reach, F.lit(None).cast("long")
    reached_slots = F.array(
        F.struct(slot.alias("slot"), until.alias("until"), no_time.alias("since")),
        F.struct((slot + width).alias("slot"), until.alias("until"), no_time.alias("since")),
        F.struct((slot - width).alias("slot"), no_time.alias("until"), since.alias("since")),
    )
    sold = (
        sales.withColumn("at", micros(sales, "datetime"))
        .select("place_id", *ITEM, F.explode(reached_slots).alias("reached"))
        .groupBy("place_id", *ITEM, F.col("reached.slot").alias("slot"))
        .agg(F.max("reached.until").alias("until"), F.min("reached.since").alias("since"))
    )
    in_reach = (F.col("first_at") <= F.col("until")) | (F.col("last_at") >= F.col("since"))
    return (
        contacts.join(sold, ["place_id", "slot"])
        .where(in_reach)
        .select("user_id", "place_id", "competitor_id", "adid", "date", *ITEM)
        .dropDuplicates()
    )


def link_pairs(
    visits: DataFrame,
    sales: DataFrame,
    tolerance: dt.timedelta = PAIR_TOLERANCE,
    *,
    start: str | None = None,
    end: str | None = None,
    days: Iterable[str] | None = None,
) -> DataFrame:
    """Every pair of an own-store contact and a sale within ``tolerance`` of it, both ends included.

    One row per pair with both times, ``datetime`` of the contact and ``sold_at``; repeated contacts and
    sales give repeated pairs. :func:`link_sales` is the distinct, far smaller answer to who bought
    what; this one is for looking at the pairs themselves, and its result is as large as they are many.

    A contact lies in one slot of the length of the tolerance, a sale is offered to its own and the slots
    beside it, so each pair meets in exactly one. A slot with very many contacts, sales or both is cut
    into a grid of parts.
    """
    schemas.check(visits, schemas.VISITS, "visits")
    schemas.check(sales, schemas.SALES, "sales")
    reach = tolerance // dt.timedelta(microseconds=1)
    if reach < 0:
        raise ValueError("tolerance must not be negative")
    width = max(reach, 1)

    def slot(time: str) -> Column:
        return F.col(time) - F.pmod(F.col(time), F.lit(width))

    own = on_days(visits, start, end, days).where(F.col("competitor_id") == OWN_STORE)
    contacts = (
        own.withColumn("at", micros(visits, "datetime"))
        .where(F.col("place_id").isNotNull() & F.col("at").isNotNull())
        .select("user_id", "place_id", "competitor_id", "adid", "date", "datetime", "at", slot("at").alias("slot"))
    )
    offered = F.explode(F.array(slot("sold"), slot("sold") - width, slot("sold") + width)).alias("slot")
    sold = (
        sales.withColumn("sold", micros(sales, "datetime"))
        .where(F.col("place_id").isNotNull() & F.col("sold").isNotNull())
        .select("place_id", *ITEM, F.col("datetime").alias("sold_at"), "sold", offered)
    )
    contacts, sold, on = split_both(contacts, sold, ["place_id", "slot"])
    return (
        contacts.join(sold, on)
        .where(F.abs(F.col("at") - F.col("sold")) <= reach)
        .select("user_id", "place_id", "competitor_id", "adid", "date", "datetime", *ITEM, "sold_at")
    )


def linked_devices(linked: DataFrame, *, min_count: int | None = None) -> DataFrame:
    """Distinct devices with a linked sale per tenant, place, day and shop."""
    schemas.check(linked, schemas.LINKED, "linked")
    group = ["user_id", "place_id", "competitor_id", "date", "caption"]
    counts = linked.select(*group, "adid").dropDuplicates().groupBy(*group).count()
    return suppress(counts, min_count)


def linked_visitors(linked: DataFrame, *, min_count: int | None = VISITORS_MIN_COUNT) -> DataFrame:
    """Estimated buyers per day, shop and item. Buyers of two items count for both."""
    schemas.check(linked, schemas.LINKED, "linked")
    counts = (
        linked.dropDuplicates()
        .groupBy("user_id", "place_id", "date", "caption", "shop_code", "item_name")
        .agg(F.count("adid").alias("count"))
    )
    return suppress(counts, min_count)
