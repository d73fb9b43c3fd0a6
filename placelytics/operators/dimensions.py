"""Joins of visits with device-level tables.

Every count here is "matching rows after the join", not distinct devices: a device with two
rows in the device table counts twice. The device tables are collapsed first, so identical rows
travel as one row with a number of copies and the counts are sums of copies. With the visits
distinct on the other side, a device brings to the join only its distinct rows of either table,
however often its id is repeated there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COPIES = "copies"
#: Days in a slot of each tier of validities; longer ones than twice the last share one slot.
SLOT_DAYS = (32, 1024)
TIER, SLOT = "validity_tier", "validity_slot"


def collapse(dimension: DataFrame, *columns: str) -> DataFrame:
    """Distinct ``columns`` of known devices with the number of rows behind each."""
    known = dimension.where(F.col("adid").isNotNull())
    return known.groupBy(*columns).agg(F.count(F.lit(1)).alias(COPIES))


def valid_on(
    visits: DataFrame, dimension: DataFrame, on: Sequence[str] = ("adid",), *, slotted: bool = False
) -> DataFrame:
    """Visits with the device's rows that are valid on the visit date, both ends included.

    With ``slotted``, a device's rows meet only the visits near their time instead of all of them: the join is
    one on device, tier and slot of time, see :func:`_row_slots`. That is for device tables of long histories,
    where most rows of a device are valid on few of its days, and gives the same rows. Its price: a
    visit is shuffled once a tier, and a device table stored by device is shuffled as well.
    """
    in_force = (F.col("start_date") <= F.col("date")) & (F.col("date") <= F.col("end_date"))
    if not slotted:
        return visits.join(dimension, list(on)).where(in_force)
    near = visits.select("*", F.inline(_visit_slots()))
    spread = dimension.where("start_date <= end_date").select("*", F.inline(_row_slots()))
    return near.join(spread, [*on, TIER, SLOT]).where(in_force).drop(TIER, SLOT)


def _day(column: str) -> Column:
    return F.unix_date(F.col(column).cast("date"))


def _slot(day: Column, tier: int) -> Column:
    """Slot of a day; the last tier has but one."""
    return F.floor(day / F.lit(SLOT_DAYS[tier])) if tier < len(SLOT_DAYS) else F.lit(0).cast("long")


def _visit_slots() -> Column:
    """The slot of the visit's day in every tier."""
    tiers = range(len(SLOT_DAYS) + 1)
    return F.array(*[F.struct(F.lit(t).alias(TIER), _slot(_day("date"), t).alias(SLOT)) for t in tiers])


def _row_slots() -> Column:
    """The slots of a device row's validity, in the one tier its length belongs to.

    A row valid for at most two slots of a tier touches three of them at most. Rows too long for a tier are in
    the next, so of rows that do not overlap few share a slot, however long the history. As a row is in one
    tier and a visit in one slot of it, each pair meets once.
    """
    first, last = _day("start_date"), _day("end_date")
    length = last - first + 1

    def slots(tier: int) -> Column:
        return F.transform(
            F.sequence(_slot(first, tier), _slot(last, tier)), lambda s: F.struct(F.lit(tier).alias(TIER), s.alias(SLOT))
        )

    chosen = F.when(length <= 2 * SLOT_DAYS[0], slots(0))
    for tier in range(1, len(SLOT_DAYS)):
        chosen = chosen.when(length <= 2 * SLOT_DAYS[tier], slots(tier))
    return chosen.otherwise(slots(len(SLOT_DAYS)))


def valid_between(dimension: DataFrame, first: str | None, last: str | None) -> DataFrame:
    """Rows valid on some day from ``first`` to ``last``, both included; ``None`` is no bound.

    Plain comparisons with literals, so a run of a few days reads only their rows of a device table.
    """
    if last is not None:
        dimension = dimension.where(F.col("start_date") <= last)
    if first is not None:
        dimension = dimension.where(F.col("end_date") >= first)
    return dimension


def snapshot(dimension: DataFrame, start_date: str) -> DataFrame:
    """Rows of the one snapshot taken on ``start_date``."""
    return dimension.where(F.col("start_date") == start_date)


def counted(distinct_devices: bool = False, weight: Column | None = None) -> Column:
    """The ``count`` column: matching rows, or distinct devices if asked for."""
    if distinct_devices:
        return F.count_distinct("adid").alias("count")
    return F.sum(F.col(COPIES) if weight is None else weight).alias("count")
