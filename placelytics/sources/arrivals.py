"""Days that newly arrived files touch, from the metadata that Spark keeps of every file it scans."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ARRIVED = "_metadata.file_modification_time"


def latest_arrival(table: DataFrame) -> dt.datetime | None:
    """When the newest file of a table scan was written; ``None`` of a table without rows."""
    return table.agg(F.max(F.col(ARRIVED)).alias("last")).first()["last"]


def touched_days(table: DataFrame, after: dt.datetime | None, until: dt.datetime) -> list[str]:
    """Days with rows in files written after ``after``, up to ``until``, in order; at most as many as there are days.

    The table must be a plain scan of files. The comparison is on file metadata: Spark leaves files that
    arrived outside the span unread, and of the others reads the day alone.
    """
    fresh = table.where(F.col(ARRIVED) <= until)
    if after is not None:
        fresh = fresh.where(F.col(ARRIVED) > after)
    days = fresh.select("date").where(F.col("date").isNotNull()).distinct()
    return sorted(row["date"] for row in days.collect())
