"""Small-count suppression."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placelytics import schemas


def suppress(counts: DataFrame, min_count: int | None, column: str = "count") -> DataFrame:
    """Groups with at least ``min_count``; ``None`` keeps every group."""
    return counts if min_count is None else counts.where(F.col(column) >= min_count)


def suppress_by_shop(counts: DataFrame, min_counts: DataFrame) -> DataFrame:
    """Groups that reach their shop's own threshold. A shop without a threshold vanishes."""
    schemas.check(min_counts, schemas.MIN_COUNTS, "min_counts")
    thresholds = min_counts.select("caption", "place_id", "infimum")
    return (
        counts.join(thresholds, ["caption", "place_id"])
        .where(F.col("count") >= F.col("infimum"))
        .drop("infimum")
    )
