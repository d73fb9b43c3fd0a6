"""Joins whose hot keys are split within the join, whatever the session's settings.

A sketch of fixed size counts the rows of a side by a hash of their key: ``CELLS`` cells, combined before their
shuffle. A cell of more rows than a task should join is hot. Its rows are dealt over several parts, and the
other side's rows of that cell are repeated for each part. A cold key that shares a hot cell is
split as well, which costs a few repeats and changes no result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Cells of the sketch; rows from which a cell is hot and is cut into parts of that many, and the most parts.
CELLS, HOT_ROWS, MOST_PARTS = 1 << 20, 1 << 20, 256
PART = "part"


def _cell(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(CELLS))


def hot_cells(df: DataFrame, keys: Sequence[str], parts: str = "parts") -> DataFrame:
    """``(cell, parts)`` of the hot cells; at most ``CELLS`` rows, and one in ``HOT_ROWS`` of ``df``'s."""
    counts = df.groupBy(_cell(keys).alias("cell")).agg(F.count(F.lit(1)).alias("rows"))
    hot = counts.where(F.col("rows") > HOT_ROWS)
    return hot.select("cell", F.least(F.ceil(F.col("rows") / HOT_ROWS), F.lit(MOST_PARTS)).cast("int").alias(parts))


def _looked_up(df: DataFrame, hot: DataFrame, keys: Sequence[str], parts: str) -> DataFrame:
    """``df`` with the number of parts of each row's cell, 1 where it is not hot."""
    named = hot.select(F.col("cell").alias("__cell"), F.col(parts).alias("__parts"))
    found = df.join(F.broadcast(named), _cell(keys) == F.col("__cell"), "left")
    return found.withColumn(parts, F.coalesce("__parts", F.lit(1))).drop("__cell", "__parts")


def _own_part(df: DataFrame, parts: str) -> Column:
    """A part of the row's own; rows that are equal in all columns share one."""
    return F.pmod(F.xxhash64(*[c for c in df.columns if c != parts]), F.col(parts)).cast("int")


def _every_part(parts: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(parts) - 1))


def split_hot(
    many: DataFrame, few: Sequence[DataFrame], hot: DataFrame | None, key: str = "adid"
) -> tuple[DataFrame, list[DataFrame], list[str]]:
    """``many`` with the part of each row, every table of ``few`` with each row once per part, and the
    columns to join on.

    ``many`` is what may hold very many rows of one key; ``few`` hold at most a few distinct rows of it.
    ``hot`` are the :func:`hot_cells` of ``many``: one sketch, of a stored ``many`` at best, serves all
    its joins. Without it nothing is split and the join is one on ``key`` alone.
    """
    if hot is None:
        return many, list(few), [key]
    dealt = _looked_up(many, hot, [key], "parts")
    dealt = dealt.withColumn(PART, _own_part(dealt, "parts")).drop("parts")
    spread = [_looked_up(df, hot, [key], "parts").withColumn(PART, _every_part("parts")).drop("parts") for df in few]
    return dealt, spread, [key, PART]


def split_both(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with the parts of either, and the columns to join on: each pair of rows meets once.

    A key hot on both sides becomes a grid: rows of a side lie in one line of it and are repeated along it.
    """
    hot_left, hot_right = hot_cells(left, keys, "lefts"), hot_cells(right, keys, "rights")

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        part, across = (f"{own}_{PART}", f"{other}_{PART}")
        df = _looked_up(df, hot_left if own == "lefts" else hot_right, keys, own)
        df = df.withColumn(part, _own_part(df, own)).drop(own)
        df = _looked_up(df, hot_left if other == "lefts" else hot_right, keys, other)
        return df.withColumn(across, _every_part(other)).drop(other)

    columns = [*keys, f"lefts_{PART}", f"rights_{PART}"]
    return dealt(left, "lefts", "rights"), dealt(right, "rights", "lefts"), columns
