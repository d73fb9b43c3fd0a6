"""Mix sources to target weights by entropy balancing.

Every source has a target in words. Among all document rates that meet the targets, those nearest to
"each document once" in relative entropy are exponential tilts of the documents' sizes,
``rate = min(CAP, exp(tilt * size / scale))``, with one tilt per source. The tilts solve the convex
dual by Newton steps; a step is one aggregation of a table of source, size and number of documents,
which has at most about ``sqrt(2 * words)`` rows a source. Rates are then rounded into whole copies.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placelytics.llm.shared import cut, require, stored

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
#: The most often a document is taken, and with it the most a source can give.
CAP = 2
#: Newton stops when every source is this near its target, relative to it.
TOLERANCE = 1e-7
MAX_STEPS = 100
#: Documents of one source and size among which one task chooses.
CHOICE = 10_000
_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(_WORD)).cast("long")


def _ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with ``rank``, from 0, by code point and null last; sorted in ranges, not in one task."""
    parts = cut(
        sources.withColumn("none", F.col("source").isNull())
        .repartitionByRange("none", "source")
        .withColumn("part", F.spark_partition_id())
    )
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        parts.groupBy("part")
        .agg(F.count("*").alias("n"))
        .select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("offset"))
    )
    within = Window.partitionBy("part").orderBy("none", "source")
    return (
        parts.withColumn("at", F.row_number().over(within))
        .join(offsets, "part")
        .withColumn("rank", F.col("at") + F.col("offset") - 1)
        .drop("none", "part", "at", "offset")
    )


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """``sources(source, source_size)`` with ``target``.

    The weights repeat in the order of the sources. ``share`` times all words are dealt by weight; a
    target stops at ``cap`` times its source and the excess is dealt again until none is above.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    table = cut(_ranked(sources).withColumn("weight", weight).withColumn("most", (cap * F.col("source_size")).cast("double")))
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        full = F.col("most") <= level * F.col("weight")
        held = table.agg(
            F.sum(F.when(full, F.col("most")).otherwise(0.0)).alias("most"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        if not held.weight:
            break
        new = (min(share, cap) * total - held.most) / held.weight
        if new <= level:
            break
        level = new
    return table.select("source", "source_size", F.least("most", level * F.col("weight")).alias("target"))


def tilts(sizes: DataFrame, wanted: DataFrame, cap: int = CAP) -> DataFrame:
    """``wanted`` with ``tilt`` and ``scale`` of each source, by safeguarded Newton steps on the dual.

    ``sizes(source, size, n)`` counts the documents. A target of all ``cap`` copies has the tilt
    infinity, one of none minus infinity.
    """
    scale = sizes.groupBy("source").agg((F.sum(F.col("n") * F.col("size")) / F.greatest(F.sum("n"), F.lit(1))).alias("scale"))
    limit = F.col("target") >= cap * F.col("source_size") * (1 - 1e-12)
    state = cut(
        wanted.join(scale, wanted["source"].eqNullSafe(scale["source"])).select(
            wanted["source"], "source_size", "target", "scale",
            F.when(limit, float("inf")).when(F.col("target") <= 0, float("-inf")).otherwise(0.0).alias("tilt"),
            F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high"),
        )
    )
    for _ in range(MAX_STEPS):
        sums = _sums(sizes, state.select("source", "scale", "tilt"), cap)
        open_ = ~F.col("tilt").isin(float("inf"), float("-inf")) & (
            F.abs(F.col("words") - F.col("target")) > TOLERANCE * F.col("target")
        )
        step = state.join(sums.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).withColumn("open", open_)
        low = F.when(F.col("words") < F.col("target"), F.col("tilt")).otherwise(F.col("low"))
        high = F.when(F.col("words") > F.col("target"), F.col("tilt")).otherwise(F.col("high"))
        solvable = (F.col("slope") > 0) & (F.col("words") > 0) & (F.col("target") > 0)
        step_by = F.log(F.col("words") / F.col("target")) * F.col("words") / F.col("slope")
        newton = F.when(solvable, F.col("tilt") - step_by)
        between = (
            F.when(F.col("low") == float("-inf"), F.least(F.col("high") * 2, F.col("high") - 1.0))
            .when(F.col("high") == float("inf"), F.greatest(F.col("low") * 2, F.col("low") + 1.0))
            .otherwise((F.col("low") + F.col("high")) / 2)
        )
        inside = F.coalesce((newton > F.col("low")) & (newton < F.col("high")), F.lit(False))
        state = cut(
            step.withColumn("low", low)
            .withColumn("high", high)
            .withColumn("tilt", F.when(~F.col("open"), F.col("tilt")).when(inside, newton).otherwise(between))
            .select("source", "source_size", "target", "scale", "tilt", "low", "high", "open")
        )
        if state.where("open").isEmpty():
            break
        state = state.drop("open")
    # Sums of doubles differ in their last bits from run to run; rounded tilts do not.
    return state.select("source", "source_size", "target", "scale", F.round("tilt", 9).alias("tilt"))


def _part() -> Column:
    return F.when(F.col("scale") > 0, F.col("size") / F.col("scale")).otherwise(0.0)


def _rate(cap: int) -> Column:
    """The tilted rate of a document; a document without words cannot be tilted and keeps rate 1."""
    tilted = F.least(F.lit(float(cap)), F.exp(F.col("tilt") * _part()))
    return F.when(F.col("size") == 0, 1.0).otherwise(tilted)


def _sums(sizes: DataFrame, tilted: DataFrame, cap: int) -> DataFrame:
    rate, words = _rate(cap), F.col("n") * F.col("size")
    part = _part()
    joined = sizes.join(tilted.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
    return joined.groupBy("source").agg(
        F.sum(words * rate).alias("words"), F.sum(F.when(rate < cap, words * rate * part).otherwise(0.0)).alias("slope")
    )


def _copies(cap: int):
    def whole(rows: pd.DataFrame) -> pd.DataFrame:
        """Whole copies of each size of one source, from the longest; what is over goes to the next."""
        rows = rows.sort_values("size", ascending=False)
        wanted = np.cumsum(rows["n"] * rows["rate"] * rows["size"]).to_numpy()
        copies, taken = np.zeros(len(rows), np.int64), 0
        for i, (size, n) in enumerate(zip(rows["size"], rows["n"], strict=True)):
            if size:
                copies[i] = min(max(round((wanted[i] - taken) / size), 0), cap * n)
                taken += int(copies[i]) * size
            else:
                copies[i] = n
        return rows.assign(copies=copies)[["source", "size", "n", "copies"]]

    return whole


def mix(
    docs: DataFrame, *, id: str = "doc_id", source: str = "source", size: Column | None = None, text: str = "text",
    weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: int = CAP,
) -> DataFrame:
    """``(id, source, size, source_size, target, rate, copies, taken)`` of every document.

    ``size`` counts the words of ``text``, unless given; null counts as 0. ``copies`` is a whole number
    from 0 to ``cap`` and ``taken`` is ``copies * size``. Within a source and size the copies go by a
    hash of the id, so reruns agree; rows that repeat id, source and size are interchangeable. A null
    source is a source. Documents without words are taken once, with 0 words. An empty table gives
    an empty result.
    """
    require(docs, id, source)
    table = stored(
        docs.select(
            F.col(id).alias("id"), F.col(source).cast("string").alias("source"),
            F.coalesce(word_count(F.col(text)) if size is None else size, F.lit(0)).cast("long").alias("size"),
        ),
        "sizes",
    )
    sizes = cut(table.groupBy("source", "size").agg(F.count("*").alias("n")))
    sources = sizes.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    state = tilts(sizes, targets(sources, weights, share, cap), cap)
    keyed = state.withColumnRenamed("source", "s")
    same = F.col("source").eqNullSafe(F.col("s"))
    rated = sizes.join(keyed, same).select("source", "size", "n", _rate(cap).alias("rate"))
    classes = rated.groupBy("source").applyInPandas(
        _copies(cap), "source string, size long, n long, copies long"
    ).withColumn("parts", F.ceil(F.col("n") / CHOICE))
    classes = cut(classes).select(F.col("source").alias("c"), F.col("size").alias("z"), "n", "copies", "parts")
    part = F.pmod(F.xxhash64("id"), F.col("parts"))
    dealt = table.join(
        classes, F.col("source").eqNullSafe(F.col("c")) & (F.col("size") == F.col("z"))
    ).select("id", "source", "size", "n", "copies", part.alias("part"))
    ahead = Window.partitionBy("source", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    quotas = (
        dealt.groupBy("source", "size", "part", "n", "copies")
        .agg(F.count("*").alias("here"))
        .withColumn("ahead", F.coalesce(F.sum("here").over(ahead), F.lit(0)))
        .select(
            F.col("source").alias("c"), F.col("size").alias("z"), F.col("part").alias("p"),
            F.greatest(F.col("copies") % F.col("n") - F.col("ahead"), F.lit(0)).alias("extra"),
        )
    )
    rank = F.row_number().over(Window.partitionBy("source", "size", "part").orderBy(F.xxhash64("id"), "id"))
    chosen = dealt.withColumn("rank", rank).join(
        quotas,
        F.col("source").eqNullSafe(F.col("c")) & (F.col("size") == F.col("z")) & (F.col("part") == F.col("p")),
    )
    copies = (F.floor(F.col("copies") / F.col("n")) + (F.col("rank") <= F.col("extra")).cast("long")).cast("long")
    return (
        chosen.select("id", "source", "size", copies.alias("copies"))
        .join(keyed, same)
        .select(
            F.col("id").alias(id), F.col("source").alias(source), "size", "source_size", "target",
            _rate(cap).alias("rate"), "copies", (F.col("copies") * F.col("size")).alias("taken"),
        )
    )


def mixed(docs: DataFrame, *, id: str = "doc_id", source: str = "source", repeat: bool = True, **options) -> DataFrame:
    """The mixed training set: every document as often as ``mix`` takes it, those with no copies left out.

    Rows keep all columns of ``docs`` and get ``size``, ``source_size``, ``target``, ``rate``, ``copies``
    and ``taken``, called ``mix_...`` where ``docs`` has such a column, and ``copy``, from 1. With
    ``repeat`` off a document is one row whatever its copies, without ``copy``. ``options`` are those
    of ``mix``. Rows that repeat id, source and size share out their copies; none is lost.
    """
    size, text = options.get("size"), options.get("text", "text")
    words = F.coalesce(word_count(F.col(text)) if size is None else size, F.lit(0)).cast("long")
    # Structs with a null in the same place are equal, and one key serves the window and the join.
    own = F.struct(F.col(id).alias("id"), F.col(source).cast("string").alias("source"), words.alias("size"))
    whole = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("doc"), own.alias("key"))
    dealt = mix(docs, id=id, source=source, **options)
    facts = ["source_size", "target", "rate"]
    shares = (
        dealt.select(F.struct(F.col(id).alias("id"), F.col(source).alias("source"), "size").alias("to"), *facts, "copies")
        .groupBy("to", "copies")
        .agg(F.count("*").alias("n"), *(F.first(c).alias(c) for c in facts))
        .withColumn("upto", F.sum("n").over(Window.partitionBy("to").orderBy("copies")))
    )
    rank = F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64("doc")))
    found = whole.withColumn("rank", rank).join(
        shares, (F.col("key") == F.col("to")) & (F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("n"))
    )
    made = {"size": F.col("key.size"), **{c: F.col(c) for c in facts}, "copies": F.col("copies"), "taken": F.col("copies") * F.col("key.size")}
    found = found.where("copies > 0")
    if repeat:
        found = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
        made["copy"] = F.col("copy")
    return found.select("doc.*", *(c.alias(f"mix_{name}" if name in docs.columns else name) for name, c in made.items()))
