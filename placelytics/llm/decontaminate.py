"""Benchmark passages in training documents, with DataFrame functions only.

The benchmark's n-grams are a broadcast hash set, keyed by one word of each n-gram: its longest, as
long words are rare. Documents are split into words once and every word probes that set; only where
it hits is the whole window compared, so no window of a document is ever built or shuffled in vain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placelytics.llm.shared import ascii_lower, require, stored

SIZE = 10
#: The set of n-grams is broadcast up to this many, and bytes of words and items; beyond, the probe is shuffled.
BROADCAST_NGRAMS, BROADCAST_BYTES = 500_000, 64 << 20
#: Names of contaminated documents that are broadcast, 16 bytes and an id each; beyond, documents are shuffled.
BROADCAST_ROWS = 1_000_000

#: Words are runs of letters, digits and all non-ASCII characters.
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _GAP), "")


def benchmark_ngrams(benchmark: DataFrame, id: str = "item_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """``(gram, items, anchor, at)``: every distinct window, its items and its longest word.

    A window is ``size`` consecutive words; an item with fewer words is one window; one without
    words, or null, has none. A null id counts as the id of the empty name.
    """
    require(benchmark, id, text)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    longest = F.array_max(F.transform("gram", lambda w, i: F.struct(F.length(w).alias("n"), (-i).alias("i"), w.alias("w"))))
    return (
        benchmark.select(F.coalesce(F.col(id).cast("string"), F.lit("")).alias("item"), words(F.col(text)).alias("w"))
        .where(F.size("w") > 0)
        .select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, size))).alias("gram"))
        .groupBy("gram")
        .agg(F.collect_set("item").alias("items"))
        .withColumn("longest", longest)
        .select("gram", "items", F.col("longest.w").alias("anchor"), (-F.col("longest.i")).alias("at"))
    )


def _few(ngrams: DataFrame) -> bool:
    """Whether the n-grams, with their items, may be broadcast."""
    held = F.octet_length(F.array_join("gram", " ")) + F.octet_length(F.array_join("items", " "))
    size = ngrams.agg(F.count("*").alias("n"), F.coalesce(F.sum(held), F.lit(0)).alias("bytes")).first()
    return size["n"] <= BROADCAST_NGRAMS and size["bytes"] <= BROADCAST_BYTES


def _found_by_broadcast(split: DataFrame, ngrams: DataFrame) -> DataFrame:
    """``(id, h, first, end, items)`` of every occurrence of an n-gram in ``(id, h, w)``."""
    at_word = split.select("id", "h", "w", F.posexplode("w").alias("pos", "word"))
    first = F.col("pos") - F.col("at")
    window = F.slice("w", F.greatest(first, F.lit(0)) + 1, F.size("gram"))
    return at_word.join(
        F.broadcast(ngrams), (F.col("word") == F.col("anchor")) & (first >= 0) & (window == F.col("gram"))
    ).select("id", "h", first.alias("first"), (first + F.size("gram")).alias("end"), "items")


def _found_by_shuffle(split: DataFrame, ngrams: DataFrame) -> DataFrame:
    """The same without a broadcast: no row that is shuffled by a word carries the words of its document.

    Places of words are joined with the anchors by hash. The places that an anchor hits, with the shapes
    ``(at, n)`` of its n-grams, of which there are fewer than ``size`` squared, go back to their document, which cuts
    out just those windows; the windows are joined with the n-grams, and that decides.
    """
    shapes = ngrams.groupBy(F.xxhash64("anchor").alias("word")).agg(
        F.collect_set(F.struct("at", F.size("gram").alias("n"))).alias("shapes")
    )
    places = split.select("id", "h", F.posexplode(F.transform("w", lambda w: F.xxhash64(w))).alias("pos", "word"))
    asked = (
        places.join(shapes, "word")
        .groupBy(F.col("id").alias("asked_id"), F.col("h").alias("asked_h"))
        .agg(F.collect_set(F.struct("pos", "shapes")).alias("asked"))
    )
    whole = split.join(asked, F.col("id").eqNullSafe(F.col("asked_id")) & (F.col("h") == F.col("asked_h")))
    cut = F.flatten(
        F.transform(
            "asked",
            lambda a: F.transform(
                F.filter(a["shapes"], lambda s: a["pos"] >= s["at"]),
                lambda s: F.struct(
                    (a["pos"] - s["at"]).alias("first"), F.slice("w", a["pos"] - s["at"] + 1, s["n"]).alias("gram")
                ),
            ),
        )
    )
    windows = whole.select("id", "h", F.inline(cut)).join(ngrams.select("gram", "items"), "gram")
    return windows.select("id", "h", "first", (F.col("first") + F.size("gram")).alias("end"), "items")


def hits(docs: DataFrame, ngrams: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, h, items, spans, n_hit)`` of the documents with occurring windows.

    ``h`` hashes the text, so that repeated ids with unlike texts stay apart. ``spans`` are the
    merged runs ``(first word, last word + 1)``, counted from 0; ``n_hit`` counts their words.
    """
    split = docs.select(F.col(id).alias("id"), F.xxhash64(text).alias("h"), words(F.col(text)).alias("w"))
    found = (_found_by_broadcast if _few(ngrams) else _found_by_shuffle)(split, ngrams)
    spans = F.sort_array(F.collect_set(F.struct("first", "end")))
    merged = F.aggregate(
        "spans",
        F.array().cast("array<struct<first:int,end:int>>"),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (s["first"] <= F.get(acc, F.size(acc) - 1)["end"]),
            F.concat(
                F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
                F.array(
                    F.struct(
                        F.get(acc, F.size(acc) - 1)["first"].alias("first"),
                        F.greatest(F.get(acc, F.size(acc) - 1)["end"], s["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(acc, F.array(s))),
    )
    covered = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["first"]))
    return (
        found.groupBy("id", "h")
        .agg(spans.alias("spans"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
        .withColumn("spans", merged)
        .withColumn("n_hit", covered)
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, *, id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", size: int = SIZE,
) -> DataFrame:
    """``(id, n_words, n_hit, n_items, items, spans, contaminated)`` of every document.

    A document word inside any occurrence of a benchmark window is hit. Null and empty texts have
    no words and are clean; repeated rows get equal results; without benchmark items all is clean.
    """
    require(docs, id, text)
    found = hits(docs, stored(benchmark_ngrams(benchmark, item_id, item_text, size), "ngrams"), id, text)
    every = docs.select(
        F.col(id).alias("id"),
        F.xxhash64(text).alias("h"),
        F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(_WORD)).cast("long").alias("n_words"),
    ).alias("d")
    none = F.array().cast("array<string>")
    return every.join(
        found.alias("f"), F.col("d.id").eqNullSafe(F.col("f.id")) & (F.col("d.h") == F.col("f.h")), "left"
    ).select(
        F.col("d.id").alias(id),
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", none).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<first:int,end:int>>")).alias("spans"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, *, remove: str = "documents", id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", size: int = SIZE,
) -> DataFrame:
    """``docs`` without what occurs in the benchmark, with its own columns and order of columns.

    ``remove="documents"`` drops contaminated rows; ``"spans"`` takes the hit words, each with the gap
    behind it, out of the text and keeps the row. Clean rows stay as they are.
    """
    require(docs, id, text)
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove must be 'documents' or 'spans', not {remove!r}")
    found = hits(docs, stored(benchmark_ngrams(benchmark, item_id, item_text, size), "ngrams"), id, text).select(
        F.col("id").alias("__id"), F.col("h").alias("__h"), F.col("spans").alias("__spans")
    )
    same = F.col(id).eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__h"))
    if remove == "documents":
        found = stored(found.select("__id", "__h"), "contaminated")
        if found.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
            found = F.broadcast(found)
        return docs.join(found, same, "left_anti")
    kept = F.concat(
        F.element_at("__gaps", 1),
        F.array_join(
            F.transform(
                "__words",
                lambda w, i: F.when(
                    F.exists("__spans", lambda s: (s["first"] <= i) & (i < s["end"])), F.lit("")
                ).otherwise(F.concat(w, F.element_at("__gaps", i + 2))),
            ),
            "",
        ),
    )
    return (
        docs.join(found, same, "left")
        .withColumn("__words", F.when(F.col("__spans").isNotNull(), F.regexp_extract_all(text, F.lit(_WORD), 0)))
        .withColumn("__gaps", F.when(F.col("__spans").isNotNull(), F.split(text, _WORD)))
        .withColumn("__kept", F.when(F.col("__spans").isNull(), F.col(text)).otherwise(kept))
        .select(*(F.col("__kept").alias(text) if c == text else F.col(c) for c in docs.columns))
    )
