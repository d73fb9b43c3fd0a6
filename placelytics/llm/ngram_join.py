"""Similarity join of documents on the Jaccard similarity of their word n-gram sets.

A grouped prefix join. The n-grams of a set are put into one global order and only a prefix is
indexed: two sets that are similar enough share an n-gram of their prefixes. Documents with identical
prefixes and sizes are one group, so copies are indexed once. Pairs of groups that share an n-gram are
filtered by size and position, expanded to their member sets, filtered by sketches, and verified on
the full sets.

What is asked for is the components of the links, so pairs are found in two phases. First every
member of an n-gram's list is verified against one leader of its size, which joins most of a family
of near copies in one step each. Then, and only where one list still spans several components, pairs
across components are verified, all of them. No link between components can be missed, and no
list is ever expanded into all pairs of one family.

The order goes by how many documents hold an n-gram, in four classes, so that common passages do not
fill the prefixes and lists stay short however large the table. The classes are three bitmaps of fixed
size made from counts over all documents; they only change the cost, never the result. A number of 63
bits, the hash of the n-gram below its class, stands for an n-gram and its place in the order.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placelytics.llm.shared import bitmap, components, cut, marked, require, rows_marked, small_batches, stored, temporary
from placelytics.llm.wordhash import blocks, gram_hashes, hashes, run_hashes, words

WORDS, PERCENT = 5, 80
#: Least number of documents, as a power of two, of each class of common n-grams above the one before.
COMMON_FROM, CLASS_STEP, CLASSES = 3, 3, 3
#: The least class starts higher where it would hold more n-grams than this, an eighth of a bitmap's bits.
COMMON_MOST = 1 << 23
#: So many n-grams before one in a prefix tell that a pair has met there already.
BEFORE = 8
#: Columns of a set's sketch, 64 bits each.
_SKETCH = ("sketch0", "sketch1", "sketch2", "sketch3")


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct 64-bit hashes of each text's n-grams; A-Z count as a-z.

    A text with fewer words than ``size`` has one n-gram, all its words; one without words has none.
    """
    for _, _, data, offsets in blocks(column):
        starts, ends, firsts = words(data, offsets)
        word = hashes(data, starts, ends, lower=True)
        grams = gram_hashes(word, size)
        short = run_hashes(word, firsts[:-1], firsts[1:])
        for i in range(len(offsets) - 1):
            first, n = firsts[i], firsts[i + 1] - firsts[i]
            if n >= size:
                yield np.unique(grams[first : first + n - size + 1])
            else:
                yield short[i : i + (n > 0)]


def _prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def common_ngrams(docs: DataFrame, size: int, percent: int, text: str = "text") -> list[np.ndarray]:
    """Bitmaps of the n-grams that occur in many, in very many, and in yet more documents.

    Prefixes are the least hashes, so n-grams are counted over all documents, but only those in twice the
    share of the space of hashes that prefixes take. The driver holds the bitmaps alone.
    """
    below = np.uint64(min((1 << 64) - 1, (1 << 64) * 2 * (100 - percent) // 100))

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen = [s[: np.searchsorted(s, below)] for s in shingle_sets(b.column(0), size)]
            grams, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *seen]), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams.view(np.int64)), pa.array(counts)], names=["gram", "n"]
            )
            pa.default_memory_pool().release_unused()

    counted = (
        docs.select(docs[text])
        .mapInArrow(local, "gram long, n long")
        .groupBy("gram")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= 1 << COMMON_FROM)
    )
    common = stored(counted.select("gram", F.floor(F.log2("n")).cast("int").alias("power")), "common")
    above, start = 0, COMMON_FROM
    for power, n in sorted(((r["power"], r["n"]) for r in common.groupBy("power").agg(F.count("*").alias("n")).collect()), reverse=True):
        above += n
        if above > COMMON_MOST:
            start = power + 1
            break
    return [bitmap(common.where(F.col("power") >= start + CLASS_STEP * i).select("gram")) for i in range(CLASSES)] if above else []


def signatures(docs: DataFrame, size: int, percent: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, h, n, node, grp, prefix)`` and a sketch of every row.

    ``n`` is the size of its set, ``node`` a 128-bit name of the set, ``grp`` one of size and prefix and
    ``h`` a hash of the text by which the text is found again. Rows without words have a null node.
    """
    common = docs.sparkSession.sparkContext.broadcast(common_ngrams(docs, size, percent, text))

    def batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = common.value
        for b in batches:
            sizes, nodes, groups, prefixes, sketches = [], [], [], [], []
            for s in shingle_sets(b.column(2), size):
                n = len(s)
                keep = min(n, _prefix_length(n, percent))
                order = (s >> np.uint64(3)).view(np.int64)
                if held:
                    places = sum(marked(bits, s.view(np.int64)).astype(np.int64) for bits in held)
                    order = np.sort(order + (places << 61))
                prefix = order[:keep].copy()
                sizes.append(n)
                nodes.append(blake2b(s.tobytes(), digest_size=16).digest() if n else None)
                name = blake2b(prefix.tobytes(), digest_size=8, salt=n.to_bytes(8, "big")).digest()
                groups.append(int.from_bytes(name, "big", signed=True))
                prefixes.append(prefix)
                parity = np.bincount((s & np.uint64(64 * len(_SKETCH) - 1)).view(np.int64), minlength=64 * len(_SKETCH)) & 1
                sketches.append(np.packbits(parity.astype(np.uint8)).view(np.int64))
            ends = np.cumsum([0, *map(len, prefixes)]).astype(np.int32)
            flat = pa.array(np.concatenate([np.zeros(0, np.int64), *prefixes]))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0), b.column(1), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()),
                    pa.array(groups, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), flat),
                    *(pa.array([k[i] for k in sketches], pa.int64()) for i in range(len(_SKETCH))),
                ],
                names=["id", "h", "n", "node", "grp", "prefix", *_SKETCH],
            )
            pa.default_memory_pool().release_unused()

    rows = docs.select(F.col(id).cast("long").alias("id"), F.xxhash64(text).alias("h"), F.col(text).alias("text"))
    longs = "".join(f", {c} long" for c in _SKETCH)
    return rows.mapInArrow(batch, f"id long, h long, n long, node binary, grp long, prefix array<long>{longs}")


def _verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` of sets that are similar enough; ``texts(node, text)`` holds them all, deflated."""

    def opened(column: pa.Array) -> pa.Array:
        return pa.array([zlib.decompress(t) for t in column.to_pylist()], pa.binary())

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, None
        for b in batches:
            linked = np.zeros(len(b), bool)
            names = b.column(0).to_pylist()
            for start in range(0, len(b), 64):
                for i, other in enumerate(shingle_sets(opened(b.column(3).slice(start, 64)), size), start):
                    if names[i] != last:
                        last, own = names[i], next(shingle_sets(opened(b.column(2).slice(i, 1)), size))
                    both = len(np.intersect1d(own, other, assume_unique=True))
                    linked[i] = 100 * both >= percent * (len(own) + len(other) - both)
            yield b.select(["a", "b"]).filter(pa.array(linked))
            pa.default_memory_pool().release_unused()

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b").mapInArrow(check, "a binary, b binary")


def _fits(a: str, b: str, percent: int):
    """Size and position filter of a shared n-gram: what both sets can still have in common suffices."""
    na, nb, pa_, pb = F.col(f"{a}n"), F.col(f"{b}n"), F.col(f"{a}pos"), F.col(f"{b}pos")
    most = F.least(na - pa_, nb - pb)
    return (100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & ((100 + percent) * most >= percent * (na + nb))


def _sketches_fit(percent: int, a: str = "a", b: str = "b"):
    """Filter of two sets on their sketches.

    A bit of a sketch is the parity of the n-grams that fall on it, so sketches differ in at most as many
    bits as the sets differ in n-grams; and similar sets may only differ in so many.
    """
    apart = sum((F.bit_count(F.col(f"{a}{s}").bitwiseXOR(F.col(f"{b}{s}"))) for s in _SKETCH), F.lit(0))
    return (100 + percent) * apart <= (100 - percent) * (F.col(f"{a}n") + F.col(f"{b}n"))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _with_before(lists: DataFrame) -> DataFrame:
    """``lists`` with the few n-grams ``before`` each one in the prefix it stands in."""
    few = Window.partitionBy("grp").orderBy("pos").rowsBetween(-BEFORE, -1)
    return lists.withColumn("before", F.collect_list("gram").over(few))


def _meetings(lists: DataFrame, percent: int) -> DataFrame:
    """Pairs of groups in different components that share an n-gram and may be similar.

    A pair is made at the first n-gram it shares, and at a later one only if none of the few before that
    is shared. The others would fill the join with the same pair once for each n-gram of a passage.
    """
    a, b = (
        lists.select("gram", *(F.col(c).alias(f"{x}{c}") for c in ("grp", "n", "pos", "low", "high", "several", "before", *_SKETCH)))
        for x in "ab"
    )
    across = (F.col("alow") != F.col("blow")) | (F.col("alow") != F.col("ahigh")) | (F.col("blow") != F.col("bhigh"))
    # The sketch of a group of one set is that of the set.
    close = F.col("aseveral") | F.col("bseveral") | _sketches_fit(percent)
    anew = ~F.arrays_overlap("abefore", "bbefore")
    return a.join(
        b, (a["gram"] == b["gram"]) & (F.col("agrp") < F.col("bgrp")) & across & _fits("a", "b", percent) & close & anew
    ).select(F.col("agrp").alias("xgrp"), *(F.col(f"b{c}").alias(f"y{c}") for c in ("grp", "n", "low", "high", "several", *_SKETCH)))


def links(docs: DataFrame, rows: DataFrame, size: int, percent: int, text: str = "text") -> DataFrame:
    """Verified links ``(a, b)`` between sets, enough of them to connect every component."""
    full = rows.where("n > 0")
    prefixes = (F.first("prefix").alias("prefix"), F.count("*").alias("copies"))
    groups = stored(full.groupBy("grp", "n").agg(*prefixes), "groups")
    listed = groups.select("grp", "n", "copies", F.posexplode("prefix").alias("pos", "gram"))
    shared = stored(listed.groupBy("gram").agg(F.count("*").alias("k")).where("k > 1"), "shared")
    lists = stored(rows_marked(listed, "gram", shared.select("gram")).join(shared, "gram"), "lists")
    own = [F.first(c).alias(c) for c in ("n", *_SKETCH)]
    nodes = stored(full.groupBy("node").agg(F.min("grp").alias("grp"), F.min("h").alias("h"), *own), "nodes")
    heads = nodes.groupBy("grp").agg(F.min("node").alias("head"), F.max("node").alias("tail"))

    # A list of two is one pair; a longer one has a leader for each size.
    level = F.when(F.col("k") > 2, F.floor(F.log(F.col("n")) / F.log(F.lit(100 / percent)))).otherwise(0)
    ranked = lists.withColumn("level", level)
    leaders = ranked.groupBy("gram", "level").agg(F.max(F.struct("copies", "grp", "n", "pos")).alias("l"))
    stars = (
        ranked.join(leaders, ["gram", "level"])
        .select(F.col("l.grp").alias("agrp"), F.col("l.n").alias("ln"), F.col("l.pos").alias("lpos"), F.col("grp").alias("mgrp"), F.col("n").alias("mn"), F.col("pos").alias("mpos"))
        .where((F.col("agrp") != F.col("mgrp")) & _fits("l", "m", percent))
        .select("agrp", "mgrp")
        .distinct()
    )
    a = _side(nodes, "a").join(heads.select(F.col("head").alias("a"), (F.col("head") != F.col("tail")).alias("several")), "a")
    stars = stars.join(a.drop("several"), "agrp").join(
        _side(nodes, "b"), (F.col("mgrp") == F.col("bgrp")) & _sketches_fit(percent)
    )
    within = a.where("several").join(_side(nodes, "b"), (F.col("agrp") == F.col("bgrp")) & _sketches_fit(percent))
    first = cut(_ordered(stars.select("a", "b").unionByName(within.select("a", "b"))))
    found = cut(_verified(first, _texts(docs, nodes, first, text), size, percent))

    roots = components(found.select(F.col("a").alias("u"), F.col("b").alias("v")))
    # A component is named by 64 bits here.
    name = F.xxhash64(F.coalesce("root", "node")).alias("root")
    placed = cut(nodes.join(roots, "node", "left").select("node", "grp", "n", *_SKETCH, name))
    ranges = cut(
        placed.groupBy("grp").agg(
            F.min("root").alias("low"), F.max("root").alias("high"), (F.count("*") > 1).alias("several"),
            *(F.first(c).alias(c) for c in _SKETCH),
        )
    )
    ranged = _with_before(lists.join(ranges, "grp"))
    # A list of two groups of one set each is done: its one pair has been verified.
    spans = [F.min("low").alias("l"), F.max("high").alias("h"), F.max("several").alias("any_several"), F.max("k").alias("most")]
    mixed = ranged.groupBy("gram").agg(*spans).where("l <> h AND (most > 2 OR any_several)").select("gram")
    open_ = stored(ranged.join(mixed, "gram"), "open")
    pairs = _meetings(open_, percent).distinct()
    sides = {x: _side(placed, x, "root") for x in "ab"}
    unlike = (F.col("aroot") != F.col("broot")) & _sketches_fit(percent)
    whole = ((F.col("ylow") != F.col("yhigh")) | (F.col("aroot") != F.col("ylow"))) & (
        F.col("yseveral") | _sketches_fit(percent, "a", "y")
    )
    expanded = (
        pairs.join(sides["a"], (F.col("xgrp") == F.col("agrp")) & whole)
        .select("a", "an", "aroot", *(f"a{c}" for c in _SKETCH), "ygrp")
        .join(sides["b"], (F.col("ygrp") == F.col("bgrp")) & unlike)
    )
    # In a group of several components one set of each pair lies outside the group's largest.
    parts = placed.join(ranges.where("low <> high").select("grp"), "grp").groupBy("grp", "root").agg(F.count("*").alias("n"))
    largest = parts.groupBy(F.col("grp").alias("lgrp")).agg(F.max(F.struct("n", "root")).alias("largest"))
    outside = sides["a"].join(largest, (F.col("agrp") == F.col("lgrp")) & (F.col("aroot") != F.col("largest.root")))
    inside = outside.join(sides["b"], (F.col("agrp") == F.col("bgrp")) & unlike)
    second = _ordered(expanded.select("a", "b").unionByName(inside.select("a", "b"))).join(first, ["a", "b"], "left_anti")
    second = cut(second)
    return found.unionByName(cut(_verified(second, _texts(docs, nodes, second, text), size, percent)))


def _side(nodes: DataFrame, x: str, *more: str) -> DataFrame:
    """The sets as members ``x`` of groups ``xgrp``, with size and sketch."""
    return nodes.select(F.col("node").alias(x), *(F.col(c).alias(f"{x}{c}") for c in ("grp", "n", *_SKETCH, *more)))


def _texts(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, text: str) -> DataFrame:
    """``(node, text)`` of the sets in ``pairs``, deflated; other texts are not shuffled."""
    named = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = stored(nodes.join(named, "node").select("node", "h"), "wanted")
    every = docs.select(F.xxhash64(text).alias("h"), F.col(text).alias("text")).where("text IS NOT NULL")
    held = docs.sparkSession.sparkContext.broadcast(bitmap(wanted.select("h")))

    # One step marks and deflates: two in a row would keep two Python workers for each task.
    def deflate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.filter(pa.array(marked(held.value, b.column(0).to_numpy())))
            texts = pa.array([zlib.compress(t.as_buffer(), 1) for t in b.column(1).cast(pa.binary())], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), texts], names=["h", "text"])
            pa.default_memory_pool().release_unused()

    found = every.mapInArrow(deflate, "h long, text binary").join(wanted, "h")
    return stored(found.groupBy("node").agg(F.first("text").alias("text")), "texts")


def classes(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", size: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """``(id, h, n, component_id)`` of every row: its set's size and the least id of its component.

    Two rows link when ``100 * intersection >= percent * union`` of their sets of ``size`` consecutive
    words, with A-Z as a-z. Rows with equal sets link. A null or wordless text has an empty set and links
    with nothing: its component is its own id. Null ids take part; a component of null ids alone
    has a null id. ``h`` hashes the text. An empty table gives an empty result.
    """
    require(docs, id, text)
    with temporary(docs.sparkSession), small_batches(docs.sparkSession):
        return stored(_classes(docs, id, text, size, percent), "classes", keep=True)


def _classes(docs: DataFrame, id: str, text: str, size: int, percent: int) -> DataFrame:
    rows = stored(signatures(docs, size, percent, id, text), "signatures")
    edges = links(docs, rows, size, percent, text)
    roots = components(edges.select(F.col("a").alias("u"), F.col("b").alias("v")))
    least = rows.where("n > 0").groupBy("node").agg(F.min("id").alias("least"))
    placed = least.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = placed.groupBy("root").agg(F.min("least").alias("component"))
    named = placed.join(ids, "root").select("node", "component", "root")
    return rows.join(named, "node", "left").select(
        F.col("id").alias(id), "h", "n",
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component_id"), "root",
    )


def drop_near_duplicates(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", size: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """``docs`` with one row of every component, that with the least id (a null id comes last).

    Rows without words belong to no component and stay, all of them. Columns stay as they are.
    """
    found = classes(docs, id=id, text=text, size=size, percent=percent)
    kept = (
        found.where("n > 0")
        .groupBy("root")
        .agg(F.min(F.struct(F.col(id).isNull().alias("none"), F.col(id).alias("id"), F.col("h").alias("h"))).alias("best"))
        .select(F.col("best.id").alias("__id"), F.col("best.h").alias("__h"))
    )
    worded = F.coalesce(F.col(text), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    one = (
        docs.where(worded)
        .withColumn("__text", F.xxhash64(text))
        .join(kept, F.col(id).cast("long").eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__h")))
        .dropDuplicates(["__id", "__h"])
        .select(*(docs[c] for c in docs.columns))
    )
    return one.unionByName(docs.where(~worded))
