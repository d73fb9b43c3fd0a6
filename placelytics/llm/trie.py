"""Trie of the prefixes that conversations share, built as a burst trie.

A conversation is the sequence of its turns' ids, 16 bytes each. Equal conversations are merged into
one weighted sequence first, so copies cost nothing further. All sequences start as suffixes in one
container under the root. In every round containers of more than ``CONTAINER`` suffixes burst: their
head becomes a node of its own and the suffixes are dealt by their next turn id to containers one turn
deeper. What never grew too large is sorted and swept once, each container on its own, into its
nodes. Totals of the burst heads are summed from below, one small join for each round.

No step holds more than one container, and a head that very many conversations pass through is a row of
sums combined before its shuffle, never a list of its members.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placelytics.llm.shared import Scratch, require

#: Suffixes that a container may hold without bursting.
CONTAINER = 4096
#: Bytes of a turn id, a cut SHA-256.
ID_BYTES = 16
#: Ids of a conversation group that are joined into one row before they are hashed, as a power of two.
_CHUNK_BITS = 12

_NODE = T.StructType(
    [T.StructField("above", T.BinaryType())]
    + [
        T.StructField(name, T.LongType())
        for name in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
    ]
    + [T.StructField("ends_sha256", T.StringType())]
)
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def _short_digest(value: Column) -> Column:
    return F.unhex(F.substring(F.sha2(value, 256), 1, 2 * ID_BYTES))


def sequences(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``(conv_id, ids, sizes)`` of every conversation, in the order of its turns.

    ``ids`` is the turns' ids end to end, ``sizes`` the UTF-8 bytes of their texts. A null role or text
    is empty; a null turn comes first; turns of one number are ordered by their ids, and repeated rows
    are turns of their own. Rows without a conversation id are left out. Ids must be whole numbers.
    """
    require(conversations, conv, turn, role, text)
    if not isinstance(conversations.schema[conv].dataType, T.IntegralType):
        raise ValueError(f"{conv} must hold whole numbers")
    who, said = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    rows = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            _short_digest(F.concat(F.char_length(who).cast("string"), F.lit(":"), who, said)).alias("id"),
            F.octet_length(said).cast("long").alias("bytes"),
        ).alias("t"),
    )
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return ordered.select(
        "conv_id",
        F.unhex(F.array_join(F.transform("t", lambda x: F.hex(x["id"])), "")).alias("ids"),
        F.transform("t", lambda x: x["bytes"]).alias("sizes"),
    )


def _merged(rows: DataFrame) -> DataFrame:
    """``(ids, sizes, n, conv, ends)``, one row per distinct sequence.

    ``ends`` hashes the ids of its conversations in ascending order. Ids are joined into rows of a bounded
    range of ids each, which are hashed one after the other as they come sorted.
    """
    names = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    chunks = (
        rows.withColumn("key", F.unhex(F.sha2("ids", 256)))
        .groupBy("key", F.shiftright("conv_id", _CHUNK_BITS).alias("chunk"))
        .agg(
            F.first("ids").alias("ids"),
            F.first("sizes").alias("sizes"),
            F.count("*").alias("n"),
            F.min("conv_id").alias("conv"),
            names.alias("names"),
        )
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, out = None, None, []

        def closed():
            return {"ids": now["ids"], "sizes": now["sizes"], "n": now["n"], "conv": now["conv"], "ends": state.hexdigest()}

        for b in batches:
            for row in b.to_pylist():
                if now is not None and row["key"] == now["key"]:
                    state.update(b"," + row["names"].encode())
                    now["n"] += row["n"]
                    continue
                if now is not None:
                    out.append(closed())
                now, state = row, hashlib.sha256(row["names"].encode())
            if len(out) > 1000:
                yield from _batches(out, schema)
                out = []
        if now is not None:
            out.append(closed())
        yield from _batches(out, schema)

    schema = pa.schema(
        [("ids", pa.binary()), ("sizes", pa.list_(pa.int64())), ("n", pa.int64()), ("conv", pa.int64()), ("ends", pa.string())]
    )
    return (
        chunks.repartition("key")
        .sortWithinPartitions("key", "chunk")
        .mapInArrow(digest, "ids binary, sizes array<long>, n long, conv long, ends string")
    )


def _batches(rows: list[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema)


class _Node:
    """A node of the path that the sweep is on."""

    __slots__ = ("bytes", "children", "conv", "depth", "ends", "leaves", "n", "saved", "sons")

    def __init__(self, depth: int, size: int) -> None:
        self.depth, self.bytes = depth, size
        self.n, self.conv, self.ends = 0, None, _NO_ENDS
        self.leaves = self.saved = self.sons = 0
        self.children: list[dict] = []

    def closed(self, out: list[dict]) -> dict:
        """Its row, without parent; its children's rows, now that they know it, go to ``out``."""
        for child in self.children:
            child["parent_conv_id"] = self.conv
        out += self.children
        return {
            "above": None,
            "conv_id": self.conv,
            "depth": self.depth,
            "n_convs": self.n,
            "n_children": self.sons,
            "n_leaves": self.leaves or 1,
            "saved_tokens": self.saved + (self.n - 1) * self.bytes,
            "ends_sha256": self.ends,
        }


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of containers whose suffixes come sorted, one container after the other."""
    schema = pa.schema([(f.name, {"binary": pa.binary(), "bigint": pa.int64(), "string": pa.string()}[f.dataType.simpleString()]) for f in _NODE])
    head, path, before, top, out = None, [], b"", None, []

    def up() -> None:
        child, parent = path.pop(), path[-1]
        row = child.closed(out)
        parent.children.append(row)
        parent.sons += 1
        parent.leaves += row["n_leaves"]
        parent.saved += row["saved_tokens"]

    def finish() -> None:
        while len(path) > 1:
            up()
        row = path.pop().closed(out)
        row["above"], row["parent_conv_id"] = top["above"], top["above_conv"]
        out.append(row)

    for b in batches:
        for row in b.to_pylist():
            rest = row["rest"]
            if row["head"] != head:
                if path:
                    finish()
                    if len(out) > 5000:
                        yield from _batches(out, schema)
                        out.clear()
                head, top, before = row["head"], row, b""
                path.append(_Node(row["depth"], row["bytes"]))
            shared, most = 0, min(len(before), len(rest))
            while shared < most and before[shared : shared + ID_BYTES] == rest[shared : shared + ID_BYTES]:
                shared += ID_BYTES
            while len(path) > shared // ID_BYTES + 1:
                up()
            for size in row["sizes"][len(path) - 1 :]:
                path.append(_Node(path[-1].depth + 1, size))
            for node in path:
                node.n += row["n"]
                node.conv = row["conv"] if node.conv is None else min(node.conv, row["conv"])
            path[-1].ends = row["ends"]
            before = rest
    if path:
        finish()
    yield from _batches(out, schema)


def trie(rows: DataFrame, container: int = CONTAINER) -> DataFrame:
    """The nodes of the trie of :func:`sequences`, one row each.

    ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``:
    the smallest conversation through the node, how many turns it is below the root, its parent's
    conversation (null for the root), the conversations through it and its children; the childless
    nodes of its subtree; the bytes that a cache of its subtree's prefixes saves; and a hash of the
    conversations that end there. An empty table gives no node.
    """
    work = Scratch(rows.sparkSession, "trie")
    merged = work.keep(_merged(rows), "merged")
    no_bytes = F.lit(None).cast("binary")
    open_ = merged.select(
        F.lit(b"").alias("head"), no_bytes.alias("above"), F.lit(None).cast("long").alias("above_conv"),
        F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("bytes"),
        F.col("ids").alias("rest"), "sizes", "n", "conv", "ends",
    )
    closed, burst = [], []
    while True:
        ended = F.max(F.when(F.octet_length("rest") == 0, F.col("ends")))
        same = [F.first(c).alias(c) for c in ("above", "above_conv", "depth", "bytes")]
        heads = open_.groupBy("head").agg(
            F.count("*").alias("suffixes"), F.sum("n").alias("n"), F.min("conv").alias("conv"), ended.alias("ends"), *same
        )
        large = work.keep(heads.where(F.col("suffixes") > container), f"large{len(burst)}")
        if large.isEmpty():
            closed.append(open_)
            break
        of = large.select("head", F.col("conv").alias("head_conv"))
        dealt = work.keep(open_.join(of, "head", "left"), f"dealt{len(burst)}")
        burst.append(large)
        closed.append(dealt.where("head_conv IS NULL").drop("head_conv"))
        next_id = F.substring("rest", 1, ID_BYTES)
        open_ = dealt.where((F.col("head_conv").isNotNull()) & (F.octet_length("rest") > 0)).select(
            _short_digest(F.concat("head", next_id)).alias("head"), F.col("head").alias("above"), F.col("head_conv").alias("above_conv"),
            (F.col("depth") + 1).alias("depth"), F.get("sizes", F.lit(0)).alias("bytes"),
            F.expr(f"substring(rest, {ID_BYTES + 1})").alias("rest"), F.slice("sizes", F.lit(2), F.greatest(F.size("sizes") - 1, F.lit(0))).alias("sizes"),
            "n", "conv", "ends",
        )
    suffixes = closed[0]
    for more in closed[1:]:
        suffixes = suffixes.unionByName(more)
    swept = suffixes.repartition("head").sortWithinPartitions("head", "rest").mapInArrow(_sweep, _NODE)
    nodes = work.keep(swept, "nodes")
    sums = [F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")]
    one = F.lit(1).cast("long").alias("n_children")
    tops = nodes.where("above IS NOT NULL").select("above", one, "n_leaves", "saved_tokens")
    below, done = None, []
    for level, heads in reversed(list(enumerate(burst))):
        sons = tops if below is None else tops.unionByName(below.select("above", one, "n_leaves", "saved_tokens"))
        sons = sons.groupBy(F.col("above").alias("head")).agg(*sums)
        own = (F.col("n") - 1) * F.col("bytes")
        totals = heads.join(sons, "head").select(
            "above", F.col("conv").alias("conv_id"), "depth", F.col("above_conv").alias("parent_conv_id"), F.col("n").alias("n_convs"),
            "n_children", "n_leaves", (F.col("saved_tokens") + own).alias("saved_tokens"),
            F.coalesce("ends", F.lit(_NO_ENDS)).alias("ends_sha256"),
        )
        below = work.keep(totals, f"heads{level}")
        done.append(below)
    work.drop("merged", *(f"{name}{i}" for i in range(len(burst) + 1) for name in ("large", "dealt")))
    for heads in done:
        nodes = nodes.unionByName(heads)
    return nodes.drop("above")


def prefix_trie(
    conversations: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    container: int = CONTAINER,
) -> DataFrame:
    """:func:`trie` of the conversations as they are; further columns are ignored."""
    return trie(sequences(conversations, conv, turn, role, text), container)
