"""Packing of token sequences of a fixed length, by exact complements and then by best fit.

Documents are tokenized and cut into pieces; what has to be packed is then only how many pieces there
are of each length, at most as many numbers as a sequence has tokens, whatever the corpus. On these
counts the longest pieces come first: the gap each leaves is looked up among the single lengths, the
sums of two and the sums of three, and combinations that fill it exactly are consumed as often as
their lengths are still available. What finds no exact complement is packed by best fit. The plan says
which ranks of a length go where; pieces get their rank within their length from counts by
partition, so no length, however frequent, is sorted or numbered in one task.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import product
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placelytics.llm.shared import Scratch, require

#: Tokens of a sequence.
LIMIT = 1024

#: Distinct splits whose ids a task remembers.
_REMEMBERED = 1_000_000
#: Fixed value: the public split pattern of byte-level tokenizers, for characters up to U+024F but for some
#: controls and blanks. Of these every version of Unicode knows the same letters and numbers.
_LETTER, _NUMBER = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾"
_SPLIT = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^\t\n\r {_LETTER}{_NUMBER}]+|[\t\n\r ]+(?![^\t\n\r ])|[\t\n\r ]+"
)
_SETTLED = r"[\t\n\r -~¡-ɏ]*"
#: Fixed rule of byte-level tokenizers: a printable byte is named by its own character, the others in order from U+0100.
_PRINTED = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_NAMES = {b: b if b in _PRINTED else 0x100 + sum(x not in _PRINTED for x in range(b)) for b in range(256)}
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}


class _Encoder:
    """Token ids of texts, as little-endian 32-bit numbers end to end.

    A text of settled characters is split as the tokenizer splits it, and each distinct split is encoded
    once; others are encoded whole. Special tokens' names in a text are ordinary text.
    """

    def __init__(self, spec: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.encode_special_tokens = True
        parts = json.loads(spec)
        byte_level = (parts.get("pre_tokenizer") or {}).items() >= _BYTE_LEVEL.items()
        usual = all(t["special"] for t in parts.get("added_tokens", ())) and not parts.get("normalizer")
        self.splits = re.compile(_SPLIT).findall if byte_level and usual and not parts["model"].get("dropout") else None
        self.settled = re.compile(_SETTLED).fullmatch
        self.model = self.tokenizer.model
        self.known: dict[str, bytes] = {}

    def _split_ids(self, split: str) -> bytes:
        """The ids of one split, whose bytes the model knows as characters."""
        ids = [t.id for t in self.model.tokenize(split.encode().decode("latin-1").translate(_BYTE_NAMES))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def ids(self, text: str) -> bytes:
        if self.splits is None or not self.settled(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        splits, known = self.splits(text), self.known
        if len(known) > _REMEMBERED:
            known.clear()
        for split in [s for s in splits if s not in known]:
            known[split] = self._split_ids(split)
        return b"".join([known[s] for s in splits])


def pieces(docs: DataFrame, vocabulary: str, end: int, limit: int = LIMIT, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, piece, start, length, ids_crc32, part, nth)`` of every row's tokens, those of ``text`` and ``end``.

    More than ``limit`` tokens are cut into pieces of ``limit``, the first of which may be shorter.
    ``nth`` numbers the pieces of one length within a partition. ``vocabulary`` is the path of a
    tokenizer's file; it is read once and sent to the tasks.
    """
    require(docs, id, text)
    spec = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_text())
    tail = np.array([end], "<u4").tobytes()

    def batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen = _Encoder(spec.value), np.zeros(limit + 1, np.int64)
        for b in batches:
            rows: list[list[int]] = [[] for _ in range(6)]
            for i, value in enumerate(b.column(1)):
                ids = encoder.ids(value.as_py() or "") + tail
                tokens = len(ids) // 4
                stop = (tokens - 1) % limit + 1
                start = piece = 0
                while start < tokens:
                    size = stop - start
                    for column, cell in zip(rows, (i, piece, start, size, zlib.crc32(ids[4 * start : 4 * stop]), seen[size])):
                        column.append(cell)
                    seen[size] += 1
                    start, stop, piece = stop, stop + limit, piece + 1
            at = pa.array(rows[0], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(at), b.column(2).take(at), pa.array(rows[1], pa.int32()), *(pa.array(r, pa.int64()) for r in rows[2:])],
                names=["id", "part", "piece", "start", "length", "ids_crc32", "nth"],
            )

    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), F.spark_partition_id().alias("part"))
    kind = docs.schema[id].dataType.simpleString()
    return rows.mapInArrow(batch, f"id {kind}, part int, piece int, start long, length long, ids_crc32 long, nth long")


Bin = tuple[tuple[tuple[int, int], ...], int]


def plan(counts: dict[int, int], limit: int = LIMIT) -> list[Bin]:
    """Kinds of sequences ``(((length, pieces), ...), sequences)`` that hold all pieces, ``counts`` by length.

    Complements are looked for down to pieces of one token, of a third and of half a sequence, since short
    pieces that fill sequences among themselves may be missed beside long ones, and with the parts of a sum
    as alike or as unlike as can be; the plan of the fewest sequences is taken.
    """
    given = np.zeros(limit + 1, np.int64)
    for length, n in counts.items():
        if not 1 <= length <= limit:
            raise ValueError(f"no piece of {length} tokens fits")
        given[length] = n
    plans = []
    for least, alike in product((1, limit // 3 + 1, limit // 2 + 1, limit), (True, False)):
        left = given.copy()
        plans.append([*_exact(left, limit, least, alike), *_best_fit(left, limit)])
    return min(plans, key=lambda bins: sum(times for _, times in bins))


def _exact(left: np.ndarray, limit: int, least: int, alike: bool) -> Iterator[Bin]:
    """Sequences that a piece of ``least`` or more and up to three others fill; takes them out of ``left``."""
    there, order = left > 0, 1 if alike else -1
    sums = np.zeros(limit + 1, np.int64)  # pairs of available lengths by their sum
    for a in np.flatnonzero(there):
        sums[2 * a : limit + 1] += there[a : limit + 1 - a]

    def gone(length: int) -> None:
        """Take a length that is used up out of the index of sums."""
        others = np.flatnonzero(there[: limit + 1 - length])
        np.subtract.at(sums, others + length, 1)
        there[length] = False

    def pair(total: int, *taken: int) -> tuple[int, int] | None:
        """Two lengths of a sum, next to those taken."""
        if total < 2 or not sums[total]:
            return None
        for a in np.flatnonzero(there[-(-total // 2) : total])[::order] + -(-total // 2):
            if there[total - a] and enough((int(a), int(total - a), *taken)):
                return int(a), int(total - a)
        return None

    def enough(lengths: tuple[int, ...]) -> bool:
        return all(left[x] >= n for x, n in Counter(lengths).items())

    def complement(length: int) -> tuple[int, ...] | None:
        gap = limit - length
        if gap == 0:
            return ()
        if there[gap] and enough((gap, length)):
            return (gap,)
        two = pair(gap, length)
        if two:
            return two
        ends = np.flatnonzero(there[: gap - 1])
        for a in ends[(ends * 3 >= gap) & (sums[gap - ends] > 0)][::order]:
            rest = pair(gap - int(a), length, int(a))
            if rest:
                return (int(a), *rest)
        return None

    for length in range(limit, least - 1, -1):
        while left[length]:
            others = complement(length)
            if others is None:
                break
            parts = Counter((length, *others))
            times = min(int(left[x]) // n for x, n in parts.items())
            for x, n in parts.items():
                left[x] -= n * times
                if not left[x] and there[x]:
                    gone(x)
            yield tuple(sorted(parts.items(), reverse=True)), times


def _best_fit(left: np.ndarray, limit: int) -> Iterator[Bin]:
    """Sequences of the other pieces, longest first, each where it leaves the least room."""
    rooms: dict[int, list[Bin]] = {limit: []}
    for length in np.flatnonzero(left)[::-1].tolist():
        n = int(left[length])
        while n:
            room = min((r for r, kinds in rooms.items() if r >= length and kinds), default=None)
            if room is None:
                parts, bins, room = (), n, limit
            else:
                parts, bins = rooms[room].pop()
            each = room // length
            full = min(bins, n // each)
            if full:
                rooms.setdefault(room - each * length, []).append(((*parts, (length, each)), full))
                n -= full * each
                bins -= full
            if n and bins:
                rooms.setdefault(room - n * length, []).append(((*parts, (length, n)), 1))
                bins, n = bins - 1, 0
            if bins and parts:
                rooms[room].append((parts, bins))
    for kinds in rooms.values():
        yield from kinds
    left[:] = 0


def _places(bins: list[Bin]) -> np.ndarray:
    """Rows ``(length, first rank, pieces of it in a sequence, first sequence, first offset)`` in order."""
    rows, ranks, base = [], Counter(), 0
    for parts, times in bins:
        offset = 0
        for length, each in parts:
            rows.append((length, ranks[length], each, base, offset))
            ranks[length] += each * times
            offset += length * each
        base += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(
    docs: DataFrame, vocabulary: str, *, end: int, limit: int = LIMIT, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(id, piece, start, length, ids_crc32, sequence_id, offset)`` of every piece of every row.

    ``start`` counts the row's tokens before the piece, ``ids_crc32`` is the CRC-32 of its token ids as
    little-endian 32-bit numbers, and ``offset`` its place in its sequence, which has no gaps. A null text is
    empty and has the one token ``end``. Rows that repeat an id are packed each for itself; other
    columns are ignored. An empty table gives an empty result.
    """
    work = Scratch(docs.sparkSession, "packing")
    cut = work.keep(pieces(docs, vocabulary, end, limit, id, text), "pieces")
    by_part = work.keep(cut.groupBy("length", "part").agg(F.count("*").alias("n")), "counts")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = by_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("first"))
    # One row for each possible length.
    counts = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = docs.sparkSession.sparkContext.broadcast(_places(plan(counts, limit)))
    kind = docs.schema[id].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = table.value
        lengths, ranks = rows[:, 0], rows[:, 1]
        starts = np.searchsorted(lengths, np.arange(limit + 2))
        for b in batches:
            length, rank = (b.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            at = np.zeros(len(b), np.int64)
            for x in np.unique(length):
                mine = length == x
                at[mine] = starts[x] + np.searchsorted(ranks[starts[x] : starts[x + 1]], rank[mine], "right") - 1
            nth = rank - ranks[at]
            sequence = rows[at, 3] + nth // rows[at, 2]
            offset = rows[at, 4] + nth % rows[at, 2] * length
            kept = [b.column(c) for c in ("id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(offset)],
                names=[id, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return (
        cut.join(firsts, ["length", "part"])
        .select("id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("nth")).alias("rank"))
        .mapInArrow(place, f"`{id}` {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    )
