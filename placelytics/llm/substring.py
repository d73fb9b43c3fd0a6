"""Repeated passages of a corpus, removed by suffix automata of reference passages.

A window of ``WINDOW`` words is repeated if its word sequence starts anywhere else, in the same or another
document. The reference is the corpus itself, so it cannot be broadcast; it is cut into shards, one
for each document that needs any, and a shard holds just the passages that document repeats:

1. Every window is represented by one of its ``GRAM``-word grams, the one with the least hash, so equal
   windows choose equal grams. Grams that occur more than once are counted over all documents and
   broadcast as a bitmap of fixed size.
2. Documents with such a gram are kept, with their pieces: the windows a gram represents. Pieces equal
   as a whole are paired by hash; where pieces around one gram differ, single windows are.
3. Each repeated window thus names another place with the same words. The words are fetched from there,
   as reference passages, and a suffix automaton is built of them. The document is streamed through
   it; what its matching statistics show to be as long as a window is removed.

Hashes only choose candidates; no window is missed by them, and what the automaton does not
confirm word by word stays.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placelytics.llm.shared import BITS, bitmap, marked, require, rows_marked, stored
from placelytics.llm.wordhash import blocks, gram_hashes, hashes, run_hashes, words

WINDOW, GRAM = 35, 8


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The leftmost place of the least of every ``width`` neighbours."""
    least, place, reach = values, np.arange(len(values)), 1
    while reach < width:
        step = min(reach, width - reach)
        later = least[step:] < least[:-step]
        place = np.where(later, place[step:], place[:-step])
        least = np.where(later, least[step:], least[:-step])
        reach += step
    return place


def pieces(word: np.ndarray, firsts: np.ndarray, window: int, gram: int):
    """``(text, start, n, gram hash, piece hash)``: runs of windows, first to last, with one gram each."""
    grams = gram_hashes(word, gram)
    width = window - gram + 1
    if len(grams) < width:
        none = np.zeros(0, np.int64)
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    place = _least(grams, width)
    text = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    start = np.arange(len(place))
    start = start[start + window <= firsts[1:][text[: len(place)]]]
    chosen = place[start]
    new = np.flatnonzero(np.diff(chosen, prepend=-1))
    n = np.diff(np.append(new, len(start)))
    first = start[new]
    whole = run_hashes(word, first, first + n + window - 1)
    return text[first], first - firsts[text[first]], n, grams[chosen[new]], whole


def _hashed(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for at, _, data, offsets in blocks(column):
        starts, ends, firsts = words(data, offsets)
        yield at, hashes(data, starts, ends), firsts


def repeated_grams(docs: DataFrame, window: int, gram: int, text: str = "text") -> np.ndarray:
    """A bitmap of the grams that represent windows in more than one place."""

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, word, firsts in _hashed(b.column(0)):
                grams = pieces(word, firsts, window, gram)[3]
                yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64))], names=["gram"])

    counts = docs.select(docs[text]).mapInArrow(chosen, "gram long").groupBy("gram").agg(F.count("*").alias("n"))
    return bitmap(counts.where("n > 1").select("gram"), BITS)


def _places(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs ``(first window, last window + 1)`` of ``(at, n)``, joined where they touch."""
    runs: list[tuple[int, int]] = []
    for at, n in sorted(spans):
        if runs and at <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(runs[-1][1], at + n))
        else:
            runs.append((at, at + n))
    return runs


class SuffixAutomaton:
    """All runs of words of some passages; a passage's runs do not reach into the next."""

    def __init__(self, passages: list[list[bytes]]) -> None:
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        for passage in passages:
            last = 0
            for word in passage:
                last = self._extended(last, word)

    def _state(self, following: dict[bytes, int], link: int, length: int) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, p: int, word: bytes) -> int:
        """The state of ``p`` and ``word`` alone, parted from that of longer runs."""
        q = self.next[p][word]
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(dict(self.next[q]), self.link[q], self.length[p] + 1)
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def _extended(self, last: int, word: bytes) -> int:
        if word in self.next[last]:
            return self._split(last, word)
        new, p = self._state({}, 0, self.length[last] + 1), last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, word)
        return new

    def covered(self, text: list[bytes], shortest: int) -> np.ndarray:
        """Which words lie in a run of at least ``shortest`` words that a passage holds.

        The matching statistic of a word is the length of the longest such run that ends with it.
        """
        following, link, length = self.next, self.link, self.length
        edges = np.zeros(len(text) + 1, np.int64)
        state = run = 0
        for i, word in enumerate(text):
            while state and word not in following[state]:
                state = link[state]
                run = length[state]
            if word in following[state]:
                state = following[state][word]
                run += 1
            if run >= shortest:
                edges[i + 1 - run] += 1
                edges[i + 1] -= 1
        return np.cumsum(edges)[:-1] > 0


def _surveyed(docs: DataFrame, repeated: np.ndarray, window: int, gram: int, id: str, text: str) -> DataFrame:
    """Every document with its counts; its words, deflated, and pieces if it has a gram of the bitmap."""
    shared = docs.sparkSession.sparkContext.broadcast(repeated)

    def batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, word, firsts in _hashed(b.column(2)):
                part = b.slice(at, len(firsts) - 1)
                of, start, n, grams, whole = pieces(word, firsts, window, gram)
                seen = marked(shared.value, grams.view(np.int64))
                of, start, n, grams, whole = of[seen], start[seen], n[seen], grams[seen], whole[seen]
                counts = np.bincount(of, minlength=len(part))
                texts = [b" ".join((t or "").encode().split()) for t in part.column(2).to_pylist()]
                kept = [hashlib.sha256(t).hexdigest() for t in texts]
                hits = pa.StructArray.from_arrays(
                    [pa.array(grams.view(np.int64)), pa.array(whole.view(np.int64)), pa.array(start), pa.array(n)],
                    names=["gram", "piece", "at", "n"],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(1), pa.array(np.diff(firsts)), pa.array(kept),
                        pa.array([zlib.compress(t) if k else None for t, k in zip(texts, counts, strict=True)], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), hits),
                    ],
                    names=["id", "doc", "n_words", "kept_sha256", "text", "hits"],
                )

    rows = docs.select(F.col(id).alias("id"), F.xxhash64(id, text).alias("doc"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        batch,
        f"id {kind}, doc long, n_words long, kept_sha256 string, text binary,"
        " hits array<struct<gram:long,piece:long,at:long,n:long>>",
    )


def _elsewhere(lowest: str, highest: str):
    """Another place than the row's own: the least one, or the greatest where the row is the least."""
    own = (F.col("doc") == F.col(f"{lowest}.doc")) & (F.col("at") == F.col(f"{lowest}.at"))
    return own, F.when(own, F.col(highest)).otherwise(F.col(lowest))


def _claims(found: DataFrame, texts: DataFrame, window: int) -> DataFrame:
    """``(doc, at, n, other)``: runs of windows and another place ``(doc, at)`` where they start too."""
    hits = found.select("doc", F.inline("hits"))
    place = F.struct("doc", "at")
    whole = hits.groupBy("gram", "piece").agg(F.count("*").alias("k"), F.min(place).alias("low"), F.max(place).alias("high"))
    around = whole.groupBy("gram").agg(F.sum("k").alias("places"), F.count("*").alias("pieces")).where("places > 1")
    own, other = _elsewhere("low", "high")
    known = hits.join(
        whole.join(around, "gram").select("gram", "piece", "k", "low", "high", (F.col("pieces") > 1).alias("mixed")),
        ["gram", "piece"],
    )
    known = stored(
        known.select("doc", "at", "n", "k", other.alias("other"), (F.col("mixed") & ((F.col("k") == 1) | own)).alias("open")),
        "pieces",
    )
    single = (
        known.where("open").groupBy("doc").agg(F.collect_list(F.struct("at", "n")).alias("spans")).join(texts, "doc")
    )

    def single_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans = b.column(1).to_pylist()
            texts = pa.array([zlib.decompress(t) for t in b.column(2).to_pylist()], pa.large_binary())
            for at, word, firsts in _hashed(texts):
                for i in range(len(firsts) - 1):
                    grams = gram_hashes(word[firsts[i] : firsts[i + 1]], window).view(np.int64)
                    starts = np.unique(np.concatenate([np.arange(s["at"], s["at"] + s["n"]) for s in spans[at + i]]))
                    starts = starts[starts < len(grams)]
                    docs = pa.array(np.full(len(starts), b.column(0)[at + i].as_py()))
                    yield pa.RecordBatch.from_arrays([docs, pa.array(starts), pa.array(grams[starts])], names=["doc", "at", "win"])

    windows = stored(
        single.select("doc", "spans", "text").mapInArrow(single_windows, "doc long, at long, win long"), "windows"
    )
    # Most of them start in one place alone; only the others are shuffled with their places.
    counts = windows.groupBy("win").agg(F.count("*").alias("k"))
    windows = rows_marked(windows, "win", counts.where("k > 1").select("win"))
    again = windows.groupBy("win").agg(F.count("*").alias("k"), F.min(place).alias("low"), F.max(place).alias("high")).where("k > 1")
    return known.where("k > 1").select("doc", "at", "n", "other").unionByName(
        windows.join(again, "win").select("doc", "at", F.lit(1).cast("long").alias("n"), other.alias("other"))
    )


def _passages(claims: DataFrame, texts: DataFrame, window: int) -> DataFrame:
    """``(doc, passages)``: the words of the places its windows repeat, fetched from there.

    A deflated block has the passages of one other document, one a line.
    """
    wanted = claims.groupBy("doc", F.col("other.doc").alias("other"), (F.col("other.at") - F.col("at")).alias("shift")).agg(
        F.collect_list(F.struct("at", "n")).alias("spans")
    )

    def fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, source = None, []
        for b in batches:
            passages = []
            for i, (other, shift, spans) in enumerate(zip(*(b.column(c).to_pylist() for c in (1, 2, 3)), strict=True)):
                if other != last:
                    last, source = other, zlib.decompress(b.column(4)[i].as_py()).split()
                runs = _places([(s["at"], s["n"]) for s in spans])
                lines = [b" ".join(source[first + shift : end + shift + window - 1]) for first, end in runs]
                passages.append(zlib.compress(b"\n".join(lines)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(passages, pa.binary())], names=["doc", "passage"])

    return (
        wanted.join(texts.withColumnRenamed("doc", "other"), "other")
        .select("doc", "other", "shift", "spans", "text")
        .mapInArrow(fetched, "doc long, passage binary")
        .groupBy("doc")
        .agg(F.sort_array(F.collect_set("passage")).alias("passages"))
    )


def remove_repeats(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """``(id, n_words, n_removed, kept, kept_sha256)`` of every row.

    A word is removed if a window of ``window`` consecutive words that covers it also starts elsewhere.
    Windows are judged on the input. Words are runs of anything but blanks, unchanged; ``kept`` joins
    what stays by one space, and is null where nothing is removed. Null and empty texts have no words;
    of repeated rows with a window in them, every copy loses it. An empty table gives an empty result.
    """
    require(docs, id, text)
    found = stored(_surveyed(docs, repeated_grams(docs, window, gram, text), window, gram, id, text), "survey")
    held = found.where("text IS NOT NULL").groupBy("doc").agg(F.first("text").alias("text"))
    texts = held.select("doc", "text")
    passages = _passages(_claims(found, texts, window), texts, window)

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        @lru_cache(maxsize=8)
        def automaton(blocks: tuple[bytes, ...]) -> SuffixAutomaton:
            return SuffixAutomaton([line.split() for x in blocks for line in zlib.decompress(x).split(b"\n")])

        for b in batches:
            removed, kept, digests = [], [], []
            for source, parts, digest in zip(*(b.column(c).to_pylist() for c in (2, 3, 4)), strict=True):
                left = None
                gone = 0
                if parts:
                    all_words = zlib.decompress(source).split()
                    covered = automaton(tuple(parts)).covered(all_words, window)
                    gone = int(covered.sum())
                    left = b" ".join(w for w, c in zip(all_words, covered, strict=True) if not c)
                    digest = hashlib.sha256(left).hexdigest()
                removed.append(gone)
                kept.append(left.decode() if gone else None)
                digests.append(digest)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(removed, pa.int64()), pa.array(kept, pa.string()), pa.array(digests, pa.string())],
                names=[id, "n_words", "n_removed", "kept", "kept_sha256"],
            )

    kind = found.schema["id"].dataType.simpleString()
    return (
        found.drop("hits")
        .join(passages, "doc", "left")
        .select("id", "n_words", "text", "passages", "kept_sha256")
        .mapInArrow(cleaned, f"`{id}` {kind}, n_words long, n_removed long, kept string, kept_sha256 string")
    )
