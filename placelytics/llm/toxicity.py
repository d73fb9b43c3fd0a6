"""Toxicity of texts: bags of character n-grams, embedded and averaged, under a linear softmax.

Every n-gram of letters shares one vector over all words it occurs in, so a misspelling that was
never seen is scored by the n-grams it has in common with words that were. A text is cut into
pieces of a few words; the vectors of a piece are averaged into the softmax and the text is as toxic
as its most toxic piece, so a single word counts the same in a short text and in a very long one.
Vectors and softmax are trained jointly, in numpy, on a bounded sample of labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placelytics.llm.shared import require
from placelytics.llm.wordhash import blocks, hashes, words

#: Bounds of the training sample: rows of each label, and bytes of a row's text.
TOXIC_ROWS, CLEAN_ROWS, ROW_BYTES = 1200, 3000, 16 << 10
GRAMS = (3, 4, 5, 6)
BUCKETS = 1 << 18
DIMENSIONS = 8
PIECE = 3
#: An n-gram has a vector if its words occur in so many texts of the sample.
MIN_TEXTS = 3
EPOCHS, RATE = 40, 0.05
THRESHOLD = 0.5
#: Every ``FOLDS``-th row, by the checksum of its id, is never learned from.
FOLDS = 5

_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_FOLDED = np.arange(256, dtype=np.uint32)
_FOLDED[65:91] += 32
_FOLDED[~_LETTERS] = 32


def held_out(id: Column) -> Column:
    """Whether a row is kept from training; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


@dataclass
class Pieces:
    """N-grams of many texts: the bucket and piece of each; pieces of text i are firsts[i]:firsts[i+1]."""

    bucket: np.ndarray
    piece: np.ndarray
    firsts: np.ndarray

    def mean(self, values: np.ndarray) -> np.ndarray:
        """The mean over the n-grams of each piece."""
        total = np.bincount(self.piece, values, minlength=self.firsts[-1])
        return total / np.maximum(np.bincount(self.piece, minlength=self.firsts[-1]), 1)


def pieces(data: np.ndarray, offsets: np.ndarray) -> Pieces:
    """The n-grams of texts given as bytes and offsets; A-Z count as a-z, anything but letters and digits as a gap."""
    texts = len(offsets) - 1
    folded = np.full(len(data) + texts + 1, 32, np.uint32)
    folded[1 + np.arange(len(data)) + np.repeat(np.arange(texts), np.diff(offsets))] = _FOLDED[data]
    bounds = offsets + np.arange(texts + 1)
    gap = folded == 32
    starts = gap[:-1] & ~gap[1:]
    word = np.cumsum(starts) - 1
    firsts = np.searchsorted(np.flatnonzero(starts), bounds)
    count = -(-np.diff(firsts) // PIECE)
    first_piece = np.concatenate([[0], np.cumsum(count)])
    text_of_word = np.repeat(np.arange(texts), np.diff(firsts))
    piece_of_word = first_piece[text_of_word] + (np.arange(firsts[-1]) - firsts[text_of_word]) // PIECE
    gaps = np.append(np.flatnonzero(gap), len(gap))
    next_gap = gaps[np.searchsorted(gaps, np.arange(len(gap)) + 1)]
    found, where = [], []
    code = folded.copy()
    for n in range(2, max(GRAMS) + 1):
        code = code[:-1] * np.uint32(0x01000193) + folded[n - 1 :] if len(code) > 1 else code[:0]
        if n in GRAMS and len(code):
            at = np.flatnonzero(next_gap[: len(code)] >= np.arange(len(code)) + n - 1)
            x = code[at] + np.uint32(n * 0x9E3779B9 & 0xFFFFFFFF)
            x = (x ^ (x >> np.uint32(16))) * np.uint32(0x85EBCA6B)
            x = (x ^ (x >> np.uint32(13))) * np.uint32(0xC2B2AE35)
            found.append(((x ^ (x >> np.uint32(16))) & np.uint32(BUCKETS - 1)).astype(np.int32))
            where.append(piece_of_word[word[at]].astype(np.int32))
    none = np.zeros(0, np.int32)
    return Pieces(np.concatenate([none, *found]), np.concatenate([none, *where]), first_piece)


@dataclass
class Model:
    """The margin each bucket adds (its vector times the difference of the softmax rows), and the bias."""

    margins: np.ndarray
    bias: float

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """A probability for every text: that of its most toxic piece; the bias alone for a text without words."""
        p = pieces(data, offsets)
        logits = p.mean(self.margins[p.bucket]) + self.bias
        best = np.full(len(offsets) - 1, self.bias)
        filled = np.flatnonzero(np.diff(p.firsts))
        if len(filled):
            best[filled] = np.maximum.reduceat(logits, p.firsts[filled])
        return 1 / (1 + np.exp(-best))


def train(texts: list[str], toxic: list[int], epochs: int = EPOCHS) -> Model:
    """Vectors and softmax, trained jointly by Adam on the whole sample.

    Pieces of a text share its label in proportion to a softmax of their own margins, so learning
    settles on the piece that makes a text toxic. Without both labels the model is the share of toxic rows.
    """
    y = np.array(toxic, float)
    share = (y.sum() + 1) / (len(y) + 2)
    prior = float(np.log(share / (1 - share)))
    if not 0 < y.sum() < len(y):
        return Model(np.zeros(BUCKETS, np.float32), prior)
    # N-grams are taken from distinct words: a word's sum serves wherever it occurs.
    text_of_word, word_ids, p = _distinct_words(texts)
    texts_with = np.bincount(np.unique(word_ids * len(y) + text_of_word) // len(y))
    support = np.bincount(p.bucket, texts_with[p.piece], minlength=BUCKETS)
    used = np.flatnonzero(support >= MIN_TEXTS)
    numbers = np.full(BUCKETS, -1, np.int32)
    numbers[used] = np.arange(len(used))
    bucket = numbers[p.bucket]
    word = p.piece[bucket >= 0]
    bucket = bucket[bucket >= 0]
    grams = np.bincount(p.piece, minlength=len(texts_with))
    del p
    firsts = np.searchsorted(text_of_word, np.arange(len(y) + 1))
    count = -(-np.diff(firsts) // PIECE)
    first_piece = np.concatenate([[0], np.cumsum(count)])
    piece = first_piece[text_of_word] + (np.arange(len(word_ids)) - firsts[text_of_word]) // PIECE
    text_of = np.repeat(np.arange(len(y)), count)
    size = np.maximum(np.bincount(piece, grams[word_ids], minlength=first_piece[-1]), 1)
    filled = np.flatnonzero(count)
    rng = np.random.default_rng(7)
    vectors = rng.normal(0, 0.01, (len(used), DIMENSIONS))
    rows = rng.normal(0, 1, (2, DIMENSIONS))
    bias = np.array([0.0, prior - 2.0])
    weights = [vectors, rows, bias]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, epochs + 1):
        apart = rows[1] - rows[0]
        sums = np.bincount(word, (vectors @ apart)[bucket], minlength=len(grams))
        logits = np.bincount(piece, sums[word_ids], minlength=len(size)) / size + bias[1] - bias[0]
        top = np.full(len(y), -np.inf)
        top[filled] = np.maximum.reduceat(logits, first_piece[filled])
        attention = np.exp(2 * (logits - top[text_of]))
        attention /= np.bincount(text_of, attention, minlength=len(y))[text_of]
        error = attention * (1 / (1 + np.exp(-logits)) - y[text_of]) / len(y)
        per_word = np.bincount(word_ids, (error / size)[piece], minlength=len(grams))
        per_bucket = np.bincount(bucket, per_word[word], minlength=len(used))
        toward = per_bucket @ vectors
        slopes = [np.outer(per_bucket, apart), np.stack([-toward, toward]), np.array([-error.sum(), error.sum()])]
        for w, g, m, v in zip(weights, slopes, first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    margins = np.zeros(BUCKETS, np.float32)
    margins[used] = vectors @ (rows[1] - rows[0])
    return Model(margins, float(bias[1] - bias[0]))


def _distinct_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, Pieces]:
    """The text and number of every word, and the n-grams of each distinct word."""
    text_of_word, word_ids, seen = [], [], {}
    for _, _, data, offsets in blocks(pa.array(texts, pa.large_string())):
        starts, ends, firsts = words(data, offsets, _LETTERS)
        done = len(text_of_word) and text_of_word[-1][0]
        text_of_word.append((done + len(offsets) - 1, done + np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))))
        known, first, of = np.unique(hashes(data, starts, ends, lower=True), return_index=True, return_inverse=True)
        numbers = np.array([seen.setdefault(int(h), (len(seen), bytes(data[starts[i] : ends[i]])))[0] for h, i in zip(known, first, strict=True)], np.int64)
        word_ids.append(numbers[of] if len(numbers) else of)
    column = pa.array([w for _, w in seen.values()], pa.large_binary())
    p = pieces(np.frombuffer(column.buffers()[2], np.uint8), np.frombuffer(column.buffers()[1], np.int64))
    return np.concatenate([t for _, t in text_of_word]), np.concatenate(word_ids), p


def fit(docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """A model of ``labels(id, label)``, from the rows that are not held out.

    At most ``TOXIC_ROWS`` and ``CLEAN_ROWS`` ids are drawn, by a hash of the id, and only their texts
    are read; longer ones than ``ROW_BYTES`` are left out of training (never out of scoring). Null ids
    and labels are ignored; an id that repeats counts once, as toxic if any of its rows is.
    """
    require(docs, id, text)
    require(labels, id, label)
    known = (
        labels.where(F.col(id).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(id)))
        .groupBy(F.col(id).alias("key"))
        .agg(F.max(F.col(label).cast("int")).alias("toxic"))
    )
    drawn = None
    for value, rows in ((1, TOXIC_ROWS), (0, CLEAN_ROWS)):
        part = known.where(F.col("toxic") == value).orderBy(F.xxhash64("key"), "key").limit(rows)
        drawn = part if drawn is None else drawn.unionByName(part)
    sample = (
        docs.where(F.octet_length(text) <= ROW_BYTES)
        .join(F.broadcast(drawn), F.col(id) == F.col("key"))
        .select("key", F.col(text).alias("text"), "toxic")
        .groupBy("key")
        .agg(F.max(F.struct("text", "toxic")).alias("row"))
        .select("key", "row.*")
    )

    def learned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([pd.DataFrame({"key": [], "text": [], "toxic": []}), *batches]).sort_values("key")
        model = train(rows["text"].tolist(), rows["toxic"].astype(int).tolist())
        yield pd.DataFrame({"margins": [model.margins.tobytes()], "bias": [model.bias]})

    # The sample is bounded, so one task can hold it; the driver only gets the model, 1 MB.
    model = sample.repartition(1).mapInPandas(learned, "margins binary, bias double").first()
    return Model(np.frombuffer(model.margins, np.float32), model.bias) if model else train([], [])


def score(docs: DataFrame, model: Model, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, score)`` of every row: 0 to 1, from the text alone. A null text is scored as an empty one."""
    require(docs, id, text)

    def batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [model.scores(data, offsets) for _, _, data, offsets in blocks(b.column(1))]
            scores = np.concatenate([np.zeros(0), *parts])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores)], names=[id, "score"])

    rows = docs.select(docs[id], docs[text])
    return rows.mapInArrow(batch, f"`{id}` {rows.schema[id].dataType.simpleString()}, score double")


def drop_toxic(docs: DataFrame, model: Model, *, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score is below ``threshold``, with all their columns, in one pass.

    Repeated rows are judged alike, null and empty texts by the bias alone.
    """
    require(docs, text)
    at = docs.columns.index(text)

    def batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [model.scores(data, offsets) for _, _, data, offsets in blocks(b.column(at))]
            yield b.filter(pa.array(np.concatenate([np.zeros(0), *parts]) < threshold))

    return docs.mapInArrow(batch, docs.schema)
