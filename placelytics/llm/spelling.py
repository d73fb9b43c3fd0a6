"""Groups of spelling variants: words one inserted, deleted or replaced character apart.

A variable-length gram index. Grams of ``SHORTEST`` characters are always grams; one that occurs too
often in the vocabulary is pruned from the dictionary in favour of its one character longer extensions,
up to ``LONGEST``. Every word is decomposed into the longest grams that start at each of its places,
without those inside another. One edit leaves untouched a run of grams at the word's left and a run at its right; how
long they are at least, whatever the edit, is the word's bound of affected grams. From it follows a
choice of two lists, one of the words that begin like the word up to a gram's end and one of those that end
like it from a gram's start, such that every near word is on one of them. Lists are merged within
words of a fitting length, candidates are filtered by the characters they hold, and verified.

A word so short or so common in its grams that an edit may touch all of them is looked up by its halves.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placelytics.llm.shared import LOWER, UPPER, Scratch, require

SHORTEST, LONGEST = 2, 4
#: A gram of more occurrences in the vocabulary is extended. It is raised so that at most ``EXTENDED`` grams are.
COMMON, EXTENDED = 1000, 100_000
#: Words that are grouped, and how much more often a form occurs.
WORD, LEAST_LENGTH, LEAST_COUNT, RATIO = "[A-Za-z\\u00C0-\\u00FF]+", 7, 2, 10


def long_runs(docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = LEAST_LENGTH) -> DataFrame:
    """``(id, run)``: every maximal run of letters of at least ``least`` characters, with A-Z lowered."""
    require(docs, id, text)
    pattern = WORD.replace("+", f"{{{least},}}")
    runs = F.explode(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)))
    return docs.select(F.coalesce(F.col(id).cast("string"), F.lit("")).alias("id"), runs.alias("run")).select(
        "id", F.translate("run", UPPER, LOWER).alias("run")
    )


def vocabulary(runs: DataFrame, word: Column | str = "run", least: int = LEAST_LENGTH, count: int = LEAST_COUNT) -> DataFrame:
    """``(word, n)`` of the words that are long and frequent enough."""
    word = F.col(word) if isinstance(word, str) else word
    words = runs.select(word.alias("word")).where(F.char_length("word") >= least)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= count)


def common_grams(words: DataFrame) -> frozenset[str]:
    """Grams that are extended; every part of one, down to ``SHORTEST``, is one too. At most ``EXTENDED``."""
    places = words.agg(F.sum(F.char_length("word") * (LONGEST - SHORTEST))).first()[0] or 0
    limit = max(COMMON, places // EXTENDED)
    size = F.char_length("word")

    def grams(q: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(size - q + 1, F.lit(1)))
        return F.filter(F.transform(starts, lambda i: F.substring(F.col("word"), i, F.lit(q))), lambda g: F.char_length(g) == q)

    counted = (
        words.select(F.explode(F.concat(*(grams(q) for q in range(SHORTEST, LONGEST)))).alias("gram"))
        .groupBy("gram")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > limit)
        .select("gram")
    )
    return frozenset(counted.toArrow().column(0).to_pylist())


def decompose(word: str, common: frozenset[str]) -> list[tuple[int, int]]:
    """First and last place of every gram of ``word``."""
    grams, last = [], -1
    for start in range(len(word) - SHORTEST + 1):
        size = SHORTEST
        while size < LONGEST and start + size < len(word) and word[start : start + size] in common:
            size += 1
        if start + size - 1 > last:
            last = start + size - 1
            grams.append((start, last))
    return grams


def untouched(
    word: str, grams: list[tuple[int, int]], common: frozenset[str], tails: frozenset[str]
) -> tuple[list[int], list[int]]:
    """How many grams at the left survive any edit from place i on, and at the right any edit before place i.

    A gram left of the edit is lost if one at or before its start could now match across the edit, which
    takes a common gram right up to the edit. One right of it is lost if a gram that starts before the edit's
    end could now hold it, which takes a common gram with more in front (``tails``).
    """
    size = len(word)
    left, right = [], []
    for i in range(size + 1):
        across = next((i - q for q in range(LONGEST - 1, SHORTEST - 1, -1) if i >= q and word[i - q : i] in common), size)
        left.append(sum(last < i and start < across for start, last in grams))
        kept = 0
        for start, last in reversed(grams):
            inner = word[i : last + 1]
            if start < i or (len(inner) < LONGEST and (inner in tails or inner[:-1] in tails)):
                break
            kept += 1
        right.append(kept)
    return left, right


def lists(word: str, common: frozenset[str], tails: frozenset[str]) -> tuple[list[int], list[int], tuple[int, int] | None]:
    """Ends of the grams, their starts, and the end and start that choose the word's own two lists.

    An edit from place i to i or i + 1 spares ``left[i]`` grams on one side and ``right`` of its end on the
    other. For every number of grams at the left there is a number at the right that every edit
    spares if it does not spare the first; the most balanced choice is taken. None: no choice works.
    """
    grams = decompose(word, common)
    left, right = untouched(word, grams, common, tails)
    ends, starts, best = [last + 1 for _, last in grams], [start for start, _ in grams], None
    for j in range(1, len(grams) + 1):
        spared = [min(right[i], right[min(i + 1, len(word))]) for i in range(len(word) + 1) if left[i] < j]
        k = min(spared, default=len(grams))
        if k < 1:
            break
        prefix, suffix = ends[j - 1], starts[len(grams) - k]
        balance = min(prefix, len(word) - suffix)
        if best is None or balance > best[0]:
            best = (balance, prefix, suffix)
    return ends, starts, best and best[1:]


def _keys(word: str, common: frozenset[str], tails: frozenset[str]) -> tuple[list[int], list[int]]:
    """Keys of the lists ``word`` is on, and for each whether the word asks it.

    -1: an entry, for words that are as long or one shorter; 0 and 1: the word asks for words that are as long, or
    one longer. Of a pair the shorter word asks; of two as long as each other both do. A key holds
    side and length of the list and a checksum of its part of a word.
    """
    size = len(word)
    ends, starts, best = lists(word, common, tails)
    on = [(0, word[:e], size, -1) for e in ends] + [(1, word[s:], size, -1) for s in starts]
    for less in (size, size - 1):
        on += [(2, word[: less // 2], size, -1), (3, word[size - (less - less // 2) :], size, -1)]
    for more in (0, 1):
        if best:
            on += [(0, word[: best[0]], size + more, more), (1, word[best[1] :], size + more, more)]
        else:
            on += [(2, word[: size // 2], size + more, more), (3, word[size // 2 :], size + more, more)]
    keys = [(length << 2 | side) << 32 | zlib.crc32(part.encode()) for side, part, length, _ in on]
    return keys, [asks for *_, asks in on]


def _listed(words: DataFrame, common: frozenset[str]) -> DataFrame:
    """``(key, asks, word, n, bits)``: the lists of every word; ``bits`` are the parities of its characters."""
    shared = words.sparkSession.sparkContext.broadcast(common)

    def batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = shared.value
        tails = frozenset(g[1:] for g in common)
        for b in batches:
            for first in range(0, len(b), 2000):
                part = b.slice(first, 2000)
                keys, asks, bits, lengths = [], [], [], []
                for word in part.column(0).to_pylist():
                    parity = 0
                    for c in word:
                        parity ^= 1 << (ord(c) * 37 & 63)
                    bits.append(parity)
                    k, a = _keys(word, common, tails)
                    keys += k
                    asks += a
                    lengths.append(len(k))
                at = pa.array(np.repeat(np.arange(len(part)), lengths))
                bits = pa.array(np.array(bits, np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(asks, pa.int32()), part.column(0).take(at), part.column(1).take(at), bits.take(at)],
                    names=["key", "asks", "word", "n", "bits"],
                )

    return words.select("word", "n").mapInArrow(batch, "key long, asks int, word string, n long, bits long")


def near_words(words: DataFrame) -> DataFrame:
    """``(word, n, other, other_n)`` of all pairs of distinct words one edit apart, both ways round."""
    work = Scratch(words.sparkSession, "spelling")
    entries = work.keep(_listed(words, common_grams(words)), "lists")
    asking = entries.where("asks >= 0")
    listed = entries.where("asks < 0").select("key", *(F.col(c).alias(f"other_{c}") for c in ("word", "n", "bits")))
    apart = F.bit_count(F.col("bits").bitwiseXOR(F.col("other_bits")))
    fits = F.when(F.col("asks") == 1, apart == 1).otherwise((apart <= 2) & (F.col("word") < F.col("other_word")))
    one_edit = F.levenshtein(F.col("word"), F.col("other_word"), 1) == 1
    pairs = (
        asking.join(listed, "key")
        .where(fits & one_edit)
        .select("word", "n", F.col("other_word").alias("other"), F.col("other_n").alias("other_n"))
        .distinct()
    )
    pairs = work.keep(pairs, "pairs")
    work.drop("lists")
    return pairs.unionByName(
        pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    )


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of every row of ``words(word, n)``.

    ``n_near`` counts the words that differ by exactly one inserted, deleted or replaced character. The
    most frequent of them, of equally frequent ones the first in code-point order, is the word's form
    if it is at least ``ratio`` times as frequent. ``root`` is where forms of forms end, the word itself
    if it has no form. Words must be distinct; null words are left out. An empty table gives an empty result.
    """
    require(words, "word", "n")
    work = Scratch(words.sparkSession, "variants")
    words = work.keep(words.where("word IS NOT NULL").select("word", "n"), "words")
    best = F.min(F.struct((-F.col("other_n")).alias("rank"), F.col("other").alias("other")))
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    form = (-F.col("best.rank") >= ratio * F.col("n"))
    found = work.keep(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(form, F.col("best.other")).alias("form"), F.when(form, -F.col("best.rank")).alias("form_n"),
        ),
        "forms",
    )
    # A form is ``ratio`` times as frequent as its word, so chains are short; each round doubles the reach.
    reach, step = found.where("form IS NOT NULL").select("word", F.col("form").alias("root")), 0
    while True:
        reach = work.keep(reach, f"reach{step}")
        further = reach.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = reach.join(further, "root", "left")
        if longer.where("next IS NOT NULL").isEmpty():
            break
        reach, step = longer.select("word", F.coalesce("next", "root").alias("root")), step + 1
    work.drop(*(f"reach{i}" for i in range(step)))
    return found.join(reach, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_groups(docs: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """:func:`variants` of the vocabulary of ``docs``. Null and empty texts hold no words; repeated rows count."""
    return variants(vocabulary(long_runs(docs, id, text)))
