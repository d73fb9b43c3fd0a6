import random
import zlib
from collections import Counter

import numpy as np
import pytest

from placelytics.llm import packing
from tests.llm import edge

public_tokenizers = pytest.importorskip("public_tokenizers")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(VOCABULARY)
    loaded.encode_special_tokens = True
    return loaded


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def expected(tokenizer, rows, limit):
    out = []
    for doc, text, *_ in rows:
        ids = ids_of(tokenizer, text)
        first = (len(ids) - 1) % limit + 1
        bounds = [0, *range(first, len(ids) + 1, limit)]
        for piece, (a, b) in enumerate(zip(bounds, bounds[1:])):
            out.append((doc, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    return sorted(out, key=str)


def sequences(rows):
    """Every sequence's pieces are gapless from 0 and within the limit."""
    at = {}
    for r in rows:
        at.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in at.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        yield end


ROWS = [*edge.ROWS, (30, "<|endoftext|> is text", "", 0, "", 0.0), (31, " " * 5000, "", 0, "", 0.0), (32, "a b​\x1c\x85é\U0001f600 的", "", 0, "", 0.0)]


@pytest.mark.parametrize("limit", [1024, 100, 7, 1])
def test_pieces_and_places(spark, tokenizer, limit):
    rows = packing.pack(edge.documents(spark, ROWS), VOCABULARY, end=2, limit=limit).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=str) == expected(tokenizer, ROWS, limit)
    fills = list(sequences(rows))
    assert max(fills) <= limit and sum(fills) == sum(r.length for r in rows)


def test_splits_are_those_of_the_tokenizer(tokenizer):
    encoder = packing._Encoder(open(VOCABULARY).read())
    settled = [chr(c) for c in range(0x250)] + ["'s", "'ll", "  ", "\n\n", "don't", " 12ab", "\t x", "\r\n", "a'", "''s"]
    rng = random.Random(1)
    texts = [a + b + c for a in ("", "x", " ", "\n ") for b in settled for c in ("", "y", " y", "  ", "'s")]
    texts += ["".join(rng.choice(settled) for _ in range(60)) for _ in range(300)]
    for text in texts:
        assert encoder.ids(text) == np.array(ids_of(tokenizer, text)[:-1], "<u4").tobytes(), repr(text)


def best_fit_decreasing(lengths, limit):
    rooms = []
    for x in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= x]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= x
        else:
            rooms.append(limit - x)
    return len(rooms)


@pytest.mark.parametrize("seed", range(8))
def test_plans_hold_every_piece_in_few_sequences(seed):
    rng = random.Random(seed)
    top = [20, 64, 64, 100, 100, 64, 40, 30][seed]
    shape = [lambda: rng.randint(1, top), lambda: min(top, 1 + int(rng.expovariate(0.1))), lambda: rng.randint(top // 3, top), lambda: top // 2 + 1][seed % 4]
    lengths = [shape() for _ in range(600)]
    bins = packing.plan(Counter(lengths), top)
    held = Counter()
    for parts, times in bins:
        assert times > 0 and sum(length * n for length, n in parts) <= top
        for length, n in parts:
            held[length] += n * times
    assert held == Counter(lengths)
    used, least = sum(t for _, t in bins), -(-sum(lengths) // top)
    assert least <= used <= best_fit_decreasing(lengths, top)


def test_exact_complements_leave_no_room():
    for lengths in ([600, 424], [500, 300, 224], [400, 300, 200, 124], [512, 512], [400, 312, 312]):
        assert [t for _, t in packing.plan(Counter(lengths * 5), 1024)] == [5]


def test_plans_do_not_grow_with_the_corpus():
    rng = random.Random(5)
    small = {x: rng.randint(1, 5) for x in range(1, 1025)}
    large = {x: n * 10**6 for x, n in small.items()}
    assert sum(t for _, t in packing.plan(large)) <= 10**6 * sum(t for _, t in packing.plan(small))
    assert len(packing.plan(large)) < 10_000


def test_lengths_beyond_the_limit_are_refused():
    with pytest.raises(ValueError, match="fits"):
        packing.plan({5: 1}, 4)


def test_empty_table(spark):
    assert packing.pack(edge.empty(spark), VOCABULARY, end=2).collect() == []
