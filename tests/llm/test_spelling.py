import itertools
import random
import re

import pytest

from placelytics.llm import spelling
from tests.llm import edge


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words, ratio=10):
    form, out = {}, {}
    for w, n in words.items():
        others = sorted((-m, o) for o, m in words.items() if near(w, o))
        best = others[0] if others and -others[0][0] >= ratio * n else None
        form[w] = best and best[1]
        out[w] = [n, len(others), best and -best[0]]
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (w, form[w], root, *out[w])
    return sorted(out.values(), key=str)


def found(df):
    return sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()), key=str)


def random_words(seed, letters, n, sizes=(7, 12)):
    rng, words = random.Random(seed), {}
    while len(words) < n:
        word = "".join(rng.choice(letters) for _ in range(rng.randrange(*sizes)))
        words[word] = rng.choice([2, 3, 20, 30, 400, 5000])
        for _ in range(rng.randrange(3)):
            i = rng.randrange(len(word))
            changed = rng.choice([word[:i] + word[i + 1 :], word[:i] + rng.choice(letters) + word[i:], word[:i] + rng.choice(letters) + word[i + 1 :]])
            words.setdefault(changed, rng.choice([2, 3, 20, 400]))
    return words


@pytest.mark.parametrize(("letters", "common"), [("abcdefghijkl", 1000), ("abcdefghijkl", 5), ("abé", 10), ("ab", 1), ("aß", 3), ("abcd", 60)])
def test_equals_brute_force(spark, monkeypatch, letters, common):
    monkeypatch.setattr(spelling, "COMMON", common)
    words = random_words(1, letters, 300)
    rows = spark.createDataFrame([(w, n, 0) for w, n in words.items()], "word string, n long, key int").repartition(4)
    assert found(spelling.variants(rows)) == brute(words)


@pytest.mark.parametrize("common", [0, 2, 10, 40, 10**9])
@pytest.mark.parametrize("letters", ["ab", "abcdef"])
def test_one_edit_apart_is_always_on_a_list(letters, common):
    """Whatever the dictionary, the shorter word finds every near one, on a closed set of common grams."""
    words = list(random_words(2, letters, 150, (3, 10)))
    grams = [w[i : i + q] for w in words for q in range(spelling.SHORTEST, spelling.LONGEST) for i in range(len(w) - q + 1)]
    chosen = frozenset(g for g in set(grams) if grams.count(g) > common)
    tails = frozenset(g[1:] for g in chosen)
    keyed = {w: list(zip(*spelling._keys(w, chosen, tails))) for w in words}
    for a, b in itertools.permutations(words, 2):
        if near(a, b) and len(a) <= len(b):
            asked = {k for k, asks in keyed[a] if asks == len(b) - len(a)}
            assert asked & {k for k, asks in keyed[b] if asks < 0}, (a, b)


def test_grams_left_untouched_survive_every_edit():
    words = list(random_words(3, "abc", 60, (4, 10)))
    grams = [w[i : i + q] for w in words for q in (2, 3) for i in range(len(w) - q + 1)]
    common = frozenset(g for g in set(grams) if grams.count(g) > 12)
    tails = frozenset(g[1:] for g in common)
    for w in words:
        own = spelling.decompose(w, common)
        left, right = spelling.untouched(w, own, common, tails)
        for i, c in itertools.product(range(len(w) + 1), "abc"):
            edits = [(w[:i] + c + w[i:], i, i)]
            if i < len(w):
                edits += [(w[:i] + c + w[i + 1 :], i, i + 1), (w[:i] + w[i + 1 :], i, i + 1)]
            for other, at, behind in edits:
                theirs = spelling.decompose(other, common)
                shift = len(other) - len(w)
                assert theirs[: left[at]] == own[: left[at]]
                kept = right[behind]
                assert [(s - shift, e - shift) for s, e in theirs[len(theirs) - kept :]] == own[len(own) - kept :]


def test_words_of_documents(spark):
    rows = [*edge.ROWS, (20, "Colour colour colours ÀÉcolour×xyz ABCDEFGH abcdefgh abcdefgi2abcdefgi", "s", 0, "", 0.0), (21, "colour " * 9000, None, 0, "", 0.0)]
    counts = {}
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r[1] or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            if len(word) >= 7:
                counts[word] = counts.get(word, 0) + 1
    words = {w: n for w, n in counts.items() if n >= 2}
    assert words and found(spelling.spelling_groups(edge.documents(spark, rows))) == brute(words)


def test_chains_of_forms_end_at_one_root(spark):
    words = {"aaaaaaa": 1, "aaaaaab": 10, "aaaaabb": 100, "aaaabbb": 1000, "aaabbbb": 10_000, "aabbbbb": 100_000, "abbbbbb": 10**6}
    rows = spark.createDataFrame(list(words.items()), "word string, n long")
    assert found(spelling.variants(rows)) == brute(words)
    assert {r.root for r in spelling.variants(rows).collect()} == {"abbbbbb"}


def test_empty_table(spark):
    assert spelling.spelling_groups(edge.empty(spark)).collect() == []
