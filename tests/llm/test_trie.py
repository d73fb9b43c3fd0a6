import hashlib
import random

import pytest

from placelytics.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, head string, n int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def brute(rows):
    talks = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            talks.setdefault(conv, []).append(((turn is not None, turn or 0), digest(role, text), (role, text)))
    talks = {c: tuple(t[2] for t in sorted(turns)) for c, turns in talks.items()}
    members = {}
    for conv, turns in talks.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(conv)
    sons = {}
    for path in members:
        if path:
            sons.setdefault(path[:-1], []).append(path)

    def below(path):
        return [path] + [p for s in sons.get(path, ()) for p in below(s)]

    out = []
    for path, convs in members.items():
        tree = below(path)
        ends = ",".join(str(c) for c in sorted(convs) if len(talks[c]) == len(path))
        out.append((
            min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), len(sons.get(path, ())),
            sum(p not in sons for p in tree),
            sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in tree if p),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def found(df):
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


EDGES = [
    (1, None, "user", "first"), (1, 1, None, "a"), (1, 2, "user", None), (1, 2, "user", "tie"),
    (2, 5, "user", "first"), (2, 6, "", "a"), (3, 1, "user", "first"), (3, 1, "user", "first"),
    (None, 1, "user", "nobody"), (4, 1, None, None), (-9, 1, None, None), (2**40, 1, None, None),
    (5, 1, "us", "erx"), (6, 1, "user", "x"), (7, 1, "user", "long " * 50_000), (8, 1, "user", "long " * 50_000),
    (9, 1, "user", "ünï"), (10, 1, "user", "ünï"), (10, 2, "user", "ünï"),
]


@pytest.mark.parametrize("container", [1, 2, 1000])
def test_edges(spark, container):
    assert found(trie.prefix_trie(table(spark, EDGES), container=container)) == brute(EDGES)


@pytest.mark.parametrize("container", [1, 5, 40])
def test_equals_brute_force(spark, container):
    rng, rows = random.Random(3), []
    for conv in range(300):
        talk = [rng.choice("abc") for _ in range(rng.randrange(1, 9))]
        if conv % 3 == 0:
            talk = list("aabbca")
        rows += [(conv * 5000, i, "user" if i % 2 else "assistant", x * (i + 1)) for i, x in enumerate(talk)]
    assert found(trie.prefix_trie(table(spark, rows), container=container)) == brute(rows)


def test_a_turnless_conversation_is_a_member_of_the_root(spark):
    rows = spark.createDataFrame([(1, b"", []), (2, b"x" * 16, [3])], "conv_id long, ids binary, sizes array<long>")
    none, two = (hashlib.sha256(x).hexdigest() for x in (b"1", b"2"))
    assert found(trie.trie(rows)) == sorted([(1, 0, None, 2, 1, 1, 0, none), (2, 1, 1, 1, 0, 1, 0, two)], key=str)


def test_copies_cost_no_bursts(spark):
    rows = [(c, i, "user", f"turn {i}") for c in range(200) for i in range(30)]
    nodes = found(trie.prefix_trie(table(spark, rows), container=2))
    assert nodes == brute(rows)


def test_empty_table_and_other_ids(spark):
    assert trie.prefix_trie(table(spark, [])).collect() == []
    with pytest.raises(ValueError, match="whole numbers"):
        trie.prefix_trie(spark.createDataFrame([("a", 1, "r", "t")], "conv_id string, turn long, role string, text string"))
