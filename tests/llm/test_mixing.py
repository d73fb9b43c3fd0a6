import random
from collections import Counter

import pytest

from placelytics.llm import mixing
from tests.llm import edge


def plain_targets(sizes, weights=mixing.WEIGHTS, share=1.5, cap=2):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, open_, rest = {}, set(names), share * sum(sizes.values())
    while open_:
        unit = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if cap * sizes[s] <= unit * weight[s]}
        if not full:
            out |= {s: unit * weight[s] for s in open_}
            break
        out |= {s: float(cap * sizes[s]) for s in full}
        rest -= sum(cap * sizes[s] for s in full)
        open_ -= full
    return out


def checked(rows, sizes):
    targets = plain_targets(sizes)
    taken, largest = dict.fromkeys(sizes, 0), dict.fromkeys(sizes, 0)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        assert 0 <= r.copies <= 2 and r.taken == r.copies * r["size"]
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
    return {s: (taken[s], targets[s], largest[s]) for s in sizes}


def corpus(n=700, sources=7, seed=1):
    rng = random.Random(seed)
    return [(i, edge.prose(rng.choice([1, 5, 40, 200, 900]) + rng.randrange(9), rng), f"s{min(rng.randrange(sources), rng.randrange(sources))}", None, None, None) for i in range(n)]


def sizes_of(rows):
    sizes = {}
    for r in rows:
        sizes[r[2]] = sizes.get(r[2], 0) + len((r[1] or "").split())
    return sizes


def test_meets_targets(spark):
    rows = corpus()
    out = mixing.mix(edge.documents(spark, rows)).collect()
    assert sorted(r.doc_id for r in out) == list(range(len(rows)))
    for taken, target, _ in checked(out, sizes_of(rows)).values():
        assert abs(taken - target) <= 0.002 * target + 5


def test_rates_are_tilts_of_size(spark):
    import math

    out = mixing.mix(edge.documents(spark, corpus())).collect()
    for source in {r.source for r in out}:
        own = [r for r in out if r.source == source and 1e-9 < r.rate < 2 and r["size"]]
        tilt = [math.log(r.rate) / r["size"] for r in own]
        assert not own or max(tilt) - min(tilt) < 1e-6 * max(1e-3, abs(max(tilt)))


def test_reruns_agree_whatever_the_partitions(spark):
    rows = corpus(300)
    a = mixing.mix(edge.documents(spark, rows).repartition(7)).collect()
    b = mixing.mix(edge.documents(spark, rows[::-1]).coalesce(1)).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_large_class_is_dealt_in_parts(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHOICE", 10)
    rows = [(i, "one two", "a" if i % 3 else "b", None, None, None) for i in range(500)]
    for taken, target, _ in checked(mixing.mix(edge.documents(spark, rows)).collect(), sizes_of(rows)).values():
        assert abs(taken - target) <= 2


def test_edges(spark):
    out = mixing.mix(edge.documents(spark)).collect()
    assert len(out) == len(edge.ROWS)
    found = checked(out, sizes_of(edge.ROWS))
    assert all(abs(taken - target) <= largest for taken, target, largest in found.values())
    assert all(r.taken == 0 and r.copies == 1 for r in out if r["size"] == 0)


def test_empty_and_wordless_tables(spark):
    assert mixing.mix(edge.empty(spark)).collect() == []
    rows = mixing.mix(edge.documents(spark, [(1, None, "a", None, None, None), (2, "", None, None, None, None)])).collect()
    assert [(r.taken, r.target) for r in rows] == [(0, 0.0), (0, 0.0)]


def times(rows):
    return Counter((r.doc_id, r.text, r.source) for r in rows)


def test_mixed_documents_are_whole_and_repeated(spark):
    rows = corpus(300)
    docs = edge.documents(spark, rows)
    copies = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
    assert set(copies.values()) == {0, 1, 2}
    out = mixing.mixed(docs).collect()
    assert times(out) == Counter({(r[0], r[1], r[2]): copies[r[0]] for r in rows if copies[r[0]]})
    assert all(r.copies == copies[r.doc_id] and 1 <= r.copy <= r.copies and r.taken == r.copies * r.mix_size for r in out)
    once = mixing.mixed(docs, repeat=False).collect()
    assert times(once) == Counter((r[0], r[1], r[2]) for r in rows if copies[r[0]])


def test_mixed_edges(spark):
    docs = edge.documents(spark)
    taken = Counter()
    for r in mixing.mix(docs).collect():
        taken[r.doc_id, r.source, r["size"]] += r.copies
    out = mixing.mixed(docs).collect()
    assert Counter((r.doc_id, r.source, r.mix_size) for r in out) == +taken
    assert {tuple(r)[:6] for r in out} <= set(edge.ROWS)
    assert mixing.mixed(edge.empty(spark)).collect() == []
