import re

from pyspark.sql import functions as F

from placelytics.llm import decontaminate
from tests.llm import edge

ITEMS = [
    (1, " ".join(edge.BASE.split()[30:45])),
    (2, "Two words!"),
    (3, None),
    (4, "..."),
    (5, " ".join(edge.BASE.split()[30:45])),
    (None, "ünïcode ÄÖ"),
    (7, " ".join(edge.LONG.split()[500:512])),
]


def split(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(text):
    own, hit, items = split(text), set(), set()
    for item, passage in ITEMS:
        w = split(passage)
        for i in range(max(len(w) - 9, 1) if w else 0):
            gram = w[i : i + 10]
            for p in range(len(own) - len(gram) + 1):
                if own[p : p + len(gram)] == gram:
                    hit |= set(range(p, p + len(gram)))
                    items.add("" if item is None else str(item))
    return len(own), len(hit), len(items), sorted(items)


def benchmark(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def test_equals_brute_force(spark):
    rows = decontaminate.contamination(edge.documents(spark), benchmark(spark)).collect()
    found = sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, sorted(r["items"]), r.contaminated) for r in rows), key=str)
    expected = []
    for r in edge.ROWS:
        n, hit, k, items = brute(r[1])
        expected.append((r[0], n, hit, k, items, hit > 0))
    assert found == sorted(expected, key=str)


def test_without_broadcast(spark, monkeypatch):
    same = sorted(map(str, decontaminate.contamination(edge.documents(spark), benchmark(spark)).drop("spans", "items").collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_NGRAMS", 0)
    assert same == sorted(map(str, decontaminate.contamination(edge.documents(spark), benchmark(spark)).drop("spans", "items").collect()))


def test_long_texts_without_broadcast(spark, monkeypatch):
    passage, short = " ".join(f"p{i}" for i in range(14)), "only three words"
    long = " ".join([*(f"w{i % 700}" for i in range(20_000)), passage, *(f"w{i % 9}" for i in range(5_000)), short])
    docs = edge.documents(spark, [(1, long, *[None] * 4), (1, long, *[None] * 4), (None, f"x {passage}", *[None] * 4), (3, "w1 w2", *[None] * 4)])
    items = spark.createDataFrame([(1, passage), (2, short), (3, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w11")], "item_id long, text string")

    def found():
        rows = decontaminate.contamination(docs, items).select("doc_id", "n_hit", F.sort_array("items").alias("items"), "spans")
        return sorted(map(str, rows.collect()))

    near = found()
    assert sum("n_hit=17" in row for row in near) == 2 and "n_hit=14" in "".join(near)
    for limit in ("BROADCAST_NGRAMS", "BROADCAST_BYTES"):
        with monkeypatch.context() as patch:
            patch.setattr(decontaminate, limit, 0)
            assert found() == near


def test_words_of_a_document_are_not_shuffled_by_word(spark):
    split = edge.documents(spark).select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"), decontaminate.words(F.col("text")).alias("w"))
    ngrams = decontaminate.benchmark_ngrams(benchmark(spark))
    plan = decontaminate._found_by_shuffle(split, ngrams)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert not re.search("EvalPython|InArrow|InPandas|NestedLoop|Cartesian", plan)
    steps = re.findall(r"Exchange\nInput \[\d+\]: \[(.*)\]\nArguments: hashpartitioning\((?:word|gram)#", plan)
    assert steps and not any(re.search(r"\bw#", step) for step in steps)


def test_removing_spans_and_documents(spark):
    docs = edge.documents(spark)
    clean = decontaminate.decontaminate(docs, benchmark(spark))
    assert clean.columns == docs.columns
    assert clean.count() == sum(brute(r[1])[1] == 0 for r in edge.ROWS)
    text = "Before, TWO -- words: after."
    one = edge.documents(spark, [(1, text, None, None, None, None), (2, "clean  text", None, None, None, None)])
    rows = dict(decontaminate.decontaminate(one, benchmark(spark), remove="spans").select("doc_id", "text").collect())
    assert rows == {1: "Before, after.", 2: "clean  text"}


def test_empty_tables(spark):
    docs = edge.documents(spark)
    assert decontaminate.contamination(edge.empty(spark), benchmark(spark)).collect() == []
    assert not any(r.contaminated for r in decontaminate.contamination(docs, benchmark(spark).limit(0)).collect())


def test_no_python_in_the_plan(spark):
    plan = decontaminate.contamination(edge.documents(spark), benchmark(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastHashJoin" in plan
