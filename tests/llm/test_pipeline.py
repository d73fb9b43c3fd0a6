"""The stages one by one on a small corpus with planted cases, and the run as a whole."""

import random

import pytest

import corpus_pipeline
from tests.llm import edge, test_decontaminate, test_exact_dedup, test_ngram_join
from tests.llm.test_toxicity import BAD


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    texts = [edge.prose(rng.choice([20, 80, 200]), rng) for _ in range(150)]
    labels = []
    for i in range(300):
        toxic = i % 3 == 0
        words = edge.prose(40, rng).split()
        if toxic:
            words[rng.randrange(40)] = rng.choice(BAD)
        texts.append(" ".join(words))
        labels.append((150 + i, 1, int(toxic)))
    texts += [texts[i].upper() for i in range(10)]
    texts += [edge.edited(texts[i], [7], rng) for i in range(30, 60) if len(texts[i].split()) >= 80]
    items = [(i, edge.prose(14, rng)) for i in range(5)]
    texts += [f"{edge.prose(30, rng)} {t} {edge.prose(30, rng)}" for _, t in items]
    rows = [(i, t, "en", f"s{i % 4}", len(t)) for i, t in enumerate(texts)]
    rows += [(len(rows), None, None, None, None), (len(rows) + 1, "", "en", "s1", 0)]
    out = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return str(out)


def test_each_stage_on_its_own_input(spark, folder):
    test_decontaminate_items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    whole = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, folder)
        after = {r.doc_id: r for r in out.collect()}
        assert set(after) <= set(before)
        if name != "source_mixing":
            assert out.columns == whole and all(after[i] == before[i] for i in after)
        gone = set(before) - set(after)
        if name == "toxicity":
            bad = {i for i, r in before.items() if any(b in (r.text or "") for b in BAD)}
            assert len(gone - bad) <= 3 and len(bad - gone) <= 5
        elif name == "exact_dedup":
            groups = {}
            for i, r in before.items():
                groups.setdefault(test_exact_dedup.normal(r.text), []).append(i)
            assert set(after) == {max(g) for g in groups.values()}
        elif name == "ngram_jaccard_join":
            classes = test_ngram_join.brute([(i, r.text) for i, r in before.items()], 5, 80)
            assert set(after) == {i for i, n, c in classes if n == 0 or i == c}
            assert gone
        elif name == "benchmark_decontamination":
            saved, test_decontaminate.ITEMS = test_decontaminate.ITEMS, test_decontaminate_items
            hit = {i for i, r in before.items() if test_decontaminate.brute(r.text)[1]}
            test_decontaminate.ITEMS = saved
            assert gone == hit and len(hit) == 5
        docs = spark.createDataFrame([before[i] for i in after], docs.schema) if name != "source_mixing" else out


def test_run_is_the_stages(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    assert rows and all(r.taken == r.copies * r["size"] for r in rows)
    assert len({r.doc_id for r in rows}) == len(rows)


def test_run_yields_the_documents_that_are_taken(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert rows and all(r.copies > 0 and r.text == texts[r.doc_id] for r in rows)
