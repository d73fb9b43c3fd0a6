import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from placelytics.llm import toxicity
from tests.llm import edge

BAD = ["grumblefoot", "snarkle", "vexatron"]


def corpus(n=400, seed=3):
    rng, rows, labels = random.Random(seed), [], []
    for i in range(n):
        words = edge.prose(rng.choice([3, 30, 300]), rng).split()
        toxic = rng.random() < 0.3
        for _ in range(toxic * rng.choice([1, 2])):
            words[rng.randrange(len(words))] = rng.choice(BAD)
        rows.append((i, " ".join(words), None, None, None, None))
        labels.append((i, int(toxic), "text of the label"))
    return rows, labels


def test_learns_words_and_unseen_misspellings(spark):
    rows, labels = corpus()
    docs = edge.documents(spark, rows)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int, text string"))
    scores = dict(toxicity.score(docs, model).collect())
    held = [(t, scores[i]) for i, t, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(s >= 0.5) == t for t, s in held]) >= 0.95
    new = edge.documents(spark, [(1, "w1 w2 grumblefoott w3", *[None] * 4), (2, "w1 w2 w5 w3", *[None] * 4)])
    fresh = dict(toxicity.score(new, model).collect())
    assert fresh[1] > 0.5 > fresh[2]


def test_held_out_rows_are_never_learned(spark):
    rows, labels = corpus(60)
    other = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t, x) for i, t, x in labels]
    docs = edge.documents(spark, rows)
    models = [toxicity.fit(docs, spark.createDataFrame(x, "doc_id long, toxic int, text string")) for x in (labels, other)]
    assert (models[0].margins == models[1].margins).all() and models[0].bias == models[1].bias
    ids = spark.range(50).select("id", toxicity.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in ids)


def test_edges_and_batches_score_alike(spark):
    model = toxicity.Model(np.random.default_rng(1).normal(0, 2, toxicity.BUCKETS).astype(np.float32), -1.0)
    out = toxicity.score(edge.documents(spark), model).collect()
    assert len(out) == len(edge.ROWS) and all(0 <= r.score <= 1 for r in out)
    texts = [r[1] or "" for r in edge.ROWS]
    alone = []
    for t in texts:
        column = pa.array([t], pa.large_string())
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
        alone.append(round(float(model.scores(data, np.frombuffer(column.buffers()[1], np.int64))[0]), 9))
    assert sorted(round(r.score, 9) for r in out) == sorted(alone)
    bias = 1 / (1 + np.exp(1.0))
    assert all(abs(s - bias) < 1e-9 for s, t in zip(alone, texts, strict=True) if not t.strip())


def test_missing_labels_and_empty_tables(spark):
    none = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int")
    model = toxicity.fit(edge.documents(spark), none)
    assert not model.margins.any()
    assert toxicity.score(edge.empty(spark), model).collect() == []
    docs = edge.documents(spark)
    assert toxicity.drop_toxic(docs, model, threshold=2.0).schema == docs.schema
    assert toxicity.drop_toxic(docs, model, threshold=2.0).count() == len(edge.ROWS)
    assert toxicity.drop_toxic(docs, model, threshold=0.0).count() == 0
