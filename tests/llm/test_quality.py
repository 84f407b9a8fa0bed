import zlib

import numpy as np
from pyspark.sql import functions as F

from markbook.llm import quality
from markbook.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in QUERIES["op7_quality_classifier"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows.values())
    labels = [r for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if rows[r.doc_id].held_out]
    for kind in (0, 1):
        own = [rows[r.doc_id].predicted == kind for r in labels if r.quality == kind]
        assert len(own) > 10 and np.mean(own) > 0.95


def test_odd_rows(spark):
    text = "some plain words in a row"
    docs = spark.createDataFrame([(1, text), (1, text), (2, None), (3, ""), (None, "x" * 200_000), (4, "?!? " * 9)], "doc_id long, text string")
    docs = docs.withColumns({c: F.lit(1) for c in ("label", "quality", "vector", "score", "doc")})
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (3, 5), (99, 1), (None, 1)], "doc_id long, quality int")
    for some in (labels, labels.limit(0)):
        out = quality.quality_scores(spark, docs, some)
        found = out.collect()
        assert set(out.columns) == {*docs.columns, "predicted"} and len(found) == 6
        assert all(0 <= r.score <= 1 for r in found)
    assert all(r.score == 0.5 for r in found)
    assert quality.quality_scores(spark, docs.limit(0), labels).count() == 0


def test_word_vectors_equal_a_plain_sum(spark):
    texts = ["the cat sat", "", "a the cat", "one"]
    found = quality.word_vectors(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3))
    want = np.zeros((quality.BUCKETS, quality.DIMS))
    for t in texts:
        words = quality.hashing.word_hashes(t)
        places, signs = quality.index_slots(words, quality.DIMS)
        for i, w in enumerate(words):
            for j in range(max(0, i - quality.REACH), min(len(words), i + quality.REACH + 1)):
                if i != j:
                    np.add.at(want[int(w % np.uint64(quality.BUCKETS))], places[j], signs[j])
    norms = np.linalg.norm(want, axis=1, keepdims=True)
    assert np.allclose(found, want / np.where(norms, norms, 1), atol=1e-6)


def test_temperature_calibrates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 5))
    y = (rng.random(4000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    net = quality.fit(x, y)
    s = net.score(x)
    sure = s > 0.8
    assert abs(s[sure].mean() - y[sure].mean()) < 0.06 and net.temperature > 0
