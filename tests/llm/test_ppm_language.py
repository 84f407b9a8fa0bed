import math
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from markbook.llm import ppm_language as ppm
from markbook.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in QUERIES["op5_language_id"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in rows.items())
    held = [rows[d.doc_id].lang_pred == d.lang for d in docs if rows[d.doc_id].held_out]
    assert np.mean(held) > 0.98


def plain_code_length(train: bytes, text: bytes) -> float:
    """Bits by one tree, by the book: escape to shorter contexts, no exclusion."""
    counts = defaultdict(Counter)
    for i in range(ppm.ORDER, len(train)):
        for k in range(ppm.ORDER + 1):
            counts[train[i - k : i]][train[i]] += 1
    bits = 0.0
    for i in range(ppm.ORDER, len(text)):
        for k in range(ppm.ORDER, -1, -1):
            c = counts.get(text[i - k : i])
            if c is None:
                continue
            total, distinct = sum(c.values()), len(c)
            if c[text[i]]:
                bits -= math.log2(c[text[i]] / (total + distinct))
                break
            bits -= math.log2(distinct / (total + distinct))
        else:
            bits += 8
    return bits


def test_code_lengths_equal_plain_ones(monkeypatch):
    monkeypatch.setattr(ppm, "_CHUNK", 7)
    train = {"x": "the cat sat on the mat and the rat", "y": "le chat est sur le tapis"}
    langs, keys, counts, lang = sorted(train), [], [], []
    for n, name in enumerate(langs):
        data = np.frombuffer(ppm.normal(train[name]), np.uint8)
        for size in range(1, ppm.ORDER + 2):
            k, c = np.unique(ppm.runs(data[ppm.ORDER + 1 - size :], size), return_counts=True)
            keys.append(k), counts.append(c), lang.append(np.full(len(k), n))
    trees = ppm.Trees.freeze(langs, np.concatenate(lang), np.concatenate(keys), np.concatenate(counts))
    texts = ["The rat sat", "sur le chat", "zzz éé 12", "x"]
    bits = trees.code_lengths([ppm.normal(t) for t in texts])
    for i, t in enumerate(texts):
        for j, name in enumerate(langs):
            assert math.isclose(bits[i, j], plain_code_length(ppm.normal(train[name]), ppm.normal(t)), rel_tol=1e-4)


def test_odd_rows(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat sat on the mat", "en"), ("le chat est sur le tapis", "fr")] * 20)]
    rows += [(100, None, "en"), (101, "", "fr"), (102, "12 -- !", "en"), (103, "the cat", None), (None, "le chat", "fr"), (0, "the cat sat on the mat", "en")]
    rows += [(104, "the mat " * 100_000, "de")]  # longer than the bound: not learned
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({c: F.lit("q") for c in ("score", "doc", "run", "h", "size")})
    out = ppm.identify_language(spark, docs, max_bytes=10_000)
    found = out.collect()
    assert len(found) == len(rows) and set(out.columns) == {*docs.columns, "lang_pred"}
    by_id = {r.doc_id: r for r in found}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (100, 101, 102))
    assert by_id[103].lang_pred == by_id[104].lang_pred == "en" and by_id[None].lang_pred == "fr"
    assert {r.lang_pred for r in found} == {"en", "fr", "und"} and all(0 <= r.score <= 1 for r in found)
    assert ppm.identify_language(spark, docs.limit(0)).count() == 0
    assert {r.lang_pred for r in ppm.identify_language(spark, docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_every_language_with_a_text_inside_the_bound_is_learned(spark):
    """Few and long texts, texts in one hash range, and languages whose texts are all empty or too long."""
    rows = [(i * 10 + j, f"{chr(97 + i % 26)}{i} word " * 11, f"l{i:02d}") for i in range(40) for j in range(2)]
    rows += [(1000 + j, "", "void") for j in range(9)] + [(2000 + j, None, "none") for j in range(9)] + [(3000, "x" * 500, "long")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert ppm.train(docs, folds=(4, 4), max_bytes=100).langs == [f"l{i:02d}" for i in range(40)]
    assert ppm.identify_language(spark, docs.where("lang = 'void'")).select("lang_pred", "score").distinct().collect() == [("und", 0.0)]
