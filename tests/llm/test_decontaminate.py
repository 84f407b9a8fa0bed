import numpy as np
from pyspark.sql import functions as F

from markbook.llm import decontaminate as dc
from markbook.llm.queries import QUERIES

from .helpers import edit_distance, words

SF = "/root/testdata/sf0.001"


def brute(docs, items):
    out = {}
    for d, text in docs.items():
        for i, item in items.items():
            a = words(item)
            edits = edit_distance(a, words(text), free_ends=True) if len(a) >= dc.MIN_WORDS else len(a) + 1
            if edits <= dc.edits_allowed(len(a)):
                out[d, i] = edits
    return out


def test_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    some = {d: t for d, t in docs.items() if len(t) < 4000}
    found = {(r.doc_id, r.item_id): r.edits for r in QUERIES["op2_benchmark_decontamination"](spark, SF).collect()}
    assert {k: v for k, v in found.items() if k[0] in some} == brute(some, items)


def test_edited_passages_equal_brute_force(spark, monkeypatch):
    """Also with the benchmark in several blocks."""
    rng = np.random.default_rng(1)
    items = {i: " ".join(f"w{v}" for v in rng.integers(0, 60, rng.integers(3, 40))) for i in range(12)}
    docs = {}
    for d in range(60):
        w = words(items[int(rng.integers(12))])
        for _ in range(int(rng.integers(0, 8))):
            at = int(rng.integers(len(w) + 1))
            w[at : at + int(rng.integers(2))] = ["X"] if rng.integers(2) else []
        around = [f"w{v}" for v in rng.integers(0, 60, 20)]
        docs[d] = " ".join(around[:10]) + "\n" + " ".join(w).upper() + "\t" + " ".join(around[10:])
    frames = (spark.createDataFrame(list(x.items()), f"{k} long, text string") for x, k in ((docs, "doc_id"), (items, "item_id")))
    docs_frame, items_frame = frames
    want = brute(docs, items)
    for words_at_once in (dc.BLOCK_WORDS, 100):
        monkeypatch.setattr(dc, "BLOCK_WORDS", words_at_once)
        found = dc.find_benchmark(spark, docs_frame, items_frame).collect()
        assert {(r.doc_id, r.item_id): r.edits for r in found} == want


def test_odd_rows(spark):
    item = "alpha beta gamma delta epsilon zeta"
    docs = spark.createDataFrame([(1, f"x {item} y"), (1, f"x {item} y"), (2, None), (3, ""), (None, item), (4, "clean text of some words")], "doc_id long, text string")
    docs = docs.withColumns({c: F.lit(0) for c in ("item_id", "item", "doc", "place", "edits")})
    bench = spark.createDataFrame([(7, item), (7, item), (8, None), (None, item), (9, ""), (10, "clean text")], "item_id long, text string")
    found = dc.find_benchmark(spark, docs, bench).collect()
    assert sorted(((r.doc_id, r.item_id, r.edits, r.start_word, r.end_word) for r in found), key=str) == [(1, 7, 0, 1, 7), (None, 7, 0, 0, 6)]
    left = dc.decontaminate(spark, docs, bench)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [2, 3, 4]
    assert dc.find_benchmark(spark, docs.limit(0), bench).count() == dc.find_benchmark(spark, docs, bench.limit(0)).count() == 0


def test_clean_rows_stay_beside_contaminated_ones_of_their_id(spark):
    item = "alpha beta gamma delta epsilon zeta"
    rows = [(None, item), (None, "clean one"), (None, None), (1, f"x {item}"), (1, "clean two"), (1, "clean two"), (2, "clean three")]
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    left = dc.decontaminate(spark, spark.createDataFrame(rows, "doc_id long, text string"), bench)
    clean = [r for r in rows if r[1] is None or item not in r[1]]
    assert sorted(map(tuple, left.collect()), key=str) == sorted(clean, key=str)


def test_bit_parallel_distance():
    rng = np.random.default_rng(8)
    for _ in range(300):
        a, b = (rng.integers(0, 4, rng.integers(1, n)).astype(np.uint64) for n in (90, 30))
        assert dc.best_match(a, b)[0] == edit_distance(a.tolist(), b.tolist(), free_ends=True)


def test_short_items_are_reported_where_asked(spark):
    docs = spark.createDataFrame([(1, "one two three four five"), (2, "two  THREE"), (3, "other")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "two three"), (2, "three four five six"), (3, "one two three four"), (4, "five")], "item_id long, text string")
    found = {(r.doc_id, r.item_id, r.start_word) for r in dc.find_benchmark(spark, docs, bench, min_words=1).collect()}
    assert found == {(1, 1, 1), (2, 1, 0), (1, 3, 0), (1, 4, 4)}
    assert dc.find_benchmark(spark, docs, bench).collect() == []
    assert dc.decontaminate(spark, docs, bench).count() == 3
