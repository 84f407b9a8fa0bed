from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from markbook.llm import passages as ps
from markbook.llm.queries import QUERIES

from .helpers import words

SF = "/root/testdata/sf0.001"


def repeated_runs(docs, n=ps.MIN_WORDS):
    """Starts of runs of n words that stand in an earlier document, for each document."""
    seen, out = {}, defaultdict(set)
    for d in sorted(docs):
        w = words(docs[d])
        own = [tuple(w[i : i + n]) for i in range(len(w) - n + 1)]
        out[d] |= {i for i, g in enumerate(own) if g in seen}
        for g in own:
            seen.setdefault(g, d)
    return {d: v for d, v in out.items() if v}


def check(rows, docs):
    spans = defaultdict(list)
    for r in rows:
        a, b = (set(zip(*(words(docs[d])[lo + k : hi] for k in range(5)))) for d, lo, hi in ((r.doc_id, r.start_word, r.end_word), (r.first_doc_id, r.first_start_word, r.first_end_word)))
        assert r.first_doc_id < r.doc_id and r.end_word - r.start_word >= ps.MIN_WORDS
        assert len(a & b) / len(a | b) >= 0.75 - 1e-9 and abs(len(a & b) / len(a | b) - r.similarity) < 1e-9
        spans[r.doc_id].append((r.start_word, r.end_word))
    for d, starts in repeated_runs(docs).items():
        assert all(any(lo <= i and i + ps.MIN_WORDS <= hi for lo, hi in spans[d]) for i in starts)
    return spans


def test_query_holds_every_repeated_run(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    check(QUERIES["op6_substring_dedup"](spark, SF).collect(), docs)


def test_passages_in_other_surroundings(spark):
    rng = np.random.default_rng(0)
    text = lambda n: [f"w{v}" for v in rng.integers(0, 5000, n)]
    line = "one line that stands in very many of the texts".split()
    shared = [text(70) for _ in range(4)]
    shared[3][30:39] = line
    docs, near = {}, {}
    for d in range(60):
        parts = text(int(rng.integers(40, 120))) + line + text(30)
        if d % 2:
            passage = list(shared[int(rng.integers(4))])
            if d % 6 == 1:  # one word replaced
                passage[35] = "changed"
                near[d] = True
            parts += passage
        docs[d] = " ".join(parts + text(int(rng.integers(20, 80))))
    docs[60] = " ".join(text(49))
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(4)
    spans = check(ps.repeated_passages(spark, frame).collect(), docs)
    assert not [d for d in spans if d % 2 == 0]  # a common line alone is no passage
    assert [d for d in near if d not in spans and d > 12] == []


def test_near_pairs_in_a_group_of_unlike_texts(spark):
    """A long common line gives unlike texts the same minima; every near pair that shares two of its own is found."""
    rng = np.random.default_rng(7)
    line = [f"common{i}" for i in range(25)]
    texts = [[f"t{t}.{i}" for i in range(13)] + line + [f"t{t}.{i}" for i in range(13, 25)] for t in range(200)]
    for t in range(60):
        copy = list(texts[t])
        copy[int(rng.integers(6, 10))] = f"new{t}"
        texts.append(copy)
    order = rng.permutation(len(texts))
    docs = {int(order[i]): " ".join(t) for i, t in enumerate(texts)}
    minima = lambda t: [int(ps.hashing.mix(ps.hashing.shingle_hashes(ps.hashing.word_hashes(" ".join(t))) ^ s).argmin()) for s in ps._SEEDS]
    want = set()
    for t in range(60):
        a, b = texts[t], texts[200 + t]
        if sum(a[i : i + 5] == b[j : j + 5] for i, j in zip(minima(a), minima(b), strict=True)) >= 2:
            want.add((int(max(order[t], order[200 + t])), int(min(order[t], order[200 + t]))))
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(4)
    found = {(r.doc_id, r.first_doc_id) for r in ps.repeated_passages(spark, frame).collect()}
    assert len(want) > 50 and (len(want - found), len(found - want)) == (0, 0)


def test_copies_and_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(200))
    rows = [(i, text) for i in range(30)] + [(3, text), (50, None), (51, ""), (None, text), (52, "w " * 3000), (53, "too short")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("row", "key", "hub", "doc", "start")})
    found = ps.repeated_passages(spark, docs).collect()
    assert {r.doc_id for r in found} == {*range(1, 30), None}
    assert all((r.start_word, r.end_word, r.first_doc_id, r.similarity) == (0, 200, 0, 1.0) for r in found)
    assert ps.repeated_passages(spark, docs.limit(0)).collect() == []


def test_windows_stand_for_all_runs():
    rng = np.random.default_rng(1)
    for _ in range(30):
        v = rng.integers(1, 12, rng.integers(1, 40)).astype(np.uint64) << np.uint64(50)  # hashes differ in their leading bits
        for length in (1, 3, 7):
            l, c, r = ps.compact_windows(v, length)
            for i in range(len(v)):
                for j in range(i + length - 1, len(v)):
                    at = i + int(v[i : j + 1].argmin())
                    held = (l <= i) & (i <= c) & (c <= j) & (j <= r)
                    assert c[held].tolist() == [at]


def test_shared_run_is_the_longest():
    rng = np.random.default_rng(2)
    for _ in range(300):
        marks = (rng.random(rng.integers(1, 25)) < 0.7).astype(float)
        at = int(rng.integers(len(marks)))
        lo, hi = ps.shared_run(marks, at, 0.8)
        best = max((j - i for i in range(at + 1) for j in range(at + 1, len(marks) + 1) if marks[i] and marks[j - 1] and marks[at] and marks[i:j].mean() >= 0.8 - 1e-12), default=0)
        assert hi - lo == best


def test_only_wanted_texts_are_hashed(monkeypatch):
    hashed, word_hashes = [], ps.hashing.word_hashes
    monkeypatch.setattr(ps.hashing, "word_hashes", lambda text: hashed.append(text) or word_hashes(text))
    batch = pa.RecordBatch.from_pydict({"row": [*range(20)], "doc": [*range(20)], "text": [f"text {i} has a few words of its own" for i in range(20)]})
    bits = np.zeros(64, np.int64)
    bits[7] = 1
    found = pa.Table.from_batches(ps._shingles(bits)([batch])).to_pydict()
    assert found["row"] == [7] and hashed == ["text 7 has a few words of its own"]


def test_windows_of_many_texts_are_those_of_each():
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{v}" for v in rng.integers(0, 40, rng.integers(1, 120))) for _ in range(50)]
    frame = lambda ids: pa.RecordBatch.from_pydict({"row": [100 + i for i in ids], "doc": [*ids], "text": [texts[i] for i in ids]})
    together = [r for b in ps._windows(10)([frame(range(50))]) for r in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True)]
    want = set()
    for i, text in enumerate(texts):
        s = ps.hashing.shingle_hashes(ps.hashing.word_hashes(text), ps.SHINGLE)
        for f, seed in enumerate(ps._SEEDS):
            v = ps.hashing.mix(s ^ seed)
            places = {int(j + v[j : j + 10].argmin()) for j in range(len(v) - 9)} if len(ps.hashing.word_hashes(text)) >= ps.SHINGLE else set()
            want |= {(100 + i, i, 1 << f, int(v[c].view(np.int64)), c) for c in places}
    assert len(together) == len(set(together)) and set(together) == want


def test_runs_that_stand_in_an_earlier_text_are_left_to_it():
    """Of a text with a verbatim passage, the second search takes only runs that go beyond it."""
    text = " ".join(f"w{i}" for i in range(104))  # 100 shingles
    rows = lambda same: pa.RecordBatch.from_arrays(
        [pa.array([1]), pa.array([text]), pa.array([[30, 55]], pa.list_(pa.int32())), pa.array([[{"start": 0, "end": 60, "same": same}]])], ["row", "text", "places", "spans"]
    )
    at = lambda same: [a for b in ps._spread(10)([rows(same)]) for a in b.column("at").to_pylist()]
    assert at(False) == [*range(21, 40), *range(46, 65)]
    assert at(True) == [*range(51, 65)]


def test_longest_runs_around_all_places():
    rng = np.random.default_rng(4)
    for _ in range(100):
        marks = (rng.random(rng.integers(1, 25)) < 0.7).astype(float)
        runs = ps.Runs(marks)
        for share in (0.75, 0.9, 1.0):
            for at in np.flatnonzero(marks).tolist():
                lo, hi = runs.around(at, share)
                lengths = [j - i for i in range(at + 1) for j in range(at + 1, len(marks) + 1) if marks[i] and marks[j - 1] and marks[i:j].mean() >= share - 1e-12]
                assert lo <= at < hi and marks[lo] and marks[hi - 1] and hi - lo == max(lengths)
