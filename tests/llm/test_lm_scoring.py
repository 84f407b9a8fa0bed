import math
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from markbook.llm import lm_scoring as lm
from markbook.llm.queries import QUERIES

from .helpers import words

SF = "/root/testdata/sf0.001"


def fold(i):
    return None if i is None else zlib.crc32(str(i).encode()) % 10


def stream(text):
    return "\n".encode() * lm.ORDER + " ".join(words(text)).encode() + b"\n"


def brute(docs):
    """Each document's row, the byte model by the book over the whole byte stream."""
    counts, followers = Counter(), defaultdict(Counter)
    for i, text in docs:
        if fold(i):
            counts.update(words(text))
            counts["\n"] += 1
            s = stream(text)
            for p in range(lm.ORDER, len(s)):
                for k in range(lm.ORDER + 1):
                    followers[s[p - k : p]][s[p]] += 1
    total, kinds = sum(counts.values()), len(counts)

    def log_prob(text):
        result, s = 0.0, stream(text)
        for p in range(lm.ORDER, len(s)):
            out = set()
            for k in range(lm.ORDER, -1, -1):
                left = {b: c for b, c in followers[s[p - k : p]].items() if b not in out}
                if not left:
                    continue
                whole = sum(left.values()) + len(left)
                if s[p] in left:
                    result += math.log10(left[s[p]] / whole)
                    break
                result += math.log10(len(left) / whole)
                out |= set(left)
            else:
                result -= math.log10(256 - len(out))
        return result

    out = []
    for i, text in docs:
        tokens = [*words(text), "\n"]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in tokens)
        out.append((i, fold(i) == 0, len(tokens), sum(counts[w] > 0 for w in tokens), total, base, log_prob(text)))
    return out


def check(found, want):
    order = lambda r: (r[0] is not None, r[0] or 0, r[2], r[6])
    found, want = sorted(map(tuple, found), key=order), sorted(want, key=order)
    assert [r[:5] for r in found] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in found], [r[5:] for r in want], rtol=1e-9)


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check(QUERIES["op10_lm_scoring"](spark, SF).collect(), brute(docs))


MIXED = [(i, f"the cat sat on {i} mats of number{i * i} and Änd") for i in range(40)] + [(41, None), (42, ""), (3, "the cat"), (None, "the unseen"), (43, "zebra " * 2000), (44, " \t the\ncat  "), (45, "\x00\x01 日本")]


def test_mixed_rows_equal_brute_force(spark):
    frame = spark.createDataFrame(MIXED, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("key", "n", "chunk", "data", "score", "doc", "learn")}).repartition(4)
    check(lm.score_documents(spark, frame).collect(), brute(MIXED))


def test_many_chunks_in_a_task():
    """Chunks end at their bound, hold whole texts, and count every key of theirs once."""
    import pyarrow as pa

    class Context:
        def partitionId(self):
            return 3

    import pyspark

    before, pyspark.TaskContext.get = pyspark.TaskContext.get, staticmethod(Context)
    sizes = lm.CHUNK_BYTES, lm.BLOCK_BYTES
    lm.CHUNK_BYTES, lm.BLOCK_BYTES = 400, 100
    try:
        batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in MIXED], pa.int64()), pa.array([t for _, t in MIXED]), pa.array([bool(fold(i)) for i, _ in MIXED])], ["doc", "text", "learn"])
        rows = [r for b in lm._chunks(iter([batch])) for r in b.to_pylist()]
    finally:
        pyspark.TaskContext.get = before
        lm.CHUNK_BYTES, lm.BLOCK_BYTES = sizes
    blocks, keys = [r for r in rows if r["key"] is None], [r for r in rows if r["key"] is not None]
    assert [d for r in blocks for d in r["doc"]] == [i for i, _ in MIXED]
    assert len({r["chunk"] for r in blocks}) > 4 and {r["chunk"] for r in keys} == {r["chunk"] for r in blocks}
    assert len({(r["chunk"], r["key"]) for r in keys}) == len(keys)
    learned = Counter()
    for i, t in MIXED:
        if fold(i):
            learned.update(lm.runs_of([lm.normal(t)])[0].view(np.int64).tolist())
    total = Counter()
    for r in keys:
        if r["key"] >= 0:
            total[r["key"]] += r["n"]
    assert {k: n for k, n in total.items() if n} == dict(learned)


def test_word_order_counts(spark):
    """The words of a training text score higher in their order than in another one."""
    rng = np.random.default_rng(0)
    vocabulary = [f"w{chr(97 + i % 26)}{i}" for i in range(200)]
    base = [[vocabulary[j] for j in rng.permutation(200)[:60]] for _ in range(30)]
    docs = [(i, " ".join(w)) for i, w in enumerate(base * 3)]
    apart = [(1000 + i, " ".join(reversed(w))) for i, w in enumerate(base)]
    score = {r.doc_id: r.score for r in lm.score_documents(spark, spark.createDataFrame(docs + [(i, t) for i, t in apart if not fold(i)], "doc_id long, text string")).collect()}
    pairs = [(score[i], score[1000 + i]) for i in range(30) if 1000 + i in score]
    assert pairs and all(a > b + 10 for a, b in pairs)


def test_repeated_rows_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b")] * 3 + [(2, "a c")], "doc_id long, text string")
    check(lm.score_documents(spark, docs).collect(), brute([(1, "a b")] * 3 + [(2, "a c")]))
    assert lm.score_documents(spark, docs.limit(0)).count() == 0
    alone = [(None, "a b c")]
    check(lm.score_documents(spark, spark.createDataFrame(alone, "doc_id long, text string")).collect(), brute(alone))
