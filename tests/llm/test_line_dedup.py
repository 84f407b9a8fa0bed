import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from markbook.llm import line_dedup as ld
from markbook.llm.queries import ORACLES, QUERIES

from .helpers import edit_distance, words

SF = "/root/testdata/sf0.001"


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    found = con.execute(ORACLES["op9_line_dedup"])
    names = [d[0] for d in found.description]
    want = sorted(found.fetchall())
    assert sorted(tuple(r) for r in QUERIES["op9_line_dedup"](spark, SF).select(*names).collect()) == want


def test_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    base = [[f"w{rng.integers(30)}" for _ in range(rng.integers(3, 12))] for _ in range(20)]
    docs = {}
    for d in range(40):
        lines = []
        for _ in range(rng.integers(1, 6)):
            line = list(base[rng.integers(20)])
            if rng.integers(2):
                at = rng.integers(len(line))
                line[at : at + rng.integers(2)] = [f"n{rng.integers(9)}"] if rng.integers(2) else []
            lines.append("  ".join(line).upper() if rng.integers(2) else " ".join(line))
        docs[d] = "\n".join(lines)
    kept, seen = {}, []
    for d in sorted(docs):
        stay = []
        for line in docs[d].split("\n"):
            w = words(line)
            if len(w) < ld.MIN_WORDS or all(edit_distance(w, s) > 1 for s in seen):
                stay.append(line)
            if len(w) >= ld.MIN_WORDS:
                seen.append(w)
        kept[d] = "\n".join(stay)
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    out = ld.line_dedup(spark, frame).collect()
    assert {r.doc_id: r.text for r in out} == kept


def test_odd_rows(spark):
    line = "one two three four five six seven"
    rows = [
        (1, line),
        (1, line),  # the same document again
        (2, f"{line}\n\n{line.replace('four', 'x')}\nshort line"),
        (3, None),
        (4, ""),
        (None, line),  # ranks last
        (5, "a b a b a b\na a b a b a b"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.withColumns({c: F.lit(1) for c in ("row", "line", "n_lines", "slot", "_gone")})
    out = ld.line_dedup(spark, docs)
    assert set(docs.columns) | {"n_dropped"} == set(out.columns)
    found = sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out.collect()), key=str)
    want = [(1, line, 1, 0), (1, line, 1, 0), (2, "\nshort line", 4, 2), (3, None, 0, 0), (4, "", 1, 0), (None, "", 1, 1), (5, "a b a b a b", 2, 1)]
    assert found == sorted(want, key=str)
    assert ld.line_dedup(spark, docs.limit(0)).count() == 0


def test_short_repeats(spark):
    """Exact repeats of short lines go too; near ones and lines without words stay."""
    line = "one two three four five six seven"
    rows = [(1, f"All rights reserved.\n\n{line}\nMIT"), (2, f"ALL  rights reserved.\nAll rights kept.\n \n{line} eight"), (3, "mit\nAll rights"), (None, "All rights\n\n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    found = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in ld.line_dedup(spark, docs, short_repeats=True).collect()}
    assert found == {1: (rows[0][1], 4, 0), 2: ("All rights kept.\n ", 4, 2), 3: ("All rights", 2, 1), None: ("\n", 3, 1)}


def test_one_word_apart():
    rng = np.random.default_rng(4)
    for _ in range(500):
        a, b = (rng.integers(0, 3, rng.integers(1, 6)).astype(np.uint64) for _ in range(2))
        assert ld.one_word_apart(a, b) == (edit_distance(a.tolist(), b.tolist()) <= 1)


def test_lines_one_word_apart_share_a_half_and_a_variant():
    rng = np.random.default_rng(6)
    for _ in range(200):
        a = [f"w{i}" for i in rng.integers(0, 50, rng.integers(6, 15))]
        b = list(a)
        at = int(rng.integers(len(b)))
        b[at : at + int(rng.integers(2))] = ["new"] if rng.integers(2) else []
        if len(b) < 6:
            continue
        x, y = (ld.Lines(" ".join(t), 6) for t in (a, b))
        assert set(x.halves()[0].tolist()) & set(y.halves()[0].tolist())
        assert set(x.variants(0).tolist()) & set(y.variants(0).tolist())


def test_short_texts_are_hashed_together(monkeypatch):
    """A batch of short texts is hashed in a few calls, and gives what each text gives alone; lines keep the number in their own text."""
    rng = np.random.default_rng(8)
    texts = [None, "", "\n\n", "\n".join(["x y"] * 3), *["\n".join(" ".join(f"é{i}" for i in rng.integers(0, 50, rng.integers(0, 12))) for _ in range(rng.integers(0, 9))) for _ in range(400)]]
    texts += ["\n" * 5 + "one two three four five six\n", " one two three four five six "]
    batch = pa.RecordBatch.from_pydict({"doc": np.arange(len(texts)), "row": np.arange(len(texts)) * 7, "text": pa.array(texts, pa.string())})
    want, want_variants = [], []
    for d, text in enumerate(texts):
        for short in (True, False):
            alone = ld.Lines(text, 1 if short else 6)
            for i, (number, line, half) in enumerate(zip(alone.number.tolist(), alone.line.tolist(), alone.halves().tolist(), strict=True)):
                size = int(alone.last[i] - alone.first[i])
                want.append((short, d, d * 7, number, line, half if size >= 6 else []))
                if not short:
                    held = alone.words[alone.first[i] : alone.last[i]]
                    left = [np.delete(held, j) for j in range(size)]
                    hashes = [int(ld.hashing.mix(np.sum(w * ld.hashing.powers(ld._B, len(w)), dtype=np.uint64, keepdims=True) + np.full(1, len(w), np.uint64) * ld._N).view(np.int64)[0]) for w in (held, *left)]
                    want_variants += [(line, k, j, held.tobytes() if j < 0 else None) for j, k in enumerate(hashes, -1)]
    calls, spans = [], ld.hashing.hashes_and_spans
    monkeypatch.setattr(ld.hashing, "hashes_and_spans", lambda text: calls.append(1) or spans(text))
    found = [(short, *r.values()) for short in (True, False) for out in ld._scan(6, short)(iter([batch])) for r in out.to_pylist()]
    every = np.full(4, -1)
    variants = [tuple(r.values()) for out in ld._variants(6, every, every)(iter([batch])) for r in out.to_pylist()]
    assert sorted(found, key=str) == sorted(want, key=str)
    assert sorted(variants, key=str) == sorted(want_variants, key=str)
    assert len(calls) == 3
    monkeypatch.setattr(ld, "_AT_ONCE", 100)
    assert sorted(((False, *r.values()) for out in ld._scan(6, False)(iter([batch])) for r in out.to_pylist()), key=str) == sorted((r for r in want if not r[0]), key=str)
