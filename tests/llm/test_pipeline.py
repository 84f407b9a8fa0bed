from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline as cp
from markbook.llm.decontaminate import edits_allowed
from markbook.llm.queries import ORACLES, QUERIES

from .helpers import edit_distance, shingles, words

SF = "/root/testdata/sf0.001"
STAGE_NAMES = ["quality_classifier", "line_dedup", "ngram_jaccard", "decontamination", "source_mixing"]


def test_every_stage_against_its_own_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    assert [name for name, _ in cp.STAGES] == STAGE_NAMES
    before = {r.doc_id: r for r in docs.collect()}
    for name, stage in cp.STAGES:
        rows = stage(spark, spark.createDataFrame(list(before.values()), docs.schema), SF).collect()
        after = {r.doc_id: r for r in rows}
        assert len(rows) == len(after) and set(after) <= set(before)
        if name == "quality_classifier":
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            assert sum(labels[i] == (i in after) for i in labels) >= 0.95 * len(labels)
            assert all(after[i] == before[i] for i in after)
        if name == "line_dedup":
            for i, r in after.items():
                assert r.n_chars == len(r.text) or r == before[i]
                assert not Counter(r.text.split("\n")) - Counter(before[i].text.split("\n"))
        if name == "ngram_jaccard":
            sets = {i: shingles(r.text) for i, r in before.items()}
            links = lambda a, b: 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b]) and bool(sets[a])
            kept = sorted(after)
            assert not any(links(a, b) for a in kept for b in kept if a < b)
            assert all(any(links(i, j) for j in before if j != i) for i in set(before) - set(after))
        if name == "decontamination":
            items = [words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            for i, r in before.items():
                w = words(r.text)
                if len(w) < 700:
                    leaked = any(edit_distance(a, w, free_ends=True) <= edits_allowed(len(a)) for a in items)
                    assert leaked == (i not in after)
        if name == "source_mixing":
            assert set(after) == set(before) and len({(r.mix_slot, r.mix_offset) for r in rows}) == len(rows)
        else:
            assert list(rows[0].asDict()) == columns
        before = after


def test_run_equals_the_stages_in_turn(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, SF)
    assert sorted(map(tuple, cp.run(spark, SF).collect())) == sorted(map(tuple, docs.collect()))


def test_stages_take_odd_rows(spark):
    text = "one two three four five six seven eight"
    rows = [(1, text), (2, text), (None, text), (3, None), (4, ""), (5, "x" * 100_000), (1, text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": F.lit(None).cast("string"), "source": F.lit(None).cast("string"), "n_chars": F.length("text").cast("long")})
    columns = docs.columns
    for frame in (docs, docs.limit(0)):
        for name, stage in cp.STAGES:
            out = stage(spark, frame, SF)
            out.collect()
            assert name == "source_mixing" or out.columns == columns


def test_short_lines_stand_once(spark):
    rows = [(1, "Released under the MIT license.\nfirst text"), (2, "Released under the MIT license.\nsecond text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": F.lit(None).cast("string"), "source": F.lit(None).cast("string"), "n_chars": F.length("text").cast("long")})
    assert {r.doc_id: (r.text, r.n_chars) for r in cp.lines(spark, docs, SF).collect()} == {1: (rows[0][1], 42), 2: ("second text", 11)}


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) == {"op4_source_mixing", "op9_line_dedup", "op12_vector_codes", "op13_host_quality_rules"}
