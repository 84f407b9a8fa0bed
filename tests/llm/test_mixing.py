from collections import Counter, defaultdict

import duckdb
from pyspark.sql import functions as F

from markbook.llm import mixing
from markbook.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    found = con.execute(ORACLES["op4_source_mixing"])
    names = [d[0] for d in found.description]
    want = sorted(found.fetchall())
    assert sorted(tuple(r) for r in QUERIES["op4_source_mixing"](spark, SF).select(*names).collect()) == want


def test_no_python_in_the_plan(spark):
    plan = QUERIES["op4_source_mixing"](spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_every_source_keeps_within_one_block_of_its_share(spark):
    sizes = {"a": 700, "b": 90, "c": 41, "d": 7, "e": 400}
    rows = [(i, s) for s, n in sizes.items() for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    weights = spark.createDataFrame([("a", 5.0), ("b", 1.0), ("c", 1.5), ("d", 0.25), ("e", 2.25)], "source string, weight double")
    out = mixing.mix_sources(spark, docs, weights=weights, block_rows=1, period=100).collect()
    assert len(out) == len(rows)
    units = {r["source"]: r["units"] for r in mixing.source_units(docs.groupBy("source").agg(F.count("*").alias("n")), weights, 100).collect()}
    assert sum(units.values()) == 100 and units["a"] > units["e"] > units["c"] > units["d"] > 0
    assert all(r.mix_release <= r.mix_slot < r.mix_deadline for r in out)
    # one block a slot, and fewer than one block from the share as long as no source has ended
    slots = {r.mix_slot: r.source for r in out}
    assert len(slots) == len(rows)
    end = min(max(r.mix_slot for r in out if r.source == s) for s in sizes)
    done = Counter()
    for slot in range(end):
        done[slots[slot]] += 1
        assert all(abs(done[s] - (slot + 1) * units[s] / 100) < 1 for s in sizes)


def test_numbers_have_no_gaps_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 16)
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "hot").otherwise("cold").alias("source"))
    places = defaultdict(list)
    for r in mixing.mix_sources(spark, docs, block_rows=8).collect():
        places[r.source].append(r.mix_block * 8 + r.mix_offset)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_odd_rows(spark):
    """Missing ids and sources, repeated rows, clashing names, an empty table, weights of nothing."""
    rows = [(1, None), (None, "a"), (None, "a"), (2, "a"), (2, "a"), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, source string").withColumns({c: F.lit(5) for c in ("n", "units", "mix_slot", "slot", "total")})
    out = mixing.mix_sources(spark, docs)
    assert sorted(out.columns) == sorted({*docs.columns, "mix_block", "mix_offset", "mix_release", "mix_deadline"})
    found = out.collect()
    assert Counter((r.doc_id, r.source) for r in found) == Counter(rows)
    assert sorted(r.mix_offset for r in found if r.source == "a") == [0, 1, 2, 3]
    assert mixing.mix_sources(spark, docs.limit(0)).count() == 0
    none = spark.createDataFrame([("x", 1.0)], "source string, weight double")
    assert mixing.mix_sources(spark, docs, weights=none).count() == len(rows)
