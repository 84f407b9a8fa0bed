import numpy as np
from pyspark.sql import functions as F

from markbook.llm import vector_search as vs
from markbook.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def brute(ids, x, queries, k=vs.K):
    out = {}
    for q in queries:
        s = (x * x[q]).sum(1)
        s[ids == ids[q]] = -np.inf
        out[int(ids[q])] = [int(ids[i]) for i in np.lexsort((ids, -s))[:k]]
    return out


def by_query(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append(r.vec_id)
    return out


def recall(found, want):
    return np.mean([len(set(found[q]) & set(w)) / len(w) for q, w in want.items()])


def test_query_recall_and_scores(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    out = QUERIES["op3_vector_search"](spark, SF).collect()
    place = {i: n for n, i in enumerate(ids.tolist())}
    assert all(abs(r.score - (x[place[r.query_id]] * x[place[r.vec_id]]).sum()) < 1e-12 for r in out)
    found, want = by_query(out), brute(ids, x, np.flatnonzero(ids % 20 == 0))
    assert set(found) == set(want) and all(len(set(v)) == vs.K for v in found.values())
    assert recall(found, want) >= 0.9


def test_parts_and_blocks_on_clustered_vectors(spark, monkeypatch):
    """Many parts, of which few are searched; small blocks; a third of all vectors equal."""
    monkeypatch.setattr(vs, "PART_ROWS", 100)
    monkeypatch.setattr(vs, "VECTOR_BLOCK", 90)
    monkeypatch.setattr(vs, "QUERY_BLOCK", 20)
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(30, 16))
    x = centres[rng.integers(0, 30, 1500)] + 0.3 * rng.normal(size=(1500, 16))
    x[::3] = x[0]
    router = vs.fit_router(np.unique(x, axis=0), 1500)
    assert router.b2.size >= 8 and router.probes <= router.b2.size // 2
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(6)
    found = by_query(vs.nearest_neighbours(spark, frame, F.col("vec_id") % 20 == 0).collect())
    want = brute(np.arange(1500), x, range(0, 1500, 20))
    assert recall(found, want) >= 0.9
    assert all(found[q] == want[q] for q in range(0, 1500, 60))  # ties among equal vectors go to the smaller ids


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.5]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, None]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (20, [2.0, 0.0]), (40, None)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("part", "vec", "query", "q", "score")})
    out = vs.nearest_neighbours(spark, frame, F.col("vec_id") % 20 == 0).collect()
    found = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in out)
    assert found == [(0, 1, 20, 2.0), (0, 2, 1, 1.0), (0, 3, 2, 0.5), (20, 1, 0, 2.0), (20, 2, 1, 2.0), (20, 3, 2, 1.0)]
    assert vs.nearest_neighbours(spark, frame.limit(0), F.col("vec_id") % 20 == 0).collect() == []


def test_parts_are_balanced():
    x = np.random.default_rng(1).normal(size=(500, 8))
    sizes = np.bincount(vs.balanced_parts(vs.neighbour_graph(x, 10), 500, 8))
    assert len(sizes) == 8 and sizes.max() - sizes.min() <= 2
