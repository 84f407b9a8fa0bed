"""Approximate nearest neighbours by learned partitions.

A nearest-neighbour graph over a bounded sample is cut into equal parts with few edges between them (recursive bisection:
spectral order, split at the median, then pairwise swaps that lower the cut). A small two-layer classifier learns the part from the vector.
Every vector is indexed under its likeliest part; a query is sent to its several most probable parts and all vectors there are
reranked by their exact inner product. How many parts is set on the sample, against brute force, for ``RECALL``.

Parts are searched in blocks of bounded size, small parts together and large ones split by hash of the id, so that a part may hold
any share of the rows; a query sees only its own parts of a block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .frames import Shared

K = 20
SAMPLE = 8192
PART_ROWS = 512
MAX_PARTS = 64
RECALL = 0.95
GRAPH_K, HIDDEN, EPOCHS, SEED = 10, 128, 40, 11
VECTOR_BLOCK, QUERY_BLOCK = 8192, 4096


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Ends of edges to each row's ``k`` nearest other rows by inner product, a row an edge, each edge both ways."""
    k = min(k, len(x) - 1)
    near = []
    for lo in range(0, len(x), 256):
        s = x[lo : lo + 256] @ x.T
        s[np.arange(len(s)), np.arange(lo, lo + len(s))] = -np.inf
        near.append(np.argpartition(-s, k - 1, axis=1)[:, :k])
    ends = np.stack([np.repeat(np.arange(len(x)), k), np.concatenate(near).ravel()], 1)
    return np.unique(np.concatenate([ends, ends[:, ::-1]]), axis=0)


def _bisect(edges: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """Two halves of a graph: sides (0 and 1) of its ``n`` nodes."""
    u, v = edges.T
    degree = np.maximum(np.bincount(u, minlength=n), 1)
    order = rng.normal(size=n)
    for _ in range(60):  # power iteration towards the slowest mode beside the constant one
        order = 0.5 * order + 0.5 * np.bincount(u, order[v], n) / degree
        order -= (order * degree).sum() / degree.sum()
        order /= max(np.linalg.norm(order), 1e-12)
    side = np.zeros(n, np.int64)
    side[np.argsort(order, kind="stable")[n // 2 :]] = 1
    for _ in range(10):
        across = np.bincount(u, side[u] != side[v], n)
        gain = 2 * across - np.bincount(u, minlength=n)
        left, right = (np.flatnonzero(side == s) for s in (0, 1))
        m = min(len(left), len(right), max(1, n // 20))
        left, right = (g[np.argsort(-gain[g], kind="stable")[:m]] for g in (left, right))
        swap = np.flatnonzero(gain[left] + gain[right] > 2)
        if not len(swap):
            break
        trial = side.copy()
        trial[left[swap]], trial[right[swap]] = 1, 0
        if (trial[u] != trial[v]).sum() >= (side[u] != side[v]).sum():
            break
        side = trial
    return side


def balanced_parts(edges: np.ndarray, n: int, parts: int) -> np.ndarray:
    """The part of each node; ``parts`` is a power of two, and sizes differ by one at most a cut."""
    rng = np.random.default_rng(SEED)
    part = np.zeros(n, np.int64)
    count = 1
    while count < parts:
        for p in range(count):
            nodes = np.flatnonzero(part == p)
            place = np.full(n, -1)
            place[nodes] = np.arange(len(nodes))
            own = place[edges]
            side = _bisect(own[(own >= 0).all(1)], len(nodes), rng)
            part[nodes] = p + side * count
        count *= 2
    return part


@dataclass
class Router:
    """Two-layer classifier of vectors to parts, and the number of parts that a query is sent to."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int = 1

    def scores(self, x: np.ndarray) -> np.ndarray:
        length = np.linalg.norm(x, axis=1, keepdims=True)
        return np.maximum(x / np.where(length, length, 1) @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def part(self, x: np.ndarray) -> np.ndarray:
        return self.scores(x).argmax(1)

    def routes(self, x: np.ndarray) -> np.ndarray:
        return np.argsort(-self.scores(x), axis=1, kind="stable")[:, : self.probes]


def fit_router(x: np.ndarray, rows: int, k: int = K, recall: float = RECALL) -> Router:
    """Learn parts from a sample of a table with ``rows`` rows."""
    n, dims = x.shape
    parts = 1
    while parts * 2 <= min(MAX_PARTS, max(1, rows // PART_ROWS), max(1, n // (4 * GRAPH_K))):
        parts *= 2
    rng = np.random.default_rng(SEED)
    if parts == 1:
        return Router(np.zeros((dims, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))
    part = balanced_parts(neighbour_graph(x, GRAPH_K), n, parts)
    router = Router(rng.normal(0, (2 / dims) ** 0.5, (dims, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, (HIDDEN, parts)), np.zeros(parts))
    params = [router.w1, router.b1, router.w2, router.b2]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-30)
    step = 0
    for _ in range(EPOCHS):
        for batch in np.array_split(rng.permutation(n), max(1, n // 256)):
            step += 1
            z = np.maximum(unit[batch] @ params[0] + params[1], 0)
            logits = z @ params[2] + params[3]
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(batch)), part[batch]] -= 1
            p /= len(batch)
            back = (p @ params[2].T) * (z > 0)
            grads = [unit[batch].T @ back, back.sum(0), z.T @ p, p.sum(0)]
            for i, g in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                params[i] -= 0.003 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    router.w1, router.b1, router.w2, router.b2 = params
    # probes: enough for the wanted recall of the sample's own neighbours, with the parts as the index will have them
    own = router.part(x)
    needed = []
    for asked in np.array_split(rng.permutation(n)[:1000], 8):
        s = x[asked] @ x.T
        s[np.arange(len(asked)), asked] = -np.inf
        near = np.argpartition(-s, min(k, n - 1) - 1, axis=1)[:, : min(k, n - 1)]
        rank = np.argsort(np.argsort(-router.scores(x[asked]), axis=1, kind="stable"), axis=1)
        needed.append(np.take_along_axis(rank, own[near], axis=1))
    needed = np.concatenate(needed)
    router.probes = next(m for m in range(1, parts + 1) if (needed < m).mean() >= recall)
    return router


def search_block(queries: np.ndarray, query_ids: np.ndarray, routes: list[np.ndarray], vectors: np.ndarray, ids: np.ndarray, part: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Each query's ``k`` nearest rows of its parts in a block, none with its own id: ids and exact inner products, nearest first, then by id."""
    for lo in range(0, len(queries), 256):
        near = queries[lo : lo + 256] @ vectors.T
        near[query_ids[lo : lo + 256, None] == ids[None, :]] = -np.inf
        for i in range(len(near)):
            near[i, ~np.isin(part, routes[lo + i])] = -np.inf
        least = np.partition(near, max(0, near.shape[1] - k), axis=1)[:, max(0, near.shape[1] - k)]
        for i, row in enumerate(near):
            # all ties take part; equal vectors must have equal scores, so they are summed again one by one
            some = np.flatnonzero((row >= least[i] - 1e-9 * max(1.0, abs(least[i]))) & (row > -np.inf))
            exact = (vectors[some] * queries[lo + i]).sum(1)
            best = np.lexsort((ids[some], -exact))[:k]
            yield int(query_ids[lo + i]), ids[some][best], exact[best]


def _search(k: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        asked = rows["query"].to_numpy(bool)
        out = []
        if asked.any() and not asked.all():
            x = np.stack(rows["vec"].to_numpy()).astype(float)
            ids = rows["vec_id"].to_numpy()
            routes = [np.asarray(r) for r in rows["routes"][asked]]
            for query, found, scores in search_block(x[asked], ids[asked], routes, x[~asked], ids[~asked], rows["part"].to_numpy()[~asked], k):
                out.append(pd.DataFrame({"query_id": query, "vec_id": found, "score": scores}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0)})

    return run


def _routed(router: Router):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack(batch.column("vec").to_numpy(zero_copy_only=False)).astype(float) if batch.num_rows else np.empty((0, 1))
            routes = router.routes(x) if len(x) else np.empty((0, 1), int)
            part = router.part(x) if len(x) else np.empty(0, int)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part, pa.int32()), pa.array(list(routes.astype(np.int32)), pa.list_(pa.int32()))], [*batch.schema.names, "part", "routes"])

    return run


def nearest_neighbours(spark: SparkSession, vectors: DataFrame, is_query, id_column: str = "vec_id", vector_column: str = "embedding", k: int = K, recall: float = RECALL) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found for each row of ``vectors`` where ``is_query`` holds.

    Nearest is the largest inner product in double precision, ties to the smaller id; a query is not its own neighbour. Fewer than
    ``k`` candidates are all returned. Rows without id, and vectors that are missing, zero, of another length than most,
    or hold missing or non-finite numbers take no part. Rows with equal id and vector count once; of one id's different vectors
    each is a candidate, and a query's answers come from all its vectors. The router is fitted on at most ``SAMPLE`` vectors in hash order;
    every vector is indexed. An empty table gives no rows.
    """
    shared = Shared(spark)
    v = F.col(vector_column)
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.transform(v, lambda x: x.cast("double")).alias("vec"), is_query.alias("query"))
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = rows.where("vec_id is not null and vec is not null").where(~F.exists("vec", odd) & F.exists("vec", lambda x: x != 0)).distinct()
    lengths = rows.groupBy(F.size("vec").alias("dims")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dims")).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if lengths is None:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("vec") == lengths["dims"])
    sample = rows.select("vec").distinct().orderBy(F.xxhash64("vec")).limit(SAMPLE).toArrow()
    router = fit_router(np.stack(sample["vec"].to_numpy()).astype(float), int(lengths["n"]), k, recall)
    placed = shared.cut(rows.mapInArrow(_routed(router), "vec_id long, vec array<double>, query boolean, part int, routes array<int>"), "placed")

    asked = placed.where("query")
    # blocks in each part, from exact counts; at most MAX_PARTS rows
    sizes = {r["part"]: r["n"] for r in placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    routed = {r["part"]: r["n"] for r in asked.select(F.explode("routes").alias("part")).groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    # small parts share a block; a large one has several
    bundle, room, blocks = -1, 0, []
    for p, n in sorted(sizes.items()):
        if n > room:
            bundle, room = bundle + 1, max(VECTOR_BLOCK - n, 0) if n <= VECTOR_BLOCK else 0
        else:
            room -= n
        blocks.append((p, bundle, n // VECTOR_BLOCK + 1))
    asked_of: dict[int, int] = {}
    for p, u, _ in blocks:
        asked_of[u] = min(asked_of.get(u, 0) + routed.get(p, 0), sum(routed.values()) // router.probes)
    blocks = spark.createDataFrame([(p, u, v, asked_of[u] // QUERY_BLOCK + 1) for p, u, v in blocks], "part int, unit int, v_blocks long, q_blocks long")
    ids = F.xxhash64("vec_id", F.lit(1))
    none = F.lit(None).cast("array<int>").alias("routes")
    index = placed.select("vec_id", "vec", "part").join(F.broadcast(blocks), "part")
    index = index.select("vec_id", "vec", F.lit(False).alias("query"), "part", none, "unit", F.pmod(ids, "v_blocks").alias("v"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("q_blocks") - 1)).alias("q"))
    asks = asked.select("vec_id", "vec", "routes", F.explode("routes").alias("part")).join(F.broadcast(blocks), "part").drop("part").distinct()
    asks = asks.select("vec_id", "vec", F.lit(True).alias("query"), F.lit(None).cast("int").alias("part"), "routes", "unit", F.explode(F.sequence(F.lit(0).cast("long"), F.col("v_blocks") - 1)).alias("v"), F.pmod(ids, "q_blocks").alias("q"))
    found = index.unionByName(asks).groupBy("unit", "v", "q").applyInPandas(_search(k), "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
