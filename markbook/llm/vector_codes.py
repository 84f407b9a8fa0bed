"""Vector code compression: product codes of integer vectors by Lloyd rounds over cover trees.

Each vector is cut into equal parts, and each part position has a codebook. A block of vectors holds one cover tree a part: a node has
a centre, a radius that bounds its points' distance from it, and a run of the block's points in tree order, so that a
difference of cumulative sums gives the sum of its points. The children of a node are a net of its points at half the radius. In
a round a node goes to the nearest entry as a whole where the second nearest is farther by more than twice the radius (triangle
inequality); only an ambiguous node hands on to its children, and the points of an ambiguous leaf are compared one by one.
Trees are built once, inside the tasks, and written to the shared folder. Each round reads them and brings sums and counts by entry to
the driver, at most ``entries x parts`` rows whatever the data. All arithmetic that decides is over integers.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from .frames import Shared

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
# Vectors whose trees stand in one row.
BLOCK = 2048
# A node of so few points is a leaf.
LEAF = 16


# --- cover trees --------------------------------------------------------------------------------


def cover_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the points, nodes ``start, end, parent, depth`` and their radii; a node's centre is its first point.

    A node whose points lie so far apart that a net at half the radius would have a child for every fourth of them is a leaf.
    """
    x = points.astype(np.float64)
    order: list[np.ndarray] = []
    nodes: list[tuple[int, int, int, int]] = []
    radii: list[float] = []
    done = 0
    stack = [(np.arange(len(x)), -1, 0)]
    while stack:
        rows, parent, depth = stack.pop()
        away = x[rows] - x[rows[0]]
        far = np.sqrt(np.einsum("ij,ij->i", away, away))
        radius, me = float(far.max()), len(nodes)
        nodes.append((done, done + len(rows), parent, depth))
        radii.append(radius)
        children = _net(x, rows, far, radius / 2) if radius > 0 and len(rows) > LEAF else None
        if children is None:
            order.append(rows)
            done += len(rows)
        else:
            stack += [(c, me, depth + 1) for c in reversed(children)]
    return np.concatenate(order).astype(np.int32), np.array(nodes, np.int32), np.array(radii)


def _net(x: np.ndarray, rows: np.ndarray, far: np.ndarray, radius: float) -> list[np.ndarray] | None:
    """Rows dealt to centres more than ``radius`` apart, each within ``radius`` of its own; None for too many centres."""
    out, most = [], max(2, len(rows) // 4)
    while len(rows):
        near = far <= radius
        out.append(rows[near])
        rows = rows[~near]
        if len(out) > most:
            return None
        if len(rows):
            away = x[rows] - x[rows[0]]
            far = np.sqrt(np.einsum("ij,ij->i", away, away))
    return out


def squared(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distance of each point to each entry, exact: products of floats where all values stay below 2^53, else integers."""
    top = 4 * max(1, points.shape[1]) * max(_top(points), _top(book), 1) ** 2
    kind = np.float64 if top < 1 << 53 else np.int64
    p, b = points.astype(kind), book.astype(kind)
    return (p * p).sum(1)[:, None] - 2 * (p @ b.T) + (b * b).sum(1)[None, :]


def _top(x: np.ndarray) -> int:
    return int(np.abs(x).max()) if x.size else 0


def assign(points: np.ndarray, nodes: np.ndarray, radii: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Entry of each point in tree order, sums and counts by entry, and how many points were compared themselves.

    ``points`` stand in tree order. Ties go to the lower index: a node goes as a whole only where no other entry can be as near.
    """
    n, k = len(points), len(book)
    labels = np.empty(n, np.int64)
    upto = np.zeros((n + 1, points.shape[1]), np.int64)
    np.cumsum(points, axis=0, dtype=np.int64, out=upto[1:])
    sums, counts = np.zeros((k, points.shape[1]), np.int64), np.zeros(k, np.int64)
    start, end, parent, depth = nodes.T
    inner = np.zeros(len(nodes), bool)
    inner[parent[parent >= 0]] = True
    ambiguous = np.zeros(len(nodes), bool)
    single = np.zeros(n + 1, np.int64)
    for level in range(int(depth.max()) + 1):
        here = np.flatnonzero((depth == level) & ((parent < 0) | ambiguous[parent]))
        if not len(here):
            break
        far = squared(points[start[here]], book)
        first = far.argmin(1)
        root = np.sqrt(far.astype(np.float64))
        least = root[np.arange(len(here)), first]
        root[np.arange(len(here)), first] = np.inf
        # the margin covers the rounding of roots and radii
        margin = 1e-6 * (1 + least + radii[here])
        whole = (root.min(1) - least > 2 * radii[here] + margin) | (radii[here] == 0)
        at, to = here[whole], first[whole]
        np.add.at(sums, to, upto[end[at]] - upto[start[at]])
        np.add.at(counts, to, (end[at] - start[at]).astype(np.int64))
        size = end[at] - start[at]
        run = np.repeat(start[at] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum()) if len(at) else np.empty(0, np.int64)
        labels[run] = np.repeat(to, size)
        ambiguous[here[~whole]] = True
        leaf = here[~whole & ~inner[here]]
        np.add.at(single, start[leaf], 1)
        np.add.at(single, end[leaf], -1)
    alone = np.flatnonzero(np.cumsum(single[:-1]) > 0)
    if len(alone):
        found = squared(points[alone], book).argmin(1)
        labels[alone] = found
        np.add.at(sums, found, points[alone].astype(np.int64))
        counts += np.bincount(found, minlength=k)
    return labels, sums, counts, len(alone)


# --- blocks -------------------------------------------------------------------------------------


def _pack(values: np.ndarray, parts: int) -> dict:
    """Points and trees of a block as bytes; integers of four bytes where they fit."""
    kind = np.int32 if _top(values) < 1 << 31 else np.int64
    width = values.shape[1] // parts
    trees = [cover_tree(values[:, p * width : (p + 1) * width]) for p in range(parts)]
    return {
        "width": width,
        "item": np.dtype(kind).itemsize,
        "points": values.astype(kind).tobytes(),
        "orders": b"".join(t[0].tobytes() for t in trees),
        "nodes": b"".join(t[1].tobytes() for t in trees),
        "radii": b"".join(t[2].tobytes() for t in trees),
        "sizes": [len(t[2]) for t in trees],
    }


def _unpack(row: dict, n: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each part: order, points in that order, nodes, radii."""
    parts, width = len(row["sizes"]), row["width"]
    points = np.frombuffer(row["points"], np.int32 if row["item"] == 4 else np.int64).reshape(n, parts * width)
    orders = np.frombuffer(row["orders"], np.int32).reshape(parts, n)
    nodes, radii, at = np.frombuffer(row["nodes"], np.int32).reshape(-1, 4), np.frombuffer(row["radii"], np.float64), 0
    for p, size in enumerate(row["sizes"]):
        yield orders[p], points[orders[p], p * width : (p + 1) * width].astype(np.int64), nodes[at : at + size], radii[at : at + size]
        at += size


def _blocks(kept: DataFrame, dim: int, parts: int) -> DataFrame:
    """A row for each block of vectors: ids, labels, points and trees."""
    width = -(-dim // parts)
    id_type, label_type = kept.schema["id"].dataType, kept.schema["label"].dataType
    schema = StructType(
        [
            StructField("ids", ArrayType(id_type)),
            StructField("labels", ArrayType(label_type)),
            StructField("width", IntegerType()),
            StructField("item", IntegerType()),
            *[StructField(c, BinaryType()) for c in ("points", "orders", "nodes", "radii")],
            StructField("sizes", ArrayType(IntegerType())),
        ]
    )
    fields = to_arrow_schema(schema)

    def block(table: pa.Table) -> pa.RecordBatch:
        n = table.num_rows
        flat = table["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        values = np.zeros((n, width * parts), np.int64)
        values[:, :dim] = np.floor(flat.reshape(n, dim).astype(np.float64) * SCALE).astype(np.int64)
        row = _pack(values, parts) | {"ids": table["id"].to_pylist(), "labels": table["label"].to_pylist()}
        return pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in fields], schema=fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            while table.num_rows >= BLOCK:
                yield block(table.slice(0, BLOCK))
                table = table.slice(BLOCK)
            held = table.to_batches()
        if held and (table := pa.Table.from_batches(held)).num_rows:
            yield block(table)

    return kept.select("id", "label", "v").mapInArrow(run, schema)


def _round(blocks: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The entries after one round: floor of the mean of the parts that are nearest; an unused entry stays."""
    parts, (k, width) = len(books), books[0].shape
    columns = ["part", "entry", "n", *[f"s{i}" for i in range(width)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts, k, width), np.int64), np.zeros((parts, k), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                for p, (order, points, nodes, radii) in enumerate(_unpack(row, len(row["ids"]))):
                    _, s, c, _ = assign(points, nodes, radii, books[p])
                    sums[p] += s
                    counts[p] += c
        part, entry = np.nonzero(counts)
        if len(part):
            data = [part, entry, counts[part, entry], *sums[part, entry].T]
            yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()) for d in data], names=columns)

    used = blocks.mapInArrow(run, ", ".join(f"{c} long" for c in columns))
    # a mean lies between the components, but their sum over all data may not fit a long
    found = used.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in columns[3:]])
    out = [b.copy() for b in books]
    for row in found.collect():
        out[row["part"]][row["entry"]] = [int(row[c]) // row["n"] for c in columns[3:]]
    return out


def _encode(blocks: DataFrame, books: list[np.ndarray]) -> DataFrame:
    id_type, label_type = (blocks.schema[c].dataType.elementType for c in ("ids", "labels"))
    schema = StructType([StructField("id", id_type), StructField("label", label_type), StructField("code", StringType()), StructField("error", LongType())])
    fields = to_arrow_schema(schema)
    digits = np.frombuffer("".join(f"{i:02x}" for i in range(256)).encode(), np.uint8).reshape(256, 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = len(row["ids"])
                codes, error = np.empty((n, len(books), 2), np.uint8), np.zeros(n, np.int64)
                for p, (order, points, nodes, radii) in enumerate(_unpack(row, n)):
                    labels = assign(points, nodes, radii, books[p])[0]
                    codes[order, p] = digits[labels]
                    away = points - books[p][labels]
                    error[order] += (away * away).sum(1)
                text = codes.reshape(n, -1).tobytes().decode()
                size = 2 * len(books)
                data = [row["ids"], row["labels"], [text[i * size : (i + 1) * size] for i in range(n)], error]
                yield pa.RecordBatch.from_arrays([pa.array(d, f.type) for d, f in zip(data, fields, strict=True)], schema=fields)

    return blocks.mapInArrow(run, schema)


def encode_vectors(
    spark: SparkSession,
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, list[np.ndarray]]:
    """``id, label, code, error, label_error`` for each vector, and the codebooks, one array ``entries x width`` a part.

    ``code``: the index of each part's entry, two hex digits each. ``error``: squared distances to those entries, summed
    over the parts. ``label_error``: errors summed over equal labels; missing labels are equal.

    Rows whose vector is missing, or holds a missing or non-finite component, are left out. The entries start as the vectors of the
    smallest ids; a missing id comes last, and rows of equal ids stand in order of their vectors. Fewer rows than entries give a
    codebook of as many entries. Each row counts, also one that repeats. The vector of the smallest id sets the length: rows of another
    length cannot be cut into the same parts and are left out too. A length that the parts do not divide is filled up
    with zeros. Components so large that a squared distance does not fit 63 bits raise. An empty table gives no rows and empty codebooks.
    Other columns are not read, whatever their names.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    shared = Shared(spark)
    fine = F.coalesce(F.forall(F.col(vector_column), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))
    rows = vectors.where(fine).select(F.col(id_column).alias("id"), F.col(label_column).alias("label"), F.col(vector_column).cast("array<double>").alias("v"))
    first = rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(1).collect()
    dim = len(first[0]["v"]) if first else 0
    kept = rows.where(F.size("v") == dim)
    top = kept.agg(F.max(F.array_max(F.transform("v", F.abs)))).first()[0] or 0.0
    # no two parts are farther apart than twice the largest component in each place
    if top * SCALE + 1 >= math.sqrt((1 << 60) / max(1, dim)):
        raise ValueError(f"components up to {top} are too large for exact squared distances")
    seeds = kept.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    width = -(-dim // parts)
    start = np.zeros((len(seeds), width * parts), np.int64)
    for i, row in enumerate(seeds):
        start[i, :dim] = np.floor(np.array(row["v"], np.float64) * SCALE)
    books = [start[:, p * width : (p + 1) * width] for p in range(parts)]
    # vectors without components, or no vectors: nothing to learn
    if not width or not seeds:
        code = F.lit("00" * parts)
        out = kept.select("id", "label", code.alias("code"), F.lit(0).cast("long").alias("error"))
        return out.withColumn("label_error", F.lit(0).cast("long")), books
    blocks = shared.cut(_blocks(kept, dim, parts), "blocks")
    for _ in range(rounds):
        books = _round(blocks, books)
    coded = shared.cut(_encode(blocks, books), "codes")
    totals = shared.cut(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "totals")
    return coded.join(totals, F.col("label").eqNullSafe(F.col("of"))).drop("of"), books


def books_digest(books: list[np.ndarray]) -> str:
    """sha256 of all components in decimal, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()
