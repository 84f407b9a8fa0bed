"""Helpers for frames: cut lineage in the shared folder, small key filters, connected components."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_own: str | None = None

# Rows in one Arrow batch: documents can be long, so fewer than Spark's 10,000.
BATCH_ROWS = 1000
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; a folder of this process only where that is unset in local mode."""
    global _own
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        if _own is None:
            _own = tempfile.mkdtemp(prefix="markbook-llm-")
            atexit.register(shutil.rmtree, _own, ignore_errors=True)
        base = _own
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


class Shared:
    """Written tables of one operator. ``cut`` writes a frame and reads it again; ``drop`` removes those no longer read."""

    def __init__(self, spark: SparkSession):
        self.spark, self.base, self._paths = spark, shared_dir(spark), {}
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))

    def cut(self, df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
        path = f"{self.base}/{name}-{uuid.uuid4().hex[:8]}"
        # the written table stands in for the shuffles that made it, so their files can go
        before = self.spark.conf.get(_CLEANUP, "false")
        self.spark.conf.set(_CLEANUP, "true")
        try:
            df.write.parquet(path, compression=compression)
        finally:
            self.spark.conf.set(_CLEANUP, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = (path, out)
        return out

    def drop(self, *frames: DataFrame) -> None:
        jvm = self.spark.sparkContext._jvm
        for frame in frames:
            path, _ = self._paths.pop(id(frame))
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def per_batch(df: DataFrame, make: Callable, schema: str) -> DataFrame:
    """``make(batch) -> dict of columns`` for each Arrow batch, typed by ``schema``."""
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    fields = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = make(batch)
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in fields], schema=fields)

    return df.mapInArrow(run, schema)


def key_bits(keys: DataFrame, column: str, words: int = 1 << 16) -> np.ndarray:
    """A bit map of uniformly hashed 64-bit keys: ``64 * words`` bits, whatever the number of keys.

    Made by Spark; the driver gets one row for each of at most ``words`` positions (1 MB). A key whose bit is unset is not
    among ``keys``; a set bit says nothing, so an exact join must follow.
    """
    rows = (
        keys.selectExpr(f"pmod({column}, {words}L) as at", f"shiftleft(1L, int(pmod(shiftright({column}, 40), 64L))) as bit")
        .groupBy("at")
        .agg(F.bit_or("bit").alias("bits"))
        .collect()
    )
    out = np.zeros(words, np.int64)
    for r in rows:
        out[r["at"]] = r["bits"]
    return out


def has_bit(bits: np.ndarray, key: int) -> bool:
    return bool((int(bits[key % len(bits)]) >> ((key >> 40) % 64)) & 1)


def has_bits(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """``has_bit`` of each of many keys."""
    return ((bits[keys % len(bits)] >> ((keys >> 40) % 64)) & 1).astype(bool)


def components(edges: DataFrame, shared: Shared) -> DataFrame:
    """``(u, v)`` edges of an undirected graph to ``(node, root)``: the smallest node of each connected component.

    Alternates the two star steps of the map-reduce method: every node's larger, then its smaller neighbours move to the
    least neighbour, until nothing moves. A row an edge; the minimum for each node is combined before the shuffle.
    """
    edges = shared.cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.*")
            .where("u <> v")
            .distinct()
        )
        done = shared.cut(small, "edges")
        shared.drop(edges)
        edges = done
        # stars: every node hangs on one other, and none on a node that itself hangs on one
        inner = edges.select(F.col("u").alias("w")).distinct()
        torn = edges.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("v")).join(inner, F.col("v") == F.col("w"), "left")
        if torn.where("n > 1 or w is not null").isEmpty():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def crc_mod(column: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; missing for a missing id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(n)
