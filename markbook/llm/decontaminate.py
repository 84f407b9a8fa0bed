"""Benchmark decontamination by pigeonhole edit matching.

A document is contaminated by a benchmark item if a run of its words is within ``k`` word edits of the item's words, ``k`` being a
share of the item's length. The item is split into ``k + 1`` pieces; ``k`` edits cannot touch all of them, so one piece stands in
the document exactly. Pieces are found by hash at every position of every text, then the item is aligned around each hit with
Myers' bit-parallel algorithm over words. Case of A-Z and white space do not matter.

The benchmark goes to the tasks in blocks of bounded size; documents are scanned once for each block and never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import hashing
from .frames import Shared

ERROR_SHARE = 0.15
MIN_WORDS = 5
# Words of benchmark items sent to the tasks at once: 8 bytes each, and about as much again for the pieces.
BLOCK_WORDS = 1 << 20
_B = np.uint64(0xD6E8FEB86659FD93)
_B_INVERSE = np.uint64(pow(int(_B), -1, 1 << 64))


def edits_allowed(words: int, share: float = ERROR_SHARE) -> int:
    return int(words * share + 1e-9)


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words."""
    if len(words) < size:
        return np.empty(0, np.uint64)
    upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * hashing.powers(_B, len(words)), dtype=np.uint64)])
    return hashing.mix((upto[size:] - upto[: len(upto) - size]) * hashing.powers(_B_INVERSE, len(words) - size + 1))


def best_match(pattern: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Fewest word edits between the pattern and any run of the text, and the end of the first such run (Myers 1999)."""
    m = len(pattern)
    at: dict[int, int] = {}
    for i, w in enumerate(pattern.tolist()):
        at[w] = at.get(w, 0) | 1 << i
    mask, high = (1 << m) - 1, 1 << (m - 1)
    up, down, score = mask, 0, m
    best, end = m, 0
    for j, w in enumerate(text.tolist()):
        eq = at.get(w, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        plus = down | (~(xh | up) & mask)
        minus = up & xh
        score += bool(plus & high) - bool(minus & high)
        plus = (plus << 1) & mask
        minus = (minus << 1) & mask
        up = minus | (~(xv | plus) & mask)
        down = plus & xv
        if score < best:
            best, end = score, j + 1
    return best, end


class Pieces:
    """Pieces of a block of items, by length: sorted hashes with the item and place of each."""

    def __init__(self, items: list[tuple[int, np.ndarray]], share: float):
        self.items, self.share = items, share
        found: dict[int, list[tuple[int, int, int]]] = {}
        for at, (_, words) in enumerate(items):
            n, pieces = len(words), edits_allowed(len(words), share) + 1
            for p in range(pieces):
                lo, hi = p * n // pieces, (p + 1) * n // pieces
                found.setdefault(hi - lo, []).append((int(run_hashes(words[lo:hi], hi - lo)[0]), at, lo))
        self.by_size = {}
        for size, rows in found.items():
            rows.sort()
            keys = np.array([r[0] for r in rows], np.uint64)
            coarse = np.zeros(1 << 16, bool)
            coarse[(keys & np.uint64(0xFFFF)).astype(np.int64)] = True
            self.by_size[size] = (keys, [r[1:] for r in rows], coarse)

    def matches(self, words: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """``item, edits, start, end`` of the best run for each item that is within its bound; start and end in words."""
        tried, best = set(), {}
        for size, (keys, places, coarse) in self.by_size.items():
            runs = run_hashes(words, size)
            maybe = np.flatnonzero(coarse[(runs & np.uint64(0xFFFF)).astype(np.int64)])
            first = np.searchsorted(keys, runs[maybe])
            last = np.searchsorted(keys, runs[maybe], side="right")
            for hit in np.flatnonzero(last > first):
                for r in range(first[hit], last[hit]):
                    item, offset = places[r]
                    origin = int(maybe[hit]) - offset
                    if (item, origin) in tried:
                        continue
                    tried.add((item, origin))
                    pattern = self.items[item][1]
                    k = edits_allowed(len(pattern), self.share)
                    lo = max(0, origin - k)
                    part = words[lo : origin + len(pattern) + k]
                    edits, end = best_match(pattern, part)
                    if edits <= k:
                        back, length = best_match(pattern[::-1], part[:end][::-1])
                        rank = (edits, lo + end - length, lo + end)
                        best[item] = min(best.get(item, rank), rank)
        for item, (edits, start, end) in best.items():
            yield self.items[item][0], edits, start, end


def _scan(pieces: Pieces) -> Callable:
    names = ["doc", "item", "edits", "start_word", "end_word"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(doc, *m) for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True) for m in pieces.matches(hashing.word_hashes(text.as_py()))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], names)

    return run


def find_benchmark(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", error_share: float = ERROR_SHARE, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, item_id, edits, start_word, end_word``: the best run for each document and item within the item's bound.

    Best is fewest edits, then the earliest. Items of fewer than ``min_words`` words, without text or without id take no part: such an item is
    found nearly everywhere, so by default it condemns no document; with ``min_words=1`` it is reported wherever it stands. A
    missing or empty document has no match. Rows that repeat an id give one row for an item, the best. A document
    without id is reported with a missing id. Other columns are ignored, whatever their names.
    """
    Shared(spark)  # sets the size of Arrow batches
    texts = docs.select(F.col(id_column).cast("long").alias("doc"), F.col(text_column).alias("text"))
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item"), "text")
    total = items.agg(F.sum(F.length("text") / 4)).first()[0] or 0
    blocks = int(total // BLOCK_WORDS) + 1
    found = []
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).distinct().orderBy("item", "text").collect()
        hashed = [(r["item"], hashing.word_hashes(r["text"])) for r in rows]
        pieces = Pieces([(i, w) for i, w in hashed if len(w) >= min_words], error_share)
        found.append(texts.mapInArrow(_scan(pieces), "doc long, item long, edits long, start_word long, end_word long"))
    matches = reduce(DataFrame.unionByName, found)
    place = F.row_number().over(Window.partitionBy("doc", "item").orderBy("edits", "start_word", "end_word"))
    return matches.withColumn("place", place).where("place = 1").select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), "edits", "start_word", "end_word")


def decontaminate(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item was found, with their columns.

    Each row is judged by its own text: rows that share an id with a contaminated one, or lack an id like it, stay if they are clean.
    """
    row = F.xxhash64(docs[id_column], docs[text_column])
    hit = find_benchmark(spark, docs.select(row.alias("row"), docs[text_column].alias("text")), benchmark, "row", **options).select(F.col("doc_id").alias("__hit")).distinct()
    return docs.join(hit, row == F.col("__hit"), "left_anti")
