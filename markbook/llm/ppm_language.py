"""Language identification by prediction by partial matching.

Each language has a variable-order context tree of bytes: how often each byte followed each context of up to ``ORDER`` bytes in training
text. A byte unseen in its longest known context costs an escape (distinct followers over total plus distinct) and is looked for
in the next shorter one; below order 0 all bytes are alike. The trees are frozen, and a document's language is the one
whose tree gives it the shortest code. All trees share one table: for every known run of bytes, its log probability in each
language with all escapes worked in, and for every known context the log of its escape.

Training takes whole texts in hash order up to ``MAX_BYTES`` a language, so the trees are bounded whatever the input.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import hashing
from .frames import Shared, crc_mod

ORDER = 4
MAX_BYTES = 2_000_000
# Parts of the hash range whose texts are added up before any text is picked.
RANGES = 1 << 12
_CHUNK = 400_000
_OTHER = re.compile(r"[\W\d_]+")
_PAD = b" " * ORDER


def normal(text: str) -> bytes:
    """Letters in lower case, everything else one space; padded so that the first byte has a full context."""
    return _PAD + _OTHER.sub(" ", text.lower()).strip().encode("utf-8", "replace") + b" "


def runs(data: np.ndarray, size: int) -> np.ndarray:
    """Each run of ``size`` bytes as a number; the length is part of it."""
    out = np.full(max(0, len(data) - size + 1), size, np.uint64)
    for j in range(size):
        out = (out << np.uint64(8)) | data[j : len(data) - size + 1 + j].astype(np.uint64)
    return out


def shorter(keys: np.ndarray, size: int) -> np.ndarray:
    """The runs without their first byte."""
    return (keys & np.uint64((1 << 8 * (size - 1)) - 1)) | np.uint64((size - 1) << 8 * (size - 1))


def context(keys: np.ndarray, size: int) -> np.ndarray:
    """The runs without their last byte."""
    return ((keys & np.uint64((1 << 8 * size) - 1)) >> np.uint64(8)) | np.uint64((size - 1) << 8 * (size - 1))


class Table:
    """Rows of an array by 64-bit key, found by open addressing; -1 for a key that is not there."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(max(len(keys), 1)))) + 2)
        size = 1 << self.bits
        self.slots, self.rows = np.zeros(size, np.uint64), np.full(size, -1, np.int32)
        todo, place = np.arange(len(keys)), self._place(keys)
        while len(todo):
            free = self.rows[place] < 0
            at, first = np.unique(place[free], return_index=True)
            won = todo[free][first]
            self.slots[at], self.rows[at] = keys[won], won
            left = np.ones(len(todo), bool)
            left[np.flatnonzero(free)[first]] = False
            todo, place = todo[left], (place[left] + 1) & (size - 1)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (hashing.mix(keys) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        place = self._place(keys)
        out = self.rows[place]
        wrong = np.flatnonzero((out >= 0) & (self.slots[place] != keys))
        while len(wrong):
            place[wrong] = (place[wrong] + 1) & (len(self.slots) - 1)
            out[wrong] = self.rows[place[wrong]]
            wrong = wrong[(out[wrong] >= 0) & (self.slots[place[wrong]] != keys[wrong])]
        return out


@dataclass
class Trees:
    """Frozen trees of all languages: log2 probabilities of known runs and escapes of known contexts, a column a language."""

    langs: list[str]
    known: list[Table]
    logs: list[np.ndarray]
    contexts: list[Table]
    escapes: list[np.ndarray]

    @classmethod
    def freeze(cls, langs: list[str], lang: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> Trees:
        """From counts of runs of 1 to ``ORDER + 1`` bytes; ``lang`` is the place in ``langs``."""
        known, logs, contexts, escapes = [], [], [], []
        sizes = (np.floor(np.log2(np.maximum(keys.astype(float), 1))) // 8).astype(int)
        for size in range(1, ORDER + 2):
            own = sizes == size
            every, row = np.unique(keys[own], return_inverse=True)
            c = np.zeros((len(every), len(langs)))
            c[row, lang[own]] = counts[own]
            heads, head = np.unique(context(every, size), return_inverse=True)
            total, distinct = np.zeros((len(heads), len(langs))), np.zeros((len(heads), len(langs)))
            np.add.at(total, head, c)
            np.add.at(distinct, head, c > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, np.log2(distinct / (total + distinct)), 0.0)
                direct = np.log2(c / (total + distinct)[head])
            below = logs[-1][known[-1].find(shorter(every, size))] if size > 1 else np.full((len(every), len(langs)), -8.0)
            known.append(Table(every))
            logs.append(np.where(c > 0, direct, escape[head] + below).astype(np.float32))
            contexts.append(Table(heads))
            escapes.append(escape.astype(np.float32))
        return cls(langs, known, logs, contexts, escapes)

    def log_probs(self, data: np.ndarray) -> np.ndarray:
        """log2 probability of each byte after the first ``ORDER``, a row a byte and a column a language."""
        n = max(0, len(data) - ORDER)
        out = np.zeros((n, len(self.langs)), np.float32)
        todo, keys = np.arange(n), runs(data, ORDER + 1)
        for size in range(ORDER + 1, 0, -1):
            row = self.known[size - 1].find(keys)
            hit = row >= 0
            out[todo[hit]] += self.logs[size - 1][row[hit]]
            todo, keys = todo[~hit], keys[~hit]
            if not len(todo):
                return out
            head = self.contexts[size - 1].find(context(keys, size))
            there = head >= 0
            out[todo[there]] += self.escapes[size - 1][head[there]]
            keys = shorter(keys, size)
        out[todo] -= 8.0
        return out

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits for each whole normalized text, a column a language."""
        data = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.array([len(t) for t in texts])
        owner = np.repeat(np.arange(len(texts)), sizes)
        place = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out = np.zeros((len(texts), len(self.langs)))
        for lo in range(0, max(0, len(data) - ORDER), _CHUNK):
            part = slice(lo, lo + _CHUNK + ORDER)
            own = slice(lo + ORDER, lo + _CHUNK + ORDER)
            logs = self.log_probs(data[part])
            logs[place[own] < ORDER] = 0  # padding
            for j in range(len(self.langs)):
                out[:, j] -= np.bincount(owner[own], logs[:, j], len(texts))
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The likeliest language of each text and its posterior probability, all languages alike before; ``und`` without a letter."""
        found, scores = ["und"] * len(texts), [0.0] * len(texts)
        own = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
        if own and self.langs:
            bits = self.code_lengths([normal(texts[i]) for i in own])
            best = bits.argmin(1)
            share = 1 / np.exp2(np.maximum(bits.min(1, keepdims=True) - bits, -1000)).sum(1)
            for i, b, s in zip(own, best, share, strict=True):
                found[i], scores[i] = self.langs[b], float(s)
        return found, scores


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            data = np.frombuffer(normal(text), np.uint8)
            for size in range(1, ORDER + 2):
                keys, n = np.unique(runs(data[ORDER + 1 - size :], size), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n)], ["lang", "run", "n"])


def train(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", folds: tuple[int, int] = (4, 2), max_bytes: int = MAX_BYTES) -> Trees:
    """Trees from texts outside the held-out fold: whole texts in hash order, up to ``max_bytes`` characters a language."""
    rows = docs.where(F.col(lang_column).isNotNull() & F.col(text_column).isNotNull() & (crc_mod(id_column, folds[0]) != folds[1]))
    rows = rows.select(F.col(lang_column).alias("lang"), F.xxhash64(id_column).alias("h"), F.col(id_column).cast("long").alias("doc"), F.length(text_column).cast("long").alias("size"))
    # which texts: only ids and sizes move. Sizes of hash ranges are added up first; texts are added up one by one inside a range
    rows = rows.where(F.col("size").between(1, max_bytes)).withColumn("part", F.pmod("h", F.lit(RANGES)))
    upto = F.sum("part_size").over(Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, 0))
    parts = rows.groupBy("lang", "part").agg(F.sum("size").alias("part_size")).withColumn("part_upto", upto)
    # at most RANGES rows a language
    inner = F.sum("size").over(Window.partitionBy("lang", "part").orderBy("h", "doc").rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.join(parts, ["lang", "part"]).withColumn("upto", F.col("part_upto") - F.col("part_size") + inner)
    picked = rows.where(F.col("upto") <= max_bytes).select("lang", "doc").distinct()
    texts = docs.select(F.col(id_column).cast("long").alias("doc"), F.col(lang_column).alias("lang"), F.col(text_column).alias("text"))
    # at most max_bytes ids a language, far fewer with texts of any length
    sample = texts.where("text is not null").join(picked, ["doc", "lang"], "left_semi").select("lang", "text")
    counts = sample.mapInArrow(_count, "lang string, run long, n long").groupBy("lang", "run").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(counts["lang"].to_pylist()))
    number = {v: i for i, v in enumerate(langs)}
    lang = np.array([number[v] for v in counts["lang"].to_pylist()], np.int64)
    return Trees.freeze(langs, lang, counts["run"].to_numpy().view(np.uint64), counts["n"].to_numpy())


def identify_language(spark: SparkSession, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang", **options) -> DataFrame:
    """All rows and columns of ``docs`` with ``lang_pred`` and ``score`` (0 to 1), from the text alone.

    A text that is missing or has no letter is ``und`` with score 0; so is every text where nothing could be learned. Ties go to the
    language first by name. Texts without a language, empty ones, and those longer than the training bound, are not learned from; every language
    that has another is learned. Columns
    of ``docs`` named ``lang_pred`` or ``score`` are replaced.
    """
    Shared(spark)  # sets the size of Arrow batches
    trees = train(docs, id_column, text_column, lang_column, **options)

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def predict(text: pa.Array) -> pa.Array:
        found, scores = trees.predict(text.to_pylist())
        return pa.StructArray.from_arrays([pa.array(found, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    found = "__lang_found"
    out = docs.drop("lang_pred", "score").withColumn(found, predict(F.col(text_column)))
    return out.withColumns({"lang_pred": F.col(found)["lang_pred"], "score": F.col(found)["score"]}).drop(found)
