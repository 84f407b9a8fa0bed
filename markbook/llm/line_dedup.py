"""Line dedup by a deletion-neighbourhood join.

Two lines are near when one word inserted, removed or replaced turns one into the other, white space and the case of A-Z aside.
Every line with one word deleted is a variant under a hashed key: lines of equal length that share the variant at the same
place differ by a replaced word; a line that equals a variant of another lacks one word of it. Groups under a key are joined to
their earliest line only, because all lines that share a variant at one place are near each other.

Only lines that share a half with a different line of about the same length can be near: lines one word apart agree before or
behind the middle. So variants are written for those lines alone; the rest costs four keys a line.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import hashing
from .frames import Shared, has_bits, key_bits

MIN_WORDS = 6
# Characters of texts that are hashed at once: many short texts cost as little as a long one, and the arrays stay in the cache.
_AT_ONCE = 1 << 17
_B = np.uint64(0xD1342543DE82EF95)
_B_INVERSE = np.uint64(pow(int(_B), -1, 1 << 64))
_N = np.uint64(0x2545F4914F6CDD1D)
_GONE, _ROW = "__line_dedup_gone", "__line_dedup_row"


class Lines:
    """Lines of a text that have at least ``min_words`` words: their numbers, first and last words, and hashes of their runs.

    A hash depends on the words of its run alone, so texts can be joined by line feeds and taken as one.
    """

    def __init__(self, text: str | None, min_words: int):
        self.words, starts, _, data = hashing.hashes_and_spans(text)
        owner = np.searchsorted(np.flatnonzero(data == 10), starts)
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else owner
        last = np.r_[first[1:], len(owner)]
        use = last - first >= min_words
        self.first, self.last = first[use], last[use]
        self.number = owner[self.first].astype(np.int32)
        n = len(self.words)
        self.upto = np.zeros(n + 1, np.uint64)
        np.cumsum(self.words * hashing.powers(_B, n)[:n], dtype=np.uint64, out=self.upto[1:])
        self.down = hashing.powers(_B_INVERSE, n + 1)
        self.line = self._run(self.first, self.last, 0)

    def _run(self, lo: np.ndarray, hi: np.ndarray, kind: int | np.ndarray) -> np.ndarray:
        sums = (self.upto[hi] - self.upto[lo]) * self.down[lo]
        return hashing.mix(sums + ((hi - lo).astype(np.uint64) + np.uint64(kind << 32)) * _N).view(np.int64)

    def halves(self) -> np.ndarray:
        """Hashes of the first and last part, a row a line: parted in the middle of the own length, and of one word less."""
        out = []
        for less in (0, 1):
            length = self.last - self.first - less
            middle = length // 2
            for kind, lo, hi in ((1, self.first, self.first + middle), (2, self.last - (length - middle), self.last)):
                part = self._run(lo, hi, kind).view(np.uint64)
                out.append(hashing.mix(part + length.astype(np.uint64) * hashing._SHINGLE[3]).view(np.int64))
        return np.stack(out, 1)

    def variants(self, i: int) -> np.ndarray:
        """Hash of line ``i`` and of the line without each of its words."""
        whole, without, _ = self.variants_of(np.array([i]))
        return np.r_[whole, without]

    def variants_of(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of the lines ``at``; of each line without each of its words, one line after the other; and the lines' words likewise."""
        sizes = (self.last - self.first)[at]
        ends = np.cumsum(sizes)
        place = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)
        words = self.words[np.repeat(self.first[at], sizes) + place]
        terms = words * hashing.powers(_B, int(sizes.max()))[place]
        upto = np.cumsum(terms, dtype=np.uint64)
        upto -= np.repeat((upto - terms)[ends - sizes], sizes)
        whole, sizes_n = upto[ends - 1], sizes.astype(np.uint64) * _N
        without = upto - terms + (np.repeat(whole, sizes) - upto) * _B_INVERSE + np.repeat(sizes_n - _N, sizes)
        return hashing.mix(whole + sizes_n).view(np.int64), hashing.mix(without).view(np.int64), words


def _joined(texts: list[str | None]) -> Iterator[tuple[int, int, str, np.ndarray]]:
    """Runs of texts joined by line feeds: from, to, the whole, and the number that each text's first line has in it."""
    lo = size = 0
    for hi, text in enumerate(texts, 1):
        size += len(text or "")
        if size >= _AT_ONCE or hi == len(texts):
            run = [t or "" for t in texts[lo:hi]]
            yield lo, hi, "\n".join(run), np.cumsum([0, *(t.count("\n") + 1 for t in run[:-1])])
            lo, size = hi, 0


def _scan(min_words: int, short_repeats: bool) -> Callable:
    """Lines and their halves; with ``short_repeats`` also shorter lines that have a word, without halves."""
    names = ["doc", "row", "line_no", "line", "halves"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, rows, parts = batch.column("doc").to_numpy(), batch.column("row").to_numpy(), []
            for lo, hi, text, starts in _joined(batch.column("text").to_pylist()):
                lines = Lines(text, 1 if short_repeats else min_words)
                if len(lines.line):
                    own = np.searchsorted(starts, lines.number, "right") - 1
                    long = lines.last - lines.first >= min_words
                    number = (lines.number - starts[own]).astype(np.int32)
                    parts.append((docs[lo:hi][own], rows[lo:hi][own], number, lines.line, long, lines.halves()[long]))
            if parts:
                doc, row, number, line, long, halves = (np.concatenate(x) for x in zip(*parts, strict=True))
                each = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(4 * long)].astype(np.int32)), pa.array(halves.ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(row), pa.array(number), pa.array(line), each], names)

    return run


def _variants(min_words: int, rows: np.ndarray, lines_wanted: np.ndarray) -> Callable:
    """``line, key, place, words``: each line that may be wanted, whole (place -1, with its words) and without its i-th word."""
    names = ["line", "key", "place", "words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").filter(pa.array(has_bits(rows, batch.column("row").to_numpy()))).to_pylist()
            for _, _, text, _ in _joined(texts):
                lines = Lines(text, min_words)
                at = np.flatnonzero(has_bits(lines_wanted, lines.line))
                if not len(at):
                    continue
                whole, without, words = lines.variants_of(at)
                sizes = (lines.last - lines.first)[at]
                ends = np.cumsum(sizes)
                line = lines.line[at]
                place = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)
                held = pa.array([words[e - n : e].tobytes() for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)], pa.binary())
                columns = [np.r_[line, np.repeat(line, sizes)], np.r_[whole, without], np.r_[np.full(len(at), -1), place].astype(np.int32)]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.concat_arrays([held, pa.nulls(len(without), pa.binary())])], names)

    return run


def one_word_apart(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the edit distance of two lines, given as hashes of their words, is at most one."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    wrong = np.flatnonzero(a != b[: len(a)])
    at = int(wrong[0]) if len(wrong) else len(a)
    return bool(np.array_equal(a[at + (len(a) == len(b)) :], b[at + 1 :]))


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        near = [one_word_apart(*(np.frombuffer(x.as_buffer(), np.uint64) for x in pair)) for pair in zip(batch.column("a"), batch.column("b"), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("line")], ["line"]).filter(pa.array(near, pa.bool_()))


def line_dedup(spark: SparkSession, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_words: int = MIN_WORDS, short_repeats: bool = False) -> DataFrame:
    """All rows and columns of ``docs``, the text without its repeated lines, and ``n_lines, n_dropped`` (long).

    A line is what stands between line feeds. A line of at least ``min_words`` words goes if an equal or near line stands
    earlier, by id (missing ids last) and place in the text; whether that one stays does not matter. With ``short_repeats``, a
    shorter line that has a word goes if an equal one stands earlier. Other lines stay as they are, in their order. A missing text stays missing, with 0 lines; an empty one has one, empty line. Rows with
    equal id and text count as one document and get the same result; rows with equal id and other texts are ordered by
    a hash of the text. Columns of ``docs`` named ``n_lines`` or ``n_dropped`` are replaced; others may have any name.
    """
    shared = Shared(spark)
    source = docs.select(F.coalesce(F.col(id_column).cast("long"), F.lit((1 << 63) - 1)).alias("doc"), F.xxhash64(F.col(id_column), F.col(text_column)).alias("row"), F.col(text_column).alias("text"))
    at = F.struct("doc", "row", "line_no")
    table = shared.cut(source.mapInArrow(_scan(min_words, short_repeats), "doc long, row long, line_no int, line long, halves array<long>"), "lines")
    places = table.select("doc", "row", "line_no", "line")
    firsts = shared.cut(places.groupBy("line").agg(F.min(at).alias("at"), F.count(F.lit(1)).alias("n")), "firsts")
    earliest = firsts.select("line", "at.*")

    # lines that share a half with another
    halves = table.select("line", F.explode("halves").alias("half"))
    own = Window.partitionBy("half")
    alike = halves.withColumns({"lo": F.min("line").over(own), "hi": F.max("line").over(own)}).where("lo < hi").select("line").distinct()
    alike = shared.cut(earliest.join(alike, "line", "left_semi"), "alike")
    # Variants of those lines. Bit maps of fixed size stand for them and their texts; a line taken by mistake has no neighbour.
    made = source.select("row", "text").mapInArrow(_variants(min_words, key_bits(alike, "row"), key_bits(alike, "line")), "line long, key long, place int, words binary")
    made = shared.cut(made, "variants")
    variants = made.select("line", "key", "place")
    met = variants.groupBy("key").agg(F.min("line").alias("lo"), F.max("line").alias("hi")).where("lo < hi").select("key")
    few = variants.join(met, "key", "left_semi").distinct().join(earliest, "line").select("key", "place", F.struct("doc", "row", "line_no", "line").alias("own"))
    few = shared.cut(few, "met")
    groups = few.groupBy("key", "place").agg(F.min("own").alias("hub"), F.count(F.lit(1)).alias("n"))
    whole = groups.where("place < 0").select("key", F.col("hub").alias("whole"))
    replaced = few.join(groups.where("place >= 0 and n > 1"), ["key", "place"]).select("own", "hub")
    longer = few.where("place >= 0").join(whole, "key").select("own", F.col("whole").alias("hub"))
    shorter = groups.where("place >= 0").join(whole, "key").select(F.col("whole").alias("own"), "hub")
    pairs = replaced.unionByName(longer).unionByName(shorter).where("hub < own").select(F.col("own.line").alias("line"), F.col("hub.line").alias("hub"))
    pairs = shared.cut(pairs.distinct(), "pairs")
    named = pairs.select(F.explode(F.array("line", "hub")).alias("line")).distinct()
    words = made.where("place < 0").select("line", "words").join(named, "line", "left_semi").dropDuplicates(["line"])
    both = pairs.join(words.withColumnRenamed("words", "a"), "line").join(words.select(F.col("line").alias("hub"), F.col("words").alias("b")), "hub")
    near = both.select("line", "a", "b").mapInArrow(_verify, "line long").distinct()

    # an occurrence goes if its line has an earlier neighbour, or if it is not the first of its line
    fate = firsts.join(near.withColumn("near", F.lit(True)), "line", "left").where("near or n > 1")
    gone = places.join(fate.select("line", F.col("at").alias("first"), "near"), "line").where(F.coalesce("near", F.lit(False)) | (at > F.col("first")))
    gone = shared.cut(gone.groupBy("row").agg(F.collect_set("line_no").alias(_GONE)), "gone")  # at most the lines of one text
    parts = F.split(F.col(text_column), "\n")
    every = F.when(F.size(parts) > 0, F.sequence(F.lit(0), F.size(parts) - 1))
    kept = F.array_join(F.transform(F.array_except(every, F.col(_GONE)), lambda i: F.get(parts, i)), "\n")
    out = docs.drop("n_lines", "n_dropped").withColumn(_ROW, F.xxhash64(F.col(id_column), F.col(text_column)))
    out = out.join(gone.withColumnRenamed("row", _ROW), _ROW, "left").withColumns(
        {
            "n_lines": F.greatest(F.size(parts), F.lit(0)).cast("long"),
            "n_dropped": F.greatest(F.size(_GONE), F.lit(0)).cast("long"),
            text_column: F.when(F.col(_GONE).isNull(), F.col(text_column)).otherwise(kept),
        }
    )
    return out.select(*docs.drop("n_lines", "n_dropped").columns, "n_lines", "n_dropped")
