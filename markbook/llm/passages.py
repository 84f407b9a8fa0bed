"""Substring dedup by compact windows.

A text is its sequence of 5-word shingles. For each of ``HASHES`` hash functions, the Cartesian tree of the shingles' hashes gives compact
windows ``(l, c, r)``: every run that starts in ``l..c`` and ends in ``c..r`` has its minimum at ``c``. Only windows that hold a run
of the wanted length are kept, about ``2 n / length`` for each function; together they stand for all runs of a text. Runs
with a common minimum meet by an equality join on it.

Members of a group are compared with the group's first text alone; candidates need windows of two functions, and the passage is
then verified on the shingles themselves. What is in no passage after that met the wrong partner, mostly as a common line gives unlike texts
the same minima. In these texts the shingles that stand in no other of them cannot match, and a place counts only where a run of the wanted
length is mostly made of the others; runs that stand in an earlier text as they are leave the search to that text. Runs there meet again by the minima of ``WIDTH`` functions at once, over the shingles that are left, for
``TUPLES`` such sets: unlike texts seldom share them all, so each member is compared with the first of its group and the one before by one more minimum.
Nothing is compared all with all, and the work grows with the windows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import hashing
from .frames import Shared, has_bit, key_bits

SHINGLE = 5
MIN_WORDS = 50
HASHES = 4
SIMILARITY = 0.75
TUPLES, WIDTH = 8, 3
AT_ONCE = 1 << 15  # shingles of texts worked on together: few enough for the processor's cache
_SEEDS = np.array([0x9FB21C651E98DF25, 0xD6D018F5C2D0A5B1, 0xA24BAED4963EE407, 0xC3A5C85C97CB3127], np.uint64)
_TUPLE_SEEDS = hashing.mix(np.arange(1, TUPLES * (WIDTH + 1) + 1, dtype=np.uint64) * _SEEDS[0]).reshape(TUPLES, -1)
_NO_ID = (1 << 63) - 1
_PASSAGE = "row long, doc long, hub_row long, hub_doc long, start int, end int, hub_start int, hub_end int, similarity double, same boolean"


def run_minima(values: np.ndarray, length: int, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places of the leftmost minima of all runs of ``length``, or of the ``wanted`` ones, ascending, and the values ranked by value, then by place."""
    low = (np.uint64(1) << np.uint64(len(values).bit_length())) - np.uint64(1)
    ranked = (values & ~low) | np.arange(len(values), dtype=np.uint64)
    least = least_of_runs(ranked, length)
    if wanted is not None:
        least = least[wanted]
    # from run to run the minimum moves to the right
    moved = np.concatenate([[True], least[1:] != least[:-1]])
    return (least[moved] & low).astype(np.int64), ranked


def compact_windows(values: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``l, c, r`` of the windows of a Cartesian tree (leftmost minimum on top) with at least ``length`` values.

    Such a window's minimum is the minimum of some run of ``length`` values, and so are the smaller values that bound it.
    So the tree is walked over the minima of all runs alone. Values are hashes: their last bits give way to the place.
    """
    n = len(values)
    if n < length:
        return (np.empty(0, np.int64),) * 3
    c, ranked = run_minima(values, length)
    l, r, stack = np.zeros(len(c), np.int64), np.full(len(c), n - 1), []
    for i, (at, v) in enumerate(zip(c.tolist(), ranked[c].tolist(), strict=True)):
        while stack and stack[-1][1] > v:
            r[stack.pop()[2]] = at - 1
        l[i] = stack[-1][0] + 1 if stack else 0
        stack.append((at, v, i))
    return l, c, r


def _texts(batch: pa.RecordBatch, wanted: Callable[[int], bool] = lambda row: True) -> Iterator[tuple[int, int, np.ndarray]]:
    for row, doc, text in zip(batch.column("row").to_pylist(), batch.column("doc").to_pylist(), batch.column("text"), strict=True):
        if not wanted(row):
            continue
        words = hashing.word_hashes(text.as_py())
        if len(words) >= SHINGLE:
            yield row, doc, hashing.shingle_hashes(words, SHINGLE)


def _windows(length: int) -> Callable:
    names, types = ["row", "doc", "fs", "key", "c"], [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32()]

    def windows(texts: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
        sizes = np.array([len(x) for *_, x in texts])
        ends = np.cumsum(sizes)
        shingles, text, parts = np.concatenate([x for *_, x in texts]), np.repeat(np.arange(len(texts)), sizes), []
        whole = ends[text[: len(text) - length + 1]] >= np.arange(length, len(text) + 1)  # runs within a text
        for f, seed in enumerate(_SEEDS[:HASHES]):
            values = hashing.mix(shingles ^ seed)
            c, _ = run_minima(values, length, whole)
            parts.append((text[c], np.full(len(c), 1 << f), values[c].view(np.int64), c))
        of, fs, key, c = (np.concatenate(x) for x in zip(*parts, strict=True))
        row, doc = (np.array(x, np.int64)[of] for x in list(zip(*texts, strict=True))[:2])
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip((row, doc, fs, key, c - (ends - sizes)[of]), types, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n = [], 0
            for text in _texts(batch):
                if len(text[2]) >= length:
                    texts.append(text)
                    n += len(text[2])
                if n > AT_ONCE:
                    yield windows(texts)
                    texts, n = [], 0
            if texts:
                yield windows(texts)

    return run


def _shingles(bits: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(row, s.astype(np.uint32).tobytes()) for row, _, s in _texts(batch, lambda row: has_bit(bits, row))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["row", "shingles"])

    return run


class Runs:
    """Longest runs of which at least a share are marked, and that end on marks, around any place. The furthest end of each start is worked out once a share."""

    def __init__(self, marks: np.ndarray):
        self.marks, self.kept = marks, {}

    def around(self, at: int, share: float) -> tuple[int, int]:
        if not self.marks[at]:
            return at, at
        if share not in self.kept:
            starts = np.flatnonzero(self.marks)
            far = furthest_ends(self.marks, starts, share)
            best = int((far - starts).argmax())
            self.kept[share] = starts, far, int(starts[best]), int(far[best])
        starts, far, lo, hi = self.kept[share]
        if lo <= at < hi:
            return lo, hi
        n = int(starts.searchsorted(at, side="right"))
        best = int(np.where(far[:n] > at, far[:n] - starts[:n], 0).argmax())
        return int(starts[best]), int(far[best])


def furthest_ends(marks: np.ndarray, starts: np.ndarray, share: float) -> np.ndarray:
    """For each marked start the furthest end, behind a mark, of a run with enough marks."""
    up = np.concatenate([[0.0], np.cumsum(marks - share)])  # a run lo..hi-1 has enough marks if up[hi] >= up[lo]
    ahead = np.maximum.accumulate(up[starts + 1][::-1])[::-1]  # ends whose sum is the highest of those still to come
    last = np.searchsorted(-ahead, -up[starts] + 1e-9, side="right") - 1
    return starts[np.maximum(last, 0)] + 1


def shared_run(marks: np.ndarray, at: int, share: float) -> tuple[int, int]:
    """The longest run around ``at`` of which at least ``share`` are marked, and that ends on marks; empty if ``at`` is none."""
    return Runs(marks).around(at, share)


def run_cover(marks: np.ndarray, share: float, length: int) -> np.ndarray:
    """Places in some run of at least ``length`` that ends on marks and of which at least ``share`` are marked."""
    cover = np.zeros(len(marks) + 1, np.int64)
    starts = np.flatnonzero(marks)
    if len(starts):
        far = furthest_ends(marks, starts, share)
        good = far - starts >= length
        np.add.at(cover, starts[good], 1)
        np.add.at(cover, far[good], -1)
    return np.cumsum(cover[:-1]) > 0


def stretches(marks: np.ndarray) -> np.ndarray:
    """Start and end of each stretch of marked places."""
    return np.flatnonzero(np.diff(np.concatenate([[False], marks, [False]]).astype(np.int8))).reshape(-1, 2)


def least_of_runs(values: np.ndarray, length: int) -> np.ndarray:
    """The least value of each run of ``length``."""
    n = len(values)
    padded = np.full(-(-n // length) * length, ~np.uint64(0))
    padded[:n] = values
    blocks = padded.reshape(-1, length)
    ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(blocks, axis=1).ravel()
    return np.minimum(ahead[: n - length + 1], behind[length - 1 : n])


def _joint(length: int) -> Callable:
    """Keys of the runs of texts given by their shared shingles: the minima of a tuple of functions, the place of the first, and one more minimum."""
    names, types = ["row", "doc", "key", "more", "c", "open"], [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()]

    def pieces(row: int, doc: int, at: np.ndarray, shingles: np.ndarray, spans: pa.Scalar) -> Iterator[tuple]:
        """Stretches of a text that alike runs cover: where they start, their shingles, which of them are known, which places are open and where a run starts that does not stand in an earlier text as it is."""
        first = int(at.min())
        marks, values = np.zeros(int(at.max()) - first + 1), np.zeros(int(at.max()) - first + 1, np.uint64)
        marks[at - first], values[at - first] = 1.0, shingles
        edges = stretches(run_cover(marks, SIMILARITY, length)).tolist()
        if edges:
            still = np.ones(len(marks), bool)
            if spans.is_valid:
                still = ~covered(*(spans.values.field(f).to_numpy() - first for f in ("start", "end")), len(marks))
            new = ~repeats(spans, first, len(marks), length)
            for lo, hi in edges:
                yield row, doc, lo + first, values[lo:hi], marks[lo:hi] > 0, still[lo:hi], new[lo:hi]

    def keys(rows: list[int], docs: list[int], starts: list[int], *arrays: list[np.ndarray]) -> pa.RecordBatch:
        sizes = np.array([len(x) for x in arrays[0]])
        ends = np.cumsum(sizes)
        own, known, still, new = (np.concatenate(x) for x in arrays)
        of, place = np.repeat(np.arange(len(sizes)), sizes), np.arange(len(own), dtype=np.uint64)
        whole = ends[of[: len(own) - length + 1]] >= np.arange(length, len(own) + 1)  # runs within a stretch
        whole &= new[: len(whole)]
        low = (np.uint64(1) << np.uint64(len(own).bit_length())) - np.uint64(1)
        out = []
        for seeds in _TUPLE_SEEDS:
            found = np.array([least_of_runs(np.where(known, (hashing.mix(own ^ seed) & ~low) | place, ~np.uint64(0)), length)[whole] for seed in seeds])
            found = found[:, found[0] != ~np.uint64(0)]  # runs with a shared shingle, the same for every function
            found = found[:, np.concatenate([np.ones(min(1, found.shape[1]), bool), (found[:-1, 1:] != found[:-1, :-1]).any(axis=0)])]
            at_least = (found & low).astype(np.int64)
            key = np.full(found.shape[1], seeds[0])
            for w in range(WIDTH):
                key = hashing.mix(key ^ hashing.mix(own[at_least[w]] + seeds[w]))
            out.append((key.view(np.int64), hashing.mix(own[at_least[WIDTH]] ^ seeds[WIDTH]).astype(np.uint32).view(np.int32), at_least[0]))
        key, more, c = (np.concatenate(x) for x in zip(*out, strict=True))
        row, doc, start = (np.array(x, np.int64)[of[c]] for x in (rows, docs, starts))
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip((row, doc, key, more, c - (ends - sizes)[of[c]] + start, still[c]), types, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, n = [], 0
            columns = [batch.column(c) for c in ("at", "sh", "spans")]
            for row, doc, at, shingles, spans in zip(batch.column("row").to_pylist(), batch.column("doc").to_pylist(), *columns, strict=True):
                new = [*pieces(row, doc, at.values.to_numpy(), shingles.values.to_numpy().view(np.uint64), spans)]
                found += new
                n += sum(len(x[3]) for x in new)
                if n > AT_ONCE:
                    yield keys(*zip(*found, strict=True))
                    found, n = [], 0
            if found:
                yield keys(*zip(*found, strict=True))

    return run


def covered(lo: np.ndarray, hi: np.ndarray, n: int) -> np.ndarray:
    """Places of ``n`` in at least one of the spans ``lo..hi-1``; spans may be empty or go beyond the ends."""
    steps = np.zeros(n + 1, np.int64)
    lo, hi = np.clip(lo, 0, n), np.clip(hi, 0, n)
    np.add.at(steps, lo[lo < hi], 1)
    np.add.at(steps, hi[lo < hi], -1)
    return np.cumsum(steps[:-1]) > 0


def repeats(spans: pa.Scalar, first: int, n: int, length: int) -> np.ndarray:
    """Of ``n`` runs of ``length``, from place ``first`` on, those in a passage that is the ``same`` in the hub."""
    if not spans.is_valid:
        return np.zeros(n, bool)
    start, end, same = (spans.values.field(f).to_numpy(zero_copy_only=False) for f in ("start", "end", "same"))
    return covered(start[same] - first, end[same] - first - length + 1, n)


def _spread(length: int) -> Callable:
    """``row, at, sh``: the shingles of each text in runs of ``length`` around one of its ``places``.

    Runs that stand in an earlier text as they are do not count: that text has them too, with the same minima, and what is like them meets it there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, n = [], 0
            for row, text, places, spans in zip(batch.column("row").to_pylist(), *(batch.column(c) for c in ("text", "places", "spans")), strict=True):
                s = hashing.shingle_hashes(hashing.word_hashes(text.as_py()), SHINGLE)
                c = places.values.to_numpy()
                runs = covered(c - length + 1, c + 1, len(s) - length + 1) & ~repeats(spans, 0, len(s) - length + 1, length)
                runs = np.flatnonzero(runs)
                at = np.flatnonzero(covered(runs, runs + length, len(s)))
                parts.append((np.full(len(at), row), at.astype(np.int32), s[at].view(np.int64)))
                n += len(at)
                if n > AT_ONCE:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)], ["row", "at", "sh"])
                    parts, n = [], 0
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)], ["row", "at", "sh"])

    return run


class _Sides:
    """A stretch of either text. What was found for a run is kept until the next run with that share: most anchors have the same."""

    def __init__(self, x: np.ndarray, y: np.ndarray, runs: Runs, kinds: int):
        self.x, self.y, self.runs, self.kinds, self.kept = x, y, runs, kinds, {}

    def of_run(self, share: float, lo: int, hi: int) -> tuple[np.ndarray, Runs, dict]:
        if self.kept.get(share, (None,))[0] != (lo, hi):
            of_x = np.zeros(self.kinds, bool)
            of_x[self.x[lo:hi]] = True
            self.kept[share] = (lo, hi), (of_x, Runs(of_x[self.y].astype(float)), {})
        return self.kept[share][1]


def match_passage(sides: _Sides, at_x: int, at_y: int, length: int) -> tuple[int, int, int, int, float] | None:
    """``start, end`` in x, ``start, end`` in y and the similarity of the passage around a common shingle.

    Shingles are numbers below ``kinds``; the runs of x are those of the shingles that y has. Ends are behind the last shingle. None if there is no run of ``length`` shingles with similarity of at least 3/4. The longest
    run is tried first; where its two sides are less alike, runs with fewer strange shingles, and then with none.
    """
    widest = 2 * SIMILARITY / (1 + SIMILARITY)  # of either side, when both have the same length; of the longer one SIMILARITY may do
    for share in (SIMILARITY, widest, (1 + widest) / 2, 1.0):
        lo, hi = sides.runs.around(at_x, share)
        if hi - lo < length:
            return None
        of_x, runs, alike = sides.of_run(share, lo, hi)
        low, high = runs.around(at_y, share)
        if high - low < length:
            continue
        if (low, high) not in alike:
            of_y = np.zeros(sides.kinds, bool)
            of_y[sides.y[low:high]] = True
            both = int(np.count_nonzero(of_x & of_y))
            alike[low, high] = both / max(1, int(np.count_nonzero(of_x)) + int(np.count_nonzero(of_y)) - both)
        if alike[low, high] >= SIMILARITY:
            return lo, hi, low, high, alike[low, high]
    return None


def _verify(length: int) -> Callable:
    """Passages of each pair of texts; anchors in a passage already found are not tried again.

    ``same``: the passage stands in the hub as it is.
    """
    names = ["row", "doc", "hub_row", "hub_doc", "start", "end", "hub_start", "hub_end", "similarity", "same"]
    types = [pa.int64()] * 4 + [pa.int32()] * 4 + [pa.float64(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            columns = [batch.column(c).to_pylist() for c in ("row", "doc", "hub_row", "hub_doc")]
            for row, doc, hub_row, hub_doc, x, y, anchors in zip(*columns, *(batch.column(c) for c in ("x", "y", "anchors")), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint32) for v in (x, y))
                if len(x) == len(y) and len(x) >= length and (x == y).all():
                    out.append((row, doc, hub_row, hub_doc, 0, len(x), 0, len(x), 1.0, True))
                    continue
                found, sides, both = [], {}, np.concatenate([x, y])
                order = np.argsort(both)
                number = np.empty(len(both), np.int64)
                number[order] = np.cumsum(np.concatenate([[False], both[order][1:] != both[order][:-1]]))
                x, y, kinds = number[: len(x)], number[len(x) :], int(number.max()) + 1
                of_x, of_y = np.zeros(kinds), np.zeros(kinds)
                of_x[x] = of_y[y] = 1.0
                common = of_y[x]
                able_x, able_y = run_cover(common, SIMILARITY, length), run_cover(of_x[y], SIMILARITY, length)
                at, hub_at = (anchors.values.field(f).to_numpy() for f in ("c", "hc"))
                able = able_x[at] & able_y[hub_at]
                at, hub_at = at[able], hub_at[able]
                # a passage lies within the stretches that runs cover
                edges_x, edges_y = stretches(able_x), stretches(able_y)
                order = np.lexsort((hub_at, at))
                for c, hc in zip(at[order].tolist(), hub_at[order].tolist(), strict=True):
                    if any(p[0] <= c < p[1] and p[2] <= hc < p[3] for p in found):
                        continue
                    lo, hi = edges_x[np.searchsorted(edges_x[:, 0], c, side="right") - 1].tolist()
                    low, high = edges_y[np.searchsorted(edges_y[:, 0], hc, side="right") - 1].tolist()
                    if (lo, low) not in sides:
                        sides[lo, low] = _Sides(x[lo:hi], y[low:high], Runs(common[lo:hi]), kinds)
                    p = match_passage(sides[lo, low], c - lo, hc - low, length)
                    if p:
                        found.append((p[0] + lo, p[1] + lo, p[2] + low, p[3] + low, p[4]))
                for p in _outermost(found):
                    same = p[1] - p[0] == p[3] - p[2] and bool((x[p[0] : p[1]] == y[p[2] : p[3]]).all())
                    out.append((row, doc, hub_row, hub_doc, *p, same))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out, strict=True), types, strict=True)], names)

    return run


def _outermost(found: list[tuple]) -> list[tuple]:
    """Passages that no other passage of the pair holds."""
    return sorted({p for p in found if not any(q[0] <= p[0] and p[1] <= q[1] and q[1] - q[0] > p[1] - p[0] for q in found)})


def _meet(rows: DataFrame) -> DataFrame:
    """Rows of groups (by ``key``) with the group's first row, where the group has several texts."""
    own, group = F.struct("doc", "row", "c"), Window.partitionBy("key")
    met = rows.withColumns({"hub": F.min(own).over(group), "last": F.max(own).over(group)})
    return met.where("hub.row <> last.row").drop("last")


def _meet_near(rows: DataFrame) -> DataFrame:
    """Pairs of rows of a group: each row with the group's first and with the one before it by ``more``. The later text is ``row`` and its place is open, the other one in ``o``."""
    order = Window.partitionBy("key").orderBy("more", "doc", "row", "c")
    own = F.struct("doc", "row", "c", "open")
    # the first by text, and not by ``more``: the same for all tuples in which a group meets
    met = rows.withColumns({"hub": F.min(own).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), "before": F.lag(own).over(order)})
    met = met.select(own.alias("x"), F.explode(F.array("hub", "before")).alias("y")).where("x.row <> y.row")
    return met.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("o")).where("x.open").select("x.doc", "x.row", "x.c", "o")


class _Search:
    def __init__(self, texts: DataFrame, length: int, shared: Shared):
        self.texts, self.length, self.shared, self.passages = texts, length, shared, None

    def shingles(self, rows: DataFrame) -> DataFrame:
        """``row, shingles`` of the texts named by ``row``, in 32 bits each; one scan of the texts."""
        wanted = self.shared.cut(rows.where("row is not null").distinct(), "wanted")
        found = self.texts.mapInArrow(_shingles(key_bits(wanted, "row")), "row long, shingles binary")
        found = self.shared.cut(found.join(wanted, "row", "left_semi"), "shingles")
        self.shared.drop(wanted)
        return found

    def verify(self, sides: DataFrame, functions: int) -> None:
        """``sides``: rows with the other text's window in ``o``. Only pairs of texts that met by so many ``functions`` are verified."""
        anchor = F.struct("c", F.col("o.c").alias("hc"))
        pairs = sides.where("o.row <> row").groupBy("row", "doc", F.col("o.row").alias("hub_row"), F.col("o.doc").alias("hub_doc"))
        # the windows that one text shares with another, bounded by its length
        pairs = pairs.agg(F.collect_set(anchor).alias("anchors"), F.bit_or("fs").alias("fs")).where(F.bit_count("fs") >= functions).drop("fs")
        pairs = self.shared.cut(pairs, "pairs")
        shingles = self.shingles(pairs.select(F.explode(F.array("row", "hub_row")).alias("row")))
        both = pairs.join(shingles.withColumnRenamed("shingles", "x"), "row").join(shingles.select(F.col("row").alias("hub_row"), F.col("shingles").alias("y")), "hub_row")
        found = both.mapInArrow(_verify(self.length), _PASSAGE).distinct()  # repeated rows of a text give the same passages
        found = self.shared.cut(found, "passages")
        self.shared.drop(pairs, shingles)
        self.passages = found if self.passages is None else self.passages.unionByName(found)

    def open_rows(self, met: DataFrame) -> DataFrame:
        """Rows of ``met`` whose place is in no passage yet and that are not the first of their group."""
        spans = self.passages.groupBy("row").agg(F.collect_set(F.struct("start", "end")).alias("spans"))  # of one text
        inside = F.exists("spans", lambda s: (F.col("c") >= s["start"]) & (F.col("c") < s["end"]))
        return met.where("o.row <> row").join(spans, "row", "left").where(~F.coalesce(inside, F.lit(False))).drop("spans")

    def shared_shingles(self, rows: DataFrame) -> DataFrame:
        """``row, doc, at, sh, spans`` of texts around the places ``c`` of ``rows``: place and hash of the shingles that another of the texts has there."""
        spans = self.passages.groupBy("row").agg(F.collect_set(F.struct("start", "end", "same")).alias("spans"))  # of one text
        places = rows.groupBy("row").agg(F.min("doc").alias("doc"), F.collect_set("c").alias("places"))  # of one text
        places = self.shared.cut(places.join(spans, "row", "left"), "places")
        # places grow with the texts: a broadcast would take all of them through the driver
        spread = self.texts.drop("doc").join(places.drop("doc").hint("merge"), "row").mapInArrow(_spread(self.length), "row long, at int, sh long")
        group = Window.partitionBy("sh")
        marked = spread.withColumns({"a": F.min("row").over(group), "b": F.max("row").over(group)}).where("a <> b")
        marked = self.shared.cut(marked.select("row", "at", "sh"), "marked", "zstd")
        # of one text; both lists are filled row by row and take less room than structs. Rows that come twice do no harm
        marked = marked.groupBy("row").agg(F.collect_list("at").alias("at"), F.collect_list("sh").alias("sh"))
        return marked.join(places.select("row", "doc", "spans"), "row")


def repeated_passages(spark: SparkSession, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, start_word, end_word, first_doc_id, first_start_word, first_end_word, similarity``: passages that stand in an earlier text.

    A passage has at least ``min_words`` words, and its shingles a similarity of at least 3/4 to those of the passage in the other
    text; ends are behind the last word. Texts are ordered by id (missing ids last), then a hash of the text. A passage is
    reported with the first text found for it, and more rows tell of others. Texts that are missing, empty or shorter than
    a passage give no rows, nor do repetitions within a text. Rows with equal id and text count once. Other columns are
    ignored, whatever their names.
    """
    shared = Shared(spark)
    length = min_words - SHINGLE + 1
    texts = docs.select(
        F.xxhash64(id_column, text_column).alias("row"), F.coalesce(F.col(id_column).cast("long"), F.lit(_NO_ID)).alias("doc"), F.col(text_column).alias("text")
    )
    windows = texts.mapInArrow(_windows(length), "row long, doc long, fs int, key long, c int")
    search = _Search(texts, length, shared)
    met = shared.cut(_meet(windows).withColumnRenamed("hub", "o"), "met")
    search.verify(met, 2)

    # groups with open places: those themselves, and all that may be their partners
    still = search.open_rows(met).select("key").distinct()
    partners = shared.cut(met.join(still, "key", "left_semi").select("row", "doc", "c"), "open")
    shared.drop(met)
    if not partners.isEmpty():
        joint = search.shared_shingles(partners).mapInArrow(_joint(length), "row long, doc long, key long, more int, c int, open boolean")
        search.verify(_meet_near(joint).withColumn("fs", F.lit(1)), 1)

    given = lambda c: F.when(F.col(c) != _NO_ID, F.col(c))
    found = search.passages.select(
        given("doc").alias("doc_id"),
        F.col("start").alias("start_word"),
        (F.col("end") + SHINGLE - 1).alias("end_word"),
        given("hub_doc").alias("first_doc_id"),
        F.col("hub_start").alias("first_start_word"),
        (F.col("hub_end") + SHINGLE - 1).alias("first_end_word"),
        "similarity",
    )
    return found.distinct()
