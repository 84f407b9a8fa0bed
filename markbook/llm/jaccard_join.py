"""N-gram Jaccard join by universe-partition pigeonhole.

Two documents link when the Jaccard similarity of their sets of 5-word shingles is at least 3/4. Then the sets differ in at
most ``(|R| + |S|) / 7`` members. The universe of shingles is split by hash into segments, more for larger size bands; a
member in which the sets differ spoils one segment, so two linked sets agree on all but that many segments.

* A set is indexed under its ``H + 1`` cheapest segment subsets, where ``H`` bounds the difference to any partner of the band
  pair. Cost is the corpus frequency of the rarest member of the subset, then its size, larger first; empty subsets come last. As all sets rank subsets
  alike, two linked sets have one of these in common (the prefix argument).
* Some segments can be indexed with their one-deletion neighbourhood: all subsets that lack one member. Sets that differ
  there in one member still meet, so such a segment is worth two. ``allocate`` takes the number of such segments with
  the lowest expected cost (rows written and sets that would meet by chance) for each band.

Sets that meet are compared by size, by a parity sketch that bounds their difference from below, and then exactly. A bucket of sets that share a subset is never expanded into all pairs: its members are
compared with one of them; the next rounds compare only what is then still in different components. Sets that meet again and
again without linking (edited copies further apart than 3/4) are indexed anew, among themselves, under the finest partition,
where far fewer of them meet; rounds go on there until each bucket is in one component or all has been compared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import hashing
from .frames import Shared, components, has_bit, key_bits

# Similarity of at least 3/4, so a difference of at most (|R| + |S|) / 7.
_NUM, _DEN = 3, 4
# Frequent shingles known to every task, by which subsets are ranked. The rank only decides costs, not results.
HEAVY = 1 << 18
_NO_ID = (1 << 63) - 1
# Width of a segment with a one-deletion neighbourhood, in units of a plain segment.
_WIDE = 4


def difference(r: int, s: int) -> int:
    """Most members in which linked sets of these sizes can differ."""
    return (r + s) * (_DEN - _NUM) // (_DEN + _NUM)


def band(size: int) -> int:
    """Size bands [1, 2), [2, 4), [4, 8) and so on."""
    return size.bit_length() - 1


def plain_segments(at: int) -> int:
    """Segments of a band: sets fill them with one or two members, so that a subset of several is mostly to be had."""
    high = 2 << at
    return high // 2 if high >= 128 else high


def budget(size: int, at: int) -> int | None:
    """Most differences of a set to a partner, in pairs whose larger set is in band ``at``; None where there is no such pair."""
    largest = min((2 << at) - 1, size * _DEN // _NUM)
    return difference(size, largest) if largest >= 1 << at else None


def _expected_cost(size: int, at: int, wide: int, population: float) -> float:
    h = budget(size, at)
    if h is None:
        return 0.0
    plain = plain_segments(at)
    slots = plain + wide * _WIDE
    keep = max(0, h + 1 - 2 * wide)
    in_wide = size * _WIDE / slots
    rows = keep + wide * (1 + in_wide)
    filled = plain * (1 - np.exp(-size / slots))
    spread = max(1.0, np.sqrt(filled * np.exp(-size / slots)))
    lacking = 1 / (1 + np.exp(np.clip(1.7 * (filled - keep) / spread, -50, 50)))
    by_chance = (lacking if keep else 0.0) + wide * np.exp(-in_wide) * (1 + in_wide)
    return rows + population * by_chance


def allocate(populations: dict[int, float]) -> dict[int, int]:
    """For each band, the number of segments with a one-deletion neighbourhood that costs least."""
    out = {}
    for at in range(max(populations, default=0) + 2):
        low, high = 1 << at, (2 << at) - 1
        sizes = sorted({max(1, low * _NUM // _DEN), low, (low + high) // 2, high})
        most = (difference(high, high) + 2) // 2
        n = populations.get(at, 0.0) + populations.get(at - 1, 0.0) + 1
        costs = [sum(_expected_cost(s, at, w, n) for s in sizes) for w in range(min(most, 8) + 1)]
        out[at] = int(np.argmin(costs))
    return out


def coarse_table(heavy: np.ndarray) -> np.ndarray:
    """Which leading 20 bits occur among the frequent shingles."""
    out = np.zeros(1 << 20, bool)
    out[(heavy >> np.uint64(44)).astype(np.int64)] = True
    return out


def frequency(members: np.ndarray, heavy: np.ndarray, weight: np.ndarray, coarse: np.ndarray) -> np.ndarray:
    """How many sets have each member, as far as it is frequent; 1 for the others."""
    out = np.ones(len(members), np.uint64)
    maybe = np.flatnonzero(coarse[(members >> np.uint64(44)).astype(np.int64)])
    if len(maybe):
        at = np.minimum(np.searchsorted(heavy, members[maybe]), len(heavy) - 1)
        out[maybe] = np.where(heavy[at] == members[maybe], np.minimum(weight[at], 65535), 1)
    return out


def subset_keys(members: np.ndarray, heavy: np.ndarray, weight: np.ndarray, coarse: np.ndarray, wide_of: dict[int, int]) -> np.ndarray:
    """Index keys of a set of shingle hashes; sets that link have a key in common."""
    size = len(members)
    rarity = frequency(members, heavy, weight, coarse)
    spread = hashing.mix(members + np.uint64(0x5851F42D4C957F2D))
    out = []
    for scheme in (band(size), band(size) + 1):
        h = budget(size, scheme)
        if h is None:
            continue
        plain, wide = plain_segments(scheme), wide_of.get(scheme, 0)
        slot = (spread % np.uint64(plain + wide * _WIDE)).astype(np.int64)
        segment = np.where(slot < plain, slot, plain + (slot - plain) // _WIDE) if wide else slot
        order = np.argsort(segment.astype(np.uint16) if plain + wide < 65536 else segment, kind="stable")
        segment, own = segment[order], members[order]
        starts = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
        ids = segment[starts]
        sums = np.add.reduceat(hashing.mix(own), starts)
        tag = np.uint64(scheme + 1) << np.uint64(56)
        name = hashing.mix(ids.astype(np.uint64) + tag)
        whole = hashing.mix(sums ^ name)
        is_plain = ids < plain
        keep = max(0, h + 1 - 2 * wide)
        cost = np.minimum.reduceat(rarity[order], starts)[is_plain]
        kept = whole[is_plain]
        lacking = keep - len(kept)
        if lacking < 0:
            # rarest first, then those of more members, which fewer sets share by chance
            few = np.uint64(15) - np.minimum(np.diff(np.r_[starts, size]), 15).astype(np.uint64)[is_plain]
            rank = (cost << np.uint64(48)) | (few << np.uint64(44)) | (kept >> np.uint64(20))
            kept = kept[np.argpartition(rank, keep)[:keep]]
        out.append(kept)
        if lacking > 0:  # empty subsets rank last, by number
            empty = np.setdiff1d(np.arange(plain), ids[is_plain])[:lacking]
            out.append(hashing.mix(hashing.mix(empty.astype(np.uint64) + tag)))
        if wide:
            at = np.repeat(np.arange(len(ids)), np.diff(np.r_[starts, size]))
            in_wide = ~is_plain[at]
            out.append(whole[~is_plain])
            out.append(hashing.mix((sums[at] - hashing.mix(own))[in_wide] ^ name[at][in_wide]))
            gone = np.setdiff1d(np.arange(plain, plain + wide), ids[~is_plain])
            out.append(hashing.mix(hashing.mix(gone.astype(np.uint64) + tag)))
    return np.concatenate(out).view(np.int64)


def parity_sketch(members: np.ndarray) -> bytes:
    """Parity of the number of members in each of at least ``4 |R|`` hash classes.

    A member that only one of two sets has flips one bit, so sketches differ in at most as many bits as the sets in members.
    """
    bits = 64 << max(0, (4 * len(members) - 1).bit_length() - 6)
    odd = np.bincount((hashing.mix(members + np.uint64(0x2127599BF4325C37)) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def may_link(a: bytes, a_size: int, b: bytes, b_size: int) -> bool:
    """Whether sets with these sketches can differ in few enough members; the longer sketch is folded to the shorter."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) < len(y):
        x, y = y, x
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum()) <= difference(a_size, b_size)


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int | None, np.ndarray]]:
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            yield doc, np.unique(hashing.shingle_hashes(hashing.word_hashes(text.as_py()), size))


def _profile(size: int) -> Callable:
    """Size and set hash of each document; and frequent shingles of this task's different sets."""

    def flush(rows: list) -> pa.RecordBatch:
        names, types = ["doc", "row", "set_id", "size", "count", "sketch"], [pa.int64()] * 5 + [pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, seen, pile = [], set(), []
        keys, counts, piled = np.empty(0, np.uint64), np.empty(0, np.int64), 0

        def merged(least: int) -> tuple[np.ndarray, np.ndarray]:
            found, n = np.unique(np.concatenate(pile), return_counts=True) if pile else (np.empty(0, np.uint64), np.empty(0, np.int64))
            every = np.r_[keys, found]
            found, where = np.unique(every, return_inverse=True)
            n = np.bincount(where, np.r_[counts, n]).astype(np.int64) if len(every) else counts
            top = np.argsort(-n, kind="stable")[:HEAVY]
            top = np.sort(top[n[top] >= least])
            return found[top], n[top]

        for batch in batches:
            for row, (doc, members) in zip(batch.column("row").to_pylist(), _sets([batch], size), strict=True):
                own = hashing.set_hash(members)
                rows.append((doc, row, own, len(members), None, parity_sketch(members)))
                if len(members) and own not in seen:
                    seen.add(own)
                    pile.append(members)
                    piled += len(members)
                    if piled > 2_000_000:
                        keys, counts = merged(1)
                        pile, piled = [], 0
                if len(rows) >= 10_000:
                    yield flush(rows)
                    rows = []
        keys, counts = merged(2)
        rows += [(None, None, int(k), None, int(n), None) for k, n in zip(keys.view(np.int64), counts, strict=True)]
        if rows:
            yield flush(rows)

    return run


def _index(size: int, heavy: np.ndarray, weight: np.ndarray, wide_of: dict[int, int]) -> Callable:
    """``(key, set_id)`` rows; a set that a task meets again is not written again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, keys, owners, n = set(), [], [], 0
        coarse = coarse_table(heavy)
        for _, members in _sets(batches, size):
            own = hashing.set_hash(members)
            if len(members) and own not in seen:
                seen.add(own)
                keys.append(subset_keys(members, heavy, weight, coarse, wide_of))
                owners.append(np.full(len(keys[-1]), own, np.int64))
                n += len(keys[-1])
                if n > 200_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(owners))], ["key", "set_id"])
                    keys, owners, n = [], [], 0
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(owners))], ["key", "set_id"])

    return run


def _members_of(size: int, bits: np.ndarray) -> Callable:
    """Shingle hashes, sorted, of documents that may be wanted."""
    names, types = ["set_id", "doc", "members"], [pa.int64(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = pa.array([has_bit(bits, k) for k in batch.column("doc_key").to_pylist()], pa.bool_())
            rows = [(hashing.set_hash(m), doc, m.tobytes()) for doc, m in _sets([batch.filter(wanted)], size) if len(m)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    return run


def _sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("a_sketch", "a_size", "b_sketch", "b_size"))
        left = pa.array([may_link(*row) for row in zip(*columns, strict=True)], pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(left)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        linked = []
        for a, b in zip(batch.column("a_members"), batch.column("b_members"), strict=True):
            a, b = (np.frombuffer(x.as_buffer(), np.uint64) for x in (a, b))
            both = len(np.intersect1d(a, b, assume_unique=True))
            linked.append(both * _DEN >= _NUM * (len(a) + len(b) - both))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], ["a", "b", "linked"])


class _Links:
    """Links found so far, the pairs compared, and the components of the links."""

    def __init__(self, texts: DataFrame, sets: DataFrame, sketches: DataFrame, size: int, shared: Shared):
        self.texts, self.sets, self.sketches, self.size, self.shared = texts, sets, sketches, size, shared
        self.links = self.checked = self.roots = None

    def members(self, nodes: DataFrame) -> DataFrame:
        """``(set_id, members)`` of the given set ids, from the text of each set's first document; one scan of the texts."""
        wanted = self.shared.cut(nodes.join(self.sets.select("set_id", "doc"), "set_id"), "wanted")
        key = F.xxhash64("doc").alias("doc_key")
        members = self.texts.select("doc", "text", key).mapInArrow(_members_of(self.size, key_bits(wanted.select(key), "doc_key")), "set_id long, doc long, members binary")
        # repeated rows of a document give a set more than once, which changes no outcome
        return self.shared.cut(members.join(wanted, ["set_id", "doc"], "left_semi").select("set_id", "members"), "members")

    def test(self, pairs: DataFrame, members: DataFrame | None = None) -> bool:
        """Compare ``(a, b)`` pairs of set ids exactly, first by size and sketch. False if there are none."""
        pairs = self.shared.cut(pairs, "pairs")
        if pairs.isEmpty():
            return False
        done = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        self.checked = done if self.checked is None else self.checked.unionByName(done)
        left, right = (self.sketches.select(F.col("set_id").alias(x), F.col("size").alias(f"{x}_size"), F.col("sketch").alias(f"{x}_sketch")) for x in "ab")
        both = pairs.join(left, "a").join(right, "b").where(F.least("a_size", "b_size") * _DEN >= F.greatest("a_size", "b_size") * _NUM)
        pairs = self.shared.cut(both.mapInArrow(_sift, "a long, b long").distinct(), "sifted")
        if pairs.isEmpty():
            return True
        if members is None:
            members = self.members(pairs.select(F.explode(F.array("a", "b")).alias("set_id")).distinct())
        left, right = (members.select(F.col("set_id").alias(x), F.col("members").alias(f"{x}_members")) for x in "ab")
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "a_members", "b_members")
        # repeated rows of a document give a pair more than once, with the same outcome
        tested = self.shared.cut(both.mapInArrow(_compare, "a long, b long, linked boolean").distinct(), "tested")
        found = tested.where("linked").select(F.col("a").alias("u"), F.col("b").alias("v"))
        if found.isEmpty():
            return True
        self.links = found if self.links is None else self.links.unionByName(found)
        self.roots = components(self.links, self.shared)
        return True

    def torn(self, rest: DataFrame) -> DataFrame | None:
        """The rows of buckets that are in several components, with the ``root`` of each; None if there are none."""
        tagged = rest.drop("root").withColumn("root", F.col("set_id"))
        if self.roots is not None:
            tagged = rest.drop("root").join(self.roots.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
        several = tagged.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.max("indexed").alias("any")).where("lo < hi and any")
        tagged = self.shared.cut(tagged.join(several.select("key"), "key", "left_semi"), "torn")
        return None if tagged.isEmpty() else tagged

    def settle(self, rest: DataFrame, rounds: int | None = None, members: DataFrame | None = None, by_cost: bool = False) -> DataFrame | None:
        """Compare what is left of torn buckets: ``rest`` has ``key, set_id, root, size, rank, indexed, cost``.

        Each round takes hubs among a bucket's indexed members and compares them with all others in other components; several
        times as many each round. Ends when every bucket is in one component or has no indexed member left (returns
        None), or after ``rounds`` (returns what is left).
        """
        hubs, tagged = 1 if by_cost else 4, rest
        while True:
            # hubs come from the bucket's smallest components, so that the largest is not compared member by member
            share = tagged.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
            order = ["cost", "set_id"] if by_cost and hubs == 1 else ["n", "cost", "set_id"]
            place = F.row_number().over(Window.partitionBy("key").orderBy(*order))
            chosen = tagged.where("indexed").join(share, ["key", "root"]).withColumn("place", place).where(F.col("place") <= hubs)
            chosen = self.shared.cut(chosen.select("key", F.col("root").alias("hub_root"), F.col("set_id").alias("hub"), F.col("size").alias("hub_size"), F.col("rank").alias("hub_rank")), "hubs")
            near = tagged.join(chosen, "key").where("root <> hub_root")
            # at their first common key, sets have in common at most that member and those ranked after it
            most = 1 + F.least(F.col("size") - F.col("rank"), F.col("hub_size") - F.col("hub_rank"))
            near = near.where(most * (_NUM + _DEN) >= _NUM * (F.col("size") + F.col("hub_size")))
            near = near.select(F.greatest("set_id", "hub").alias("a"), F.least("set_id", "hub").alias("b")).distinct()
            self.test(near.join(self.checked, ["a", "b"], "left_anti"), members)
            tagged = self.torn(tagged.join(chosen.select("key", F.col("hub").alias("set_id")), ["key", "set_id"], "left_anti"))
            hubs *= 64
            rounds = None if rounds is None else rounds - 1
            if tagged is None or rounds == 0:
                return tagged


def _finest(heavy: np.ndarray, weight: np.ndarray) -> Callable:
    """Index of sets under segments of one shingle each, ranked by corpus frequency and then by hash.

    With one shingle a segment, only members that the other set lacks spoil a segment. A set needs the ``r - 6r/7 + 1`` cheapest
    segments (rounded up) to meet partners of its size or larger (``indexed``), and ``r - 3r/4 + 1`` to meet smaller ones. ``cost``
    is the number of members that are not frequent.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "set_id", "size", "rank", "indexed", "cost"]
        coarse = coarse_table(heavy)
        for batch in batches:
            parts = []
            for own, packed in zip(batch.column("set_id").to_pylist(), batch.column("members"), strict=True):
                members = np.frombuffer(packed.as_buffer(), np.uint64)
                size, rarity = len(members), frequency(members, heavy, weight, coarse)
                prefix = lambda num, den: size + (-size * num // den) + 1  # noqa: B023, E731
                first = members[np.lexsort((members, rarity))[: prefix(_NUM, _DEN)]]
                n, rank = len(first), np.arange(1, len(first) + 1)
                parts.append((first.view(np.int64), np.full(n, own), np.full(n, size), rank, rank <= prefix(2 * _NUM, _NUM + _DEN), np.full(n, int((rarity <= 1).sum()))))
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)], names)

    return run


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = 5, wide_of: dict[int, int] | None = None) -> DataFrame:
    """One row for each input row: ``doc_id, n_shingles, set_id, component_id``.

    ``component_id`` is the smallest id that is reachable by links, the own one included. A missing or empty text has no
    shingles and no link. A text with fewer than ``size`` words has one shingle, all its words. Equal sets are one node
    with all their documents, so copies are never compared. Rows that repeat an id are separate rows; if their texts
    differ, they are not linked by the id. A row without id gets the component of its links, and a missing one without
    links. Other columns are ignored, whatever their names. ``wide_of`` overrides ``allocate``.
    """
    rows, named = _linked(spark, docs, id_column, text_column, size, wide_of)
    given = lambda c: F.when(c != _NO_ID, c)
    return rows.join(named.drop("root"), "set_id", "left").select(
        given(F.col("doc")).alias("doc_id"), F.col("size").alias("n_shingles"), "set_id", given(F.coalesce("component", "doc")).alias("component_id")
    )


def _linked(spark: SparkSession, docs: DataFrame, id_column: str, text_column: str, size: int, wide_of: dict[int, int] | None) -> tuple[DataFrame, DataFrame]:
    """``doc, row, set_id, size`` of each input row, and ``set_id, root, component`` of each set: the smallest set and id of its component."""
    shared = Shared(spark)
    # a missing id ranks last
    texts = docs.select(F.coalesce(F.col(id_column).cast("long"), F.lit(_NO_ID)).alias("doc"), F.col(text_column).alias("text"), F.xxhash64(id_column, text_column).alias("row"))
    profile = shared.cut(texts.mapInArrow(_profile(size), "doc long, row long, set_id long, size long, count long, sketch binary"), "profile")
    texts = texts.select("doc", "text")
    rows = profile.where("size is not null").select("doc", "row", "set_id", "size")
    # the most frequent shingles of all sets: at most HEAVY rows reach the driver and the tasks
    top = profile.where("size is null").groupBy("set_id").agg(F.sum("count").alias("n")).where("n > 2").orderBy(F.desc("n"), "set_id").limit(HEAVY).toArrow()
    heavy, weight = top["set_id"].to_numpy().view(np.uint64), top["n"].to_numpy()
    order = np.argsort(heavy)
    heavy, weight = heavy[order], weight[order]
    sets = rows.where("size > 0").groupBy("set_id").agg(F.min("doc").alias("doc"), F.max("size").alias("size"))
    if wide_of is None:
        by_band = sets.groupBy((F.length(F.bin("size")) - 1).alias("at")).count().collect()
        wide_of = allocate({int(r["at"]): float(r["count"]) for r in by_band})
    keys = texts.mapInArrow(_index(size, heavy, weight, wide_of), "key long, set_id long")
    first = F.first("set_id").over(Window.partitionBy("key").orderBy("set_id").rowsBetween(Window.unboundedPreceding, 0))
    buckets = shared.cut(keys.select("key", "set_id", first.alias("hub")).where("set_id <> hub").distinct(), "buckets")

    sketches = profile.where("size > 0").select("set_id", "doc", "size", "sketch").join(sets.select("set_id", "doc"), ["set_id", "doc"], "left_semi").drop("doc")
    found = _Links(texts, sets, sketches, size, shared)
    if found.test(buckets.select(F.col("set_id").alias("a"), F.col("hub").alias("b")).distinct()):
        rest = found.torn(buckets.select("key", "set_id", F.lit(True).alias("indexed")))
        if rest is not None:
            members = found.members(rest.select("set_id").distinct())
            rest = rest.join(sets.select("set_id", "size"), "set_id").withColumns({"rank": F.lit(1), "cost": F.lit(0).cast("long")})
            rest = found.settle(rest, rounds=1, members=members)
        if rest is not None:
            # sets that share much and do not link: a finer index of these sets alone
            own = members.join(rest.select("set_id").distinct(), "set_id", "left_semi")
            finest = own.mapInArrow(_finest(heavy, weight), "key long, set_id long, size long, rank long, indexed boolean, cost long")
            rest = found.torn(shared.cut(finest.distinct(), "finest"))
            if rest is not None:
                found.settle(rest, members=members, by_cost=True)

    if found.roots is None:
        return rows, sets.select("set_id", F.col("set_id").alias("root"), F.col("doc").alias("component"))
    named = sets.join(found.roots.withColumnRenamed("node", "set_id"), "set_id", "left").select("set_id", "doc", F.coalesce("root", "set_id").alias("root"))
    least = named.groupBy("root").agg(F.min("doc").alias("component"))
    return rows, named.join(least, "root").select("set_id", "root", "component")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = 5) -> DataFrame:
    """One row of ``docs`` for each group of linked ones, with its columns: that with the smallest id (missing ids last), then set.

    Groups are of texts, so a row whose id another text has too stays if its own group has no smaller one. Of rows with equal id and text one
    stays. Texts without words are in no group; without an id as well, all of them stay.
    """
    rows, named = _linked(spark, docs.select(id_column, text_column), id_column, text_column, size, None)
    # the copies of a set are combined before they meet its component
    own = rows.where("size > 0").groupBy("set_id").agg(F.min(F.struct("doc", "row")).alias("own")).join(named, "set_id")
    least = own.groupBy("root").agg(F.min(F.struct("own.doc", "set_id", "own.row")).alias("least")).select(F.col("least.row").alias("__kept"))
    kept = least.unionByName(rows.where("size = 0").select(F.col("row").alias("__kept")))
    bare = docs[id_column].isNull() & ~F.coalesce(docs[text_column].rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))
    # equal rows are combined before the shuffle, so that a text that is often repeated is in no task whole
    each = docs.where(~bare).withColumn("__row", F.xxhash64(id_column, text_column)).dropDuplicates(["__row"])
    return each.join(kept, F.col("__row") == F.col("__kept"), "left_semi").drop("__row").unionByName(docs.where(bare))
