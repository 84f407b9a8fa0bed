"""Alignment of two tokenizers over a corpus by inverted pair bitmaps.

Both tokenizers cut the same bytes. Where tokens of both end, a group ends; a link is a pair of token occurrences whose bytes overlap.
Documents are numbered inside chunks, each made by one task. For each pair of ids a chunk holds a bitmap of the documents that have it
linked, made by OR, and planes of bitmaps for how often: bit by bit, one less than the number of links. Only bytes that are not zero
are kept. The popcounts of a pair's bitmaps, added over the chunks, are its document count; weighted by plane, its link count. The
counts go to the chunks that hold the pair, and there the bitmaps bring them, as postings, back to the documents.
Bitmaps are shuffled once, with their chunk: a pair that every document holds costs a bit a document and plane.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from .frames import Shared

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"

# Documents of a chunk are numbered in 16 bits; a chunk also ends at so many (pair, document) entries.
CHUNK_DOCS, CHUNK_ENTRIES = 1 << 16, 1 << 22
# Texts aligned together, in bytes; one longer text is aligned by itself.
BATCH_BYTES = 4 << 20
# Longer texts go to the tokenizer that scans them without recursion.
LONG_TEXT = 100_000

# Fixed value: how byte-level BPE cuts a text before it merges.
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Fixed value: how piece vocabularies write a space.
SPACE_MARK = "▁"


# --- vocabularies -------------------------------------------------------------------------------


class Spelling:
    """The bytes of each id, flat."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.size)[:-1]])
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        width = len(str(len(tokens)))
        self.digits = np.zeros((len(tokens), width + 1), np.uint8)
        for i in range(len(tokens)):
            self.digits[i, :width] = np.frombuffer(str(i).rjust(width, "\0").encode(), np.uint8)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        shift = np.repeat(self.start[ids] - (np.cumsum(size) - size), size)
        return self.flat[shift + np.arange(len(shift))]


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: printable ones for themselves, the others from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """Byte-level BPE from its JSON file. Where ids are in order of the merges, a rank encoder gives the same ids faster."""

    def __init__(self, data: bytes):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_str(data.decode())
        self.slow.encode_special_tokens = True
        known = json.loads(data)
        vocabulary, special = known["model"]["vocab"], {t["id"] for t in known.get("added_tokens", [])}
        alphabet = byte_alphabet()
        tokens = [b""] * (1 + max([*vocabulary.values(), *special]))
        for text, i in vocabulary.items():
            if i not in special:
                tokens[i] = bytes(alphabet[c] for c in text)
        self.spelling = Spelling(tokens)
        self.fast = None
        merges = [m.split(" ") if isinstance(m, str) else m for m in known["model"]["merges"]]
        cut = known.get("pre_tokenizer") or {}
        plain = known.get("normalizer") is None and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
        ranks = {t: i for i, t in enumerate(tokens) if t}
        if plain and len(ranks) == 256 + len(merges) and all(vocabulary["".join(m)] == 256 + i for i, m in enumerate(merges)):
            import tiktoken

            self.fast = tiktoken.Encoding("ranks", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self._one(" " + t) for t in texts]

    def _one(self, text: str) -> np.ndarray:
        if self.fast is not None and len(text) <= LONG_TEXT:
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.int64)


class PieceBpe:
    """A piece model with byte fallback, which sets a space before the text itself."""

    def __init__(self, data: bytes):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_proto=data)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.spelling = Spelling(
            [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE_MARK, " ").encode() for i, p in enumerate(pieces)]
        )

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in self.model.encode(texts, num_threads=1)]


_loaded: dict[bytes, object] = {}


def load(data: bytes):
    """The tokenizer of a file's bytes, kept in the worker: JSON for byte-level BPE, else a piece model."""
    key = hashlib.sha256(data).digest()
    if key not in _loaded:
        _loaded[key] = ByteBpe(data) if data.lstrip()[:1] == b"{" else PieceBpe(data)
    return _loaded[key]


# --- alignment of texts -------------------------------------------------------------------------


def align(raw: list[bytes], a_tokens, b_tokens, texts: bool = False) -> tuple[dict, np.ndarray, np.ndarray]:
    """For texts as bytes: counts and groups of each, and of every link the place of its text and its pair of ids.

    A text is cut by neither tokenizer, and all its figures are 0, if it is empty, is no UTF-8 or comes back changed from one of them.
    """
    n = len(raw)
    out = {c: np.zeros(n, np.int64) for c in ("n_a", "n_b", "n_groups", "n_links")} | {"groups": [""] * n}
    none = np.empty(0, np.int64)
    live = [i for i, r in enumerate(raw) if r and _is_text(r)]
    if not live:
        return out, none, none
    words = [raw[i].decode() for i in live]
    a_ids, b_ids = a_tokens.encode(words), b_tokens.encode(words)
    sa, sb = a_tokens.spelling, b_tokens.spelling
    good = []
    for k, i in enumerate(live):
        want = len(raw[i]) + 1
        if sa.size[a_ids[k]].sum() == want == sb.size[b_ids[k]].sum():
            whole = np.frombuffer(b" " + raw[i], np.uint8)
            if np.array_equal(sa.spell(a_ids[k]), whole) and np.array_equal(sb.spell(b_ids[k]), whole):
                good.append(k)
    if not good:
        return out, none, none
    at = np.array([live[k] for k in good])
    a, b = np.concatenate([a_ids[k] for k in good]), np.concatenate([b_ids[k] for k in good])
    n_a, n_b = (np.array([len(ids[k]) for k in good]) for ids in (a_ids, b_ids))
    ea, eb = np.cumsum(sa.size[a]), np.cumsum(sb.size[b])
    text_end = ea[np.cumsum(n_a) - 1]
    is_a, is_b = np.zeros(ea[-1] + 1, bool), np.zeros(ea[-1] + 1, bool)
    is_a[ea] = True
    is_b[eb] = True
    both, ends = np.flatnonzero(is_a & is_b), np.flatnonzero(is_a | is_b)
    # a stretch between two ends lies in one token of each: one link
    upto_a, upto_b = np.cumsum(is_a), np.cumsum(is_b)
    linked_a, linked_b = a[upto_a[ends - 1]], b[upto_b[ends - 1]]
    text_of = np.searchsorted(text_end, ends)
    out["n_a"][at], out["n_b"][at] = n_a, n_b
    out["n_groups"][at] = np.bincount(np.searchsorted(text_end, both), minlength=len(good))
    out["n_links"][at] = np.bincount(text_of, minlength=len(good))

    # A ids of a group, then its B ids: an id moves by what the other side has before it
    before_b = np.concatenate([[0], upto_b[both][:-1]])
    group_a, group_b = np.searchsorted(both, ea), np.searchsorted(both, eb)
    place_a, place_b = np.arange(len(a)) + before_b[group_a], np.arange(len(b)) + upto_a[both][group_b]
    width = max(sa.digits.shape[1], sb.digits.shape[1])
    rows = np.zeros((len(a) + len(b), width), np.uint8)
    for place, s, ids, end, last in ((place_a, sa, a, ea, b"|"), (place_b, sb, b, eb, b";")):
        w = s.digits.shape[1]
        rows[place, : w - 1] = s.digits[ids, : w - 1]
        rows[place, -1] = np.where((is_a & is_b)[end], last[0], ord(","))
    used = rows != 0
    stop = np.cumsum(used.sum(1))[np.cumsum(n_a + n_b) - 1]
    written, begin = rows[used].tobytes(), 0
    for i, e in zip(at.tolist(), stop.tolist(), strict=True):
        group = written[begin : e - 1]
        out["groups"][i] = group.decode() if texts else hashlib.sha256(group).hexdigest()
        begin = e
    return out, at[text_of], linked_a * len(sb.size) + linked_b


def _is_text(raw: bytes) -> bool:
    try:
        raw.decode()
        return True
    except UnicodeDecodeError:
        return False


# --- bitmaps ------------------------------------------------------------------------------------


def bitmaps(pair: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For pairs and documents in order: each pair, its document count, and its bitmap as bytes with their end.

    Documents of the same eight are OR-ed into a byte; a byte that is not zero is kept as its number in two bytes and itself.
    """
    eight = doc >> 3
    new = np.ones(len(pair), bool)
    new[1:] = (pair[1:] != pair[:-1]) | (eight[1:] != eight[:-1])
    at = np.flatnonzero(new)
    bits = np.bitwise_or.reduceat((1 << (doc & 7)).astype(np.uint8), at)
    records = np.stack([(eight[at] & 255).astype(np.uint8), (eight[at] >> 8).astype(np.uint8), bits], 1)
    first = np.flatnonzero(np.concatenate([[True], pair[at][1:] != pair[at][:-1]]))
    count = np.add.reduceat(np.bitwise_count(bits).astype(np.int64), first)
    return pair[at][first], count, records, np.append(first[1:], len(at)) * 3


def planes(keys: np.ndarray, often: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Plane 0 has all keys, plane p those with bit p - 1 set in one less than how often they occur."""
    yield 0, keys
    rest, plane = often - 1, 1
    while rest.any():
        if (rest & 1).any():
            yield plane, keys[(rest & 1) == 1]
        rest, plane = rest >> 1, plane + 1


def members(records: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and document of every set bit, for bitmaps of ``sizes`` bytes one after another."""
    triple = records.reshape(-1, 3)
    row = np.repeat(np.arange(len(sizes)), sizes // 3)
    at, bit = np.nonzero(np.unpackbits(triple[:, 2:], axis=1, bitorder="little"))
    return row[at], (triple[at, 0].astype(np.int64) + (triple[at, 1].astype(np.int64) << 8)) * 8 + bit


def _binary(records: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(kind, len(ends), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(records).tobytes())])


def _chunks(docs: DataFrame, files: object, texts: bool) -> DataFrame:
    """Rows of two kinds by chunk: a document with its figures (``pair`` missing), and a bitmap of a pair and plane."""
    from pyspark import TaskContext

    counts = ["n_a", "n_b", "n_groups", "n_links"]
    schema = StructType(
        [
            StructField("chunk", LongType()),
            StructField("place", IntegerType()),
            StructField("id", docs.schema["id"].dataType),
            *[StructField(c, LongType()) for c in counts],
            StructField("groups", StringType()),
            StructField("pair", LongType()),
            StructField("plane", IntegerType()),
            StructField("n_docs", LongType()),
            StructField("docs", BinaryType()),
        ]
    )
    fields = to_arrow_schema(schema)

    def rows(n: int, given: dict) -> pa.RecordBatch:
        columns = [given[f.name] if isinstance(given.get(f.name), pa.Array) else pa.array(given[f.name], f.type) if f.name in given else pa.nulls(n, f.type) for f in fields]
        return pa.RecordBatch.from_arrays(columns, schema=fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_tokens, b_tokens = (load(f) for f in files.value)
        chunk, placed, entries, size = TaskContext.get().partitionId() << 32, 0, [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            if not entries:
                return
            keys, often = (np.concatenate(x) for x in zip(*entries, strict=True))
            order = np.argsort(keys)
            for plane, held in planes(keys[order], often[order]):
                pair, count, records, ends = bitmaps(held >> 16, held & 0xFFFF)
                k = len(pair)
                yield rows(k, {"chunk": np.full(k, chunk), "pair": pair, "plane": np.full(k, plane, np.int32), "n_docs": count, "docs": _binary(records, ends, fields.field("docs").type)})

        for batch in batches:
            raw = batch.column("text").to_pylist()
            start = 0
            while start < len(raw):
                end, total = start, 0
                while end < len(raw) and (end == start or total + len(raw[end] or b"") <= BATCH_BYTES) and placed + end - start < CHUNK_DOCS:
                    total += len(raw[end] or b"")
                    end += 1
                found, doc, pair = align([r or b"" for r in raw[start:end]], a_tokens, b_tokens, texts)
                yield rows(end - start, {"chunk": np.full(end - start, chunk), "place": np.arange(placed, placed + end - start, dtype=np.int32), "id": batch.column("id").slice(start, end - start)} | found)
                if len(pair):
                    entries.append(np.unique(pair << 16 | (doc + placed), return_counts=True))
                    size += len(entries[-1][0])
                placed += end - start
                start = end
                if placed >= CHUNK_DOCS or size >= CHUNK_ENTRIES:
                    yield from flush()
                    chunk, placed, entries, size = chunk + 1, 0, [], 0
        yield from flush()

    return docs.mapInArrow(run, schema)


def weight(plane: int) -> int:
    return 1 << max(plane - 1, 0)


def _returned(chunks: DataFrame, scores: DataFrame) -> DataFrame:
    """The documents of each chunk with the sums over their links; its bitmaps meet the scores of its pairs."""
    figures = ["id", "n_a", "n_b", "n_groups", "n_links", "groups"]
    schema = StructType([*[chunks.schema[c] for c in figures], StructField("n_best", LongType()), StructField("count_sum", LongType())])
    fields = to_arrow_schema(schema)

    def run(rows: pa.Table, known: pa.Table) -> pa.Table:
        is_doc = pc.is_null(rows["pair"])
        docs, postings = rows.filter(is_doc), rows.filter(pc.invert(is_doc))
        pair, n, best_of = (known[c].to_numpy() for c in ("of_pair", "n", "best"))
        order = np.argsort(pair)
        best, total = np.zeros((2, CHUNK_DOCS), np.int64)
        for batch in postings.to_batches():
            if not batch.num_rows:
                continue
            blob = batch.column("docs")
            offsets = np.frombuffer(blob.buffers()[1], np.int32)[blob.offset : blob.offset + len(blob) + 1]
            row, doc = members(np.frombuffer(blob.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], np.diff(offsets))
            at = order[np.searchsorted(pair, batch.column("pair").to_numpy(), sorter=order)]
            times = np.array([weight(p) for p in batch.column("plane").to_pylist()], np.int64)
            np.add.at(total, doc, (times * n[at])[row])
            np.add.at(best, doc, (times * best_of[at])[row])
        place = docs["place"].to_numpy()
        columns = [*[docs[c] for c in figures], pa.array(best[place], pa.int64()), pa.array(total[place], pa.int64())]
        return pa.Table.from_arrays([c.cast(f.type) for c, f in zip(columns, fields, strict=True)], schema=fields)

    return chunks.groupBy("chunk").cogroup(scores.groupBy("of_chunk")).applyInArrow(run, schema)


def align_tokenizers(
    spark: SparkSession,
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    a_path: str = BYTE_BPE,
    b_path: str = PIECE_BPE,
    texts: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Documents and pairs of two tokenizers, A byte-level BPE and B a piece model with byte fallback.

    Documents: ``id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum``, a row for each row of ``docs``. ``groups`` is
    ``a1,a2|b1;a3|b2``, or with ``texts=False`` its sha256. ``n_best``: links whose pair is in the most documents among the pairs of its A id, ties
    included. ``count_sum``: over all links, the documents that hold the pair. Pairs: ``a_id, b_id, n_docs, n_links``.

    A missing or empty text, one that is no UTF-8, and one that either tokenizer changes have no tokens: all figures are 0 and ``groups``
    is empty. Special tokens in a text are plain text. Rows that repeat, also in their id, are a document each. Long texts stay whole. An empty
    table gives no rows. Other columns are not read, whatever their names. The files are read by the driver and sent to the tasks.
    """
    shared = Shared(spark)
    files = []
    for path in (a_path, b_path):
        with open(path, "rb") as f:
            files.append(f.read())
    b_size = len(load(files[1]).spelling.size)
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("binary").alias("text"))
    chunks = shared.cut(_chunks(rows, spark.sparkContext.broadcast(files), texts), "chunks")
    bitmap = chunks.where("pair is not null").select("chunk", "pair", "plane", "n_docs", "docs")
    times = F.expr("shiftleft(1L, greatest(plane - 1, 0))")
    pairs = bitmap.groupBy("pair").agg(F.sum(F.when(F.col("plane") == 0, F.col("n_docs"))).alias("n"), F.sum(F.col("n_docs") * times).alias("n_links"))
    pairs = shared.cut(pairs.withColumn("a_id", F.expr(f"pair div {b_size}")), "pairs")
    # a row for each id of A: bounded by its vocabulary
    most = pairs.groupBy(F.col("a_id").alias("of")).agg(F.max("n").alias("most"))
    scores = pairs.join(F.broadcast(most), F.col("a_id") == F.col("of")).select(F.col("pair").alias("of_pair"), "n", (F.col("n") == F.col("most")).cast("long").alias("best"))
    # only numbers go by pair; the bitmaps move once, with the documents of their chunk
    held = bitmap.where("plane = 0").select(F.col("chunk").alias("of_chunk"), F.col("pair").alias("held"))
    scored = held.join(scores, F.col("held") == F.col("of_pair")).select("of_chunk", "of_pair", "n", "best")
    return _returned(chunks, scored), pairs.selectExpr("a_id", f"pair % {b_size} as b_id", "n as n_docs", "n_links")
