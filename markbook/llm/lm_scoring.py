"""LM scoring by prediction by partial matching over bytes.

A text is its words in lower case (A-Z) with one space between them, and one end. Each byte is predicted from the ``ORDER`` bytes before
it, across words; before a text stand ends. A byte that followed its context in training has its share of what followed (count over
total plus distinct followers). One that never did costs an escape (distinct over total plus distinct) and is looked for in the next shorter
context, whose counts leave out the bytes that the longer ones have ruled out (symbol exclusion). Below order 0 the bytes left are alike.
Counts are of all occurrences in all training documents.

Each task packs its texts into chunks and counts the runs of context and byte, and the words, of a chunk. Counts are added up by run; contexts,
escapes and shorter contexts are aggregates and joins over the distinct runs. Each chunk then gets the probabilities of its own
runs by a join, and its texts are scored where they meet. So no task holds more of the model than its chunk needs, and the driver holds none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import hashing
from .frames import Shared, crc_mod
from .ppm_language import Table

ORDER = 5
# Bytes of text in a chunk, and texts scored together; one longer text is a chunk by itself.
CHUNK_BYTES, BLOCK_BYTES = 32 << 20, 512 << 10
# Keys of blocks that a task holds before it adds them up.
HELD_KEYS = 2_000_000
_END = b"\n"  # stands for the end of a text, which no word holds
_END_WORD = -1
_BLOCK = "chunk long, doc array<long>, learn array<boolean>, sizes array<int>, words array<int>, data binary"
_KEY = "key long, n long"


def normal(text: str | None) -> bytes:
    return b" ".join((text or "").encode("utf-8", "surrogatepass").translate(hashing.LOWER).split())


def runs_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The run of context and byte at each byte and end of the texts, and the first place of each text."""
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    data = np.frombuffer(_END * ORDER + b"".join(t + _END * (ORDER + 1) for t in texts), np.uint8).astype(np.uint64)
    keys = np.zeros(len(data) - ORDER, np.uint64)
    for back in range(ORDER, -1, -1):
        keys = (keys << np.uint64(8)) | data[ORDER - back : len(data) - back]
    # behind each text stand the ends that come before the next one
    first = np.cumsum(sizes + ORDER) - sizes - ORDER
    own = np.ones(len(keys), bool)
    for j in range(ORDER):
        own[first + sizes + j] = False
    return keys[own], np.cumsum(sizes) - sizes


def words_of(texts: list[bytes]) -> np.ndarray:
    """A negative number for each word, so that words and runs are told apart; ``_END_WORD`` is the end of a text."""
    hashes = hashing.word_hashes(b" ".join(texts).decode("utf-8", "surrogatepass"))
    return np.minimum((hashes | np.uint64(1 << 63)).view(np.int64), _END_WORD - 1)


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(every, kind="stable")
    every, n = every[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
    return every[first], np.add.reduceat(n, first)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of normalised texts by chunk, and after them the chunk's keys with their number in training texts."""
    from pyspark import TaskContext

    types = {"chunk": pa.int64(), "doc": pa.list_(pa.int64()), "learn": pa.list_(pa.bool_()), "sizes": pa.list_(pa.int32()), "words": pa.list_(pa.int32()), "data": pa.binary(), "key": pa.int64(), "n": pa.int64()}
    chunk, held, keys, counts, ends = TaskContext.get().partitionId() << 32, 0, [], [], 0

    def rows(n: int, given: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(given[c], t) if c in given else pa.nulls(n, t) for c, t in types.items()], list(types))

    def block(docs: list[tuple[int | None, bool, bytes]]) -> pa.RecordBatch:
        nonlocal ends
        for learn in (True, False):
            own = [t for _, flag, t in docs if flag == learn]
            if own:
                for found in (runs_of(own)[0].view(np.int64), words_of(own)):
                    each, n = np.unique(found, return_counts=True)
                    keys.append(each)
                    counts.append(n if learn else np.zeros(len(each), np.int64))
                ends += len(own) * learn
        if sum(map(len, keys)) > HELD_KEYS + len(keys[0]):
            keys[:], counts[:] = ([x] for x in _summed(keys, counts))
        texts = [t for _, _, t in docs]
        data = pa.compress(b"".join(texts), codec="zstd", asbytes=True)
        given = {"chunk": [chunk], "doc": [[d for d, _, _ in docs]], "learn": [[f for _, f, _ in docs]], "sizes": [[len(t) for t in texts]], "words": [[t.count(b" ") + bool(t) for t in texts]], "data": [data]}
        return rows(1, given)

    def flush() -> Iterator[pa.RecordBatch]:
        keys.append(np.array([_END_WORD]))
        counts.append(np.array([ends]))
        every, n = _summed(keys, counts)
        for lo in range(0, len(every), 200_000):
            part = slice(lo, lo + 200_000)
            yield rows(len(every[part]), {"chunk": np.full(len(every[part]), chunk), "key": every[part], "n": n[part]})

    pile, size = [], 0
    for batch in batches:
        for doc, learn, text in zip(batch.column("doc").to_pylist(), batch.column("learn").to_pylist(), batch.column("text"), strict=True):
            data = normal(text.as_py())
            if pile and size + len(data) > BLOCK_BYTES:
                yield block(pile)
                held += size
                pile, size = [], 0
                if held + len(data) > CHUNK_BYTES:
                    yield from flush()
                    chunk, held, keys, counts, ends = chunk + 1, 0, [], [], 0
            pile.append((doc, learn, data))
            size += len(data)
    if pile:
        yield block(pile)
    if pile or held:
        yield from flush()


# --- probabilities ------------------------------------------------------------------------------


def _tail(run: Column, size: int) -> Column:
    """The last bytes of a run."""
    return run.bitwiseAND(F.lit((1 << 8 * size) - 1))


def run_probabilities(runs: DataFrame, shared: Shared) -> DataFrame:
    """``key, value``: the log10 probability of the last byte of each run, of ``key, n`` with the number in training texts."""
    seen = runs.where("n > 0").withColumn("context", F.shiftright("key", 8))
    whole = seen.groupBy("context").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("distinct"))
    direct = seen.join(whole, "context").select("key", F.log10(F.col("n") / (F.col("total") + F.col("distinct"))).alias("value"))

    nothing = F.array().cast("array<bigint>")
    left = shared.cut(runs.where("n = 0").select("key", F.lit(0.0).cast("double").alias("value"), nothing.alias("out"), F.lit(False).alias("found")), "new_runs")
    byte = F.col("key").bitwiseAND(F.lit(255))
    for size in range(ORDER, -1, -1):
        # what followed each context of so many bytes, at most 256 bytes each
        ends = seen.groupBy(_tail(F.col("key"), size + 1).alias("run")).agg(F.sum("n").alias("n"))
        followers = ends.groupBy(F.shiftright("run", 8).alias("head")).agg(F.collect_list(F.struct(F.col("run").bitwiseAND(F.lit(255)).alias("b"), "n")).alias("all"))
        met = left.join(followers, _tail(F.shiftright("key", 8), size) == F.col("head"), "left")
        met = met.withColumn("left", F.filter(F.coalesce("all", F.array().cast(followers.schema["all"].dataType)), lambda x: ~F.array_contains("out", x["b"])))
        met = met.withColumns(
            {
                "total": F.aggregate("left", F.lit(0).cast("bigint"), lambda a, x: a + x["n"]) + F.size("left"),
                "own": F.aggregate("left", F.lit(0).cast("bigint"), lambda a, x: a + F.when(x["b"] == byte, x["n"]).otherwise(F.lit(0))),
            }
        )
        open_ = ~F.col("found") & (F.size("left") > 0)
        step = F.log10(F.when(F.col("own") > 0, F.col("own")).otherwise(F.size("left")) / F.col("total"))
        left = met.select(
            "key",
            F.when(open_, F.col("value") + step).otherwise(F.col("value")).alias("value"),
            F.when(open_ & (F.col("own") == 0), F.array_union("out", F.transform("left", lambda x: x["b"]))).otherwise(F.col("out")).alias("out"),
            (F.col("found") | (F.col("own") > 0)).alias("found"),
        )
    alike = F.log10(F.greatest(F.lit(256) - F.size("out"), F.lit(1)))
    return direct.unionByName(left.select("key", F.when(F.col("found"), F.col("value")).otherwise(F.col("value") - alike).alias("value")))


# --- texts --------------------------------------------------------------------------------------


def _score(tokens: int, kinds: int):
    """A row for each text of a chunk, from the chunk's blocks and the values of its keys."""
    schema = "doc_id long, learn boolean, n_tokens long, n_known long, base_score double, score double"
    names = [c.split()[0] for c in schema.split(", ")]
    whole = tokens + 0.1 * (kinds + 1)

    def run(blocks: pa.Table, values: pa.Table) -> pa.Table:
        key, value = values["key"].to_numpy(), values["value"].to_numpy()
        counts = value[key < 0]
        model, logs = Table(key[key >= 0].view(np.uint64)), value[key >= 0]
        lexicon, known, base = Table(key[key < 0].view(np.uint64)), counts > 0, np.log10((counts + 0.1) / whole)
        end = lexicon.find(np.array([_END_WORD]).view(np.uint64))[0]
        columns: list[list] = [[] for _ in names]
        for row in blocks.to_pylist():
            sizes = row["sizes"]
            data = pa.decompress(row["data"], decompressed_size=sum(sizes), codec="zstd", asbytes=True)
            stops = np.cumsum(sizes).tolist()
            texts = [data[stop - size : stop] for stop, size in zip(stops, sizes, strict=True)]
            keys, first = runs_of(texts)
            score = np.add.reduceat(logs[model.find(keys)], first)
            each = lexicon.find(words_of(texts).view(np.uint64))
            upto = np.concatenate([[0], np.cumsum(row["words"])])
            sums = [np.concatenate([[0.0], np.cumsum(x[each])]) for x in (known, base)]
            n_known, plain = (s[upto[1:]] - s[upto[:-1]] for s in sums)
            found = [row["doc"], row["learn"], np.array(row["words"]) + 1, (n_known + known[end]).astype(np.int64), plain + base[end], score]
            for column, part in zip(columns, found, strict=True):
                column += list(part)
        types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return run, schema


def score_documents(spark: SparkSession, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", folds: tuple[int, int] = (10, 0)) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``, a row for each input row.

    Learns from rows whose crc32 of the id modulo ``folds[0]`` is not ``folds[1]``; rows without id are not learned from and not
    held out. A missing or empty text has one token, its end. ``base_score`` is the smoothed unigram score, ``score`` the log10
    probability of the text's bytes and end. Without training rows every base term is log10 of 1, and bytes are alike. Rows that repeat are
    a text each. An empty table gives no rows. Other columns are ignored, whatever their names.
    """
    shared = Shared(spark)
    fold = crc_mod(id_column, folds[0])
    texts = docs.select(F.col(id_column).cast("long").alias("doc"), F.col(text_column).alias("text"), F.coalesce(fold != folds[1], F.lit(False)).alias("learn"))
    chunks = shared.cut(texts.mapInArrow(_chunks, f"{_BLOCK}, {_KEY}"), "chunks", "zstd")
    held = chunks.where("key is not null").select("chunk", "key", "n")
    counted = shared.cut(held.groupBy("key").agg(F.sum("n").alias("n")), "counted", "zstd")
    tokens, kinds = counted.where("key < 0 and n > 0").agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    words = counted.where("key < 0").select("key", F.col("n").cast("double").alias("value"))
    values = shared.cut(run_probabilities(counted.where("key >= 0"), shared).unionByName(words), "values", "zstd")
    shared.drop(counted)
    # each chunk's keys with their values: what a task needs of the model
    own = held.select(F.col("chunk").alias("of_chunk"), "key").join(values, "key")
    blocks = chunks.where("key is null").select("chunk", "doc", "learn", "sizes", "words", "data")
    run, schema = _score(tokens, kinds)
    scored = blocks.groupBy("chunk").cogroup(own.groupBy("of_chunk")).applyInArrow(run, schema)
    held_out = F.coalesce(crc_mod("doc_id", folds[0]) == folds[1], F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")
