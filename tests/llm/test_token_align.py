"""The operator against alignments made token by token."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from markbook.llm import token_align as ta


@pytest.fixture(scope="module")
def tokenizers():
    return tuple(ta.load(open(path, "rb").read()) for path in (ta.BYTE_BPE, ta.PIECE_BPE))


def spans(ids, spelling):
    at = 0
    for i in ids:
        piece = bytes(spelling.flat[spelling.start[i] : spelling.start[i] + spelling.size[i]])
        yield int(i), at, at + len(piece), piece
        at += len(piece)


def aligned(text, a_tokens, b_tokens):
    """Ids, groups and links of one text by comparing all token spans; None where a tokenizer changes it."""
    if not text:
        return None
    a = list(spans(a_tokens.slow.encode(" " + text, add_special_tokens=False).ids, a_tokens.spelling))
    b = list(spans(b_tokens.model.encode(text), b_tokens.spelling))
    want = (" " + text).encode()
    if b"".join(x[3] for x in a) != want or b"".join(x[3] for x in b) != want:
        return None
    links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
    ends = sorted({x[2] for x in a} & {y[2] for y in b})
    groups, start = [], 0
    for end in ends:
        side = lambda tokens: ",".join(str(t[0]) for t in tokens if start < t[2] <= end)  # noqa: B023, E731
        groups.append(f"{side(a)}|{side(b)}")
        start = end
    return len(a), len(b), ";".join(groups), links


TEXTS = [
    (0, "The quick brown fox jumps over the lazy dog"),
    (1, "The quick brown fox jumps over the lazy dog"),
    (2, None),
    (3, ""),
    (4, " leading and  double spaces \n\ttabs\r\n"),
    (5, "日本語のテキスト, naïve café — “quotes”"),
    (6, "<|endoftext|> <s> </s> <0x41> <unk>"),
    (7, "holds a piece mark ▁ of its own"),
    (8, "\x00\x01 odd bytes \x7f"),
    (9, "word " * 3000),
    (None, "a text without an id"),
    (1, "another text under an id that is there"),
    (11, "🙂🙃 emoji 𝔘𝔫𝔦𝔠𝔬𝔡𝔢"),
]


def expected(texts, tokenizers):
    per = [aligned(t, *tokenizers) for _, t in texts]
    count = Counter(pair for p in per if p for pair in set(p[3]))
    top = defaultdict(int)
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    out = []
    for (i, _), p in zip(texts, per, strict=True):
        if p is None:
            out.append((i, 0, 0, 0, 0, "", 0, 0))
        else:
            n_a, n_b, groups, links = p
            best = sum(count[x] == top[x[0]] for x in links)
            out.append((i, n_a, n_b, groups.count(";") + 1, len(links), groups, best, sum(count[x] for x in links)))
    links = Counter(pair for p in per if p for pair in p[3])
    return out, {pair: (n, links[pair]) for pair, n in count.items()}


def key(row):
    return tuple((x is not None, x) for x in row)


def test_documents_and_pairs_equal_brute_force(spark, tokenizers):
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in TEXTS], "doc_id long, text string, n_links string, pair string").repartition(3)
    found, pairs = ta.align_tokenizers(spark, docs)
    want, want_pairs = expected(TEXTS, tokenizers)
    assert sorted((tuple(r) for r in found.collect()), key=key) == sorted(want, key=key)
    assert {(r.a_id, r.b_id): (r.n_docs, r.n_links) for r in pairs.collect()} == want_pairs
    assert found.columns == ["id", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]


def test_digest_is_that_of_the_groups(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    texts = {(r.id, r.n_a): r.groups for r in ta.align_tokenizers(spark, docs)[0].collect()}
    for r in ta.align_tokenizers(spark, docs, texts=False)[0].collect():
        assert r.groups == (hashlib.sha256(texts[r.id, r.n_a].encode()).hexdigest() if r.n_a else "")


def test_chunks_do_not_change_the_result(spark, tokenizers, monkeypatch):
    """Counts go over all chunks, also where one is full after a few documents."""
    texts = [(i, f"text {i % 7} of the corpus, the {'very ' * (i % 3)}same words") for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    want, _ = expected(texts, tokenizers)
    assert sorted(tuple(r) for r in ta.align_tokenizers(spark, docs)[0].collect()) == sorted(want)


def test_empty_table(spark):
    found, pairs = ta.align_tokenizers(spark, spark.createDataFrame([], "doc_id long, text string"))
    assert found.collect() == [] and pairs.collect() == []


def test_bitmaps_and_planes():
    rng = np.random.default_rng(0)
    entries = sorted({(int(p), int(d)) for p, d in zip(rng.integers(9, size=900), rng.integers(1 << 16, size=900), strict=True)} | {(3, d) for d in range(2000)})
    pair, doc = (np.array(x) for x in zip(*entries, strict=True))
    often = rng.integers(1, 12, size=len(pair))
    total = Counter()
    for plane, held in ta.planes(pair << 16 | doc, often):
        pairs, count, records, ends = ta.bitmaps(held >> 16, held & 0xFFFF)
        row, members = ta.members(records.reshape(-1), np.diff(np.concatenate([[0], ends])))
        assert count.tolist() == np.bincount(row, minlength=len(pairs)).tolist()
        for r, d in zip(row.tolist(), members.tolist(), strict=True):
            total[int(pairs[r]), d] += ta.weight(plane)
    assert total == Counter({(int(p), int(d)): int(n) for p, d, n in zip(pair, doc, often, strict=True)})


def test_both_encoders_give_the_same_ids(tokenizers):
    """The rank encoder stands in for the merges of the file, over spaces, scripts and long runs."""
    byte_bpe = tokenizers[0]
    assert byte_bpe.fast is not None
    rng = np.random.default_rng(1)
    pieces = ["a", "the ", "  ", "\n", "\t", "'s", "'ll", "é", "日本", " ", "​", " ", "1", "99", "!!", "\r\n", "zz", "Ω", "ß", "<|endoftext|>"]
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000][::37]
    texts = ["".join(rng.choice(pieces, 100)) for _ in range(100)] + ["".join(f"a{chr(c)}b {chr(c)}1" for c in points[k : k + 300]) for k in range(0, len(points), 300)]
    texts += [" " * 50_000, "a" * 50_000, "日" * 20_000]
    for text in texts:
        assert byte_bpe._one(text).tolist() == byte_bpe.slow.encode(text, add_special_tokens=False).ids


def test_long_texts_take_the_other_encoder(tokenizers, monkeypatch):
    text = "a long text of many words " * 50
    short = tokenizers[0]._one(text).tolist()
    monkeypatch.setattr(ta, "LONG_TEXT", 10)
    assert tokenizers[0]._one(text).tolist() == short
