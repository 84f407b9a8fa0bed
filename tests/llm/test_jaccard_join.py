import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from markbook.llm import hashing
from markbook.llm import jaccard_join as jj
from markbook.llm.queries import QUERIES

from .helpers import edited_copies, groups, shingles

SF = "/root/testdata/sf0.001"


def brute(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    links = [
        (a, b)
        for a, b in itertools.combinations(sorted(sets), 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    return sets, groups(links, sets)


def check(rows, texts):
    sets, roots = brute(texts)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == {i: (len(sets[i]), roots[i]) for i in texts}


@pytest.mark.parametrize("wide", [None, {0: 1, 1: 2, 2: 3, 3: 3}])
def test_equals_brute_force(spark, wide):
    """Both ways of indexing: plain segments, and some with their one-deletion neighbourhood."""
    texts = dict(enumerate(edited_copies(1) + ["a", "a b", "a b c d e", "a b c d e f", "A  b\tC d e f"]))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    check(jj.ngram_jaccard_join(spark, docs, wide_of=wide).collect(), texts)


def test_many_alike_texts_that_do_not_link(spark):
    """Copies further apart than 3/4 of one text, among others that link."""
    rng = np.random.default_rng(3)
    base = [f"b{i}" for i in range(80)]
    texts = {}
    for i in range(60):
        text = list(base)
        for at in rng.choice(80, int(rng.integers(1, 7)), replace=False):
            text[at] = f"x{i}.{at}"
        texts[i] = " ".join(text)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    check(jj.ngram_jaccard_join(spark, docs).collect(), texts)


def test_query_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    check(QUERIES["op1_ngram_jaccard_join"](spark, SF).collect(), texts)


def test_odd_rows(spark):
    """Missing ids and texts, repeated rows, clashing names, an empty table."""
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(3, long), (3, long), (None, long), (1, None), (2, ""), (4, " \n "), (5, "x"), (5, "y"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.withColumns({c: F.lit(7) for c in ("set_id", "size", "key", "doc", "members", "component_id")})
    out = jj.ngram_jaccard_join(spark, docs).collect()
    found = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=str)
    want = [(3, 29996, 3)] * 2 + [(None, 29996, 3), (1, 0, 1), (2, 0, 2), (4, 0, 4), (5, 1, 5), (5, 1, 5), (None, 0, None)]
    assert found == sorted(want, key=str)
    assert jj.ngram_jaccard_join(spark, docs.limit(0)).collect() == []


def test_keep_one_of_each(spark):
    rows = [(2, "a b c d e f", 1), (1, "a b c d e f", 2), (3, "other", 3), (3, "other", 3), (4, None, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component long")
    kept = jj.keep_one_of_each(spark, docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4]


def test_keep_one_by_row_and_not_by_id(spark):
    """Rows that share an id but not the text, and groups without any id."""
    a, b, c, d, e = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcde")
    rows = [
        (1, a), (1, b), (2, b + " more"), (3, c), (3, a),  # an id with two groups; b's copy goes, and a's under id 3
        (None, c), (None, d), (None, d), (None, d + " more"), (None, e), (None, None), (None, " "), (None, " "), (4, ""), (4, None),
    ]
    kept = jj.keep_one_of_each(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    found = sorted(((r.doc_id, r.text) for r in kept if r.text not in (d, d + " more")), key=str)
    want = [(1, a), (1, b), (3, c), (None, e), (None, None), (None, " "), (None, " "), (4, ""), (4, None)]
    assert found == sorted(want, key=str)
    assert sum(r.text in (d, d + " more") for r in kept) == 1


def test_sketch_never_exceeds_difference():
    rng = np.random.default_rng(5)
    for _ in range(50):
        common = rng.integers(0, 1 << 63, int(rng.integers(1, 300))).astype(np.uint64)
        a = np.unique(np.r_[common, rng.integers(0, 1 << 63, int(rng.integers(0, 80))).astype(np.uint64)])
        b = np.unique(np.r_[common, rng.integers(0, 1 << 63, int(rng.integers(0, 500))).astype(np.uint64)])
        if len(np.setxor1d(a, b)) <= jj.difference(len(a), len(b)):
            assert jj.may_link(jj.parity_sketch(a), len(a), jj.parity_sketch(b), len(b))


def test_allocation_grows_with_the_bands():
    assert set(jj.allocate({0: 10.0, 3: 1e6})) == set(range(5))
    assert jj.allocate({}) == {0: 0, 1: jj.allocate({})[1]}


def test_word_hashes():
    h = hashing.word_hashes
    assert h(None).size == h("").size == h(" \t\n").size == 0
    assert (h("The cat x") == h("THE \v cat X")).all()
    assert len(set(h(" ".join(f"w{i}" for i in range(100_000))).tolist())) == 100_000
    assert h("ab a b ba")[0] != h("ba")[0]
