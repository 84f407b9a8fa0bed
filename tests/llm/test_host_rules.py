"""Counts against plain Python, verdicts against the formulas by hand."""

import random
import re
from collections import Counter

import pytest

from markbook.llm import host_rules as hr

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in hr.SYMBOLS for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_lines": len(lines),
        "base_failed": len(words) < 10 or 100 * len(covered) > 20 * len(words),
    }


def made_texts(n=150):
    rng = random.Random(4)
    pieces = ["word", "a", "b", "c", "d", "é", "日本", "#", "|x|", " ", " ", "\x0b", "\x0c", "\r", "\t", "\n", "\n\n", " \n ", "long" * 9, "\x00", "\x1f"]
    out = [None, "", " ", "\n", "one", "a b c d e", "a b c d e a b c d e", "a " * 5000, "a b " * 40 + "z", "w1 w2 w3 w4 w5 x w1 w2 w3 w4 w5 y z q r s"]
    for _ in range(n):
        out.append("".join(rng.choice(pieces) + rng.choice([" ", " ", "  ", "\n", ""]) for _ in range(rng.randrange(60))))
    return out


def test_counts_equal_plain_python(spark):
    texts = made_texts()
    docs = spark.createDataFrame([(i, t, "h") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    got = {r.doc_id: r.asDict() for r in hr.host_rules(spark, docs).collect()}
    for i, text in enumerate(texts):
        want = plain(text)
        assert {k: got[i][k] for k in want} == want, repr(text)


def test_very_long_text(spark):
    """Windows are sorted, not compared pair by pair."""
    text = " ".join(f"w{i % 60000}" for i in range(200000))
    docs = spark.createDataFrame([(1, text, "h")], "doc_id long, text string, source string")
    assert hr.host_rules(spark, docs).first().n_repeat_words == 200000


GOOD = " ".join(f"plain{i}" for i in range(30))
BAD = " ".join(f"|plain| # plain{i}" for i in range(30))


def hosts(spark, spec, good=GOOD):
    """``host: (documents that fail the symbol rule, documents that fail none)``."""
    rows = [(f"{h}-{i}", BAD if i < bad else good, h) for h, (bad, fine) in spec.items() for i in range(bad + fine)]
    return spark.createDataFrame(rows, "doc_id string, text string, source string")


def kept(spark, docs):
    return Counter((r.doc_id.rpartition("-")[0], r.failed_rules, r.kept) for r in hr.host_rules(spark, docs).collect())


def test_verdict_by_host(spark):
    spec = {f"good{i}": (1, 60) for i in range(20)} | {"bad": (95, 5), "strict": (40, 60), "one": (1, 0)}
    got = kept(spark, hosts(spark, spec))
    # clean hosts keep all, also the odd document that fails a rule
    assert got["good0", "symbols", True] == 1 and got["good0", "", True] == 60
    # a host that is nearly all bad goes as a whole
    assert got["bad", "symbols", False] == 95 and got["bad", "", False] == 5
    # one that fails a rule often loses the documents that fail it
    assert got["strict", "symbols", False] == 40 and got["strict", "", True] == 60


def test_rates_by_hand(spark):
    spec = {"a": (2, 8), "b": (9, 1), "c": (5, 45), None: (1, 1)}
    counted = hr.text_counts(hosts(spark, {str(k): v for k, v in spec.items()}), "text")
    got = {r.host: r.rate for r in hr.host_rates(counted, "source").where("rule = 'symbols'").collect()}
    n = {str(k): sum(v) for k, v in spec.items()}
    f = {str(k): v[0] for k, v in spec.items()}
    mean = sum(f.values()) / sum(n.values())
    spread = sum(n[h] * (f[h] / n[h] - mean) ** 2 for h in n)
    between = (spread - len(n) * mean * (1 - mean)) / sum(n.values())
    weight = min(max(mean * (1 - mean) / between - 1, hr.LEAST_WEIGHT), hr.MOST_WEIGHT)
    assert got == pytest.approx({h: (f[h] + weight * mean) / (n[h] + weight) for h in n})


def test_hosts_that_are_alike_keep_their_documents(spark):
    got = kept(spark, hosts(spark, {f"h{i}": (2, 8) for i in range(8)}))
    assert all(k for _, _, k in got)


def test_odd_rows(spark):
    rows = [(1, GOOD, None, "x", True), (1, GOOD, None, "x", True), (None, GOOD, "h", "x", False), (2, None, None, "y", None), (3, "", "h", None, None), (4, GOOD, "h", "z", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_words string, kept boolean")
    got = sorted(((r.doc_id, r.n_words, r.kept) for r in hr.host_rules(spark, docs).collect()), key=str)
    assert got == sorted([(1, 30, True), (1, 30, True), (None, 30, True), (2, 0, False), (3, 0, False), (4, 30, True)], key=str)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert hr.host_rules(spark, docs).collect() == []


def test_no_python_in_the_plan(spark):
    plan = hr.host_rules(spark, hosts(spark, {"a": (1, 3)}))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
