"""Quality rules with a verdict by host, in DataFrame operations alone.

Each document is held against rules of its own text. How many documents of a host fail a rule is counted, and the share is shrunk by a beta
prior that the hosts themselves give (method of moments: the spread of the hosts' shares beyond what chance gives). A host at which
nearly every document fails some rule is rejected as a whole; at a host that fails one rule often, the documents that fail it go. A
host with few documents has little weight against the prior, so one bad document condemns no host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import Shared

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
# A host whose share of documents that fail any rule is at least this goes as a whole.
REJECT_RATE = 0.75
# At a host whose share for one rule is at least this, the documents that fail the rule go.
STRICT_RATE = 0.25
# Bounds of the prior's weight, in documents.
LEAST_WEIGHT, MOST_WEIGHT = 1.0, 10000.0

SYMBOLS = "#*$%&|<>"
_BLANK = "[ \t\n\x0b\x0c\r]"

# Rules over the counts of a document. The first two are those of ``base_failed``.
RULES = {
    "few_words": f"n_words < {MIN_WORDS}",
    "repeats": f"100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words",
    "word_length": "word_chars < 2 * n_words or word_chars > 12 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "same_lines": "10 * n_dup_lines > 3 * n_lines",
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, _BLANK + "+", -1), "")


def text_counts(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with the counts of each text; a missing text counts as an empty one.

    Windows of five words are compared by hash first. Only where a hash occurs twice they are sorted as words, with their places, so
    that equal windows stand side by side; a text of n words costs n log n.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    worded = F.filter(F.split(whole, "\n", -1), lambda x: x.rlike(_BLANK.replace("[", "[^")))
    out = docs.withColumns({"__words": _words(whole), "__lines": worded, "__text": whole})
    at = F.sequence(F.lit(0), F.size("__words") - WINDOW)
    hashed = F.transform(at, lambda i: F.xxhash64(*[F.get("__words", i + j) for j in range(WINDOW)]))
    out = out.withColumns(
        {
            "n_words": F.size("__words").cast("long"),
            "word_chars": F.length(F.array_join("__words", "")).cast("long"),
            "n_symbols": F.when(F.col("__text").rlike(f"[{SYMBOLS}]"), F.length("__text") - F.length(F.translate("__text", SYMBOLS, ""))).otherwise(0).cast("long"),
            "n_lines": F.size("__lines").cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "__hashes": F.when(F.size("__words") >= WINDOW, hashed),
        }
    )
    placed = F.transform(at, lambda i: F.struct(F.array_join(F.slice("__words", i + 1, WINDOW), " ").alias("w"), i.alias("i")))
    repeats = F.size("__hashes") > F.size(F.array_distinct("__hashes"))
    out = out.withColumn("__windows", F.when(repeats, F.sort_array(placed)))
    same = lambda x, j: F.coalesce(F.get("__windows", j)["w"] == x["w"], F.lit(False))
    found = F.filter("__windows", lambda x, j: same(x, j - 1) | same(x, j + 1))
    out = out.withColumn("__starts", F.sort_array(F.transform(found, lambda x: x["i"])))
    # a window covers the words up to the next one that repeats, five at most
    covered = F.transform("__starts", lambda x, j: F.least(F.coalesce(F.get("__starts", j + 1) - x, F.lit(WINDOW)), F.lit(WINDOW)))
    out = out.withColumn("n_repeat_words", F.coalesce(F.aggregate(covered, F.lit(0).cast("long"), lambda a, b: a + b), F.lit(0).cast("long")))
    return out.drop("__words", "__lines", "__text", "__hashes", "__windows", "__starts")


def host_rates(counted: DataFrame, host: str) -> DataFrame:
    """``host, rule, n, failed, rate``: the shrunken share of each host's documents that fail a rule, or any (rule ``any``).

    A row a host and rule; counts are combined before the shuffle, so a host of any size costs a row a task.
    """
    fails = {name: F.expr(rule) for name, rule in RULES.items()}
    fails["any"] = F.expr(" or ".join(f"({rule})" for rule in RULES.values()))
    by_host = counted.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(f"f_{name}") for name, c in fails.items()]
    )
    rows = by_host.select("host", "n", F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"f_{name}").alias("failed")) for name in fails])).alias("r"))
    rows = rows.select("host", "n", "r.rule", "r.failed")
    sums = rows.groupBy("rule").agg(
        F.count(F.lit(1)).alias("hosts"),
        F.sum("n").alias("all_n"),
        F.sum("failed").alias("all_failed"),
        F.sum(F.col("failed") * F.col("failed") / F.col("n")).alias("squares"),
    )
    prior = sums.selectExpr("rule", "all_failed / all_n as mean", "squares - all_failed * all_failed / all_n as spread", "hosts", "all_n")
    between = F.expr("(spread - hosts * mean * (1 - mean)) / all_n")
    weight = F.when(between > 0, F.least(F.greatest(F.expr("mean * (1 - mean)") / between - 1, F.lit(LEAST_WEIGHT)), F.lit(MOST_WEIGHT))).otherwise(F.lit(MOST_WEIGHT))
    prior = prior.select("rule", "mean", weight.alias("weight"))
    # the prior has a row a rule
    return rows.join(F.broadcast(prior), "rule").selectExpr("host", "rule", "n", "failed", "(failed + weight * mean) / (n + weight) as rate")


def host_rules(spark: SparkSession, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", host_column: str = "source") -> DataFrame:
    """``id, counts, n_lines, base_failed, kept, failed_rules, host_rejected``, a row for each row of ``docs``.

    ``base_failed``: fewer than ten words, or more than 20 % of the words in a window of five that occurs twice or more in the
    text. ``kept`` is false for those, for documents of a rejected host, and for documents that fail a rule at a host that
    fails it often. ``failed_rules`` names the rules that the text fails, in order of ``RULES``.

    A missing text has no words, so it fails; so does an empty one. A missing host is a host of its own. Rows that repeat,
    also in their id, are each a document and count as such. An empty table gives no rows. Other columns are not read, whatever their names. Long
    texts stay whole.
    """
    shared = Shared(spark)
    named = docs.select(F.col(id_column).alias("__id"), F.col(host_column).cast("string").alias("__host"), F.col(text_column).alias("__whole"))
    counted = shared.cut(text_counts(named, "__whole").drop("__whole"), "counted")
    rates = host_rates(counted, "__host")
    verdicts = rates.groupBy("host").agg(
        F.bool_or((F.col("rule") == "any") & (F.col("rate") >= REJECT_RATE)).alias("host_rejected"),
        F.collect_set(F.when((F.col("rule") != "any") & (F.col("rate") >= STRICT_RATE), F.col("rule"))).alias("strict"),
    )
    # only hosts with a verdict; written, so that its size is known when the join is planned
    verdicts = shared.cut(verdicts.where(F.col("host_rejected") | (F.size("strict") > 0)), "verdicts")
    joined = counted.join(verdicts, F.col("__host").eqNullSafe(F.col("host")), "left")
    failed = F.array_compact(F.array(*[F.when(F.expr(rule), F.lit(name)) for name, rule in RULES.items()]))
    rejected = F.coalesce("host_rejected", F.lit(False))
    strict = F.coalesce("strict", F.array().cast("array<string>"))
    base = F.expr(f"({RULES['few_words']}) or ({RULES['repeats']})")
    return joined.select(
        F.col("__id").alias(id_column),
        *COUNTS,
        "n_lines",
        base.alias("base_failed"),
        (~base & ~rejected & ~F.arrays_overlap(failed, strict)).alias("kept"),
        F.array_join(failed, ",").alias("failed_rules"),
        rejected.alias("host_rejected"),
    )
