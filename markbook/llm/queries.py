"""Queries of the operators: each reads whole tables, applies its operator and keeps the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from .decontaminate import find_benchmark
from .frames import crc_mod, read
from .host_rules import COUNTS, LEAST_WEIGHT, MAX_REPEAT_PERCENT, MIN_WORDS as LEAST_WORDS, MOST_WEIGHT, REJECT_RATE, RULES, STRICT_RATE, host_rules
from .html_extract import extract_main_text
from .jaccard_join import ngram_jaccard_join
from .line_dedup import MIN_WORDS, line_dedup
from .lm_scoring import score_documents
from .mixing import BLOCK_ROWS, PERIOD, mix_sources
from .passages import repeated_passages
from .ppm_language import identify_language
from .quality import quality_scores
from .token_align import align_tokenizers
from .vector_codes import ENTRIES, PARTS, ROUNDS, SCALE, books_digest, encode_vectors
from .vector_search import nearest_neighbours

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(spark, read(spark, sf_dir, "documents"))


@query
def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_benchmark(spark, read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), min_words=1)


@query
def op3_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(spark, read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source")
    return mix_sources(spark, docs)


ORACLES["op4_source_mixing"] = f"""
WITH RECURSIVE
counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
weighed AS (SELECT source, n, greatest(CAST(floor(sqrt(n) * 1000) AS BIGINT), 1) AS w FROM counts),
totals AS (SELECT count(*) AS k, sum(w)::BIGINT AS all_w, greatest({PERIOD}, 4 * count(*)) AS total FROM weighed),
shares AS (
  SELECT source, n, total, k, ((total - k) * w) // all_w AS part, ((total - k) * w) % all_w AS rest FROM weighed, totals
),
units AS (
  SELECT source, n, total,
    1 + part + (total - k - (SELECT sum(part)::BIGINT FROM shares)) // k
      + CASE WHEN row_number() OVER (ORDER BY rest DESC, source NULLS LAST)
             <= (total - k - (SELECT sum(part)::BIGINT FROM shares)) % k THEN 1 ELSE 0 END AS units,
    row_number() OVER (ORDER BY source NULLS LAST) AS i
  FROM shares
),
list_of AS (SELECT list(units ORDER BY i) AS u, any_value(total) AS total, count(*) AS k FROM units),
runs(t, done, best) AS (
  SELECT CAST(-1 AS BIGINT), list_transform(u, lambda x: CAST(0 AS BIGINT)), CAST(0 AS BIGINT) FROM list_of
  UNION ALL
  SELECT t, list_transform(range(1, k + 1), lambda i: done[i] + CASE WHEN i = best THEN 1 ELSE 0 END), best
  FROM (
    SELECT t + 1 AS t, done, k,
      -- deadline first, then the smaller number
      list_min(list_transform(
        list_filter(range(1, k + 1), lambda i: done[i] < u[i] AND (done[i] * total) // u[i] <= t + 1),
        lambda i: (((done[i] + 1) * total + u[i] - 1) // u[i]) * 1000000 + i)) % 1000000 AS best
    FROM runs, list_of WHERE t + 1 < total
  )
),
slots AS (SELECT best AS i, t AS slot, row_number() OVER (PARTITION BY best ORDER BY t) - 1 AS nth FROM runs WHERE t >= 0),
numbered AS (
  SELECT d.doc_id, d.source, u.units, u.total, u.i,
    row_number() OVER (PARTITION BY u.i ORDER BY md5(coalesce(CAST(d.doc_id AS VARCHAR), '')), d.doc_id) - 1 AS r
  FROM documents d JOIN units u ON d.source IS NOT DISTINCT FROM u.source
),
blocks AS (SELECT *, r // {BLOCK_ROWS} AS b FROM numbered)
SELECT doc_id, b.source, b AS mix_block, (b // units) * total + slot AS mix_slot, r % {BLOCK_ROWS} AS mix_offset,
  (b * total) // units AS mix_release, ((b + 1) * total + units - 1) // units AS mix_deadline
FROM blocks b JOIN slots s ON s.i = b.i AND s.nth = b.b % b.units
"""


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify_language(spark, read(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return found.select("doc_id", F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(spark, read(spark, sf_dir, "documents"))


@query
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_scores(spark, read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return scored.select("doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score", "predicted")


@query
def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    main = extract_main_text(spark, read(spark, sf_dir, "pages"))
    return main.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(spark, docs)


ORACLES["op9_line_dedup"] = f"""
WITH parts AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no
  FROM documents WHERE text IS NOT NULL
),
worded AS (
  SELECT doc_id, line_no, raw,
    list_filter(regexp_split_to_array(translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words
  FROM parts
),
numbered AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS LAST, line_no) AS pos FROM worded),
firsts AS (
  SELECT array_to_string(words, ' ') AS line, any_value(words) AS words, min(pos) AS pos
  FROM numbered WHERE len(words) >= {MIN_WORDS} GROUP BY 1
),
-- a line that lacks its i-th word
variants AS (
  SELECT line, pos, i, array_to_string(list_concat(words[1:i - 1], words[i + 1:]), ' ') AS variant
  FROM (SELECT *, unnest(range(1, len(words) + 1)) AS i FROM firsts)
),
near AS (
  -- another word in one place
  SELECT line FROM (SELECT line, pos, min(pos) OVER (PARTITION BY variant, i) AS least FROM variants) WHERE least < pos
  UNION
  -- one word more than an earlier line
  SELECT v.line FROM variants v JOIN firsts f ON f.line = v.variant WHERE f.pos < v.pos
  UNION
  -- one word fewer
  SELECT f.line FROM variants v JOIN firsts f ON f.line = v.variant WHERE v.pos < f.pos
),
kept AS (
  SELECT n.doc_id, n.line_no, n.raw,
    len(n.words) >= {MIN_WORDS} AND (f.pos < n.pos OR near.line IS NOT NULL) AS gone
  FROM numbered n
  LEFT JOIN firsts f ON f.line = array_to_string(n.words, ' ') AND len(n.words) >= {MIN_WORDS}
  LEFT JOIN near ON near.line = f.line
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
  coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_dropped, 0) AS n_dropped
FROM documents d LEFT JOIN (
  SELECT doc_id, string_agg(raw, chr(10) ORDER BY line_no) FILTER (WHERE NOT gone) AS text,
    count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped
  FROM kept GROUP BY doc_id
) k ON k.doc_id = d.doc_id
"""


@query
def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(spark, read(spark, sf_dir, "documents"))


@query
def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned, _ = align_tokenizers(spark, read(spark, sf_dir, "documents"), texts=False)
    return aligned.withColumnsRenamed({"id": "doc_id", "groups": "groups_sha256"})


@query
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = encode_vectors(spark, read(spark, sf_dir, "embeddings"))
    return coded.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))


def _codes_oracle() -> str:
    """Lloyd rounds by brute force over components, one row each."""
    nearest = """
n{r} AS MATERIALIZED (
  SELECT vec_id, part, min(entry) AS entry, any_value(least) AS d FROM (
    SELECT x.vec_id, x.part, b.entry, sum((x.v - b.v) * (x.v - b.v))::BIGINT AS d, min(d) OVER (PARTITION BY x.vec_id, x.part) AS least
    FROM x JOIN b{r} b USING (part, pos) GROUP BY x.vec_id, x.part, b.entry
  ) WHERE d = least GROUP BY vec_id, part
)"""
    book = """
b{s} AS MATERIALIZED (
  SELECT b.part, b.entry, b.pos, coalesce(m.v, b.v) AS v FROM b{r} b LEFT JOIN (
    SELECT part, entry, pos, ((sum(v) - (((sum(v) % count(*)) + count(*)) % count(*))) // count(*))::BIGINT AS v
    FROM x JOIN n{r} USING (vec_id, part) GROUP BY part, entry, pos
  ) m USING (part, entry, pos)
)"""
    rounds = ",".join(nearest.format(r=r) + "," + book.format(r=r, s=r + 1) for r in range(ROUNDS))
    return f"""
WITH kept AS (
  SELECT vec_id, label, embedding AS e, len(embedding) // {PARTS} AS width FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
),
x AS MATERIALIZED (
  SELECT vec_id, i // width AS part, i % width AS pos, floor(CAST(e[i + 1] AS DOUBLE) * {SCALE})::BIGINT AS v
  FROM (SELECT *, unnest(range(0, width * {PARTS})) AS i FROM kept)
),
b0 AS MATERIALIZED (
  SELECT part, entry, pos, v
  FROM x JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT {ENTRIES}) USING (vec_id)
),{rounds},{nearest.format(r=ROUNDS)},
coded AS (
  SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM n{ROUNDS} GROUP BY vec_id
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM b{ROUNDS}) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)
"""


ORACLES["op12_vector_codes"] = _codes_oracle()


@query
def op13_host_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules(spark, read(spark, sf_dir, "documents"))


_FAILS = ", ".join(f"CASE WHEN {rule} THEN '{name}' END" for name, rule in RULES.items())
ORACLES["op13_host_quality_rules"] = f"""
WITH worded AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM worded)
),
covered AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 5)) AS place FROM windows WHERE (doc_id, w) IN (SELECT doc_id, w FROM windows GROUP BY ALL HAVING count(*) > 1)
  ) GROUP BY doc_id
),
counted AS (
  SELECT doc_id, source, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM worded LEFT JOIN covered USING (doc_id)
),
failing AS (SELECT *, list_filter([{_FAILS}], lambda x: x IS NOT NULL) AS fails FROM counted),
rules AS (SELECT unnest([{', '.join(f"'{name}'" for name in RULES)}, 'any']) AS rule),
hosts AS (
  SELECT source, rule, count(*) AS n, count(*) FILTER (list_contains(fails, rule) OR (rule = 'any' AND len(fails) > 0)) AS failed
  FROM failing CROSS JOIN rules GROUP BY source, rule
),
sums AS (
  SELECT rule, count(*) AS k, sum(n) AS all_n, sum(failed) / sum(n) AS mean,
    sum(failed * failed / n) - sum(failed) * sum(failed) / sum(n) AS spread
  FROM hosts GROUP BY rule
),
prior AS (
  SELECT rule, mean, CASE WHEN tau > 0 THEN least(greatest(mean * (1 - mean) / tau - 1, {LEAST_WEIGHT}), {MOST_WEIGHT}) ELSE {MOST_WEIGHT} END AS weight
  FROM (SELECT *, (spread - k * mean * (1 - mean)) / all_n AS tau FROM sums)
),
rates AS (SELECT source, rule, (failed + weight * mean) / (n + weight) AS rate FROM hosts JOIN prior USING (rule)),
verdicts AS (
  SELECT source, bool_or(rule = 'any' AND rate >= {REJECT_RATE}) AS host_rejected,
    coalesce(list(rule) FILTER (rule <> 'any' AND rate >= {STRICT_RATE}), []) AS strict
  FROM rates GROUP BY source
)
SELECT doc_id, {', '.join(COUNTS)}, n_lines,
  n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
  NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AND NOT host_rejected AND NOT list_has_any(fails, strict) AS kept,
  array_to_string(fails, ',') AS failed_rules, host_rejected
FROM failing f JOIN verdicts v ON f.source IS NOT DISTINCT FROM v.source
"""
