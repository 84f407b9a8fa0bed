"""JSON pages and tables written from the views, for the queries that read landed files."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from markbook.session import scratch_dir

from .views import RESULTS_FROM, Views, achieved, coding_number, described, possible, standard_set

PAGE_SIZE = 1000
# Landed text is mostly field names, so it lands compressed. A compressed file is read by one task, so a file of bare records is kept short.
LANDED = {"compression": "gzip"}
FILE_RECORDS = 50_000


def envelopes(rows: DataFrame, size: int = PAGE_SIZE, page: Column | None = None, **stated: int) -> DataFrame:
    """``value``: envelopes of up to ``size`` records as JSON lines, put together by the task that has the rows, in their order.

    Rows are not shuffled and a task holds less than ``size`` records a page. ``page`` numbers the pages; those lines are parts of their page, each with
    a number of its own. ``stated`` stands in every envelope.
    """
    tail = "".join(f",{json.dumps(k)}:{v:d}" for k, v in stated.items())
    numbered = page is not None

    def joined(batches):
        held: dict[int | None, list[str]] = {}
        part = (TaskContext.get().partitionId() << 32) - 1

        def line(number, records):
            nonlocal part
            part += 1
            named = f',"page":{number:d},"part":{part}' if numbered else ""
            return f'{{"results":[{",".join(records)}]{named}{tail}}}'

        for batch in batches:
            lines = []
            if numbered:
                for number, record in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    records = held.setdefault(number, [])
                    records.append(record)
                    if len(records) == size:
                        lines.append(line(number, held.pop(number)))
            else:
                # a whole batch at once
                records = held.pop(None, []) + batch.column(1).to_pylist()
                whole = len(records) // size * size
                lines += [line(None, records[i : i + size]) for i in range(0, whole, size)]
                if whole < len(records):
                    held[None] = records[whole:]
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])
        for number, records in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([line(number, records)], pa.string())], ["value"])

    number = page if numbered else F.lit(None)
    return rows.select(number.cast("int").alias("page"), F.to_json(F.struct(*rows.columns)).alias("record")).mapInArrow(joined, "value string")


def write_envelopes(lines: DataFrame, path: str, mode: str = "error") -> None:
    """Files of at most ``FILE_RECORDS`` records, whose names are in the order of the lines."""
    lines.write.mode(mode).options(**LANDED, maxRecordsPerFile=FILE_RECORDS // PAGE_SIZE).text(path)


def land_pages(rows: DataFrame, page_size: int = PAGE_SIZE) -> str:
    """Write rows as envelopes of up to ``page_size`` records, one per line."""
    path = scratch_dir(rows.sparkSession)
    total = rows.count()
    write_envelopes(envelopes(rows, page_size, num_pages=total // page_size + 1, num_results=total), path)
    return path


def land_documents(rows: DataFrame) -> str:
    path = scratch_dir(rows.sparkSession)
    rows.write.options(**LANDED, maxRecordsPerFile=FILE_RECORDS).json(path)
    return path


# One nested detail document per part: band sets with bands, questions with choices and standards.
_DETAIL_DOCUMENTS = """
SELECT CAST(p_partkey AS INT) AS assessment_id,
  transform(sequence(1, 1 + p_size % 2), s -> named_struct('bands',
    transform(sequence(1, 3), b -> named_struct(
      'name', 'Band ' || b, 'min_score', CAST((b - 1) * 10 * s AS DECIMAL(10,2)),
      'max_score', CAST(b * 10 * s AS DECIMAL(10,2)), 'color', CASE WHEN b < 3 THEN 'c' || b END))))
    AS performance_band_sets,
  transform(sequence(1, 1 + p_size % 4), q -> named_struct(
    'question_number', q, 'question_text', 'Question ' || q || ' of ' || p_partkey,
    'question_type', CASE WHEN q % 2 = 0 THEN 'MC' ELSE 'CR' END, 'max_points', CAST(q AS DECIMAL(10,2)),
    'correct_answer', CASE WHEN q % 2 = 0 THEN 'A' END,
    'answer_choices', CASE WHEN q % 2 = 0 THEN transform(sequence(1, 3), c -> named_struct(
      'letter', 'L' || c, 'text', 'Choice ' || c, 'is_correct', CASE WHEN c = 1 THEN true END)) END,
    'standards', transform(sequence(1, 1 + q % 2), s -> named_struct(
      'standard_id', CAST((p_partkey + q + s) % 11 AS INT), 'code', 'C' || (p_partkey + q + s) % 11,
      'description', 'D' || p_partkey, 'subject', CASE WHEN s = 1 THEN 'Math' END, 'grade_level', 'G' || q))))
    AS questions
FROM {parts}
"""
# A document is a hundred times as long as its part, so the parts are spread first, by their number.
TASK_PARTS = 20_000


def detail_documents(v: Views) -> DataFrame:
    tasks = -(-v.part.count() // TASK_PARTS)
    spread = f"(SELECT /*+ REPARTITION({tasks}) */ p_partkey, p_size FROM part)"
    return v.sql(_DETAIL_DOCUMENTS.format(parts=spread if tasks > 1 else "part"))


# The same content as flat rows, for DuckDB.
FLAT_BANDS = """
SELECT CAST(p_partkey AS INT) AS assessment_id, 'Band ' || b AS band_name,
       CAST((b - 1) * 10 * s AS DECIMAL(10,2)) AS min_score, CAST(b * 10 * s AS DECIMAL(10,2)) AS max_score,
       CASE WHEN b < 3 THEN 'c' || b END AS color
FROM (SELECT *, unnest(range(1, 4)) AS b FROM (SELECT *, unnest(range(1, 2 + p_size % 2)) AS s FROM part))
"""
FLAT_QUESTIONS = """
SELECT CAST(p_partkey AS INT) AS assessment_id, CAST(q AS INT) AS question_number,
       'Question ' || q || ' of ' || p_partkey AS question_text,
       CASE WHEN q % 2 = 0 THEN 'MC' ELSE 'CR' END AS question_type, CAST(q AS DECIMAL(10,2)) AS max_points,
       CASE WHEN q % 2 = 0 THEN 'A' END AS correct_answer
FROM (SELECT *, unnest(range(1, 2 + p_size % 4)) AS q FROM part)
"""
FLAT_CHOICES = """
SELECT CAST(p_partkey AS INT) AS assessment_id, CAST(q AS INT) AS question_number, 'L' || c AS choice_letter,
       'Choice ' || c AS choice_text, c = 1 AS is_correct
FROM (SELECT *, unnest(range(1, 4)) AS c FROM (SELECT *, unnest(range(1, 2 + p_size % 4)) AS q FROM part) WHERE q % 2 = 0)
"""
FLAT_QUESTION_STANDARDS = """
SELECT CAST(p_partkey AS INT) AS assessment_id, CAST(q AS INT) AS question_number,
       CAST((p_partkey + q + s) % 11 AS INT) AS standard_id, 'C' || (p_partkey + q + s) % 11 AS standard_code,
       'D' || p_partkey AS standard_description, CASE WHEN s = 1 THEN 'Math' END AS subject, 'G' || q AS grade_level
FROM (SELECT *, unnest(range(1, 2 + q % 2)) AS s FROM (SELECT *, unnest(range(1, 2 + p_size % 4)) AS q FROM part))
WHERE (p_partkey + q + s) % 11 <> 0
"""

# One nested record per student, assessment and date. Odd students carry 'standards', others
# 'standard_results' under the alternative names; students divisible by 9 carry neither.
# Rows meet as the few numbers that their texts are made of, once for both lists.
_HELD = "collect_list(named_struct('s', l_suppkey, 'n', l_linenumber, 'q', l_quantity))"
_SUM = "aggregate(filter(transform(held, x -> {points}), p -> p IS NOT NULL), CAST(NULL AS DECIMAL(20,2)), (a, p) -> CAST(coalesce(a, 0) + p AS DECIMAL(20,2)))"
NESTED_RECORDS = f"""
SELECT 'D' AS district_name, '' AS school_name, 'Site ' || CAST(grp AS STRING) AS site_name,
       CASE WHEN grp % 2 = 0 THEN 'S' || CAST(grp AS STRING) ELSE '' END AS state_student_id,
       'alt' || CAST(grp AS STRING) AS sasid, '' AS local_student_id,
       CASE WHEN grp % 3 = 0 THEN '' ELSE CAST(grp AS STRING) END AS lasid, 'x' || CAST(grp AS STRING) AS student_id,
       CASE WHEN grp % 2 = 0 THEN 'math' END AS subject, 'by name' AS subject_name,
       CAST(AssessmentID AS INT) AS assessment_id, CAST(DateCompleted AS STRING) AS date_completed,
       '2001-01-01' AS test_date, CAST(0 AS INT) AS school_id, CAST(grp % 40 AS INT) AS site_id, 'Set' AS standard_set,
       CAST(size(held) % 3 AS DECIMAL(10,2)) AS overall_score,
       CAST(CASE WHEN size(held) % 2 = 0 THEN 0 ELSE {_SUM.format(points=achieved('x.q'))} END AS DECIMAL(10,2)) AS points_achieved,
       CAST(CASE WHEN grp % 4 = 0 THEN 0 ELSE 7 END AS DECIMAL(10,2)) AS total_score,
       CAST(3 AS DECIMAL(10,2)) AS raw_score,
       CAST(CASE WHEN size(held) % 2 = 0 THEN NULL ELSE 0 END AS DECIMAL(10,2)) AS points_possible,
       CAST({_SUM.format(points=possible('x.n'))} AS DECIMAL(10,2)) AS max_score,
       CASE WHEN grp % 2 = 1 AND grp % 9 <> 0 THEN
         transform(held, x -> named_struct('standard_set', {standard_set('x.s')}, 'standard_code', {coding_number('x.s', 'x.n')},
           'description', {described('x.s', 'x.n')}, 'points_achieved', {achieved('x.q')}, 'points_possible', {possible('x.n')}))
         ELSE array() END AS standards,
       CASE WHEN grp % 2 = 0 AND grp % 9 <> 0 THEN
         transform(held, x -> named_struct('set_name', {standard_set('x.s')}, 'code', {coding_number('x.s', 'x.n')},
           'standard_description', {described('x.s', 'x.n')}, 'score', {achieved('x.q')}, 'max_score', {possible('x.n')}))
         END AS standard_results
FROM (
  SELECT grp, AssessmentID, DateCompleted, {_HELD} AS held
  FROM (SELECT /*+ REPARTITION(grp, AssessmentID, DateCompleted) */ CAST(c_custkey AS BIGINT) AS grp,
               CASE WHEN l_partkey % 151 = 0 THEN NULL ELSE CAST(l_partkey % 150 AS INT) END AS AssessmentID,
               CAST(l_shipdate AS DATE) AS DateCompleted, l_suppkey, l_linenumber, l_quantity
        {RESULTS_FROM})
  GROUP BY grp, AssessmentID, DateCompleted)
"""

# Parent fields of those records, for DuckDB; the aggregates are repeated from above.
FLAT_PARENTS = """
SELECT StudentID_LASID AS LASID0, AssessmentID, DateCompleted, CAST(StudentID_LASID AS BIGINT) AS grp,
       COUNT(*) AS n, SUM(PointsAchieved) AS a, SUM(PointsPossible) AS p
FROM results_base GROUP BY StudentID_LASID, AssessmentID, DateCompleted
"""
