"""Sources, write modes and load jobs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from markbook import schemas
from markbook.functions import scalars as s
from markbook.operators.joins import lookup_join
from markbook.plans import enrichment, summary, weekly
from markbook.session import scratch_dir
from markbook.sources import pages, tables
from markbook.sources import reference_tables as ref

from .landing import detail_documents, envelopes, land_documents, land_pages, write_envelopes
from .registry import query
from .scalar_rules import ASSIGNMENT_SUBJECT
from .views import Views

C = F.col
RAW_COLUMNS = [f.name for f in schemas.DETAIL_RESULT.fields]


def profile(v: Views):
    return enrichment.build_profile(
        v.enrollment, v.sites, v.users, v.roster, v.section_roster, v.subject_map
    )


@query("scan_paged_json", f"SELECT {', '.join(RAW_COLUMNS)} FROM raw_results")
def scan_paged_json(v):
    path = land_pages(v.raw_results)
    sent = pages.read_pages(v.spark, path, schemas.DETAIL_RESULT)
    return sent.withColumns({c: s.safe_decimal(C(c)) for c in ("points", "points_possible")})


@query(
    "scan_sites",
    """SELECT site_id, site_name FROM (
         SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY seq DESC) AS rn FROM site_records
         WHERE site_id <> 0) x WHERE rn = 1""",
)
def scan_sites(v):
    path = land_documents(v.site_records)
    records = pages.read_documents(v.spark, path, StructType([*schemas.SITES.fields, StructField("seq", LongType())]))
    return ref.sites(records, "seq").select("site_id", "site_name")


@query(
    "scan_enrollment",
    """SELECT district_student_id, state_student_id,
              CASE WHEN CAST(grade_level_id AS INT) = 1 THEN 'K' WHEN CAST(grade_level_id AS INT) > 1
                   THEN CAST(CAST(grade_level_id AS INT) - 1 AS VARCHAR) END AS grade,
              CASE WHEN site_id <> 0 THEN site_id END AS site_id, school, district
       FROM (SELECT *, row_number() OVER (PARTITION BY district_student_id ORDER BY seq DESC) AS rn
             FROM enrollment_records) x WHERE rn = 1""",
)
def scan_enrollment(v):
    return ref.enrollment(v.enrollment_records, "seq")


@query(
    "scan_users",
    """SELECT user_id, arg_max(first_name, seq) AS first_name, arg_max(last_name, seq) AS last_name
       FROM user_records GROUP BY user_id""",
)
def scan_users(v):
    return ref.users(v.user_records, "seq")


@query("scan_roster", "SELECT district_student_id, user_id, section_id, grade_level_id, seq FROM roster")
def scan_roster(v):
    return ref.roster(v.roster)


@query(
    "scan_section_roster",
    """SELECT student_id, section_id, teacher_first, teacher_last, subject_area, CAST(NULL AS VARCHAR) AS grade_level,
              content_area, CAST(NULL AS VARCHAR) AS course_name FROM section_roster""",
)
def scan_section_roster(v):
    return ref.section_roster(v.section_roster).drop("seq")


@query(
    "scan_subject_map",
    """SELECT m.subject_area_name, f.sa_code, m.course_id_code,
              row_number() OVER (PARTITION BY m.subject_area_name ORDER BY m.own, m.course_id_code)::INT AS place
       FROM (SELECT subject_area_name, course_id_code, MIN(sa_code) AS own FROM subject_map GROUP BY 1, 2) m
       JOIN (SELECT subject_area_name, MIN(sa_code) AS sa_code FROM subject_map GROUP BY 1) f
         ON m.subject_area_name = f.subject_area_name""",
)
def scan_subject_map(v):
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("subject_area_name").orderBy("priority"))
    return ref.subject_map(v.subject_map).withColumn("place", place).drop("priority")


@query("scan_catalogue", "SELECT * FROM catalogue")
def scan_catalogue(v):
    return ref.catalogue(v.catalogue)


@query(
    "scan_assessment_metadata",
    "SELECT assessment_id, title, name, scope, publisher, subject, subject_name FROM header_records",
)
def scan_assessment_metadata(v):
    return pages.assessment_metadata(v.spark, land_pages(v.header_records))


@query(
    "scan_assessment_detail",
    """SELECT CAST(p_partkey AS INT) AS assessment_id, CAST(1 + p_size % 2 AS INT) AS band_sets,
              CAST(1 + p_size % 4 AS INT) AS questions FROM part""",
)
def scan_assessment_detail(v):
    detail = pages.assessment_detail(v.spark, land_documents(detail_documents(v)))
    return detail.select(
        "assessment_id", F.size("performance_band_sets").alias("band_sets"), F.size("questions").alias("questions")
    )


@query(
    "source_filters",
    """SELECT ResultID, SchoolID, DateCompleted FROM results
       WHERE SchoolID IN (1, 2, 3, 5, 8) AND DateCompleted BETWEEN DATE '1996-01-01' AND DATE '1997-06-30'""",
)
def source_filters(v):
    rows = pages.source_filters(
        v.results,
        F.col("DateCompleted"),
        F.col("SchoolID"),
        [1, 2, 3, 5, 8],
        dt.date(1996, 1, 1),
        dt.date(1997, 6, 30),
    )
    return rows.select("ResultID", "SchoolID", "DateCompleted")


_KINDS = {"result_seq": "bigint", "assessment_id": "bigint", "points": "double", "points_possible": "double"}


@query(
    "discover_schema",
    " UNION ALL ".join(
        f"SELECT '{c}' AS field, '{_KINDS.get(c, 'string')}' AS type, COUNT({c}) / COUNT(*) AS non_null_rate FROM raw_results"
        for c in RAW_COLUMNS
    ),
)
def discover_schema(v):
    return pages.discover_pages(v.spark, land_pages(v.raw_results))


SKETCH = {
    "sets": ["performance_band_sets[] object", "performance_band_sets[].bands array"],
    "bands": ["performance_band_sets[].bands[] object", *[f"performance_band_sets[].bands[].{c}" for c in ("name string", "min_score decimal", "max_score decimal")]],
    "coloured": ["performance_band_sets[].bands[].color string"],
    "parts": ["$ object", "assessment_id bigint", "performance_band_sets array", "questions array"],
    "asked": ["questions[] object", *[f"questions[].{c}" for c in ("question_number bigint", "question_text string", "question_type string", "max_points decimal", "standards array")]],
    "chosen": ["questions[].correct_answer string", "questions[].answer_choices array"],
    "choices": ["questions[].answer_choices[] object", *[f"questions[].answer_choices[].{c}" for c in ("letter string", "text string")]],
    "right_ones": ["questions[].answer_choices[].is_correct boolean"],
    "links": ["questions[].standards[] object", *[f"questions[].standards[].{c}" for c in ("standard_id bigint", "code string", "description string", "grade_level string")]],
    "subjects": ["questions[].standards[].subject string"],
}


@query(
    "schema_sketch",
    """WITH parts AS (SELECT p_size FROM part),
         sets AS (SELECT unnest(range(1, 2 + p_size % 2)) AS s FROM part),
         bands AS (SELECT unnest(range(1, 4)) AS b FROM sets),
         coloured AS (SELECT b FROM bands WHERE b < 3),
         asked AS (SELECT unnest(range(1, 2 + p_size % 4)) AS q FROM part),
         chosen AS (SELECT q FROM asked WHERE q % 2 = 0),
         choices AS (SELECT unnest(range(1, 4)) AS c FROM chosen),
         right_ones AS (SELECT c FROM choices WHERE c = 1),
         links AS (SELECT unnest(range(1, 2 + q % 2)) AS s FROM asked),
         subjects AS (SELECT s FROM links WHERE s = 1)
       """
    + " UNION ALL ".join(
        f"SELECT '{name.split()[0]}' AS field, '{name.split()[1]}' AS type, COUNT(*) AS n FROM {table}"
        for table, names in SKETCH.items()
        for name in names
    ),
)
def schema_sketch(v):
    sketch = pages.schema_sketch(v.spark, land_documents(detail_documents(v)))
    return sketch.groupBy("field", "type").agg(F.sum("n").alias("n"))


PAGE_OF = "cast(result_seq % 64 as int) + 1"
LOST_PAGE = "page % 7 = 3 OR page BETWEEN 20 AND 22"
CUT_RECORD = "page = 2 AND result_seq % 101 = 0"


@query(
    "page_gaps",
    f"""WITH sent AS (SELECT result_seq, CAST(result_seq % 64 AS INT) + 1 AS page FROM raw_results),
         lost AS (SELECT page, row_number() OVER (ORDER BY page) AS i
                  FROM (SELECT unnest(range(1, 65)) AS page) WHERE {LOST_PAGE}),
         runs AS (SELECT MIN(page) AS a, MAX(page) AS b, COUNT(*) AS n FROM lost GROUP BY page - i)
       SELECT 'first' AS request, 'pages' AS kind, CAST(a AS INT) AS first, CAST(b AS INT) AS last, n AS missing,
              CASE WHEN a = b THEN 'page ' || a ELSE 'pages ' || a || '-' || b END || ' of 64' AS detail
       FROM runs
       UNION ALL
       SELECT 'second', 'records', NULL, NULL, COUNT(*) FILTER ({CUT_RECORD}),
              COUNT(*) FILTER (NOT ({CUT_RECORD})) || ' of ' || COUNT(*) || ' records'
       FROM sent""",
)
def page_gaps(v):
    """One request lacks pages, another one records of a page."""
    base = scratch_dir(v.spark)
    sent = v.raw_results.withColumn("page", F.expr(PAGE_OF))
    total = sent.count()
    every = v.spark.range(1, 65).select(F.col("id").cast("int").alias("page"))
    for request, kept in (("first", f"not ({LOST_PAGE})"), ("second", f"not ({CUT_RECORD})")):
        # the pages grow with the table, so each lands in parts; a page without records lands too
        lines = envelopes(sent.where(kept).select(v.raw_results.columns), page=F.expr(PAGE_OF), num_pages=64, num_results=total)
        write_envelopes(lines, f"{base}/{request}")
        landed = every.where(f"not ({LOST_PAGE})") if request == "first" else every
        empty = landed.select("page", F.lit(64).alias("num_pages"), F.lit(total).alias("num_results"))
        write_envelopes(empty.select(F.to_json(F.struct("*")).alias("value")), f"{base}/{request}", "append")
    gaps = pages.page_gaps(pages.landed_pages(v.spark, f"{base}/*"))
    return gaps.withColumn("request", F.regexp_extract("request", "([^/]+)$", 1))


# --- write modes -----------------------------------------------------------------------------------


@query("append_results", "SELECT ResultID, AcademicYear, PointsAchieved, SchoolID FROM results")
def append_results(v):
    path = scratch_dir(v.spark)
    even = F.coalesce(F.col("SchoolID") % 2 == 0, F.lit(False))
    tables.append_results(v.results.where(even), path)
    tables.append_results(v.results.where(~even), path)
    return tables.read_results(v.spark, path).select("ResultID", "AcademicYear", "PointsAchieved", "SchoolID")


@query("full_refresh", "SELECT ResultID, AcademicYear, PointsAchieved FROM results WHERE SchoolID IS NOT NULL")
def full_refresh(v):
    path = scratch_dir(v.spark)
    tables.append_results(v.results_base, path)
    tables.full_refresh(v.results.where(F.col("SchoolID").isNotNull()), path)
    return tables.read_results(v.spark, path).select("ResultID", "AcademicYear", "PointsAchieved")


SUMMARY_SQL = f"""
SELECT AcademicYear, SchoolName, StudentID_SASID, StudentID_LASID, LastName, FirstName, StudentGrade, ClassName,
       TeacherLastName, TeacherFirstName, Subject, ProgramName, Publisher, Component, AssignmentName, AssessmentID,
       DateCompleted, CAST(NULL AS VARCHAR) AS StandardSet,
       CAST(SUM(PointsAchieved) AS DECIMAL(20,2)) AS TotalPointsAchieved,
       CAST(SUM(PointsPossible) AS DECIMAL(20,2)) AS TotalPointsPossible,
       CASE WHEN SUM(PointsPossible) > 0
            THEN printf('%.6f', CAST(SUM(PointsAchieved) AS DOUBLE) / CAST(SUM(PointsPossible) AS DOUBLE) * 100) || '%' END
         AS OverallPercentCorrect,
       SchoolID
FROM (SELECT * EXCLUDE (Subject), {ASSIGNMENT_SUBJECT} AS Subject
      FROM results WHERE AssessmentID IS NOT NULL AND StudentID_SASID IS NOT NULL) r
GROUP BY AcademicYear, SchoolName, StudentID_SASID, StudentID_LASID, LastName, FirstName, StudentGrade, ClassName,
         TeacherLastName, TeacherFirstName, Subject, ProgramName, Publisher, Component, AssignmentName, AssessmentID,
         DateCompleted, SchoolID
"""


@query("summary", SUMMARY_SQL)
def summary_rows(v):
    return summary.summary(v.results)


@query("ordered_summary", SUMMARY_SQL)
def ordered_summary(v):
    return summary.ordered_summary(summary.summary(v.results))


@query("rebuild_summary", SUMMARY_SQL)
def rebuild_summary(v):
    warehouse = weekly.Warehouse(v.spark, scratch_dir(v.spark))
    tables.append_results(v.results, warehouse.path("results"))
    weekly.rebuild_summary(warehouse)
    return warehouse.table(schemas.SUMMARY)


@query(
    "surrogate_key",
    """SELECT row_number() OVER (ORDER BY md5(k), a NULLS FIRST, b NULLS FIRST, c NULLS FIRST, d NULLS FIRST)
                + (SELECT MAX(SourceAssessmentID) FROM assignments_seed) AS AssignmentID,
              a AS ProgramName, b AS Component, c AS AssignmentName, d AS SchoolID
       FROM (SELECT DISTINCT ProgramName AS a, Component AS b, AssignmentName AS c, SchoolID AS d,
                    coalesce(ProgramName, '') || '|' || coalesce(Component, '') || '|' || coalesce(AssignmentName, '')
                      || '|' || coalesce(CAST(SchoolID AS VARCHAR), '') AS k
             FROM results) x""",
)
def surrogate_key(v):
    key = ["ProgramName", "Component", "AssignmentName", "SchoolID"]
    rows = v.results.select(*key).distinct()
    start = tables.next_id(v.assignments_seed, "SourceAssessmentID")
    return tables.surrogate_key(rows, "AssignmentID", key, start)


@query(
    "extraction_log",
    """SELECT 'results' AS endpoint, COUNT(*) AS records_extracted, 'success' AS status,
              CAST(NULL AS VARCHAR) AS error_message FROM results""",
)
def extraction_log(v):
    log = scratch_dir(v.spark)
    tables.logged_append(v.results, scratch_dir(v.spark), "results", log)
    return v.spark.read.parquet(log).drop("extraction_date")


@query(
    "archive_by_year",
    """SELECT CASE WHEN AcademicYear < '1998-1999' THEN 'archive' ELSE 'live' END AS tier, ResultID, AcademicYear
       FROM results""",
)
def archive_by_year(v):
    path, archive = scratch_dir(v.spark), scratch_dir(v.spark)
    tables.append_results(v.results, path)
    tables.archive_years(v.spark, path, archive, "1998-1999")
    live, old = (tables.read_results(v.spark, p).select("ResultID", "AcademicYear") for p in (path, archive))
    return live.withColumn("tier", F.lit("live")).unionByName(old.withColumn("tier", F.lit("archive")))


@query(
    "incremental_window",
    """SELECT ResultID, AcademicYear, DateCompleted,
              CASE WHEN DateCompleted BETWEEN DATE '1998-06-10' AND DATE '1998-07-10' THEN PointsPossible
                   ELSE PointsAchieved END AS PointsAchieved
       FROM results_base""",
)
def incremental_window(v):
    path, as_of, days = scratch_dir(v.spark), dt.date(1998, 7, 10), 30
    tables.append_results(v.results_base, path)
    batch = tables.incremental_rows(v.results_base, as_of, days)
    batch = batch.withColumn("PointsAchieved", F.col("PointsPossible"))
    tables.replace_window(v.spark, path, batch, as_of - dt.timedelta(days=days), as_of)
    return tables.read_results(v.spark, path).select(
        "ResultID", "AcademicYear", "DateCompleted", "PointsAchieved"
    )


# --- required fields -------------------------------------------------------------------------------


@query(
    "load_metrics",
    """SELECT COUNT(*) FILTER (WHERE e.site_id <> 0) AS Inserted,
              COUNT(*) - COUNT(*) FILTER (WHERE e.site_id <> 0) AS Skipped
       FROM raw_results r LEFT JOIN enrollment e ON r.local_student_id = e.district_student_id""",
)
def load_metrics(v):
    from markbook.operators.reports import load_metrics as report

    known = ref.enrollment(v.enrollment, "seq").where(F.col("site_id").isNotNull())
    return report(v.raw_results, known.withColumnRenamed("district_student_id", "local_student_id"))


@query(
    "require_school",
    """SELECT result_seq, local_student_id FROM raw_results r
       WHERE EXISTS (SELECT 1 FROM enrollment e WHERE e.district_student_id = r.local_student_id AND e.site_id <> 0)""",
)
def require_school(v):
    return enrichment.require_school(v.raw_results, ref.enrollment(v.enrollment, "seq")).select(
        "result_seq", "local_student_id"
    )
