"""Scalar rules and predicates on whole tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from markbook import schemas
from markbook.functions import fixed_values as fixed
from markbook.functions import predicates as pred
from markbook.functions import scalars as s
from markbook.operators import merges, nested, program_sync, reports
from markbook.plans import enrichment
from markbook.sources.pages import read_documents

from .landing import FLAT_PARENTS, NESTED_RECORDS, land_documents
from .registry import query

C = F.col

YEAR_OF = """CASE WHEN month({d}) >= 7 THEN CAST(year({d}) AS VARCHAR) || '-' || CAST(year({d}) + 1 AS VARCHAR)
                  WHEN {d} IS NOT NULL THEN CAST(year({d}) - 1 AS VARCHAR) || '-' || CAST(year({d}) AS VARCHAR) END"""
DATE_OF = """CAST(coalesce(try_strptime({t}, '%Y-%m-%d'), try_strptime({t}, '%m/%d/%Y'),
               try_strptime({t}, '%Y-%m-%dT%H:%M:%S'), try_strptime({t}, '%Y-%m-%d %H:%M:%S')) AS DATE)"""
GRADE_OF = """CASE WHEN NOT regexp_full_match({t}, '-?[0-9]+') THEN NULL WHEN CAST({t} AS INT) = 1 THEN 'K'
                   WHEN CAST({t} AS INT) > 1 THEN CAST(CAST({t} AS INT) - 1 AS VARCHAR) END"""


def case_like(text: str, rules, otherwise: str = "NULL") -> str:
    """The rules of ``fixed_values`` as a CASE, in their order."""
    return "CASE " + " ".join(f"WHEN {text} LIKE '{p}' THEN '{label}'" for p, label in rules) + f" ELSE {otherwise} END"


SUBJECT_FROM_CODE = case_like("standard_code", fixed.CODE_SUBJECTS)
SUBJECT_FROM_TITLE = case_like("lower(title)", fixed.TITLE_SUBJECTS)
PREFIX_CASE = case_like("StandardCodingNumber", fixed.CODE_PREFIX_SUBJECTS)
ASSIGNMENT_SUBJECT = case_like("AssignmentName", fixed.ASSIGNMENT_SUBJECTS, "Subject")
SET_OF = """CASE WHEN standard_code LIKE 'CCSS.%' THEN 'Common Core State Standards'
  WHEN standard_code LIKE 'ELA-Literacy.%' OR standard_code LIKE 'Math.Content.%' THEN 'Michigan State Standards'
  WHEN standard_code <> '' THEN nullif(standard_set, '') END"""


def half_even(a: str, p: str) -> str:
    """Percent text by integer arithmetic, for non-negative points with two decimals."""
    n, d = f"(CAST({a} * 100 AS BIGINT) * 10000)", f"CAST({p} * 100 AS BIGINT)"
    h = f"({n} // {d} + CASE WHEN 2 * ({n} % {d}) > {d} OR (2 * ({n} % {d}) = {d} AND ({n} // {d}) % 2 = 1) THEN 1 ELSE 0 END)"
    return (
        f"CASE WHEN {p} <> 0 THEN CAST({h} // 100 AS VARCHAR) || '.' || lpad(CAST({h} % 100 AS VARCHAR), 2, '0') || '%' END"
    )


def program_terms(*fields: str) -> str:
    return any_term(fixed.PROGRAM_TERMS, *fields)


def any_term(terms, *fields: str) -> str:
    return " OR ".join(f"lower({f}) LIKE '%{t}%'" for f in fields for t in terms)


PROGRAM_VIEW = f"({program_terms('ProgramName', 'AssignmentName')} OR {any_term(fixed.PUBLISHER_TERMS, 'Publisher')})"


@query(
    "academic_year",
    f"""SELECT result_seq, {YEAR_OF.format(d='d')} AS academic_year
        FROM (SELECT result_seq, CAST(try_strptime(left(date_taken, 10), '%Y-%m-%d') AS DATE) AS d FROM raw_results) x""",
)
def academic_year(v):
    return v.raw_results.select("result_seq", s.academic_year(C("date_taken")).alias("academic_year"))


@query("academic_year_asof", f"SELECT ResultID, {YEAR_OF.format(d='DateCompleted')} AS academic_year FROM results")
def academic_year_asof(v):
    return v.results.select("ResultID", s.academic_year_asof(C("DateCompleted")).alias("academic_year"))


@query(
    "grade_from_level_id",
    f"SELECT seq, {GRADE_OF.format(t='level_text')} AS grade FROM level_records",
)
def grade_from_level_id(v):
    return v.level_records.select("seq", s.grade_from_level_id(C("level_text")).alias("grade"))


@query(
    "parse_date",
    f"""SELECT result_seq, d AS date_completed, coalesce(date_text <> '' AND d IS NULL, false) AS date_unparsed
        FROM (SELECT *, {DATE_OF.format(t='left(date_text, 19)')} AS d FROM date_records) x""",
)
def parse_date(v):
    text = C("date_text")
    return v.date_records.select(
        "result_seq", s.parse_date(text).alias("date_completed"), s.date_unparsed(text).alias("date_unparsed")
    )


@query("safe_decimal", "SELECT result_seq, TRY_CAST(number_text AS DECIMAL(10,2)) AS points FROM number_records")
def safe_decimal(v):
    return v.number_records.select("result_seq", s.safe_decimal(C("number_text")).alias("points"))


@query(
    "percent_text",
    f"SELECT ResultID, {half_even('PointsAchieved', 'PointsPossible')} AS percent FROM results",
)
def percent_text(v):
    return v.results.select("ResultID", s.percent_text(C("PointsAchieved"), C("PointsPossible")).alias("percent"))


@query(
    "overall_percent_text",
    """SELECT StudentID_LASID, AssessmentID, CASE WHEN SUM(PointsPossible) > 0 THEN
              printf('%.6f', CAST(SUM(PointsAchieved) AS DOUBLE) / CAST(SUM(PointsPossible) AS DOUBLE) * 100) || '%' END AS percent
       FROM results GROUP BY StudentID_LASID, AssessmentID""",
)
def overall_percent_text(v):
    sums = v.results.groupBy("StudentID_LASID", "AssessmentID").agg(
        F.sum("PointsAchieved").alias("a"), F.sum("PointsPossible").alias("p")
    )
    return sums.select("StudentID_LASID", "AssessmentID", s.overall_percent_text(C("a"), C("p")).alias("percent"))


@query("subject_from_code", f"SELECT result_seq, {SUBJECT_FROM_CODE} AS subject FROM raw_results")
def subject_from_code(v):
    return v.raw_results.select("result_seq", s.subject_from_code(C("standard_code")).alias("subject"))


@query("subject_from_title", f"SELECT result_seq, {SUBJECT_FROM_TITLE} AS subject FROM raw_results")
def subject_from_title(v):
    return v.raw_results.select("result_seq", s.subject_from_title(C("title")).alias("subject"))


@query("subject_coalesce_code", f"SELECT ResultID, coalesce(Subject, {PREFIX_CASE}) AS subject_out FROM results")
def subject_coalesce_code(v):
    out = s.subject_or_code(C("Subject"), C("StandardCodingNumber"))
    return v.results.select("ResultID", out.alias("subject_out"))


@query(
    "subject_code_first",
    f"SELECT ResultID, coalesce({PREFIX_CASE}, Subject) AS with_row, {PREFIX_CASE} AS code_only FROM results",
)
def subject_code_first(v):
    code = C("StandardCodingNumber")
    return v.results.select(
        "ResultID",
        s.subject_code_first(code, C("Subject")).alias("with_row"),
        s.subject_code_first(code).alias("code_only"),
    )


@query("subject_from_assignment", f"SELECT ResultID, {ASSIGNMENT_SUBJECT} AS subject_out FROM results")
def subject_from_assignment(v):
    out = s.subject_from_assignment(C("AssignmentName"), C("Subject"))
    return v.results.select("ResultID", out.alias("subject_out"))


@query("infer_standard_set", f"SELECT result_seq, {SET_OF} AS standard_set_out FROM raw_results")
def infer_standard_set(v):
    out = s.infer_standard_set(C("standard_code"), C("standard_set"))
    return v.raw_results.select("result_seq", out.alias("standard_set_out"))


def nested_records(v):
    return read_documents(v.spark, land_documents(v.sql(NESTED_RECORDS)), schemas.NESTED_RESULT)


LASID_OF = "CASE WHEN grp % 3 = 0 THEN 'x' || LASID0 ELSE LASID0 END"
SASID_OF = "CASE WHEN grp % 2 = 0 THEN 'S' || CAST(grp AS VARCHAR) ELSE 'alt' || CAST(grp AS VARCHAR) END"


@query(
    "alias_fields",
    f"""SELECT {LASID_OF} AS StudentID_LASID, {SASID_OF} AS StudentID_SASID, 'Site ' || LASID0 AS SchoolName,
               CASE WHEN grp % 2 = 0 THEN 'math' ELSE 'by name' END AS Subject, AssessmentID, DateCompleted,
               CAST(grp % 40 AS INT) AS SchoolID, {YEAR_OF.format(d='DateCompleted')} AS AcademicYear
        FROM ({FLAT_PARENTS}) x""",
)
def alias_fields(v):
    return nested.common_fields(nested_records(v)).select(
        "StudentID_LASID",
        "StudentID_SASID",
        "SchoolName",
        "Subject",
        "AssessmentID",
        "DateCompleted",
        "SchoolID",
        "AcademicYear",
    )


# Record points after the aliases: own points unless 0 or missing, then total_score, then raw_score.
TOTAL_ACHIEVED = "CASE WHEN n % 2 = 1 AND a <> 0 THEN CAST(a AS DECIMAL(10,2)) WHEN grp % 4 <> 0 THEN 7 ELSE 3 END"


@query(
    "alias_points",
    f"""SELECT LASID0 AS lasid0, AssessmentID AS assessment_id, CAST(DateCompleted AS VARCHAR) AS date_completed,
               CAST({TOTAL_ACHIEVED} AS DECIMAL(10,2)) AS TotalPointsAchieved, CAST(p AS DECIMAL(10,2)) AS TotalPointsPossible
        FROM ({FLAT_PARENTS}) x""",
)
def alias_points(v):
    return nested.alias_points(nested_records(v)).select(
        F.substring("student_id", 2, 50).alias("lasid0"),
        "assessment_id",
        "date_completed",
        "TotalPointsAchieved",
        "TotalPointsPossible",
    )


@query(
    "explode_standards",
    f"""SELECT CASE WHEN CAST(StudentID_LASID AS BIGINT) % 3 = 0 THEN 'x' || StudentID_LASID ELSE StudentID_LASID END AS StudentID_LASID,
               AssessmentID, DateCompleted, nullif(StandardSet, '') AS StandardSet,
               nullif(StandardCodingNumber, '') AS StandardCodingNumber, StandardDescription,
               nullif(PointsAchieved, 0) AS PointsAchieved, nullif(PointsPossible, 0) AS PointsPossible,
               {half_even('nullif(PointsAchieved, 0)', 'PointsPossible')} AS PercentCorrect
        FROM results_base WHERE CAST(StudentID_LASID AS BIGINT) % 9 <> 0""",
)
def explode_standards(v):
    return nested.explode_standards(nested_records(v)).select(
        "StudentID_LASID",
        "AssessmentID",
        "DateCompleted",
        "StandardSet",
        F.nullif("StandardCodingNumber", F.lit("")).alias("StandardCodingNumber"),
        "StandardDescription",
        F.nullif("PointsAchieved", F.lit(0)).alias("PointsAchieved"),
        F.nullif("PointsPossible", F.lit(0)).alias("PointsPossible"),
        "PercentCorrect",
    )


@query(
    "overall_from_nested",
    f"""SELECT {LASID_OF} AS StudentID_LASID, AssessmentID, DateCompleted,
               CAST(achieved AS DECIMAL(20,2)) AS TotalPointsAchieved, CAST(p AS DECIMAL(20,2)) AS TotalPointsPossible,
               {half_even('achieved', 'p')} AS OverallPercentCorrect
        FROM (SELECT *, CAST({TOTAL_ACHIEVED} AS DECIMAL(10,2)) AS achieved FROM ({FLAT_PARENTS}) y) x
        WHERE n % 3 <> 0 OR (n % 2 = 1 AND a <> 0)""",
)
def overall_from_nested(v):
    return nested.overall_from_nested(nested_records(v)).select(
        "StudentID_LASID",
        "AssessmentID",
        "DateCompleted",
        "TotalPointsAchieved",
        "TotalPointsPossible",
        "OverallPercentCorrect",
    )


@query(
    "has_overall",
    f"""SELECT LASID0 AS lasid0, AssessmentID AS assessment_id, CAST(DateCompleted AS VARCHAR) AS date_completed
        FROM ({FLAT_PARENTS}) x WHERE n % 3 <> 0 OR (n % 2 = 1 AND a <> 0)""",
)
def has_overall(v):
    rows = nested_records(v).where(pred.has_overall(C("overall_score"), C("points_achieved")))
    return rows.select(F.substring("student_id", 2, 50).alias("lasid0"), "assessment_id", "date_completed")


@query(
    "program_from_title",
    """SELECT ResultID, CASE WHEN upper(AssignmentName) LIKE '%ELA%' THEN 'ELA'
              WHEN upper(AssignmentName) LIKE '%MATH%' THEN 'Math' END AS program FROM results""",
)
def program_from_title(v):
    return v.results.select("ResultID", s.program_from_title(C("AssignmentName")).alias("program"))


HEADER_ROWS = """
SELECT CASE WHEN upper(t) LIKE '%ELA%' THEN 'ELA' WHEN upper(t) LIKE '%MATH%' THEN 'Math' END AS ProgramName,
       publisher AS Publisher, scope AS Component, t AS AssignmentName, assessment_id AS SourceAssessmentID,
       coalesce(nullif(subject, ''), subject_name) AS Subject, seq
FROM (SELECT *, coalesce(nullif(title, ''), name) AS t FROM header_records) h
"""


@query("metadata_mapping", HEADER_ROWS)
def metadata_mapping(v):
    return merges.metadata_mapping(v.header_records)


LANDING_NULLS = ("ClassName", "ClassGrade", "ProgramName", "Publisher", "Component")


@query(
    "landing_projection",
    "SELECT "
    + ", ".join(
        {
            "StudentID_LASID": "local_student_id AS StudentID_LASID",
            "AssignmentName": "title AS AssignmentName",
            "AssessmentID": "assessment_id AS AssessmentID",
            "PointsAchieved": "points AS PointsAchieved",
        }.get(f.name, f"CAST(NULL AS {'INT' if f.name == 'SchoolID' else 'DATE' if f.name == 'DateCompleted' else 'DECIMAL(10,2)' if f.name == 'PointsPossible' else 'VARCHAR'}) AS {f.name}")
        for f in schemas.LANDING.fields
    )
    + " FROM raw_results",
)
def landing_projection(v):
    return enrichment.landing_projection(
        v.raw_results,
        StudentID_LASID=C("local_student_id"),
        AssignmentName=C("title"),
        AssessmentID=C("assessment_id"),
        PointsAchieved=C("points"),
    )


@query(
    "person_name",
    "SELECT ResultID, TeacherLastName || ', ' || TeacherFirstName AS teacher_name FROM results",
)
def person_name(v):
    return v.results.select(
        "ResultID", s.person_name(C("TeacherLastName"), C("TeacherFirstName")).alias("teacher_name")
    )


@query(
    "null_safe_key",
    """SELECT ResultID, coalesce(StudentID_LASID, '') || '|' || coalesce(CAST(AssessmentID AS VARCHAR), '') || '|' ||
              coalesce(StandardCodingNumber, '') || '|' || coalesce(CAST(DateCompleted AS VARCHAR), '') AS k FROM results""",
)
def null_safe_key(v):
    return v.results.select("ResultID", reports.duplicate_key().alias("k"))


@query(
    "null_propagating_key",
    "SELECT ResultID, ProgramName || '|' || Component || '|' || AssignmentName AS k FROM results",
)
def null_propagating_key(v):
    key = s.null_propagating_key(C("ProgramName"), C("Component"), C("AssignmentName"))
    return v.results.select("ResultID", key.alias("k"))


@query(
    "truncate_text",
    """SELECT ResultID, left(t, 50) || '...' AS always,
              CASE WHEN length(left(t, 50)) >= 50 THEN left(t, 50) || '...' ELSE left(t, 50) END AS when_long
       FROM (SELECT ResultID, repeat(StandardDescription || ' ', 1 + CAST(ResultID % 9 AS INT)) AS t FROM results) x""",
)
def truncate_text(v):
    text = F.repeat(F.concat("StandardDescription", F.lit(" ")), (1 + C("ResultID") % 9).cast("int"))
    return v.results.withColumn("t", text).select(
        "ResultID", s.truncate_text(C("t")).alias("always"), s.truncate_long_text(C("t")).alias("when_long")
    )


@query(
    "leading_grade",
    "SELECT ResultID, nullif(regexp_extract(AssignmentName, '^([0-9]{1,2})', 1), '') AS grade FROM results",
)
def leading_grade(v):
    return v.results.select("ResultID", s.leading_grade(C("AssignmentName")).alias("grade"))


@query(
    "safe_ratio_pct",
    "SELECT ResultID, CAST(PointsAchieved AS DOUBLE) / CAST(nullif(PointsPossible, 0) AS DOUBLE) * 100 AS pct FROM results",
)
def safe_ratio_pct(v):
    return v.results.select("ResultID", s.ratio_pct(C("PointsAchieved"), C("PointsPossible")).alias("pct"))


# --- predicates ------------------------------------------------------------------------------------


@query("program_view", f"SELECT ResultID, ProgramName, Publisher, AssignmentName FROM results WHERE {PROGRAM_VIEW}")
def program_view(v):
    return program_sync.program_view(v.results).select("ResultID", "ProgramName", "Publisher", "AssignmentName")


@query("program_name_only", f"SELECT ResultID, ProgramName FROM results WHERE {program_terms('ProgramName')}")
def program_name_only(v):
    return v.results.where(pred.program_name_only(C("ProgramName"))).select("ResultID", "ProgramName")


_FIVE = ("ProgramName", "AssignmentName", "Component", "Publisher", "SchoolName")


@query(
    "program_any_field",
    f"SELECT ResultID FROM results WHERE {any_term(fixed.ANY_FIELD_TERMS, *_FIVE)}",
)
def program_any_field(v):
    return v.results.where(pred.program_any_field(*[C(c) for c in _FIVE])).select("ResultID")


@query(
    "valid_standard",
    """SELECT ResultID, StandardCodingNumber, StandardCodingNumber <> 'Overall' AS is_standard FROM results
       WHERE StandardCodingNumber <> ''""",
)
def valid_standard(v):
    code = C("StandardCodingNumber")
    return v.results.where(pred.valid_standard(code)).select(
        "ResultID", code, pred.valid_standard(code, allow_overall=False).alias("is_standard")
    )


@query(
    "recent_days",
    "SELECT ResultID, DateCompleted FROM results WHERE DateCompleted >= DATE '2000-12-31' - INTERVAL 35 DAY",
)
def recent_days(v):
    rows = v.results.where(pred.recent_days(C("DateCompleted"), dt.date(2000, 12, 31), 35))
    return rows.select("ResultID", "DateCompleted")


@query(
    "starts_with_digit",
    "SELECT ResultID, AssignmentName FROM results WHERE regexp_matches(AssignmentName, '^[0-9]')",
)
def starts_with_digit(v):
    return v.results.where(pred.starts_with_digit(C("AssignmentName"))).select("ResultID", "AssignmentName")


@query(
    "grade_prefix",
    """SELECT CAST(g AS INT) AS TargetGrade, ResultID, AssignmentName FROM results, range(1, 13) t(g)
       WHERE starts_with(AssignmentName, CAST(g AS VARCHAR))""",
)
def grade_prefix(v):
    return reports.grade_prefix_rows(v.results).select("TargetGrade", "ResultID", "AssignmentName")


@query("teacher_like", "SELECT ResultID, TeacherLastName FROM results WHERE TeacherLastName LIKE '%L1%'")
def teacher_like(v):
    return v.results.where(pred.teacher_like(C("TeacherLastName"), "L1")).select("ResultID", "TeacherLastName")


@query(
    "needs_enrichment",
    """SELECT DISTINCT StudentID_LASID FROM results
       WHERE (TeacherLastName IS NULL OR StudentGrade IS NULL) AND StudentID_LASID IS NOT NULL""",
)
def needs_enrichment(v):
    need = pred.needs_enrichment(C("StudentID_LASID"), C("TeacherLastName"), C("StudentGrade"))
    return v.results.where(need).select("StudentID_LASID").distinct()


@query(
    "view_since_date",
    f"SELECT ResultID, DateCompleted FROM results WHERE {PROGRAM_VIEW} AND DateCompleted >= DATE '1999-01-01'",
)
def view_since_date(v):
    return program_sync.view_since_date(v.results, dt.date(1999, 1, 1)).select("ResultID", "DateCompleted")
