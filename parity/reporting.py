"""Reports, lists, set operations and quality checks."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import functions as F

from markbook import schemas
from markbook.functions import scalars as s
from markbook.operators import merges, program_sync, quality, reports
from markbook.plans import summary

from .joins_merges import ensure_columns
from .registry import query
from .scalar_rules import PREFIX_CASE, PROGRAM_VIEW
from .scans_loads import SUMMARY_SQL
from .views import BASE_TABLES

C = F.col
TEACHER, AS_OF = "L1", dt.date(2000, 12, 31)

# --- duplicates and population ---------------------------------------------------------------------

_KEY = """coalesce(StudentID_LASID, '') || '|' || coalesce(CAST(AssessmentID AS VARCHAR), '') || '|' ||
  coalesce(StandardCodingNumber, '') || '|' || coalesce(CAST(DateCompleted AS VARCHAR), '')"""


@query(
    "duplicate_count",
    f"""SELECT COUNT(*) AS TotalRecords, COUNT(DISTINCT {_KEY}) AS UniqueRecords,
               COUNT(*) - COUNT(DISTINCT {_KEY}) AS DuplicateCount FROM results""",
)
def duplicate_count(v):
    return reports.duplicate_count(v.results)


@query(
    "duplicate_count_after_delete",
    f"SELECT COUNT(DISTINCT {_KEY}) AS TotalRecords, COUNT(DISTINCT {_KEY}) AS UniqueRecords, CAST(0 AS BIGINT) AS DuplicateCount FROM results",
)
def duplicate_count_after_delete(v):
    return reports.duplicate_count(quality.delete_duplicates(v.results))


@query(
    "duplicate_groups",
    """SELECT StudentID_LASID, FirstName, LastName, SchoolName, AssessmentID, AssignmentName, StandardCodingNumber,
              DateCompleted, COUNT(*) AS Occurrences
       FROM results GROUP BY ALL HAVING COUNT(*) > 1""",
)
def duplicate_groups(v):
    return reports.duplicate_groups(v.results)


@query(
    "table_counts",
    f"""SELECT 'results' AS table_name, COUNT(*) AS n FROM results
        UNION ALL SELECT 'summary', COUNT(*) FROM ({SUMMARY_SQL}) q
        UNION ALL SELECT 'assignments', COUNT(*) FROM assignments_now
        UNION ALL SELECT 'standards', COUNT(*) FROM standards_now""",
)
def table_counts(v):
    return reports.table_counts(
        results=v.results,
        summary=summary.summary(v.results),
        assignments=v.assignments_now,
        standards=v.standards_now,
    )


@query(
    "date_ranges",
    """SELECT 'results' AS Source, MIN(DateCompleted) AS earliest, MAX(DateCompleted) AS latest FROM results
       UNION ALL SELECT 'assignments', MIN(CreatedDate), MAX(CreatedDate) FROM assignments_now
       UNION ALL SELECT 'standards', MIN(CreatedDate), MAX(CreatedDate) FROM standards_now""",
)
def date_ranges(v):
    frames = {
        "results": (v.results, "DateCompleted"),
        "assignments": (v.assignments_now, "CreatedDate"),
        "standards": (v.standards_now, "CreatedDate"),
    }
    out = None
    for name, (df, column) in frames.items():
        one = reports.date_ranges(df, column).select(
            F.lit(name).alias("Source"), C(f"min_{column}").alias("earliest"), C(f"max_{column}").alias("latest")
        )
        out = one if out is None else out.unionByName(one)
    return out


_STANDARD = "StandardCodingNumber <> '' AND StandardCodingNumber <> 'Overall'"
_A_KEY, _S_KEY = "ProgramName || '|' || Component || '|' || AssignmentName", "StandardSet || '|' || StandardCodingNumber"


@query(
    "distinct_in_source",
    f"""SELECT COUNT(DISTINCT {_A_KEY}) AS UniqueAssignments,
               COUNT(DISTINCT CASE WHEN {_STANDARD} THEN {_S_KEY} END) AS UniqueStandards FROM results""",
)
def distinct_in_source(v):
    return reports.distinct_in_source(v.results)


_NO_ASSIGNMENT = """NOT EXISTS (SELECT 1 FROM assignments_seed a WHERE a.ProgramName = r.ProgramName
  AND a.Component = r.Component AND a.AssignmentName = r.AssignmentName)"""
_NO_STANDARD = """NOT EXISTS (SELECT 1 FROM standards_seed t WHERE t.StandardSet = r.StandardSet
  AND t.StandardCodingNumber = r.StandardCodingNumber)"""
_GAPS = f"""(SELECT COUNT(DISTINCT {_A_KEY}) FROM results r WHERE {_NO_ASSIGNMENT}) AS MissingAssignments,
  (SELECT COUNT(DISTINCT {_S_KEY}) FROM results r WHERE {_STANDARD} AND {_NO_STANDARD}) AS MissingStandards"""


@query("missing_lookups", f"SELECT {_GAPS}")
def missing_lookups(v):
    return reports.missing_lookups(v.results, v.assignments_seed, v.standards_seed)


@query(
    "missing_lookups_null_safe",
    f"""SELECT (SELECT COUNT(*) FROM (
             SELECT DISTINCT ProgramName, Component, AssignmentName FROM results
             EXCEPT SELECT ProgramName, Component, AssignmentName FROM assignments_seed) a) AS MissingAssignments,
           (SELECT COUNT(*) FROM (
             SELECT DISTINCT StandardSet, StandardCodingNumber FROM results WHERE {_STANDARD}
             EXCEPT SELECT StandardSet, StandardCodingNumber FROM standards_seed) b) AS MissingStandards""",
)
def missing_lookups_null_safe(v):
    return reports.missing_lookups(v.results, v.assignments_seed, v.standards_seed, null_safe=True)


@query(
    "population_status",
    f"""SELECT *, CASE WHEN AssignmentsCount > 0 AND StandardsCount > 0 AND MissingAssignments = 0 AND MissingStandards = 0
                       THEN 'SUCCESS' WHEN AssignmentsCount > 0 OR StandardsCount > 0 THEN 'PARTIAL SUCCESS' ELSE 'FAILED' END AS Status
        FROM (SELECT (SELECT COUNT(*) FROM assignments_seed) AS AssignmentsCount,
                     (SELECT COUNT(*) FROM standards_seed) AS StandardsCount, {_GAPS}) x""",
)
def population_status(v):
    return reports.population_status(v.results, v.assignments_seed, v.standards_seed)


@query(
    "population_status_by_count",
    f"""SELECT *, CASE WHEN AssignmentsCount > 0 AND StandardsCount > 0 AND AssignmentsCount >= UniqueAssignments
                        AND StandardsCount >= UniqueStandards THEN 'SUCCESS' ELSE 'WARNING' END AS Status
        FROM (SELECT (SELECT COUNT(*) FROM assignments_seed) AS AssignmentsCount,
                     (SELECT COUNT(*) FROM standards_seed) AS StandardsCount,
                     COUNT(DISTINCT {_A_KEY}) AS UniqueAssignments,
                     COUNT(DISTINCT CASE WHEN {_STANDARD} THEN {_S_KEY} END) AS UniqueStandards FROM results) x""",
)
def population_status_by_count(v):
    return reports.population_status_by_count(v.results, v.assignments_seed, v.standards_seed)


@query(
    "distinct_ids",
    """SELECT COUNT(DISTINCT AssessmentID) AS UniqueAssessments, COUNT(DISTINCT StandardCodingNumber) AS UniqueStandards
       FROM results""",
)
def distinct_ids(v):
    return reports.distinct_ids(v.results)


# --- counts ----------------------------------------------------------------------------------------


@query(
    "program_subject_breakdown",
    """SELECT ProgramName, Subject, COUNT(*) AS AssignmentCount FROM assignments_now
       WHERE ProgramName IS NOT NULL OR Subject IS NOT NULL GROUP BY ProgramName, Subject""",
)
def program_subject_breakdown(v):
    return reports.program_subject_breakdown(v.assignments_now)


@query(
    "standards_by_subject",
    "SELECT Subject, COUNT(*) AS StandardCount FROM standards_now WHERE Subject IS NOT NULL GROUP BY Subject",
)
def standards_by_subject(v):
    return reports.standards_by_subject(v.standards_now)


def catalogued(v):
    return merges.merge_standards_catalogue(ensure_columns(v), v.results, v.catalogue)


@query(
    "enrichment_stats",
    """SELECT COUNT(*) AS TotalStandards, COUNT(coalesce(c.content_area, t.StandardSet)) AS WithStandardSet,
              COUNT(c.grade_level) AS WithGradeLevel, COUNT(c.subject_desc1) AS WithStrand, COUNT(c.type) AS WithCategory
       FROM (SELECT DISTINCT StandardCodingNumber FROM results WHERE StandardCodingNumber <> '') r
       LEFT JOIN catalogue c ON r.StandardCodingNumber = c.glce_code
       LEFT JOIN standards_seed t ON t.StandardCodingNumber = r.StandardCodingNumber""",
)
def enrichment_stats(v):
    return reports.enrichment_stats(catalogued(v))


@query(
    "school_coverage",
    """SELECT COUNT(*) AS TotalAssignments, COUNT(SchoolID) AS AssignmentsWithSchool,
              COUNT(*) - COUNT(SchoolID) AS AssignmentsWithoutSchool FROM assignments_now""",
)
def school_coverage(v):
    return reports.school_coverage(v.assignments_now)


@query(
    "null_school_count",
    """SELECT COUNT(*) - COUNT(SchoolID) AS RecordsWithNullSchoolID, COUNT(SchoolID) AS TotalRecordsRemaining FROM results""",
)
def null_school_count(v):
    return reports.null_school_count(v.results)


@query(
    "assessment_usage",
    """SELECT a.AssignmentName, a.ProgramName, a.SchoolID, n.SchoolName AS site_name,
              COUNT(DISTINCT r.StudentID_LASID) AS NumStudents, MAX(r.DateCompleted) AS MostRecentUse
       FROM assignments_now a
       LEFT JOIN (SELECT AssessmentID, StudentID_LASID, MAX(DateCompleted) AS DateCompleted FROM results GROUP BY 1, 2) r
         ON a.SourceAssessmentID = r.AssessmentID
       LEFT JOIN (SELECT DISTINCT SchoolID, SchoolName FROM results WHERE SchoolID IS NOT NULL) n ON a.SchoolID = n.SchoolID
       GROUP BY a.AssignmentName, a.ProgramName, a.SchoolID, n.SchoolName""",
)
def assessment_usage(v):
    return reports.assessment_usage(v.assignments_now, v.results)


# --- grades and teachers ---------------------------------------------------------------------------

_GRADES = """SELECT StudentGrade, COUNT(*) AS RecordCount, COUNT(DISTINCT StudentID_LASID) AS UniqueStudents
  FROM results WHERE {where} GROUP BY StudentGrade"""


@query("grade_distribution", _GRADES.format(where="true"))
def grade_distribution(v):
    return reports.grade_distribution(v.results)


@query(
    "grade_distribution_recent_teacher",
    _GRADES.format(where="DateCompleted >= DATE '2000-12-31' - INTERVAL 35 DAY AND TeacherLastName LIKE '%L1%'"),
)
def grade_distribution_recent_teacher(v):
    return reports.grade_distribution(v.results, AS_OF, 35, TEACHER)


@query(
    "teacher_grade_counts",
    """SELECT TeacherLastName, TeacherFirstName, StudentGrade, COUNT(*) AS StudentCount FROM results
       WHERE TeacherLastName LIKE '%L1%' GROUP BY 1, 2, 3""",
)
def teacher_grade_counts(v):
    return reports.teacher_grade_counts(v.results, TEACHER)


@query(
    "class_statistics",
    """SELECT COUNT(DISTINCT StudentID_LASID) AS TotalStudents, MIN(DateCompleted) AS EarliestAssessment,
              MAX(DateCompleted) AS LatestAssessment, COUNT(*) AS TotalAssessments,
              COUNT(DISTINCT StudentID_LASID) FILTER (WHERE StudentGrade = '6' AND DateCompleted >= DATE '1999-08-01')
                AS StudentsInGrade
       FROM results WHERE TeacherLastName LIKE '%L1%'""",
)
def class_statistics(v):
    return reports.class_statistics(v.results, TEACHER, "6", dt.date(1999, 8, 1))


_OFFSETS = """(SELECT g, COUNT(DISTINCT StudentGrade) AS n,
    CASE WHEN COUNT(DISTINCT StudentGrade) = 1 THEN TRY_CAST(MIN(StudentGrade) AS INT) - g END AS off
  FROM (SELECT CAST(regexp_extract(AssignmentName, '^([0-9]{1,2})', 1) AS INT) AS g, StudentGrade FROM results
        WHERE regexp_matches(AssignmentName, '^[0-9]') AND DateCompleted >= DATE '1996-08-01' AND StudentGrade IS NOT NULL) x
  GROUP BY g) o"""


@query(
    "grade_offsets",
    f"SELECT CAST(g AS VARCHAR) AS LeadingGrade, n AS StoredGrades, CAST(off AS INT) AS Offset FROM {_OFFSETS}".replace(
        "AS Offset", 'AS "Offset"'
    ),
)
def grade_offsets(v):
    return reports.grade_offsets(v.results, dt.date(1996, 8, 1))


@query(
    "grade_offset",
    f"""SELECT DetectedOffset, LeadingGrades, CASE WHEN DetectedOffset = 1 THEN 'confirmed'
               WHEN DetectedOffset <> 0 THEN 'other offset' ELSE 'undetermined' END AS Verdict
        FROM (SELECT CAST(arg_min(off, g) FILTER (WHERE off IS NOT NULL) AS INT) AS DetectedOffset, COUNT(*) AS LeadingGrades
              FROM {_OFFSETS}) y""",
)
def grade_offset(v):
    return reports.grade_offset(v.results, dt.date(1996, 8, 1))


# --- performance and programs ----------------------------------------------------------------------


@query(
    "avg_pct_by_standard",
    """SELECT StandardCodingNumber, StandardDescription,
              round(AVG(CAST(PointsAchieved AS DOUBLE) / CAST(nullif(PointsPossible, 0) AS DOUBLE) * 100), 6) AS AvgPercent
       FROM results GROUP BY 1, 2""",
)
def avg_pct_by_standard(v):
    # The mean's last digits depend on the order of the sum, so both sides are compared to six places.
    return reports.avg_pct_by_standard(v.results).withColumn("AvgPercent", F.round("AvgPercent", 6))


def _register_program_counts(name: str, *columns: str, program_only: bool = False) -> None:
    where = f"WHERE {PROGRAM_VIEW}" if program_only else ""
    cols = ", ".join(columns)

    @query(name, f"SELECT {cols}, COUNT(*) AS AssessmentCount FROM results {where} GROUP BY {cols}")
    def run(v):
        rows = program_sync.program_view(v.results) if program_only else v.results
        return reports.counts_by(rows, *columns, name="AssessmentCount")


_register_program_counts("program_counts", "ProgramName")
_register_program_counts("publisher_counts", "Publisher")
_register_program_counts("program_publisher_counts", "ProgramName", "Publisher")
_register_program_counts("program_component_counts", "ProgramName", "Component", program_only=True)
_register_program_counts("standard_counts", "StandardCodingNumber", program_only=True)


@query("unique_students", "SELECT COUNT(DISTINCT StudentID_LASID) AS UniqueStudents FROM results")
def unique_students(v):
    return reports.unique_students(v.results)


@query(
    "summary_vs_detail",
    f"""SELECT (SELECT COUNT(*) FROM ({SUMMARY_SQL}) q) AS SummaryCount,
               (SELECT COUNT(DISTINCT AssignmentName || StudentID_LASID) FROM results) AS UniqueAssignmentStudents""",
)
def summary_vs_detail(v):
    results = v.spread("results")
    return reports.summary_vs_detail(summary.summary(results), results)


# --- lists -----------------------------------------------------------------------------------------


@query(
    "top_recent_lookups",
    """SELECT StandardSet, StandardCodingNumber, left(StandardDescription, 50) || '...' AS StandardDescription, CreatedDate
       FROM standards_now ORDER BY CreatedDate DESC NULLS LAST, StandardSet NULLS FIRST, StandardCodingNumber NULLS FIRST LIMIT 5""",
)
def top_recent_lookups(v):
    top = reports.top_recent_lookups(v.standards_now, "CreatedDate", "StandardSet", "StandardCodingNumber")
    return top.select(
        "StandardSet",
        "StandardCodingNumber",
        s.truncate_text(C("StandardDescription")).alias("StandardDescription"),
        "CreatedDate",
    )


_TOP_ID = "SourceAssessmentID, AssignmentName, ProgramName, Component, SchoolID"


@query(
    "top_by_id",
    f"""SELECT {_TOP_ID} FROM assignments_now ORDER BY SourceAssessmentID DESC NULLS LAST, AssignmentName NULLS FIRST,
        ProgramName NULLS FIRST, Component NULLS FIRST, SchoolID NULLS FIRST LIMIT 10""",
)
def top_by_id(v):
    columns = _TOP_ID.split(", ")
    return reports.top_by(
        v.assignments_now.select(*columns), 10, C("SourceAssessmentID").desc_nulls_last(), *columns[1:]
    )


@query(
    "top_null_school",
    """SELECT ResultID, StudentID_LASID, LastName, FirstName, AssignmentName, DateCompleted, SchoolName, SchoolID
       FROM results WHERE SchoolID IS NULL ORDER BY DateCompleted DESC NULLS LAST, ResultID LIMIT 10""",
)
def top_null_school(v):
    return reports.top_null_school(v.results)


@query(
    "recent_for_teacher",
    """SELECT ResultID, LastName || ', ' || FirstName AS StudentName, StudentGrade, AssignmentName, DateCompleted, SchoolName
       FROM results WHERE TeacherLastName LIKE '%L1%' ORDER BY DateCompleted DESC NULLS LAST, ResultID LIMIT 10""",
)
def recent_for_teacher(v):
    return reports.recent_for_teacher(v.results, TEACHER)


@query(
    "recent_for_teacher_grade",
    """SELECT ResultID, LastName || ', ' || FirstName AS StudentName, StudentGrade, AssignmentName, DateCompleted, SchoolName
       FROM results WHERE TeacherLastName LIKE '%L1%' AND AssignmentName LIKE '5%' AND DateCompleted >= DATE '1996-08-01'
       ORDER BY DateCompleted DESC NULLS LAST, ResultID LIMIT 10""",
)
def recent_for_teacher_grade(v):
    return reports.recent_for_teacher(v.results, TEACHER, name_prefix="5", since=dt.date(1996, 8, 1))


@query(
    "distinct_top_students",
    """SELECT DISTINCT StudentID_LASID, LastName || ', ' || FirstName AS StudentName, StudentGrade,
              TeacherLastName || ', ' || TeacherFirstName AS TeacherName, SchoolName
       FROM results WHERE TeacherLastName LIKE '%L1%' AND DateCompleted >= DATE '2000-12-31' - INTERVAL 35 DAY
       ORDER BY StudentName NULLS LAST, StudentID_LASID NULLS LAST, StudentGrade NULLS LAST, TeacherName NULLS LAST LIMIT 5""",
)
def distinct_top_students(v):
    return reports.distinct_top_students(v.results, TEACHER, AS_OF, 35)


@query(
    "random_sample_per_grade",
    """SELECT TargetGrade, ResultID, StudentGrade, AssignmentName, LastName || ', ' || FirstName AS StudentName, SchoolName
       FROM (SELECT *, CAST(g AS INT) AS TargetGrade,
                    row_number() OVER (PARTITION BY g ORDER BY md5('s' || CAST(ResultID AS VARCHAR)), ResultID) AS rn
             FROM results, range(1, 13) t(g)
             WHERE starts_with(AssignmentName, CAST(g AS VARCHAR)) AND DateCompleted >= DATE '1996-08-01') x
       WHERE rn <= 5""",
)
def random_sample_per_grade(v):
    return reports.random_sample_per_grade(v.results, dt.date(1996, 8, 1), seed="s")


@query(
    "top50_grade_names",
    """SELECT ResultID, StudentGrade, AssignmentName, LastName || ', ' || FirstName AS StudentName, TeacherLastName, DateCompleted
       FROM results WHERE regexp_matches(AssignmentName, '^[0-9]') AND DateCompleted >= DATE '1996-08-01'
       ORDER BY AssignmentName, StudentGrade NULLS FIRST, ResultID LIMIT 50""",
)
def top50_grade_names(v):
    return reports.top50_grade_names(v.results, dt.date(1996, 8, 1))


# --- set operations --------------------------------------------------------------------------------


@query(
    "labelled_union",
    f"SELECT 'all' AS Source, COUNT(*) AS n FROM results UNION ALL SELECT 'program', COUNT(*) FROM results WHERE {PROGRAM_VIEW}",
)
def labelled_union(v):
    count = lambda df: df.agg(F.count(F.lit(1)))
    return reports.labelled_union(
        {"all": count(v.results), "program": count(program_sync.program_view(v.results))}
    )


@query(
    "distinct_rows",
    f"""SELECT DISTINCT AssessmentID, AssignmentName, coalesce(Subject, {PREFIX_CASE}) AS Subject, ProgramName, Publisher,
               Component, SchoolID FROM results WHERE AssessmentID IS NOT NULL AND SchoolID IS NOT NULL""",
)
def distinct_rows(v):
    return merges.assignment_candidates(v.results)


# --- quality ---------------------------------------------------------------------------------------


def _year_rows(v):
    return v.raw_results.select(
        s.academic_year(C("date_taken")).alias("AcademicYear"), C("title").alias("SchoolName")
    )


_MISSING = """SELECT COUNT(*) FROM raw_results WHERE {c}"""
_NO_YEAR = "try_strptime(left(date_taken, 10), '%Y-%m-%d') IS NULL"


@query(
    "required_violations",
    f"""SELECT 'AcademicYear' AS column_name, ({_MISSING.format(c=_NO_YEAR)}) AS violations
        UNION ALL SELECT 'SchoolName', ({_MISSING.format(c='title IS NULL')})""",
)
def required_violations(v):
    return quality.required_violations(_year_rows(v), schemas.RESULTS.required)


@query(
    "nullable_fields",
    f"SELECT 'SchoolName' AS column_name, ({_MISSING.format(c='title IS NULL')}) AS violations",
)
def nullable_fields(v):
    relaxed = quality.relax_required(schemas.RESULTS, "AcademicYear")
    return quality.required_violations(_year_rows(v), relaxed.required)


@query(
    "unique_violations",
    """SELECT 'standard' AS key_of, StandardSet AS part_1, StandardCodingNumber AS part_2, COUNT(*) AS n
       FROM (SELECT DISTINCT StandardSet, StandardCodingNumber, StandardDescription FROM results) x
       GROUP BY StandardSet, StandardCodingNumber HAVING COUNT(*) > 1
       UNION ALL
       SELECT 'assignment', ProgramName || '|' || Component || '|' || AssignmentName, CAST(SchoolID AS VARCHAR), COUNT(*)
       FROM (SELECT DISTINCT ProgramName, Component, AssignmentName, SchoolID, AssessmentID FROM results) y
       GROUP BY ProgramName, Component, AssignmentName, SchoolID HAVING COUNT(*) > 1""",
)
def unique_violations(v):
    standards = v.results.select(*schemas.STANDARDS.unique, "StandardDescription").distinct()
    assignments = v.results.select(*schemas.ASSIGNMENTS.unique, "AssessmentID").distinct()
    a = quality.unique_violations(standards, schemas.STANDARDS.unique).select(
        F.lit("standard").alias("key_of"),
        C("StandardSet").alias("part_1"),
        C("StandardCodingNumber").alias("part_2"),
        "n",
    )
    b = quality.unique_violations(assignments, schemas.ASSIGNMENTS.unique).select(
        F.lit("assignment").alias("key_of"),
        s.null_propagating_key(C("ProgramName"), C("Component"), C("AssignmentName")).alias("part_1"),
        C("SchoolID").cast("string").alias("part_2"),
        "n",
    )
    return a.unionByName(b)


_SHORT = {"SchoolName": 7, "StudentGrade": 1, "AssignmentName": 12, "StandardCodingNumber": 18}


@query(
    "length_violations",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE length({c}) > {w}) AS violations FROM results"
        for c, w in {**schemas.RESULTS.widths, **_SHORT}.items()
        if c not in ("ClassGrade", "PercentCorrect")
    ),
)
def length_violations(v):
    return quality.length_violations(v.results, {**schemas.RESULTS.widths, **_SHORT})


@query(
    "table_presence",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, true AS present, COUNT(*) AS row_count FROM {t}" for t in BASE_TABLES
    )
    + " UNION ALL SELECT 'no_such_table', false, 0",
)
def table_presence(v):
    return quality.table_presence(v.spark, {t: f"{v.sf_dir}/{t}.parquet" for t in (*BASE_TABLES, "no_such_table")})


_REPORTED = {"StandardSet": "string", "StandardCodingNumber": "string", "StandardDescription": "string", "Subject": "string"}


@query(
    "column_report",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(MAX(length({c})) AS INT) AS max_length, '{t}' AS data_type FROM standards_now"
        for c, t in _REPORTED.items()
    )
    + " UNION ALL SELECT 'CreatedDate', NULL, 'date' FROM (SELECT COUNT(*) FROM standards_now) x",
)
def column_report(v):
    return quality.column_report(v.standards_now)


@query(
    "orphans",
    """SELECT 'scores.student_id' AS relation, COUNT(*) AS orphan_rows, COUNT(DISTINCT student_id) AS orphan_keys
       FROM score_records s WHERE student_id IS NOT NULL AND NOT EXISTS (
         SELECT 1 FROM (SELECT CAST(district_student_id AS INT) AS id FROM enrollment WHERE site_id <> 0) p WHERE p.id = s.student_id)
       UNION ALL
       SELECT 'questions.assessment_id', COUNT(*), COUNT(DISTINCT assessment_id) FROM question_records q
       WHERE assessment_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM assessments_seed a WHERE a.assessment_id = q.assessment_id)
       UNION ALL
       SELECT 'links.standard_id', COUNT(*), COUNT(DISTINCT standard_id) FROM link_records l
       WHERE standard_id IS NOT NULL AND NOT EXISTS (
         SELECT 1 FROM standard_records t WHERE t.standard_id = l.standard_id)""",
)
def orphans(v):
    students = v.enrollment.where("site_id <> 0").select(C("district_student_id").cast("int").alias("student_id"))
    return quality.orphan_report(
        {
            "scores.student_id": (v.score_records, "student_id", students, "student_id"),
            "questions.assessment_id": (v.question_records, "assessment_id", v.assessments_seed, "assessment_id"),
            "links.standard_id": (v.link_records, "standard_id", v.standard_records, "standard_id"),
        }
    )


# child table, its view, column, view of the parent, key
FOREIGN_KEYS = (
    ("performance_bands", "band_rows", "assessment_id", "assessments_seed", "assessment_id"),
    ("assessment_questions", "question_rows", "assessment_id", "assessments_seed", "assessment_id"),
    ("answer_choices", "choice_rows", "question_id", "question_rows", "question_id"),
    ("question_standards", "question_links", "question_id", "question_rows", "question_id"),
    ("question_standards", "question_links", "standard_id", "legacy_rows", "standard_id"),
    ("students", "student_rows", "school_id", "school_rows", "school_id"),
    ("student_scores", "score_rows", "student_id", "student_rows", "student_id"),
    ("student_scores", "score_rows", "assessment_id", "assessments_seed", "assessment_id"),
    ("student_responses", "response_rows", "score_id", "score_rows", "score_id"),
    ("student_responses", "response_rows", "student_id", "student_rows", "student_id"),
    ("student_responses", "response_rows", "assessment_id", "assessments_seed", "assessment_id"),
    ("student_responses", "response_rows", "question_id", "question_rows", "question_id"),
)


@query(
    "foreign_keys",
    " UNION ALL ".join(
        f"SELECT '{table}.{column}' AS relation, COUNT(*) AS orphan_rows, COUNT(DISTINCT {column}) AS orphan_keys FROM {child} c"
        f" WHERE {column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{column})"
        for table, child, column, parent, key in FOREIGN_KEYS
    ),
)
def foreign_keys(v):
    layouts = (
        schemas.BANDS,
        schemas.QUESTIONS,
        schemas.CHOICES,
        schemas.QUESTION_STANDARDS,
        schemas.STUDENTS,
        schemas.SCORES,
        schemas.RESPONSES,
    )
    stored = {table: getattr(v, child) for table, child, *_ in FOREIGN_KEYS}
    stored |= {"assessments": v.assessments_seed, "legacy_standards": v.legacy_rows, "schools": v.school_rows}
    return quality.foreign_key_report(stored, layouts)


@query(
    "constraint_report",
    " UNION ALL ".join(
        [
            f"SELECT '{table}' AS table_name, 'reference' AS kind, '{column}' AS columns, COUNT(*) AS violations, COUNT(DISTINCT {column}) AS keys"
            f" FROM {child} c WHERE {column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{column})"
            for table, child, column, parent, key in FOREIGN_KEYS
        ]
        + [
            "SELECT 'question_standards', 'unique', 'question_id,standard_id', coalesce(SUM(n), 0)::BIGINT, COUNT(*) FROM"
            " (SELECT COUNT(*) AS n FROM question_links GROUP BY question_id, standard_id HAVING COUNT(*) > 1)",
            "SELECT 'students', 'unique', 'student_id', coalesce(SUM(n), 0)::BIGINT, COUNT(*) FROM"
            " (SELECT COUNT(*) AS n FROM student_rows GROUP BY student_id HAVING COUNT(*) > 1)",
        ]
        + [f"SELECT 'results', 'required', '{c}', COUNT(*) FILTER ({c} IS NULL), 0 FROM results" for c in schemas.RESULTS.required]
        + [
            f"SELECT 'results', 'length', '{c}', COUNT(*) FILTER (length({c}) > {w}), 0 FROM results"
            for c, w in {**schemas.RESULTS.widths, **_SHORT}.items()
            if c not in ("ClassGrade", "PercentCorrect")
        ]
    ),
)
def constraint_report(v):
    layouts = [schemas.BANDS, schemas.QUESTIONS, schemas.CHOICES, schemas.QUESTION_STANDARDS, schemas.STUDENTS, schemas.SCORES, schemas.RESPONSES]
    widths = {c: w for c, w in {**schemas.RESULTS.widths, **_SHORT}.items() if c not in ("ClassGrade", "PercentCorrect")}
    layouts.append(replace(schemas.RESULTS, widths=widths))
    stored = {table: getattr(v, child) for table, child, *_ in FOREIGN_KEYS}
    stored |= {"assessments": v.assessments_seed, "legacy_standards": v.legacy_rows, "schools": v.school_rows, "results": v.results}
    return quality.constraint_report(stored, layouts)
