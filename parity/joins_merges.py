"""Joins, picks, merges, program sync and nested data."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from markbook.functions import predicates as pred
from markbook.functions import scalars as s
from markbook.operators import joins, lookups, merges, nested, picks, program_sync, quality
from markbook.plans import enrichment, summary
from markbook.session import scratch_dir
from markbook.sources import buckets, pages
from markbook.sources import reference_tables as ref

from .landing import (
    FLAT_BANDS,
    FLAT_CHOICES,
    FLAT_QUESTION_STANDARDS,
    FLAT_QUESTIONS,
    detail_documents,
    land_documents,
    land_pages,
)
from .registry import query
from .scalar_rules import (
    DATE_OF,
    GRADE_OF,
    HEADER_ROWS,
    PREFIX_CASE,
    PROGRAM_VIEW,
    SET_OF,
    SUBJECT_FROM_CODE,
    SUBJECT_FROM_TITLE,
    YEAR_OF,
    half_even,
    program_terms,
)
from .scans_loads import SUMMARY_SQL, profile

C = F.col

# --- lookups ---------------------------------------------------------------------------------------

# Helper queries for the oracles; each is a WITH entry.
STUDENTS = f"""students AS (
  SELECT district_student_id AS sid, state_student_id, {GRADE_OF.format(t='CAST(grade_level_id AS VARCHAR)')} AS grade,
         nullif(site_id, 0) AS school_no, nullif(school, '') AS school, district
  FROM enrollment)"""
FIRST_ROSTER = """first_roster AS (
  SELECT f.district_student_id AS sid, f.section_id, f.grade_level_id AS level_id, u.first_name AS tf, u.last_name AS tl
  FROM (SELECT *, row_number() OVER (PARTITION BY district_student_id ORDER BY seq) AS rn FROM roster) f
  LEFT JOIN users u ON f.user_id = u.user_id WHERE f.rn = 1)"""
MATCHED = """matched AS (
  SELECT * FROM (
    SELECT i.student_id AS sid, m.subject_area_name AS subject_name, i.section_id, i.teacher_first, i.teacher_last,
           row_number() OVER (PARTITION BY i.student_id, m.subject_area_name ORDER BY m.course_id_code) AS pick
    FROM (SELECT *, row_number() OVER (PARTITION BY student_id, subject_area, content_area ORDER BY seq) AS rn
          FROM section_roster WHERE subject_area IS NOT NULL AND content_area IS NOT NULL) i
    JOIN subject_map m ON m.sa_code = i.subject_area AND m.course_id_code = i.content_area
    WHERE i.rn = 1) x WHERE pick = 1)"""
FULL_NAME = """CASE WHEN {s} IN ('ELA', 'English') THEN 'English Language Arts' WHEN {s} IN ('Math', 'Mathematics') THEN 'Mathematics'
  WHEN {s} IN ('Science', 'Social Studies') THEN {s} END"""
RAW_SUBJECT = f"coalesce({SUBJECT_FROM_CODE}, {SUBJECT_FROM_TITLE})"


@query(
    "enrich_enrollment",
    f"""WITH {STUDENTS}
        SELECT r.result_seq, st.state_student_id, st.grade, st.school_no AS site_id, st.district
        FROM raw_results r LEFT JOIN students st ON r.local_student_id = st.sid""",
)
def enrich_enrollment(v):
    rows = lookups.enrich_enrollment(v.raw_results, ref.enrollment(v.enrollment, "seq"))
    return rows.select("result_seq", "state_student_id", "grade", "site_id", "district")


@query(
    "enrich_site",
    """SELECT e.district_student_id, e.site_id, x.site_name FROM enrollment e
       LEFT JOIN (SELECT * FROM sites WHERE site_id <> 0) x ON e.site_id = x.site_id""",
)
def enrich_site(v):
    known = v.sites.where(C("site_id") != 0)
    return lookups.enrich_site(v.enrollment, known).select("district_student_id", "site_id", "site_name")


@query(
    "school_name_fallback",
    """SELECT e.district_student_id, coalesce(nullif(e.school, ''), x.site_name) AS school_name FROM enrollment e
       LEFT JOIN (SELECT * FROM sites WHERE site_id <> 0) x ON e.site_id = x.site_id""",
)
def school_name_fallback(v):
    known = v.sites.where(C("site_id") != 0)
    return lookups.with_school_name(v.enrollment, known).select("district_student_id", "school_name")


@query(
    "match_section",
    f"""WITH {MATCHED}
        SELECT r.result_seq, m.section_id, m.teacher_first, m.teacher_last
        FROM (SELECT *, {RAW_SUBJECT} AS subj FROM raw_results) r
        LEFT JOIN matched m ON m.sid = r.local_student_id AND m.subject_name = {FULL_NAME.format(s='r.subj')}""",
)
def match_section(v):
    choices = lookups.section_choices(ref.section_roster(v.section_roster), ref.subject_map(v.subject_map))
    subject = s.subject_of_result(C("standard_code"), C("title"))
    rows = lookups.match_section(v.raw_results, choices, subject)
    return rows.select("result_seq", "section_id", "teacher_first", "teacher_last")


TEACHER_SQL = f"""WITH {MATCHED}, {FIRST_ROSTER}
  SELECT r.result_seq, CASE WHEN m.sid IS NOT NULL THEN m.section_id ELSE f.section_id END AS section_id,
         CASE WHEN m.sid IS NOT NULL THEN m.teacher_first ELSE f.tf END AS teacher_first,
         CASE WHEN m.sid IS NOT NULL THEN m.teacher_last ELSE f.tl END AS teacher_last
  FROM (SELECT *, {RAW_SUBJECT} AS subj FROM raw_results) r
  LEFT JOIN matched m ON m.sid = r.local_student_id AND m.subject_name = {FULL_NAME.format(s='r.subj')}
  LEFT JOIN first_roster f ON f.sid = r.local_student_id"""


@query("teacher_fallback", TEACHER_SQL)
def teacher_fallback(v):
    choices = lookups.section_choices(ref.section_roster(v.section_roster), ref.subject_map(v.subject_map))
    subject = s.subject_of_result(C("standard_code"), C("title"))
    found = choices.withColumn("matched", F.lit(True)).select(lookups.STUDENT, "subject_name", "section.*", "matched")
    rows = joins.lookup_join(
        v.raw_results.withColumn("subject_name", s.canonical_subject(subject)),
        found,
        [lookups.STUDENT, "subject_name"],
    )
    rows = joins.lookup_join(rows, lookups.roster_users(v.roster, v.users), [lookups.STUDENT])
    columns = lookups.teacher_fallback(
        C("matched").isNotNull(),
        {n: C(n) for n in ("section_id", "teacher_first", "teacher_last")},
        {
            "section_id": C("roster_section_id"),
            "teacher_first": C("roster_teacher_first"),
            "teacher_last": C("roster_teacher_last"),
        },
    )
    return rows.select("result_seq", *[c.alias(n) for n, c in columns.items()])


@query(
    "grade_fallback",
    f"""WITH {STUDENTS}, {FIRST_ROSTER}
        SELECT r.result_seq, coalesce(st.grade, {GRADE_OF.format(t='CAST(f.level_id AS VARCHAR)')}) AS grade
        FROM raw_results r LEFT JOIN students st ON r.local_student_id = st.sid
        LEFT JOIN first_roster f ON f.sid = r.local_student_id""",
)
def grade_fallback(v):
    rows = lookups.enrich_enrollment(v.raw_results, ref.enrollment(v.enrollment, "seq"))
    rows = joins.lookup_join(rows, lookups.roster_users(v.roster, v.users), [lookups.STUDENT])
    return rows.select("result_seq", lookups.grade_fallback(C("grade"), C("roster_level_id")).alias("grade"))


@query(
    "standards_catalogue",
    """SELECT t.StandardCodingNumber, t.StandardSet, c.description, c.content_area, c.grade_level
       FROM standards_now t LEFT JOIN catalogue c ON t.StandardCodingNumber = c.glce_code""",
)
def standards_catalogue(v):
    return lookups.standards_catalogue(v.standards_now, v.catalogue).select(
        "StandardCodingNumber", "StandardSet", "description", "content_area", "grade_level"
    )


SYNC_KEYS = ["StudentID_LASID", "AssignmentName", "DateCompleted", "StandardCodingNumber"]
_MATCH4 = " AND ".join(f"t.{k} = r.{k}" for k in SYNC_KEYS)


@query(
    "anti_join",
    f"SELECT ResultID FROM results r WHERE NOT EXISTS (SELECT 1 FROM program_results_seed t WHERE {_MATCH4})",
)
def anti_join(v):
    return joins.anti_join(v.results, v.program_results_seed, SYNC_KEYS).select("ResultID")


@query(
    "anti_join_null_safe",
    "SELECT ResultID FROM results r WHERE NOT EXISTS (SELECT 1 FROM program_results_seed t WHERE "
    + " AND ".join(f"t.{k} IS NOT DISTINCT FROM r.{k}" for k in SYNC_KEYS)
    + ")",
)
def anti_join_null_safe(v):
    return joins.anti_join(v.results, v.program_results_seed, SYNC_KEYS, null_safe=True).select("ResultID")


@query(
    "semi_join",
    f"""SELECT StandardSet, StandardCodingNumber, StandardDescription FROM standards_now t
        WHERE EXISTS (SELECT 1 FROM results r WHERE {PROGRAM_VIEW} AND r.StandardSet = t.StandardSet
                      AND r.StandardCodingNumber = t.StandardCodingNumber)""",
)
def semi_join(v):
    keys = ["StandardSet", "StandardCodingNumber"]
    rows = joins.semi_join(v.standards_now, program_sync.program_view(v.results), keys)
    return rows.select(*keys, "StandardDescription")


@query(
    "scattered_join",
    f"""WITH {STUDENTS}
        SELECT r.result_seq, st.state_student_id, st.grade, st.school_no AS site_id
        FROM raw_results r LEFT JOIN students st ON r.local_student_id = st.sid""",
)
def scattered_join(v):
    """The shuffle form of a lookup join, with the hot-key path taken by the most frequent students."""
    lookup = ref.enrollment(v.enrollment, "seq").withColumnRenamed("district_student_id", lookups.STUDENT)
    rows = joins.scattered_join(v.raw_results, lookup, [lookups.STUDENT], "left", hot_rows=50, limit=20)
    return rows.select("result_seq", "state_student_id", "grade", "site_id")


LATEST = """latest AS (
  SELECT AssessmentID, SchoolID AS school_no FROM (
    SELECT AssessmentID, SchoolID,
           row_number() OVER (PARTITION BY AssessmentID ORDER BY DateCompleted DESC NULLS LAST, SchoolID) AS rn
    FROM results WHERE AssessmentID IS NOT NULL AND SchoolID IS NOT NULL) x WHERE rn = 1)"""


@query(
    "inner_latest",
    f"""WITH {LATEST}
        SELECT a.AssignmentName, a.SchoolID, a.SourceAssessmentID, l.school_no AS LatestSchoolID
        FROM assignments_seed a JOIN latest l ON a.SourceAssessmentID = l.AssessmentID""",
)
def inner_latest(v):
    return lookups.inner_latest(v.assignments_seed, v.results).select(
        "AssignmentName", "SchoolID", "SourceAssessmentID", "LatestSchoolID"
    )


@query(
    "usage_left_joins",
    """SELECT a.ProgramName, a.Component, a.AssignmentName, a.SchoolID, a.SourceAssessmentID, n.SchoolName AS site_name,
              u.Records, u.NumStudents, u.MostRecentUse
       FROM assignments_now a
       LEFT JOIN (SELECT AssessmentID, COUNT(*) AS Records, COUNT(DISTINCT StudentID_LASID) AS NumStudents,
                         MAX(DateCompleted) AS MostRecentUse FROM results GROUP BY AssessmentID) u
         ON a.SourceAssessmentID = u.AssessmentID
       LEFT JOIN (SELECT DISTINCT SchoolID, SchoolName FROM results WHERE SchoolID IS NOT NULL) n ON a.SchoolID = n.SchoolID""",
)
def usage_left_joins(v):
    return lookups.usage_left_joins(v.assignments_now, v.results).select(
        "ProgramName",
        "Component",
        "AssignmentName",
        "SchoolID",
        "SourceAssessmentID",
        "site_name",
        "Records",
        "NumStudents",
        "MostRecentUse",
    )


@query(
    "roster_users",
    f"WITH {FIRST_ROSTER} SELECT sid AS student, section_id, level_id, tf AS teacher_first, tl AS teacher_last FROM first_roster",
)
def roster_users(v):
    return lookups.roster_users(v.roster, v.users).select(
        C(lookups.STUDENT).alias("student"),
        C("roster_section_id").alias("section_id"),
        C("roster_level_id").alias("level_id"),
        C("roster_teacher_first").alias("teacher_first"),
        C("roster_teacher_last").alias("teacher_last"),
    )


FULL_SQL = f"""WITH {STUDENTS}, {MATCHED}, {FIRST_ROSTER},
  rows AS (SELECT *, {RAW_SUBJECT} AS subj, {DATE_OF.format(t='left(date_taken, 19)')} AS d,
                  CAST(try_strptime(left(date_taken, 10), '%Y-%m-%d') AS DATE) AS iso FROM raw_results)
  SELECT {YEAR_OF.format(d='r.iso')} AS AcademicYear, st.district AS DistrictName, coalesce(st.school, x.site_name) AS SchoolName,
         st.state_student_id AS StudentID_SASID, r.local_student_id AS StudentID_LASID, r.last_name AS LastName,
         r.first_name AS FirstName,
         coalesce(st.grade, {GRADE_OF.format(t='CAST(f.level_id AS VARCHAR)')}) AS StudentGrade,
         CAST(NULL AS VARCHAR) AS ClassName, CASE WHEN m.sid IS NOT NULL THEN m.teacher_last ELSE f.tl END AS TeacherLastName,
         CASE WHEN m.sid IS NOT NULL THEN m.teacher_first ELSE f.tf END AS TeacherFirstName,
         CAST(NULL AS VARCHAR) AS ClassGrade, r.subj AS Subject, CAST(NULL AS VARCHAR) AS ProgramName,
         CAST(NULL AS VARCHAR) AS Publisher, CAST(NULL AS VARCHAR) AS Component, r.title AS AssignmentName,
         r.assessment_id AS AssessmentID, r.d AS DateCompleted, {SET_OF} AS StandardSet, r.standard_code AS StandardCodingNumber,
         r.standard_description AS StandardDescription, r.points AS PointsAchieved, r.points_possible AS PointsPossible,
         {half_even('r.points', 'r.points_possible')} AS PercentCorrect, st.school_no AS SchoolID,
         CASE WHEN m.sid IS NOT NULL THEN m.section_id ELSE f.section_id END AS SectionID
  FROM rows r JOIN students st ON r.local_student_id = st.sid AND st.school_no IS NOT NULL
  LEFT JOIN sites x ON x.site_id = st.school_no
  LEFT JOIN matched m ON m.sid = r.local_student_id AND m.subject_name = {FULL_NAME.format(s='r.subj')}
  LEFT JOIN first_roster f ON f.sid = r.local_student_id"""


@query("full_enrichment", FULL_SQL)
def full_enrichment(v):
    return enrichment.full_enrichment(v.raw_results, profile(v))


@query("bucketed_enrichment", FULL_SQL)
def bucketed_enrichment(v):
    """Both sides stored by student, and a profile that counts as too large to broadcast."""
    name = f"t{uuid.uuid4().hex}"
    count = buckets.buckets_for(v.raw_results)
    for kind, rows in (("raw", v.raw_results), ("profile", profile(v))):
        buckets.write_bucketed(rows, f"{name}_{kind}", scratch_dir(v.spark), "local_student_id", count)
    return enrichment.bucketed_enrichment(v.spark, f"{name}_raw", f"{name}_profile", max_bytes=0)


# --- picks -----------------------------------------------------------------------------------------

CANDIDATES = f"""(SELECT DISTINCT AssessmentID, AssignmentName, coalesce(Subject, {PREFIX_CASE}) AS Subject, ProgramName,
  Publisher, Component, SchoolID FROM results WHERE AssessmentID IS NOT NULL AND SchoolID IS NOT NULL) c"""
FIRST_ASSESSMENT = f"""(SELECT * FROM (SELECT *, row_number() OVER (
    PARTITION BY coalesce(ProgramName, ''), coalesce(Component, ''), coalesce(AssignmentName, ''), SchoolID
    ORDER BY AssessmentID, Subject NULLS LAST, Publisher NULLS LAST) AS rn FROM {CANDIDATES}) y WHERE rn = 1)"""


@query(
    "first_assessment_per_key",
    f"SELECT AssessmentID, AssignmentName, Subject, ProgramName, Publisher, Component, SchoolID FROM {FIRST_ASSESSMENT} z",
)
def first_assessment_per_key(v):
    return picks.first_assessment_per_key(merges.assignment_candidates(v.results))


STANDARD_ROWS = f"""(SELECT DISTINCT StandardCodingNumber, StandardDescription, {PREFIX_CASE} AS Subject
  FROM results WHERE StandardCodingNumber <> '') c"""
ONE_STANDARD = f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY StandardCodingNumber
    ORDER BY StandardDescription NULLS LAST, Subject NULLS LAST) AS rn FROM {STANDARD_ROWS}) y WHERE rn = 1)"""


@query(
    "one_per_standard", f"SELECT StandardCodingNumber, StandardDescription, Subject FROM {ONE_STANDARD} z"
)
def one_per_standard(v):
    return picks.one_per_standard(merges.standard_candidates(v.results))


@query(
    "latest_per_assessment",
    f"""SELECT AssessmentID, SchoolID, DateCompleted FROM (SELECT AssessmentID, SchoolID, DateCompleted,
          row_number() OVER (PARTITION BY AssessmentID ORDER BY DateCompleted DESC NULLS LAST, SchoolID) AS rn
        FROM results WHERE AssessmentID IS NOT NULL AND SchoolID IS NOT NULL) x WHERE rn = 1""",
)
def latest_per_assessment(v):
    return picks.latest_per_assessment(v.results)


DEDUPED = """SELECT ResultID, StudentID_LASID, AssessmentID, StandardCodingNumber, DateCompleted, PointsAchieved FROM (
  SELECT *, row_number() OVER (PARTITION BY StudentID_LASID, AssessmentID, StandardCodingNumber, DateCompleted
                               ORDER BY ResultID DESC) AS rn FROM results) x WHERE rn = 1"""
_DEDUP_COLUMNS = (
    "ResultID",
    "StudentID_LASID",
    "AssessmentID",
    "StandardCodingNumber",
    "DateCompleted",
    "PointsAchieved",
)


@query("latest_duplicate", DEDUPED)
def latest_duplicate(v):
    return picks.latest_duplicate(v.results).select(*_DEDUP_COLUMNS)


@query("delete_duplicates", DEDUPED)
def delete_duplicates(v):
    return quality.delete_duplicates(v.results).select(*_DEDUP_COLUMNS)


@query(
    "delete_null_school", "SELECT ResultID, SchoolID, PointsAchieved FROM results WHERE SchoolID IS NOT NULL"
)
def delete_null_school(v):
    return quality.delete_null_school(v.results).select("ResultID", "SchoolID", "PointsAchieved")


@query(
    "last_wins",
    "SELECT StudentID_LASID, MAX(ResultID) AS ResultID, arg_max(DateCompleted, ResultID) AS DateCompleted FROM results GROUP BY 1",
)
def last_wins(v):
    return picks.last_per_key(v.results, ["StudentID_LASID"], ["ResultID"]).select(
        "StudentID_LASID", "ResultID", "DateCompleted"
    )


@query(
    "first_wins",
    """SELECT district_student_id, arg_min(section_id, seq) AS section_id, arg_min(user_id, seq) AS user_id
       FROM roster GROUP BY 1""",
)
def first_wins(v):
    return picks.first_per_key(v.roster, ["district_student_id"], ["seq"]).select(
        "district_student_id", "section_id", "user_id"
    )


# --- merges ----------------------------------------------------------------------------------------


@query(
    "merge_assignments",
    f"""SELECT coalesce(z.ProgramName, t.ProgramName) AS ProgramName, coalesce(z.Component, t.Component) AS Component,
               coalesce(z.AssignmentName, t.AssignmentName) AS AssignmentName, coalesce(z.SchoolID, t.SchoolID) AS SchoolID,
               CASE WHEN t.Subject IS NOT NULL THEN t.SourceAssessmentID ELSE z.AssessmentID END AS SourceAssessmentID,
               coalesce(z.Publisher, t.Publisher) AS Publisher, coalesce(z.Subject, t.Subject) AS Subject
        FROM assignments_seed t FULL OUTER JOIN {FIRST_ASSESSMENT} z
          ON coalesce(t.ProgramName, '') = coalesce(z.ProgramName, '') AND coalesce(t.Component, '') = coalesce(z.Component, '')
         AND coalesce(t.AssignmentName, '') = coalesce(z.AssignmentName, '') AND t.SchoolID = z.SchoolID""",
)
def merge_assignments(v):
    return merges.merge_assignments(v.assignments_seed, v.results)


@query(
    "merge_standards",
    f"""SELECT coalesce(t.StandardCodingNumber, z.StandardCodingNumber) AS StandardCodingNumber, t.StandardSet,
               coalesce(z.StandardDescription, t.StandardDescription) AS StandardDescription,
               coalesce(z.Subject, t.Subject) AS Subject
        FROM standards_seed t FULL OUTER JOIN {ONE_STANDARD} z ON t.StandardCodingNumber = z.StandardCodingNumber""",
)
def merge_standards(v):
    return merges.merge_standards(v.standards_seed, v.results)


CATALOGUE_SOURCE = f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY code
     ORDER BY description NULLS LAST, subject NULLS LAST, standard_set NULLS LAST) AS rn
   FROM (SELECT r.code, coalesce(g.description, r.own) AS description, g.content_area AS standard_set,
                coalesce(r.subj, g.subject) AS subject, g.grade_level, g.subject_desc1, g.type
         FROM (SELECT DISTINCT StandardCodingNumber AS code, StandardDescription AS own,
                      coalesce({PREFIX_CASE}, Subject) AS subj FROM results WHERE StandardCodingNumber <> '') r
         LEFT JOIN catalogue g ON r.code = g.glce_code) y) w WHERE rn = 1)"""


@query(
    "merge_standards_catalogue",
    f"""SELECT coalesce(t.StandardCodingNumber, z.code) AS StandardCodingNumber,
               coalesce(z.standard_set, t.StandardSet) AS StandardSet,
               coalesce(z.description, t.StandardDescription) AS StandardDescription, coalesce(z.subject, t.Subject) AS Subject,
               z.grade_level AS GradeLevel, z.subject_desc1 AS Strand, z.type AS Category
        FROM standards_seed t FULL OUTER JOIN {CATALOGUE_SOURCE} z ON t.StandardCodingNumber = z.code""",
)
def merge_standards_catalogue(v):
    return merges.merge_standards_catalogue(ensure_columns(v), v.results, v.catalogue)


_ADDED = StructType([StructField(c, StringType()) for c in ("GradeLevel", "Strand", "Category")])


@query(
    "ensure_columns",
    """SELECT *, CAST(NULL AS VARCHAR) AS GradeLevel, CAST(NULL AS VARCHAR) AS Strand, CAST(NULL AS VARCHAR) AS Category
       FROM standards_seed""",
)
def ensure_columns(v):
    return quality.ensure_columns(quality.ensure_columns(v.standards_seed, _ADDED), _ADDED)


@query(
    "insert_absent_standard",
    """SELECT StandardSet, StandardCodingNumber, StandardDescription, Subject FROM standards_seed
       UNION ALL
       SELECT StandardSet, StandardCodingNumber, StandardDescription, Subject FROM (
         SELECT *, row_number() OVER (PARTITION BY StandardSet, StandardCodingNumber ORDER BY ResultID) AS rn FROM results) r
       WHERE (StandardSet IS NULL OR StandardCodingNumber IS NULL OR rn = 1)
         AND NOT EXISTS (SELECT 1 FROM standards_seed t WHERE t.StandardSet = r.StandardSet
                         AND t.StandardCodingNumber = r.StandardCodingNumber)""",
)
def insert_absent_standard(v):
    source = v.results.select(
        "StandardSet", "StandardCodingNumber", "StandardDescription", "Subject", C("ResultID").alias("seq")
    )
    return merges.insert_absent_standard(v.standards_seed, source, "seq")


_AKEY = ("ProgramName", "Component", "AssignmentName", "SchoolID")


@query(
    "insert_absent_assignment",
    f"""SELECT ProgramName, Component, AssignmentName, SchoolID, SourceAssessmentID, Publisher, Subject FROM assignments_seed
       UNION ALL
       SELECT ProgramName, Component, AssignmentName, SchoolID, AssessmentID, Publisher, Subject FROM (
         SELECT *, row_number() OVER (PARTITION BY {', '.join(_AKEY)} ORDER BY ResultID) AS rn FROM results_base) r
       WHERE ({' OR '.join(f'{k} IS NULL' for k in _AKEY)} OR rn = 1)
         AND NOT EXISTS (SELECT 1 FROM assignments_seed t WHERE {' AND '.join(f't.{k} = r.{k}' for k in _AKEY)})""",
)
def insert_absent_assignment(v):
    source = v.results_base.select(
        *_AKEY, C("AssessmentID").alias("SourceAssessmentID"), "Publisher", "Subject", C("ResultID").alias("seq")
    )
    return merges.insert_absent_assignment(v.assignments_seed, source, "seq")


def upsert_sql(target: str, source: str, keys, first, last, where: str = "true") -> str:
    """Row-at-a-time upserts of a batch: first record inserts, last record sets the updated columns."""
    null_key = " OR ".join(f"{k} IS NULL" for k in keys)
    on = " AND ".join(f"t.{k} = z.{k}" for k in keys)
    picked = [f"arg_min_null({c}, seq) AS {c}" for c in first] + [f"arg_max_null({c}, seq) AS {c}" for c in last]
    batch = (
        f"SELECT {', '.join([*keys, *picked])} FROM src WHERE NOT ({null_key}) GROUP BY {', '.join(keys)} "
        f"UNION ALL SELECT {', '.join([*keys, *first, *last])} FROM src WHERE {null_key}"
    )
    cols = [f"coalesce(t.{k}, z.{k}) AS {k}" for k in keys]
    cols += [f"CASE WHEN t.here THEN t.{c} ELSE z.{c} END AS {c}" for c in first]
    cols += [f"CASE WHEN z.here THEN z.{c} ELSE t.{c} END AS {c}" for c in last]
    return (
        f"WITH src AS (SELECT * FROM {source} WHERE {where}), batch AS ({batch}) "
        f"SELECT {', '.join(cols)} FROM (SELECT *, true AS here FROM {target}) t "
        f"FULL OUTER JOIN (SELECT *, true AS here FROM batch) z ON {on}"
    )


@query(
    "upsert_assessments",
    upsert_sql(
        "assessments_seed",
        "(SELECT * REPLACE (coalesce(deleted, false) AS deleted) FROM assessment_records) q",
        ["assessment_id"],
        ["local_assessment_id", "subject_id", "created_date"],
        ["title", "description", "subject_name", "version", "deleted"],
        "assessment_id IS NOT NULL",
    ),
)
def upsert_assessments(v):
    return merges.upsert_assessments(v.assessments_seed, v.assessment_records, "seq")


@query(
    "upsert_questions",
    upsert_sql(
        "questions_seed",
        "question_records",
        ["assessment_id", "question_number"],
        [],
        ["question_text", "question_type", "max_points", "correct_answer"],
    ),
)
def upsert_questions(v):
    return merges.upsert_questions(v.questions_seed, v.question_records, "seq")


@query(
    "upsert_legacy_standards",
    upsert_sql(
        "legacy_standards_seed",
        "standard_records",
        ["standard_id"],
        ["standard_code"],
        ["standard_description", "subject", "grade_level"],
        "standard_id IS NOT NULL",
    ),
)
def upsert_legacy_standards(v):
    return merges.upsert_legacy_standards(v.legacy_standards_seed, v.standard_records, "seq")


@query(
    "upsert_scores",
    upsert_sql(
        "scores_seed",
        "score_records",
        ["student_id", "assessment_id", "test_date"],
        ["local_student_id"],
        ["raw_score", "percent_correct", "performance_band", "version"],
    ),
)
def upsert_scores(v):
    return merges.upsert_scores(v.scores_seed, v.score_records, "seq")


@query(
    "insert_ignore_link",
    "SELECT question_id, standard_id FROM links_seed UNION SELECT question_id, standard_id FROM link_records",
)
def insert_ignore_link(v):
    return merges.insert_ignore_link(v.links_seed, v.link_records)


@query(
    "insert_new_assessments",
    f"""SELECT ProgramName, Component, AssignmentName, SchoolID, SourceAssessmentID, Publisher, Subject FROM assignments_seed
        UNION ALL
        SELECT ProgramName, Component, AssignmentName, CAST(NULL AS INT), SourceAssessmentID, Publisher, Subject FROM (
          SELECT *, row_number() OVER (PARTITION BY SourceAssessmentID ORDER BY seq) AS rn FROM ({HEADER_ROWS}) h) r
        WHERE (SourceAssessmentID IS NULL OR rn = 1)
          AND NOT EXISTS (SELECT 1 FROM assignments_seed t WHERE t.SourceAssessmentID = r.SourceAssessmentID)""",
)
def insert_new_assessments(v):
    return merges.insert_new_assessments(v.assignments_seed, v.header_records)


@query(
    "update_from_latest_school",
    f"""WITH {LATEST}
        SELECT a.ProgramName, a.Component, a.AssignmentName, coalesce(l.school_no, a.SchoolID) AS SchoolID,
               a.SourceAssessmentID, a.Publisher, a.Subject
        FROM assignments_seed a LEFT JOIN latest l ON a.SourceAssessmentID = l.AssessmentID""",
)
def update_from_latest_school(v):
    return merges.update_from_latest_school(v.assignments_seed, v.results)


def backfill_sql(grade: str) -> str:
    return f"""WITH {FIRST_ROSTER},
  needing AS (SELECT DISTINCT StudentID_LASID AS sid FROM results WHERE TeacherLastName IS NULL OR StudentGrade IS NULL),
  known AS (SELECT f.sid, f.tf, f.tl, {grade} AS grade FROM first_roster f JOIN needing n ON f.sid = n.sid
            WHERE f.tf <> '' OR f.tl <> '' OR f.level_id <> 0)
  SELECT r.ResultID, coalesce(r.TeacherFirstName, k.tf) AS TeacherFirstName, coalesce(r.TeacherLastName, k.tl) AS TeacherLastName,
         coalesce(r.StudentGrade, k.grade) AS StudentGrade
  FROM results r LEFT JOIN known k ON r.StudentID_LASID = k.sid"""


_BACKFILLED = ("ResultID", "TeacherFirstName", "TeacherLastName", "StudentGrade")


@query("backfill_teacher_grade", backfill_sql(GRADE_OF.format(t="CAST(f.level_id AS VARCHAR)")))
def backfill_teacher_grade(v):
    return lookups.backfill_teacher_grade(v.results, v.roster, v.users).select(*_BACKFILLED)


@query("backfill_teacher_grade_raw", backfill_sql("CAST(f.level_id AS VARCHAR)"))
def backfill_teacher_grade_raw(v):
    return lookups.backfill_teacher_grade(v.results, v.roster, v.users, convert_grade=False).select(*_BACKFILLED)


@query(
    "backfill_section_teacher",
    """WITH sec AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY student_id, subject_area ORDER BY seq) AS rn
                                  FROM section_roster) x WHERE rn = 1)
       SELECT r.ResultID, q.section_id AS SectionID,
              CASE WHEN q.student_id IS NOT NULL THEN q.teacher_first ELSE r.TeacherFirstName END AS TeacherFirstName,
              CASE WHEN q.student_id IS NOT NULL THEN q.teacher_last ELSE r.TeacherLastName END AS TeacherLastName
       FROM results r LEFT JOIN sec q ON q.student_id = r.StudentID_LASID AND q.subject_area =
         CASE r.Subject WHEN 'ELA' THEN 1 WHEN 'Math' THEN 2 WHEN 'Science' THEN 3 WHEN 'Social Studies' THEN 4 END""",
)
def backfill_section_teacher(v):
    return lookups.backfill_section_teacher(v.results, v.section_roster).select(
        "ResultID", "SectionID", "TeacherFirstName", "TeacherLastName"
    )


# --- program copies --------------------------------------------------------------------------------


@query(
    "sync_program_results",
    f"""SELECT StudentID_LASID, AssignmentName, DateCompleted, StandardCodingNumber, CAST(NULL AS BIGINT) AS ResultID,
               CAST(NULL AS VARCHAR) AS ProgramName FROM program_results_seed
        UNION ALL
        SELECT StudentID_LASID, AssignmentName, DateCompleted, StandardCodingNumber, ResultID, ProgramName FROM results r
        WHERE {PROGRAM_VIEW} AND NOT EXISTS (SELECT 1 FROM program_results_seed t WHERE {_MATCH4})""",
)
def sync_program_results(v):
    return program_sync.sync_program_results(v.results, v.program_results_seed).select(
        *SYNC_KEYS, "ResultID", "ProgramName"
    )


@query(
    "sync_program_summary",
    f"""SELECT StudentID_LASID, AssignmentName, DateCompleted, CAST(NULL AS DECIMAL(20,2)) AS TotalPointsAchieved
        FROM program_summary_seed
        UNION ALL
        SELECT StudentID_LASID, AssignmentName, DateCompleted, TotalPointsAchieved FROM ({SUMMARY_SQL}) q
        WHERE ({program_terms('ProgramName')}) AND NOT EXISTS (
          SELECT 1 FROM program_summary_seed t WHERE t.StudentID_LASID = q.StudentID_LASID
            AND t.AssignmentName = q.AssignmentName AND t.DateCompleted = q.DateCompleted)""",
)
def sync_program_summary(v):
    return program_sync.sync_program_summary(summary.summary(v.results), v.program_summary_seed).select(
        "StudentID_LASID", "AssignmentName", "DateCompleted", "TotalPointsAchieved"
    )


_PROGRAM_STANDARDS = f"""SELECT StandardSet, StandardCodingNumber, CAST(NULL AS VARCHAR) AS StandardDescription,
       CAST(NULL AS VARCHAR) AS Subject FROM program_standards_seed
UNION ALL
SELECT DISTINCT StandardSet, StandardCodingNumber, StandardDescription, Subject FROM standards_now s
WHERE EXISTS (SELECT 1 FROM results r WHERE {PROGRAM_VIEW} AND r.StandardSet = s.StandardSet
              AND r.StandardCodingNumber = s.StandardCodingNumber)
  AND NOT EXISTS (SELECT 1 FROM program_standards_seed t WHERE t.StandardSet = s.StandardSet
                  AND t.StandardCodingNumber = s.StandardCodingNumber)"""
_PROGRAM_ASSIGNMENTS = f"""SELECT ProgramName, Component, AssignmentName, CAST(NULL AS VARCHAR) AS Subject FROM program_assignments_seed
UNION ALL
SELECT DISTINCT ProgramName, Component, AssignmentName, Subject FROM assignments_now s
WHERE ({program_terms('ProgramName')}) AND NOT EXISTS (
  SELECT 1 FROM program_assignments_seed t WHERE t.ProgramName = s.ProgramName AND t.Component = s.Component
    AND t.AssignmentName = s.AssignmentName)"""


@query("sync_program_standards", _PROGRAM_STANDARDS)
def sync_program_standards(v):
    return program_sync.sync_program_standards(v.standards_now, v.results, v.program_standards_seed)


@query("sync_program_assignments", _PROGRAM_ASSIGNMENTS)
def sync_program_assignments(v):
    return program_sync.sync_program_assignments(v.assignments_now, v.program_assignments_seed)


@query(
    "sync_status",
    f"""SELECT 'Sync completed' AS Status, (SELECT COUNT(*) FROM results WHERE {PROGRAM_VIEW}) AS results_count,
               (SELECT COUNT(*) FROM ({SUMMARY_SQL}) q WHERE {program_terms('ProgramName')}) AS summary_count,
               (SELECT COUNT(*) FROM ({_PROGRAM_STANDARDS}) a) AS standards_count,
               (SELECT COUNT(*) FROM ({_PROGRAM_ASSIGNMENTS}) b) AS assignments_count""",
)
def sync_status(v):
    rows = summary.summary(v.results)
    return program_sync.sync_status(
        program_sync.program_view(v.results),
        rows.where(pred.program_name_only(C("ProgramName"))),
        sync_program_standards(v),
        sync_program_assignments(v),
    )


@query(
    "program_copy",
    """SELECT StudentID_LASID, AssignmentName, DateCompleted, StandardCodingNumber, CAST(NULL AS VARCHAR) AS Publisher
       FROM program_results_seed
       UNION ALL
       SELECT StudentID_LASID, AssignmentName, DateCompleted, StandardCodingNumber, Publisher FROM results
       WHERE lower(ProgramName) LIKE '%nwea%' OR lower(Publisher) LIKE '%nwea%'""",
)
def program_copy(v):
    return program_sync.program_copy(v.results, v.program_results_seed, ["NWEA"]).select(*SYNC_KEYS, "Publisher")


# --- nested documents ------------------------------------------------------------------------------


def detail(v):
    return pages.assessment_detail(v.spark, land_documents(detail_documents(v)))


@query("flatten_bands", FLAT_BANDS)
def flatten_bands(v):
    return nested.flatten_bands(detail(v))


@query("flatten_questions", FLAT_QUESTIONS)
def flatten_questions(v):
    return nested.flatten_questions(detail(v)).drop("position")


@query("flatten_choices", FLAT_CHOICES)
def flatten_choices(v):
    return nested.flatten_choices(detail(v))


@query("flatten_question_standards", FLAT_QUESTION_STANDARDS)
def flatten_question_standards(v):
    return nested.flatten_question_standards(detail(v)).drop("position")


@query(
    "score_rows",
    """SELECT student_id, assessment_id, local_student_id, test_date, raw_score, percent_correct, performance_band, version
       FROM score_records""",
)
def score_rows(v):
    return pages.score_rows(v.spark, land_pages(v.score_records))
