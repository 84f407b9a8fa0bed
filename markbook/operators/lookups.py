"""Enrichment of result rows from enrollment, sites, sections, roster, users and the catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.predicates import needs_enrichment
from ..functions.scalars import (
    canonical_subject,
    first_number,
    first_text,
    grade_from_level_id,
    parse_date,
    school_name,
)
from ..sources.tables import stage
from .joins import broadcast_if_small, lookup_join
from .picks import first_per_key, latest_per_assessment

STUDENT = "local_student_id"
_SUBJECTS = sorted(set(fixed.SUBJECT_LABELS.values()))
_SECTION_COLUMNS = {name: f"section_{i}" for i, name in enumerate(_SUBJECTS)}


def enrich_enrollment(results: DataFrame, enrollment: DataFrame, how: str = "left") -> DataFrame:
    """State id, grade, site, school and district of the student."""
    lookup = enrollment.withColumnRenamed("district_student_id", STUDENT)
    return lookup_join(results, lookup, [STUDENT], how)


def enrich_site(df: DataFrame, sites: DataFrame) -> DataFrame:
    """Site name by site id."""
    return lookup_join(df, sites.select("site_id", "site_name"), ["site_id"])


def with_school_name(df: DataFrame, sites: DataFrame) -> DataFrame:
    """Enrolled school, else the site's name, as ``school_name``."""
    return (
        enrich_site(df, sites)
        .withColumn("school_name", school_name(F.col("school"), F.col("site_name")))
        .drop("school", "site_name")
    )


def section_uses(section_roster: DataFrame, subject_map: DataFrame) -> DataFrame:
    """Roster sections with the subject names they can serve and their rank for it.

    The map side holds one row per (code, content area) with its subjects in a short list (there are
    four subject names), so it is a lookup. Rows without a code or a content area serve nothing.
    """
    wanted = subject_map.where(F.col("subject_area_name").isin(_SUBJECTS))
    areas = wanted.groupBy(
        F.col("sa_code").alias("subject_area"), F.col("course_id_code").alias("content_area")
    ).agg(F.collect_set(F.struct("subject_area_name", "priority")).alias("uses"))
    return (
        lookup_join(section_roster, areas, ["subject_area", "content_area"], "inner")
        .withColumn("use", F.explode("uses"))
        .select(
            F.col("student_id").alias(STUDENT),
            F.col("use.subject_area_name").alias("subject_name"),
            F.struct("section_id", "teacher_first", "teacher_last").alias("section"),
            F.struct("use.priority", "seq").alias("rank"),
        )
    )


def section_choices(section_roster: DataFrame, subject_map: DataFrame) -> DataFrame:
    """Section per student and subject name: of the first content area in map order the first roster row."""
    uses = section_uses(section_roster, subject_map)
    return first_per_key(uses, [STUDENT, "subject_name"], ["rank"]).drop("rank")


def sections_by_student(section_roster: DataFrame, subject_map: DataFrame) -> DataFrame:
    """The same choices as one column per subject; at most one entry a subject is gathered for a student."""
    known = section_choices(section_roster, subject_map).where(F.col("subject_name").isin(list(_SECTION_COLUMNS)))
    found = known.groupBy(STUDENT).agg(F.map_from_entries(F.collect_list(F.struct("subject_name", "section"))).alias("of"))
    return found.select(STUDENT, *[F.col("of")[name].alias(column) for name, column in _SECTION_COLUMNS.items()])


def match_section(results: DataFrame, choices: DataFrame, subject: Column) -> DataFrame:
    """Section columns by student and subject label; NULL where no section matches."""
    return (
        lookup_join(
            results.withColumn("subject_name", canonical_subject(subject)),
            choices.select(STUDENT, "subject_name", "section.*"),
            [STUDENT, "subject_name"],
        )
        .drop("subject_name")
    )


def roster_users(roster: DataFrame, users: DataFrame) -> DataFrame:
    """Per student the first roster row, its section and level, and the teacher behind its user id."""
    first = first_per_key(roster, ["district_student_id"], ["seq"]).select(
        F.col("district_student_id").alias(STUDENT),
        F.col("section_id").alias("roster_section_id"),
        F.col("grade_level_id").alias("roster_level_id"),
        "user_id",
    )
    teachers = users.select(
        "user_id",
        F.col("first_name").alias("roster_teacher_first"),
        F.col("last_name").alias("roster_teacher_last"),
    )
    return lookup_join(first, teachers, ["user_id"]).drop("user_id")


def teacher_fallback(matched: Column, section: dict[str, Column], roster: dict[str, Column]) -> dict[str, Column]:
    """Section id and teacher names from the section if one matched, else all from the roster.

    The switch is for the three columns together: a matched section with no teacher stays so.
    """
    return {name: F.when(matched, section[name]).otherwise(roster[name]) for name in section}


def grade_fallback(grade: Column, roster_level_id: Column) -> Column:
    return F.coalesce(grade, grade_from_level_id(roster_level_id))


def student_profile(
    enrollment: DataFrame,
    sites: DataFrame,
    users: DataFrame,
    roster: DataFrame,
    section_roster: DataFrame,
    subject_map: DataFrame,
) -> DataFrame:
    """Everything the landing rows need to know about a student, one row each.

    Sections are folded to one column per subject, so the result rows need a single join, on the
    student, in place of one per lookup. Students without a site are left out: their results are
    skipped.
    """
    students = with_school_name(enrollment.where(F.col("site_id").isNotNull()), sites)
    return (
        students.withColumnRenamed("district_student_id", STUDENT)
        .join(roster_users(roster, users), STUDENT, "left")
        .join(sections_by_student(section_roster, subject_map), STUDENT, "left")
    )


def profile_section(subject_label: Column) -> Column:
    """The profile's section column for a subject label."""
    labels: dict[str, list[str]] = {}
    for label, name in fixed.SUBJECT_LABELS.items():
        labels.setdefault(name, []).append(label)
    # each label is compared once: with the names spelled out for every column the landing rows' method was too long to be compiled
    return F.coalesce(*[F.when(subject_label.isin(of), F.col(_SECTION_COLUMNS[name])) for name, of in labels.items()])


def standards_catalogue(standards: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Catalogue columns by standard code; a code listed twice in the catalogue gives two rows."""
    cat = broadcast_if_small(catalogue)
    return standards.join(cat, standards["StandardCodingNumber"] == cat["glce_code"], "left")


def inner_latest(assignments: DataFrame, results: DataFrame) -> DataFrame:
    """Assignments with the school of the most recent result of their assessment."""
    latest = latest_per_assessment(results).select(
        F.col("AssessmentID").alias("SourceAssessmentID"), F.col("SchoolID").alias("LatestSchoolID")
    )
    return lookup_join(assignments, latest, ["SourceAssessmentID"], "inner")


def with_site_names(assignments: DataFrame, results: DataFrame) -> DataFrame:
    """Assignments with the names their school has in the results; two names give two rows."""
    names = (
        results.where(F.col("SchoolID").isNotNull())
        .select("SchoolID", F.col("SchoolName").alias("site_name"))
        .distinct()
    )
    return assignments.join(broadcast_if_small(names), "SchoolID", "left")


def usage_left_joins(assignments: DataFrame, results: DataFrame) -> DataFrame:
    """Assignments with school names and the use of their assessment.

    The results are counted per assessment before the join, so it does not pair every assignment
    of an assessment with every result of it.
    """
    usage = results.groupBy(F.col("AssessmentID").alias("SourceAssessmentID")).agg(
        F.count(F.lit(1)).alias("Records"),
        F.countDistinct("StudentID_LASID").alias("NumStudents"),
        F.max("DateCompleted").alias("MostRecentUse"),
    )
    return lookup_join(with_site_names(assignments, results), usage, ["SourceAssessmentID"])


def students_lacking(results: DataFrame) -> DataFrame:
    """Students with a row that lacks the teacher or the grade."""
    lacking = needs_enrichment(F.col("StudentID_LASID"), F.col("TeacherLastName"), F.col("StudentGrade"))
    return results.where(lacking).select(F.col("StudentID_LASID").alias(STUDENT)).distinct()


def backfill_teacher_grade(
    results: DataFrame, roster: DataFrame, users: DataFrame, convert_grade: bool = True, lacking: DataFrame | None = None
) -> DataFrame:
    """Fill missing teacher names and grade on all rows of every student that lacks one somewhere.

    ``convert_grade=False`` writes the level id as it is. ``lacking``: those students, where ``results`` is only part of a table.
    """
    # staged, as the join measures the lookup before it reads it
    needing = stage(students_lacking(results)) if lacking is None else lacking
    level = F.col("roster_level_id")
    has_level = F.coalesce(~level.cast("string").isin("", "0"), F.lit(False))
    has_name = lambda c: F.coalesce(F.col(c) != "", F.lit(False))
    known = (
        roster_users(roster, users)
        .where(has_name("roster_teacher_first") | has_name("roster_teacher_last") | has_level)
        .select(
            STUDENT,
            F.col("roster_teacher_first").alias("_first"),
            F.col("roster_teacher_last").alias("_last"),
            (grade_from_level_id(level) if convert_grade else level.cast("string")).alias("_grade"),
        )
        .join(needing, STUDENT, "left_semi")
        .withColumnRenamed(STUDENT, "StudentID_LASID")
    )
    filled = lookup_join(results, stage(known), ["StudentID_LASID"]).withColumns(
        {
            "TeacherFirstName": F.coalesce("TeacherFirstName", "_first"),
            "TeacherLastName": F.coalesce("TeacherLastName", "_last"),
            "StudentGrade": F.coalesce("StudentGrade", "_grade"),
        }
    )
    return filled.select(*results.columns)


def backfill_section_teacher(results: DataFrame, section_roster: DataFrame) -> DataFrame:
    """Section and teacher of existing rows by student and subject code; other rows stay as they are.

    Where a student has several sections of a subject the first in arrival order is taken.
    """
    code = None
    for subject, value in fixed.SECTION_SUBJECT_CODES.items():
        test = F.col("Subject") == subject
        code = F.when(test, value) if code is None else code.when(test, value)
    sections = first_per_key(
        section_roster.where(F.col("subject_area").isNotNull()), ["student_id", "subject_area"], ["seq"]
    ).select(
        F.col("student_id").alias("StudentID_LASID"),
        F.col("subject_area").alias("_code"),
        F.struct("section_id", "teacher_first", "teacher_last").alias("_section"),
    )
    have_section = "SectionID" in results.columns
    old_section = F.col("SectionID") if have_section else F.lit(None).cast("string")
    matched = F.col("_section").isNotNull()
    filled = lookup_join(results.withColumn("_code", code), sections, ["StudentID_LASID", "_code"]).withColumns(
        {
            "SectionID": F.when(matched, F.col("_section.section_id")).otherwise(old_section),
            "TeacherFirstName": F.when(matched, F.col("_section.teacher_first")).otherwise(
                F.col("TeacherFirstName")
            ),
            "TeacherLastName": F.when(matched, F.col("_section.teacher_last")).otherwise(
                F.col("TeacherLastName")
            ),
        }
    )
    return filled.select(*results.columns, *([] if have_section else ["SectionID"]))


def alias_fields(nested: DataFrame, academic_year: Column) -> dict[str, Column]:
    """Landing fields of a nested record, each from its first alias that holds something."""
    text = lambda *names: first_text(*[F.col(n) for n in names])
    return {
        "AcademicYear": academic_year,
        "DistrictName": F.col("district_name"),
        "SchoolName": text("school_name", "site_name"),
        "StudentID_SASID": text("state_student_id", "sasid"),
        "StudentID_LASID": text("local_student_id", "lasid", "student_id"),
        "LastName": text("last_name", "student_last_name"),
        "FirstName": text("first_name", "student_first_name"),
        "StudentGrade": text("grade_level", "student_grade"),
        "ClassName": text("class_name", "section_name"),
        "TeacherLastName": F.col("teacher_last_name"),
        "TeacherFirstName": F.col("teacher_first_name"),
        "ClassGrade": text("class_grade_level", "grade_level"),
        "Subject": text("subject", "subject_name"),
        "ProgramName": F.col("program_name"),
        "Publisher": F.col("publisher"),
        "Component": F.col("component"),
        "AssignmentName": text("assessment_name", "assessment_title", "assignment_name"),
        "AssessmentID": F.col("assessment_id"),
        "DateCompleted": parse_date(text("date_completed", "test_date")),
        "SchoolID": first_number(F.col("school_id"), F.col("site_id")),
    }
