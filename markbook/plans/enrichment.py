"""Raw result rows to landing rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as s
from ..operators.joins import BROADCAST_BYTES, fits_broadcast, lookup_join
from ..operators.lookups import STUDENT, grade_fallback, profile_section, student_profile, teacher_fallback
from ..schemas import LANDING, conform
from ..sources import buckets
from ..sources import reference_tables as ref
from ..sources.tables import stage


def build_profile(
    enrollment: DataFrame,
    sites: DataFrame,
    users: DataFrame,
    roster: DataFrame,
    section_roster: DataFrame,
    subject_map: DataFrame,
    seq: str = "seq",
) -> DataFrame:
    """``student_profile`` from the lookup inputs as they are landed, each with an arrival column.

    It is staged: the join measures it before it reads it.
    """
    return stage(
        student_profile(
            ref.enrollment(enrollment, seq),
            ref.sites(sites, seq),
            ref.users(users, seq),
            ref.roster(roster),
            ref.section_roster(section_roster),
            ref.subject_map(subject_map),
        )
    )


def landing_projection(rows: DataFrame, **columns) -> DataFrame:
    """The 27 landing columns, in order; those the source does not send are typed NULLs."""
    return conform(rows.select(*[c.alias(n) for n, c in columns.items()]), LANDING)


def bucketed_enrichment(spark: SparkSession, raw_table: str, profile_table: str, academic_year: str | None = None, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``full_enrichment`` of tables bucketed by student: neither is shuffled.

    A profile that is small enough is broadcast all the same. Where the tables are not bucketed alike, or one student holds
    much of the results, the join is that of ``full_enrichment``.
    """
    raw, profile = spark.table(raw_table), spark.table(profile_table)
    co_located = buckets.alike(spark, STUDENT, raw_table, profile_table) and buckets.even(spark, raw_table)
    if not co_located or fits_broadcast(profile, max_bytes):
        return full_enrichment(raw, profile, academic_year)
    return _landing_rows(raw.join(profile.hint("merge"), STUDENT), academic_year)


def full_enrichment(raw: DataFrame, profile: DataFrame, academic_year: str | None = None) -> DataFrame:
    """Landing rows of all results whose student has a school.

    One join, on the student; everything else is column expressions.
    """
    return _landing_rows(lookup_join(raw, profile, [STUDENT], "inner"), academic_year)


def _landing_rows(known: DataFrame, academic_year: str | None) -> DataFrame:
    """Landing rows of raw rows with the profile of their student."""
    code, title = F.col("standard_code"), F.col("title")
    rows = known.withColumn("subject", s.subject_of_result(code, title))
    rows = rows.withColumn("section", profile_section(F.col("subject")))
    teacher = teacher_fallback(
        F.col("section").isNotNull(),
        {
            "SectionID": F.col("section.section_id"),
            "TeacherFirstName": F.col("section.teacher_first"),
            "TeacherLastName": F.col("section.teacher_last"),
        },
        {
            "SectionID": F.col("roster_section_id"),
            "TeacherFirstName": F.col("roster_teacher_first"),
            "TeacherLastName": F.col("roster_teacher_last"),
        },
    )
    return landing_projection(
        rows,
        AcademicYear=s.academic_year(F.col("date_taken"), academic_year),
        DistrictName=F.col("district"),
        SchoolName=F.col("school_name"),
        StudentID_SASID=F.col("state_student_id"),
        StudentID_LASID=F.col(STUDENT),
        LastName=F.col("last_name"),
        FirstName=F.col("first_name"),
        StudentGrade=grade_fallback(F.col("grade"), F.col("roster_level_id")),
        Subject=F.col("subject"),
        AssignmentName=title,
        AssessmentID=F.col("assessment_id"),
        DateCompleted=s.parse_date(F.col("date_taken")),
        StandardSet=s.infer_standard_set(code, F.col("standard_set")),
        StandardCodingNumber=code,
        StandardDescription=F.col("standard_description"),
        PointsAchieved=s.safe_decimal(F.col("points")),
        PointsPossible=s.safe_decimal(F.col("points_possible")),
        PercentCorrect=s.percent_text(F.col("points"), F.col("points_possible")),
        SchoolID=F.col("site_id"),
        **teacher,
    )


def require_school(raw: DataFrame, enrollment: DataFrame) -> DataFrame:
    """Results of students that have a school; school id 0 is none."""
    with_school = enrollment.where(F.col("site_id").isNotNull()).select(
        F.col("district_student_id").alias(STUDENT)
    )
    return lookup_join(raw, with_school, [STUDENT], "left_semi")
