"""Reports and reconciliation checks.

A report with several figures is one pass of conditional aggregates; distinct keys are reduced
before any join; report lists use ``orderBy().limit()`` with a tie-break that makes them repeatable.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import predicates as pred
from ..functions import scalars as s
from ..sources.tables import stage
from .joins import anti_join, lookup_join
from .lookups import with_site_names
from .picks import top_per_key


def row_count() -> Column:
    return F.count(F.lit(1))


def side_by_side(frames: dict[str, DataFrame]) -> DataFrame:
    """One row from one-row, one-column frames, one column each."""
    long = None
    for name, df in frames.items():
        one = df.select(F.lit(name).alias("name"), F.col(df.columns[0]).cast("bigint").alias("n"))
        long = one if long is None else long.unionByName(one)
    return long.agg(*[F.max(F.when(F.col("name") == n, F.col("n"))).alias(n) for n in frames])


def _count_distinct(df: DataFrame, key: Column) -> DataFrame:
    return df.agg(F.countDistinct(key).alias("n"))


# --- duplicates ------------------------------------------------------------------------------------


def duplicate_key() -> Column:
    return s.null_safe_key(
        *[F.col(c) for c in ("StudentID_LASID", "AssessmentID", "StandardCodingNumber", "DateCompleted")]
    )


def duplicate_count(results: DataFrame) -> DataFrame:
    """Rows, distinct keys, and the difference; equal keys are counted together before the shuffle."""
    per_key = results.groupBy(duplicate_key().alias("k")).agg(row_count().alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("TotalRecords"), row_count().alias("UniqueRecords")
    ).withColumn("DuplicateCount", F.col("TotalRecords") - F.col("UniqueRecords"))


def duplicate_groups(results: DataFrame) -> DataFrame:
    keys = [
        "StudentID_LASID",
        "FirstName",
        "LastName",
        "SchoolName",
        "AssessmentID",
        "AssignmentName",
        "StandardCodingNumber",
        "DateCompleted",
    ]
    counted = results.groupBy(*keys).agg(row_count().alias("Occurrences")).where(F.col("Occurrences") > 1)
    return counted.orderBy(F.col("Occurrences").desc(), *keys)


# --- population checks -----------------------------------------------------------------------------


def table_counts(**tables: DataFrame) -> DataFrame:
    """Row count of each table, one row each."""
    return labelled_union({name: df.agg(row_count().alias("n")) for name, df in tables.items()}, "table_name", "n")


def labelled_union(frames: dict[str, DataFrame], label: str = "Source", value: str = "n") -> DataFrame:
    """One-row counts under their labels."""
    out = None
    for name, df in frames.items():
        one = df.select(F.lit(name).alias(label), F.col(df.columns[0]).alias(value))
        out = one if out is None else out.unionByName(one)
    return out


def date_ranges(df: DataFrame, *columns: str) -> DataFrame:
    """Lowest and highest value of each date column, in one pass."""
    return df.agg(
        *[f(c).alias(f"{prefix}_{c}") for c in columns for prefix, f in (("min", F.min), ("max", F.max))]
    )


ASSIGNMENT_KEY = ("ProgramName", "Component", "AssignmentName")
STANDARD_KEY = ("StandardSet", "StandardCodingNumber")


def _joined_key(columns: Sequence[str], null_safe: bool) -> Column:
    make = s.null_safe_key if null_safe else s.null_propagating_key
    return make(*[F.col(c) for c in columns])


def _source_keys(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct assignment and standard keys of the results."""
    standards = results.where(pred.valid_standard(F.col("StandardCodingNumber"), allow_overall=False))
    return results.select(*ASSIGNMENT_KEY).distinct(), standards.select(*STANDARD_KEY).distinct()


def distinct_in_source(results: DataFrame, null_safe: bool = False) -> DataFrame:
    """Distinct assignments and standards in the results.

    By default a key with a missing part is not counted at all; ``null_safe`` counts it too.
    """
    assignments, standards = _source_keys(results)
    return side_by_side(
        {
            "UniqueAssignments": _count_distinct(assignments, _joined_key(ASSIGNMENT_KEY, null_safe)),
            "UniqueStandards": _count_distinct(standards, _joined_key(STANDARD_KEY, null_safe)),
        }
    )


def missing_lookups(
    results: DataFrame, assignments: DataFrame, standards: DataFrame, null_safe: bool = False
) -> DataFrame:
    """Distinct source keys that have no lookup row; keys are made distinct before the anti join."""
    a, st = _source_keys(results)
    a = anti_join(a, assignments, ASSIGNMENT_KEY, null_safe)
    st = anti_join(st, standards, STANDARD_KEY, null_safe)
    return side_by_side(
        {
            "MissingAssignments": _count_distinct(a, _joined_key(ASSIGNMENT_KEY, null_safe)),
            "MissingStandards": _count_distinct(st, _joined_key(STANDARD_KEY, null_safe)),
        }
    )


def population_status(
    results: DataFrame, assignments: DataFrame, standards: DataFrame, null_safe: bool = False
) -> DataFrame:
    """Counts of the two lookups, their gaps, and a verdict on both."""
    a, st = _source_keys(results)
    gaps_a = anti_join(a, assignments, ASSIGNMENT_KEY, null_safe)
    gaps_s = anti_join(st, standards, STANDARD_KEY, null_safe)
    row = side_by_side(
        {
            "AssignmentsCount": assignments.agg(row_count().alias("n")),
            "StandardsCount": standards.agg(row_count().alias("n")),
            "MissingAssignments": _count_distinct(gaps_a, _joined_key(ASSIGNMENT_KEY, null_safe)),
            "MissingStandards": _count_distinct(gaps_s, _joined_key(STANDARD_KEY, null_safe)),
        }
    )
    n_a, n_s = F.col("AssignmentsCount"), F.col("StandardsCount")
    complete = (F.col("MissingAssignments") == 0) & (F.col("MissingStandards") == 0)
    return row.withColumn(
        "Status",
        F.when((n_a > 0) & (n_s > 0) & complete, "SUCCESS")
        .when((n_a > 0) | (n_s > 0), "PARTIAL SUCCESS")
        .otherwise("FAILED"),
    )


def population_status_by_count(results: DataFrame, assignments: DataFrame, standards: DataFrame) -> DataFrame:
    """The shorter verdict: each lookup has rows, and at least as many as there are distinct keys."""
    a, st = _source_keys(results)
    row = side_by_side(
        {
            "AssignmentsCount": assignments.agg(row_count().alias("n")),
            "StandardsCount": standards.agg(row_count().alias("n")),
            "UniqueAssignments": _count_distinct(a, _joined_key(ASSIGNMENT_KEY, False)),
            "UniqueStandards": _count_distinct(st, _joined_key(STANDARD_KEY, False)),
        }
    )
    n_a, n_s = F.col("AssignmentsCount"), F.col("StandardsCount")
    good = (n_a > 0) & (n_s > 0) & (n_a >= F.col("UniqueAssignments")) & (n_s >= F.col("UniqueStandards"))
    return row.withColumn("Status", F.when(good, "SUCCESS").otherwise("WARNING"))


def distinct_ids(results: DataFrame) -> DataFrame:
    """Distinct assessments and standard codes."""
    return side_by_side(
        {
            "UniqueAssessments": results.agg(F.countDistinct("AssessmentID")),
            "UniqueStandards": results.agg(F.countDistinct("StandardCodingNumber")),
        }
    )


# --- counts by column ------------------------------------------------------------------------------


def counts_by(df: DataFrame, *columns: str, name: str = "n") -> DataFrame:
    """Rows per combination of columns, most frequent first."""
    return df.groupBy(*columns).agg(row_count().alias(name)).orderBy(F.col(name).desc(), *columns)


def program_subject_breakdown(assignments: DataFrame) -> DataFrame:
    named = assignments.where(F.col("ProgramName").isNotNull() | F.col("Subject").isNotNull())
    return counts_by(named, "ProgramName", "Subject", name="AssignmentCount")


def standards_by_subject(standards: DataFrame) -> DataFrame:
    return counts_by(standards.where(F.col("Subject").isNotNull()), "Subject", name="StandardCount")


def enrichment_stats(standards: DataFrame) -> DataFrame:
    filled = ("StandardSet", "GradeLevel", "Strand", "Category")
    return standards.agg(row_count().alias("TotalStandards"), *[F.count(c).alias(f"With{c}") for c in filled])


def school_coverage(assignments: DataFrame) -> DataFrame:
    return assignments.agg(
        row_count().alias("TotalAssignments"),
        F.count("SchoolID").alias("AssignmentsWithSchool"),
        (row_count() - F.count("SchoolID")).alias("AssignmentsWithoutSchool"),
    )


def null_school_count(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count_if(F.col("SchoolID").isNull()).alias("RecordsWithNullSchoolID"),
        F.count("SchoolID").alias("TotalRecordsRemaining"),
    )


def assessment_usage(assignments: DataFrame, results: DataFrame) -> DataFrame:
    """Distinct students and most recent date per assignment name, program, school and school name.

    Many schools use the same assessments, so students are counted once per distinct set of assessments
    and not once per school. A set is known by its size and two hashes of its members, so that it needs no list.
    """
    line = ["AssignmentName", "ProgramName", "SchoolID", "site_name"]
    assessment = "SourceAssessmentID"
    per_student = results.groupBy(F.col("AssessmentID").alias(assessment), "StudentID_LASID").agg(
        F.max("DateCompleted").alias("LastUse")
    )
    figures = [F.countDistinct("StudentID_LASID").alias("NumStudents"), F.max("LastUse").alias("MostRecentUse")]
    # A struct, so that lines with missing parts are equal to themselves.
    parts = stage(
        with_site_names(assignments, results).select(F.struct(*line).alias("line"), assessment).distinct()
    )
    one_set = ["size", "total", "mixed"]
    lines = parts.groupBy("line").agg(
        F.count(assessment).alias("size"),
        F.sum(F.xxhash64(assessment).cast("decimal(38,0)")).alias("total"),
        F.bit_xor(F.xxhash64(assessment, F.lit(1))).alias("mixed"),
    )
    named = lines.groupBy(*one_set).agg(F.min("line").alias("line"))
    members = parts.join(named, "line").select(*one_set, assessment)
    used = members.join(per_student, assessment).groupBy(*one_set).agg(*figures)
    out = lines.join(used, one_set, "left")
    columns = ("line.*", F.coalesce("NumStudents", F.lit(0)).alias("NumStudents"), "MostRecentUse")
    return out.select(*columns).orderBy(*line)


# --- grades and teachers ---------------------------------------------------------------------------


def grade_distribution(
    results: DataFrame, as_of: dt.date | None = None, days: int | None = None, teacher: str | None = None
) -> DataFrame:
    """Rows and distinct students per grade, optionally for recent dates or one teacher."""
    if days is not None:
        results = results.where(pred.recent_days(F.col("DateCompleted"), as_of, days))
    if teacher is not None:
        results = results.where(pred.teacher_like(F.col("TeacherLastName"), teacher))
    # Rows per student first: one shuffle serves both figures, and a large grade is spread by student.
    per_student = results.groupBy("StudentGrade", "StudentID_LASID").agg(row_count().alias("n"))
    return (
        per_student.groupBy("StudentGrade")
        .agg(F.sum("n").alias("RecordCount"), F.count("StudentID_LASID").alias("UniqueStudents"))
        .orderBy("StudentGrade")
    )


def teacher_grade_counts(results: DataFrame, teacher: str) -> DataFrame:
    rows = results.where(pred.teacher_like(F.col("TeacherLastName"), teacher))
    keys = ["TeacherLastName", "TeacherFirstName", "StudentGrade"]
    return rows.groupBy(*keys).agg(row_count().alias("StudentCount")).orderBy("StudentGrade", *keys[:2])


def class_statistics(results: DataFrame, teacher: str, grade: str, since: dt.date) -> DataFrame:
    """A teacher's students, dates and rows, and how many students show one grade since a date."""
    rows = results.where(pred.teacher_like(F.col("TeacherLastName"), teacher))
    in_grade = F.count_if((F.col("StudentGrade") == grade) & (F.col("DateCompleted") >= F.lit(since)))
    per_student = rows.groupBy("StudentID_LASID").agg(
        row_count().alias("n"),
        F.min("DateCompleted").alias("first"),
        F.max("DateCompleted").alias("last"),
        in_grade.alias("in_grade"),
    )
    return per_student.agg(
        F.count("StudentID_LASID").alias("TotalStudents"),
        F.min("first").alias("EarliestAssessment"),
        F.max("last").alias("LatestAssessment"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("TotalAssessments"),
        F.count_if(F.col("StudentID_LASID").isNotNull() & (F.col("in_grade") > 0)).alias("StudentsInGrade"),
    )


def grade_offsets(results: DataFrame, since: dt.date) -> DataFrame:
    """Per grade an assignment name starts with: how many stored grades it meets, and the offset if one.

    The distinct pairs are few, so nothing is collected per grade.
    """
    pairs = (
        results.where(pred.starts_with_digit(F.col("AssignmentName")) & (F.col("DateCompleted") >= F.lit(since)))
        .select(s.leading_grade(F.col("AssignmentName")).alias("LeadingGrade"), "StudentGrade")
        .where(F.col("LeadingGrade").isNotNull() & F.col("StudentGrade").isNotNull())
        .distinct()
    )
    only = F.when(row_count() == 1, F.min("StudentGrade"))
    return pairs.groupBy("LeadingGrade").agg(
        row_count().alias("StoredGrades"),
        (only.try_cast("int") - F.col("LeadingGrade").cast("int")).alias("Offset"),
    )


def grade_offset(results: DataFrame, since: dt.date) -> DataFrame:
    """The offset of the lowest leading grade that has one, and a verdict."""
    known = F.col("Offset").isNotNull()
    offset = F.col("DetectedOffset")
    return (
        grade_offsets(results, since)
        .agg(
            F.min_by("Offset", F.when(known, F.col("LeadingGrade").cast("int"))).alias("DetectedOffset"),
            row_count().alias("LeadingGrades"),
        )
        .withColumn(
            "Verdict",
            F.when(offset == 1, "confirmed").when(offset != 0, "other offset").otherwise("undetermined"),
        )
    )


# --- performance and size --------------------------------------------------------------------------


def avg_pct_by_standard(results: DataFrame) -> DataFrame:
    """Mean percent per standard, highest first."""
    keys = ["StandardCodingNumber", "StandardDescription"]
    pct = s.ratio_pct(F.col("PointsAchieved"), F.col("PointsPossible"))
    return (
        results.groupBy(*keys)
        .agg(F.avg(pct).alias("AvgPercent"))
        .orderBy(F.col("AvgPercent").desc_nulls_last(), *keys)
    )


def unique_students(results: DataFrame) -> DataFrame:
    return results.agg(F.countDistinct("StudentID_LASID").alias("UniqueStudents"))


def summary_vs_detail(summary: DataFrame, results: DataFrame) -> DataFrame:
    key = F.concat(F.col("AssignmentName"), F.col("StudentID_LASID").cast("string"))
    return side_by_side(
        {
            "SummaryCount": summary.agg(row_count().alias("n")),
            "UniqueAssignmentStudents": _count_distinct(results, key),
        }
    )


def load_metrics(raw: DataFrame, profile: DataFrame) -> DataFrame:
    """Rows a load inserts and rows it skips for want of a school.

    Rows are counted per student first, so the join is between students.
    """
    per_student = raw.groupBy("local_student_id").agg(row_count().alias("n"))
    known = profile.select("local_student_id", F.lit(1).alias("known"))
    joined = lookup_join(per_student, known, ["local_student_id"])
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    return joined.agg(
        total(F.col("known").isNotNull()).alias("Inserted"), total(F.col("known").isNull()).alias("Skipped")
    )


# --- lists -----------------------------------------------------------------------------------------


def top_by(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first rows in an order; Spark keeps ``n`` per task and merges those."""
    return df.orderBy(*order).limit(n)


def top_recent_lookups(lookup: DataFrame, created: str, *tie: str, n: int = 5) -> DataFrame:
    return top_by(lookup, n, F.col(created).desc_nulls_last(), *tie)


def top_null_school(results: DataFrame, n: int = 10) -> DataFrame:
    rows = results.where(F.col("SchoolID").isNull()).select(
        "ResultID",
        "StudentID_LASID",
        "LastName",
        "FirstName",
        "AssignmentName",
        "DateCompleted",
        "SchoolName",
        "SchoolID",
    )
    return top_by(rows, n, F.col("DateCompleted").desc_nulls_last(), "ResultID")


def recent_for_teacher(
    results: DataFrame, teacher: str, n: int = 10, name_prefix: str | None = None, since: dt.date | None = None
) -> DataFrame:
    rows = results.where(pred.teacher_like(F.col("TeacherLastName"), teacher))
    if name_prefix is not None:
        rows = rows.where(F.col("AssignmentName").startswith(name_prefix))
    if since is not None:
        rows = rows.where(F.col("DateCompleted") >= F.lit(since))
    rows = rows.select(
        "ResultID",
        s.person_name(F.col("LastName"), F.col("FirstName")).alias("StudentName"),
        "StudentGrade",
        "AssignmentName",
        "DateCompleted",
        "SchoolName",
    )
    return top_by(rows, n, F.col("DateCompleted").desc_nulls_last(), "ResultID")


def distinct_top_students(results: DataFrame, teacher: str, as_of: dt.date, days: int, n: int = 5) -> DataFrame:
    rows = results.where(
        pred.teacher_like(F.col("TeacherLastName"), teacher)
        & pred.recent_days(F.col("DateCompleted"), as_of, days)
    ).select(
        "StudentID_LASID",
        s.person_name(F.col("LastName"), F.col("FirstName")).alias("StudentName"),
        "StudentGrade",
        s.person_name(F.col("TeacherLastName"), F.col("TeacherFirstName")).alias("TeacherName"),
        "SchoolName",
    )
    return top_by(rows.distinct(), n, *[F.col(c).asc_nulls_last() for c in ("StudentName", *rows.columns)])


def grade_prefix_rows(results: DataFrame) -> DataFrame:
    """Each row once per grade 1 to 12 its assignment name starts with; '12...' belongs to 1 and 12.

    The grades come from a constant list, so the rows are not joined with anything.
    """
    grades = F.array(*[F.lit(g) for g in range(1, 13)])
    fits = F.filter(grades, lambda g: F.startswith(F.col("AssignmentName"), g.cast("string")))
    return results.where(F.col("AssignmentName").isNotNull()).withColumn("TargetGrade", F.explode(fits))


def random_sample_per_grade(results: DataFrame, since: dt.date, n: int = 5, seed: str = "") -> DataFrame:
    """Rows per grade prefix in an order that looks random and is the same in every run."""
    rows = grade_prefix_rows(results.where(F.col("DateCompleted") >= F.lit(since)))
    order = F.md5(F.concat(F.lit(seed), F.col("ResultID").cast("string")).cast("binary"))
    return top_per_key(rows, ["TargetGrade"], [order, F.col("ResultID")], n).select(
        "TargetGrade",
        "ResultID",
        "StudentGrade",
        "AssignmentName",
        s.person_name(F.col("LastName"), F.col("FirstName")).alias("StudentName"),
        "SchoolName",
    )


def top50_grade_names(results: DataFrame, since: dt.date, n: int = 50) -> DataFrame:
    rows = results.where(
        pred.starts_with_digit(F.col("AssignmentName")) & (F.col("DateCompleted") >= F.lit(since))
    ).select(
        "ResultID",
        "StudentGrade",
        "AssignmentName",
        s.person_name(F.col("LastName"), F.col("FirstName")).alias("StudentName"),
        "TeacherLastName",
        "DateCompleted",
    )
    return top_by(rows, n, "AssignmentName", F.col("StudentGrade").asc_nulls_first(), "ResultID")
