"""Program-specific copies of the four tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import predicates as pred
from .joins import anti_join, semi_join


def program_view(results: DataFrame) -> DataFrame:
    """Results of the default program."""
    return results.where(pred.program_view(F.col("ProgramName"), F.col("Publisher"), F.col("AssignmentName")))


def view_since_date(results: DataFrame, start) -> DataFrame:
    return program_view(results.where(F.col("DateCompleted") >= F.lit(start)))


def _append(target: DataFrame, new: DataFrame) -> DataFrame:
    return target.unionByName(new, allowMissingColumns=True)


RESULT_KEYS = ("StudentID_LASID", "AssignmentName", "DateCompleted", "StandardCodingNumber")
SUMMARY_KEYS = ("StudentID_LASID", "AssignmentName", "DateCompleted")
STANDARD_KEYS = ("StandardSet", "StandardCodingNumber")
ASSIGNMENT_KEYS = ("ProgramName", "Component", "AssignmentName")


def new_program_results(results: DataFrame, target: DataFrame, null_safe: bool = False) -> DataFrame:
    """The program's results that are not in the copy.

    By plain equality a row with a missing key part is new in every run;
    ``null_safe`` makes the sync repeatable.
    """
    return anti_join(program_view(results), target, RESULT_KEYS, null_safe)


def new_program_summary(summary: DataFrame, target: DataFrame, null_safe: bool = False) -> DataFrame:
    rows = summary.where(pred.program_name_only(F.col("ProgramName")))
    return anti_join(rows, target, SUMMARY_KEYS, null_safe)


def new_program_standards(standards: DataFrame, results: DataFrame, target: DataFrame) -> DataFrame:
    """Standards used by the program and not in the copy."""
    rows = standards.select(*STANDARD_KEYS, "StandardDescription", "Subject").distinct()
    used = program_view(results).select(*STANDARD_KEYS).distinct()
    return anti_join(semi_join(rows, used, STANDARD_KEYS), target, STANDARD_KEYS)


def new_program_assignments(assignments: DataFrame, target: DataFrame) -> DataFrame:
    rows = assignments.where(pred.program_name_only(F.col("ProgramName")))
    return anti_join(rows.select(*ASSIGNMENT_KEYS, "Subject").distinct(), target, ASSIGNMENT_KEYS)


def sync_program_results(results: DataFrame, target: DataFrame, null_safe: bool = False) -> DataFrame:
    return _append(target, new_program_results(results, target, null_safe))


def sync_program_summary(summary: DataFrame, target: DataFrame, null_safe: bool = False) -> DataFrame:
    return _append(target, new_program_summary(summary, target, null_safe))


def sync_program_standards(standards: DataFrame, results: DataFrame, target: DataFrame) -> DataFrame:
    return _append(target, new_program_standards(standards, results, target))


def sync_program_assignments(assignments: DataFrame, target: DataFrame) -> DataFrame:
    return _append(target, new_program_assignments(assignments, target))


def sync_status(results: DataFrame, summary: DataFrame, standards: DataFrame, assignments: DataFrame) -> DataFrame:
    """One row: a text and the four row counts."""
    frames = {"results": results, "summary": summary, "standards": standards, "assignments": assignments}
    counts = None
    for name, df in frames.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        counts = one if counts is None else counts.unionByName(one)
    return counts.agg(
        F.lit("Sync completed").alias("Status"),
        *[F.max(F.when(F.col("name") == n, F.col("n"))).alias(f"{n}_count") for n in frames],
    )


def program_copy(results: DataFrame, target: DataFrame, keywords: Sequence[str]) -> DataFrame:
    """Append the results of any program found by keyword in program or publisher, without a check."""
    rows = results.where(pred.program_keyword(keywords, F.col("ProgramName"), F.col("Publisher")))
    return _append(target, rows)
