"""One row per key.

Written as ``row_number() = 1``: Spark limits each group before the shuffle (WindowGroupLimit),
so a key with a third of all rows sends one row per map task and never gathers in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


_RANK = "_pick_rank"


def top_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows of each key in the given order."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) <= n).drop(_RANK)


def first_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column]) -> DataFrame:
    return top_per_key(df, keys, order, 1)


def last_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str]) -> DataFrame:
    return top_per_key(df, keys, [F.col(c).desc_nulls_last() for c in order], 1)


def first_assessment_per_key(candidates: DataFrame) -> DataFrame:
    """Lowest assessment id per program, component, name (missing counting as '') and school.

    One assessment can carry several subjects and publishers; those ties go by text, missing last.
    """
    blank = lambda name: F.coalesce(F.col(name), F.lit(""))
    return first_per_key(
        candidates,
        [blank("ProgramName"), blank("Component"), blank("AssignmentName"), F.col("SchoolID")],
        [
            F.col("AssessmentID").asc(),
            F.col("Subject").asc_nulls_last(),
            F.col("Publisher").asc_nulls_last(),
            *[F.col(c).asc_nulls_last() for c in ("ProgramName", "Component", "AssignmentName")],
        ],
    )


def one_per_standard(candidates: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """One row per standard code: lowest description, then subject, then the extra columns."""
    order = ["StandardDescription", "Subject", *extra]
    return first_per_key(candidates, ["StandardCodingNumber"], [F.col(c).asc_nulls_last() for c in order])


def latest_per_assessment(results: DataFrame) -> DataFrame:
    """School of the most recent result of each assessment; a tie goes to the lowest school id."""
    rows = (
        results.where(F.col("AssessmentID").isNotNull() & F.col("SchoolID").isNotNull())
        .groupBy("AssessmentID", "SchoolID")
        .agg(F.max("DateCompleted").alias("DateCompleted"))
    )
    return first_per_key(
        rows, ["AssessmentID"], [F.col("DateCompleted").desc_nulls_last(), F.col("SchoolID").asc()]
    )


DUPLICATE_KEY = ("StudentID_LASID", "AssessmentID", "StandardCodingNumber", "DateCompleted")


def latest_duplicate(results: DataFrame) -> DataFrame:
    """Highest ResultID per student, assessment, standard and date; missing parts group together."""
    return first_per_key(results, list(DUPLICATE_KEY), [F.col("ResultID").desc()])
