"""Summary rows: one per student and assessment, or several where subject or teacher differ by standard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..functions.scalars import overall_percent_text, subject_from_assignment
from ..schemas import SUMMARY, SUMMARY_KEYS, TOTAL, conform


# What a stored group keeps beside its totals, so that rows can be taken out of it: rows, and those with points.
STATE = ("_rows", "_achieved", "_possible")
_TOTALS = {"_achieved": ("PointsAchieved", "TotalPointsAchieved"), "_possible": ("PointsPossible", "TotalPointsPossible")}


def summary(results: DataFrame) -> DataFrame:
    """Totals and percent per group; missing values form groups of their own.

    One aggregate with map-side partial sums, so a group with a third of all rows is small before
    it is shuffled.
    """
    rows = _summed_rows(results)
    totals = rows.groupBy(*SUMMARY_KEYS).agg(
        F.sum("PointsAchieved").cast(TOTAL).alias("TotalPointsAchieved"),
        F.sum("PointsPossible").cast(TOTAL).alias("TotalPointsPossible"),
    )
    return conform(_with_percent(totals), SUMMARY.columns)


def _summed_rows(results: DataFrame) -> DataFrame:
    rows = results.where(F.col("AssessmentID").isNotNull() & F.col("StudentID_SASID").isNotNull())
    return rows.withColumn("Subject", subject_from_assignment(F.col("AssignmentName"), F.col("Subject")))


def _with_percent(totals: DataFrame) -> DataFrame:
    percent = overall_percent_text(F.col("TotalPointsAchieved"), F.col("TotalPointsPossible"))
    return totals.withColumn("OverallPercentCorrect", percent)


def _stored(totals: DataFrame) -> DataFrame:
    return conform(_with_percent(totals), StructType([*SUMMARY.columns.fields, *[StructField(c, LongType()) for c in STATE]]))


def _counted(rows: DataFrame) -> DataFrame:
    """Totals and counts per group; a row whose ``_change`` is -1 counts against its group."""
    signed = "_change" in rows.columns
    out, sign = F.col("_change") < 0, F.col("_change").cast("long")
    figures = [(F.sum(sign) if signed else F.count(F.lit(1))).alias("_rows")]
    for count, (name, total) in _TOTALS.items():
        points = F.col(name)
        figures.append(F.sum(F.when(out, -points).otherwise(points) if signed else points).cast(TOTAL).alias(total))
        have = F.sum(F.when(points.isNotNull(), sign).otherwise(F.lit(0).cast("long"))) if signed else F.count(points)
        figures.append(have.alias(count))
    return _summed_rows(rows).groupBy(*SUMMARY_KEYS).agg(*figures)


def stored_summary(results: DataFrame) -> DataFrame:
    """``summary`` with the counts that ``changed_summary`` needs."""
    return _stored(_counted(results))


def changed_summary(stored: DataFrame, changes: DataFrame) -> DataFrame:
    """A stored summary after rows were taken out (``_change`` -1) and put in (1), from these rows alone.

    Sums are exact decimals, so it equals a summary of all rows. A group without rows goes; a total without points is missing. Groups
    meet by one aggregate over the stored rows and the few changed ones, also where parts of their key are missing.
    """
    both = stored.select(*SUMMARY_KEYS, *[t for _, t in _TOTALS.values()], *STATE).unionByName(_counted(changes))
    merged = both.groupBy(*SUMMARY_KEYS).agg(
        *[F.sum(c).alias(c) for c in STATE], *[F.sum(t).cast(TOTAL).alias(t) for _, t in _TOTALS.values()]
    )
    left = merged.where(F.col("_rows") > 0).withColumns({t: F.when(F.col(c) > 0, F.col(t)) for c, (_, t) in _TOTALS.items()})
    return _stored(left)


def ordered_summary(summary_rows: DataFrame) -> DataFrame:
    """The order a reader wants; stored files are not sorted by it."""
    return summary_rows.orderBy("DateCompleted", "LastName", "FirstName", "AssignmentName")
