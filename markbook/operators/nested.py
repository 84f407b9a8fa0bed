"""Nested records to flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import has_overall
from ..functions.scalars import academic_year, first_number, first_text, percent_text, safe_decimal
from ..schemas import POINTS, SUMMARY, conform
from .lookups import alias_fields


def _year(override: str | None):
    return academic_year(first_text(F.col("date_completed"), F.col("test_date")), override)


def common_fields(nested: DataFrame, year: str | None = None) -> DataFrame:
    """The landing fields of each nested record, without its standards."""
    return nested.select(*[c.alias(n) for n, c in alias_fields(nested, _year(year)).items()])


def _totals() -> dict[str, Column]:
    return {
        "TotalPointsAchieved": first_number(F.col("points_achieved"), F.col("total_score"), F.col("raw_score")),
        "TotalPointsPossible": first_number(F.col("points_possible"), F.col("max_score")),
    }


def alias_points(nested: DataFrame) -> DataFrame:
    """Record-level points with two places, each from its first alias that is neither missing nor 0."""
    return nested.withColumns({name: points.try_cast(POINTS) for name, points in _totals().items()})


def explode_standards(nested: DataFrame, year: str | None = None) -> DataFrame:
    """One landing row per standard of a record; a record with no standards gives none.

    The parent fields are picked before the explode, so it multiplies only the columns that are kept.
    """
    filled = F.when(F.size("standards") > 0, F.col("standards")).otherwise(F.col("standard_results"))
    s = lambda *names: first_text(*[F.col(f"s.{n}") for n in names])
    achieved = first_number(F.col("s.points_achieved"), F.col("s.score"))
    possible = first_number(F.col("s.points_possible"), F.col("s.max_score"))
    parents = alias_fields(nested, _year(year))
    return (
        nested.select(*[c.alias(n) for n, c in parents.items()], filled.alias("all_standards"))
        .select(*parents, F.explode("all_standards").alias("s"))
        .select(
            *parents,
            s("standard_set", "set_name").alias("StandardSet"),
            s("standard_code", "code").alias("StandardCodingNumber"),
            s("standard_description", "description").alias("StandardDescription"),
            safe_decimal(achieved).alias("PointsAchieved"),
            safe_decimal(possible).alias("PointsPossible"),
            percent_text(achieved, possible).alias("PercentCorrect"),
        )
    )


def overall_from_nested(nested: DataFrame, year: str | None = None) -> DataFrame:
    """One summary row per record that has an overall score or points; 0 counts as having none."""
    kept = nested.where(has_overall(F.col("overall_score"), F.col("points_achieved"))).withColumns(_totals())
    achieved, possible = F.col("TotalPointsAchieved"), F.col("TotalPointsPossible")
    fields = alias_fields(nested, _year(year))
    return conform(
        kept.select(
            *[c.alias(n) for n, c in fields.items()],
            F.col("standard_set").alias("StandardSet"),
            achieved,
            possible,
            percent_text(achieved, possible).alias("OverallPercentCorrect"),
        ),
        SUMMARY.columns,
    )


def flatten_bands(detail: DataFrame) -> DataFrame:
    return (
        detail.select("assessment_id", F.explode("performance_band_sets").alias("set"))
        .select("assessment_id", F.explode("set.bands").alias("b"))
        .select("assessment_id", F.col("b.name").alias("band_name"), "b.min_score", "b.max_score", "b.color")
    )


def _questions(detail: DataFrame) -> DataFrame:
    return detail.select("assessment_id", F.posexplode("questions").alias("q_at", "q"))


def _place(*parts: str) -> Column:
    """Where an element stood in its document: the arrival order of an upsert."""
    return F.struct("assessment_id", *parts).alias("position")


def flatten_questions(detail: DataFrame) -> DataFrame:
    return _questions(detail).select(
        "assessment_id",
        "q.question_number",
        "q.question_text",
        "q.question_type",
        "q.max_points",
        "q.correct_answer",
        _place("q_at"),
    )


def flatten_choices(detail: DataFrame) -> DataFrame:
    """Answer choices; a choice that does not say so is not correct."""
    return (
        _questions(detail)
        .select("assessment_id", "q.question_number", F.explode("q.answer_choices").alias("c"))
        .select(
            "assessment_id",
            "question_number",
            F.col("c.letter").alias("choice_letter"),
            F.col("c.text").alias("choice_text"),
            F.coalesce("c.is_correct", F.lit(False)).alias("is_correct"),
        )
    )


def flatten_question_standards(detail: DataFrame) -> DataFrame:
    """Standards named by questions, with the question they belong to; one without an id cannot be linked."""
    return (
        _questions(detail)
        .select("assessment_id", "q_at", "q.question_number", F.posexplode("q.standards").alias("s_at", "s"))
        .select(
            "assessment_id",
            "question_number",
            "s.standard_id",
            F.col("s.code").alias("standard_code"),
            F.col("s.description").alias("standard_description"),
            "s.subject",
            "s.grade_level",
            _place("q_at", "s_at"),
        )
        .where(F.coalesce(F.col("standard_id") != 0, F.lit(False)))
    )
