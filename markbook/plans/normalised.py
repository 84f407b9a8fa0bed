"""The earlier, normalised tables: assessments, their questions, choices, standards and bands, and scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..operators import merges, nested
from ..operators.joins import anti_join
from ..sources import snapshots, tables
from .weekly import Warehouse, reject

QUESTION_KEY = ["assessment_id", "question_number"]


def load_assessments(warehouse: Warehouse, records: DataFrame, seq: str = "seq") -> None:
    known = warehouse.table(schemas.ASSESSMENTS)
    snapshots.replace_rows(merges.upsert_assessments(known, records, seq), warehouse.path("assessments"))


def load_scores(warehouse: Warehouse, records: DataFrame, seq: str = "seq") -> None:
    known = warehouse.table(schemas.SCORES)
    snapshots.replace_rows(merges.upsert_scores(known, records, seq), warehouse.path("student_scores"))


def question_ids(known: DataFrame, batch: DataFrame) -> DataFrame:
    """Ids of all questions: the stored ones, and new ones for the questions of the batch without one."""
    new = anti_join(batch.select(*QUESTION_KEY).distinct(), known, QUESTION_KEY)
    numbered = tables.surrogate_key(new, "question_id", QUESTION_KEY, tables.next_id(known, "question_id"))
    return known.select(*QUESTION_KEY, "question_id").unionByName(numbered)


def load_details(warehouse: Warehouse, detail: DataFrame) -> None:
    """Bands, questions, choices, standards and links of assessment details, one document per assessment.

    Questions, standards and links are upserted; bands and choices are appended. A question without a
    number cannot be found again: it goes to the rejects, and its choices and links are left out.
    """
    w = warehouse
    layout = schemas.QUESTIONS.columns
    stored = schemas.StructType([*layout.fields, schemas.StructField("question_id", schemas.LONG)])
    known = w.read(schemas.QUESTIONS.name, stored)

    questions = nested.flatten_questions(detail)
    reject(w, "unnumbered_question", "details", questions.where(F.col("question_number").isNull()), "assessment_id", "question_text")
    questions = questions.where(F.col("question_number").isNotNull())
    ids = tables.stage(question_ids(known, questions))
    merged = merges.upsert_questions(known.drop("question_id"), questions, "position")
    snapshots.replace_rows(merged.join(ids, QUESTION_KEY), w.path(schemas.QUESTIONS.name))

    bands = schemas.conform(nested.flatten_bands(detail), schemas.BANDS.columns)
    bands.write.mode("append").parquet(w.path(schemas.BANDS.name))

    choices = nested.flatten_choices(detail).join(ids, QUESTION_KEY)
    choices = schemas.conform(choices, schemas.CHOICES.columns)
    choices.write.mode("append").parquet(w.path(schemas.CHOICES.name))

    used = nested.flatten_question_standards(detail)
    standards = merges.upsert_legacy_standards(
        w.table(schemas.LEGACY_STANDARDS), used.drop(*QUESTION_KEY), "position"
    )
    snapshots.replace_rows(standards, w.path(schemas.LEGACY_STANDARDS.name))

    links = w.table(schemas.QUESTION_STANDARDS)
    pairs = schemas.conform(used.join(ids, QUESTION_KEY), schemas.QUESTION_STANDARDS.columns)
    snapshots.replace_rows(merges.insert_ignore_link(links, pairs), w.path(schemas.QUESTION_STANDARDS.name))
