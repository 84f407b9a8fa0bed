"""Upserts as DataFrame transforms: ``(target, source) -> new target``.

Parquet tables take no MERGE, so a merge is one full outer join whose output is written over the
table through a staging folder (``sources.tables``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import valid_standard
from ..functions.scalars import first_text, program_from_title, subject_code_first, subject_or_code
from .joins import anti_join, lookup_join, no_scatter
from .lookups import inner_latest, standards_catalogue
from .picks import first_assessment_per_key, first_per_key, last_per_key, one_per_standard

COALESCE, OVERWRITE, KEEP = "coalesce", "overwrite", "keep"


def merge_frames(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: dict[str, str],
    blank_keys: Sequence[str] = (),
) -> DataFrame:
    """Merge ``source`` into ``target`` on ``keys``; unmatched source rows are inserted.

    ``update`` names what a match does to a column: ``coalesce`` takes the source value unless it is
    missing, ``overwrite`` takes it as it is; any other column keeps the target value. Both sides have
    at most one row per key. A missing key matches nothing, except that for ``blank_keys`` it equals ''.
    Rows that cannot match are scattered, so they do not gather in one task.
    """
    columns = target.columns

    def side(df: DataFrame, name: str, sign: int) -> DataFrame:
        parts = {
            f"_k{i}": F.coalesce(F.col(k), F.lit("")) if k in blank_keys else F.col(k)
            for i, k in enumerate(keys)
        }
        missing = reduce(or_, [F.col(p).isNull() for p in parts])
        return (
            df.select(*[c.alias(p) for p, c in parts.items()], F.struct(*df.columns).alias(name))
            .withColumn("_scatter", F.when(missing, sign * (F.spark_partition_id() + 1)).otherwise(no_scatter(list(parts))))
        )

    on = [f"_k{i}" for i in range(len(keys))] + ["_scatter"]
    joined = side(target, "t", 1).join(side(source, "s", -1), on, "full_outer")
    have = set(source.columns)

    def value(c: str):
        old = F.col(f"t.{c}")
        if c not in have:
            return old
        new = F.col(f"s.{c}")
        policy = update.get(c, KEEP)
        if policy == COALESCE:
            return F.coalesce(new, old)
        if policy == OVERWRITE:
            return F.when(F.col("s").isNotNull(), new).otherwise(old)
        return F.when(F.col("t").isNotNull(), old).otherwise(new)

    return joined.select(*[value(c).alias(c) for c in columns])


def collapse_batch(source: DataFrame, keys: Sequence[str], update: Sequence[str], seq: str) -> DataFrame:
    """What row-at-a-time upserts of one batch leave behind, one row per key.

    Updated columns come from the last record of a key, all others from the first. Rows with a missing
    key part never meet another and stay as they are.
    """
    rest = [c for c in source.columns if c not in keys and c != seq]
    missing = reduce(or_, [F.col(k).isNull() for k in keys])
    keyed = source.where(~missing)
    # Two picks, so that each limits its rows per key before the shuffle.
    first = first_per_key(keyed, keys, [F.col(seq).asc_nulls_last()]).select(*keys, *[c for c in rest if c not in update])
    last = last_per_key(keyed, keys, [seq]).select(*keys, *[c for c in rest if c in update])
    merged = first.join(last, list(keys)).select(*keys, *rest)
    return merged.unionByName(source.where(missing).select(*keys, *rest))


# --- assignments and standards ---------------------------------------------------------------------


def assignment_candidates(results: DataFrame) -> DataFrame:
    """Distinct assignments in the results; the fact shrinks here, before any ranking."""
    return (
        results.where(F.col("AssessmentID").isNotNull() & F.col("SchoolID").isNotNull())
        .select(
            "AssessmentID",
            "AssignmentName",
            subject_or_code(F.col("Subject"), F.col("StandardCodingNumber")).alias("Subject"),
            "ProgramName",
            "Publisher",
            "Component",
            "SchoolID",
        )
        .distinct()
    )


def merge_assignments(assignments: DataFrame, results: DataFrame) -> DataFrame:
    source = first_assessment_per_key(assignment_candidates(results)).withColumnRenamed(
        "AssessmentID", "SourceAssessmentID"
    )
    coalesced = ("AssignmentName", "Subject", "ProgramName", "Publisher", "Component", "SchoolID")
    return merge_frames(
        assignments,
        source,
        ["ProgramName", "Component", "AssignmentName", "SchoolID"],
        dict.fromkeys(coalesced, COALESCE),
        blank_keys=["ProgramName", "Component", "AssignmentName"],
    )


def standard_candidates(results: DataFrame, keep_subject: bool = False) -> DataFrame:
    """Distinct code, description and subject; the subject comes from the code, then if kept the row."""
    code = F.col("StandardCodingNumber")
    return (
        results.where(valid_standard(code))
        .select(
            code,
            "StandardDescription",
            subject_code_first(code, F.col("Subject") if keep_subject else None).alias("Subject"),
        )
        .distinct()
    )


def merge_standards(standards: DataFrame, results: DataFrame) -> DataFrame:
    """Standards by code; of several descriptions the lowest is taken, so the merge is repeatable."""
    source = one_per_standard(standard_candidates(results))
    return merge_frames(
        standards,
        source,
        ["StandardCodingNumber"],
        {"StandardDescription": COALESCE, "Subject": COALESCE},
    )


def merge_standards_catalogue(standards: DataFrame, results: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Standards by code, completed from the catalogue, whose description is preferred."""
    own = standard_candidates(results, keep_subject=True).withColumnsRenamed(
        {"StandardDescription": "own_description", "Subject": "own_subject"}
    )
    joined = standards_catalogue(own, catalogue).select(
        "StandardCodingNumber",
        F.coalesce("description", "own_description").alias("StandardDescription"),
        F.col("content_area").alias("StandardSet"),
        F.coalesce("own_subject", "subject").alias("Subject"),
        F.col("grade_level").alias("GradeLevel"),
        F.col("subject_desc1").alias("Strand"),
        F.col("type").alias("Category"),
    )
    details = ("StandardSet", "GradeLevel", "Strand", "Category")
    source = one_per_standard(joined, details)
    return merge_frames(
        standards,
        source,
        ["StandardCodingNumber"],
        dict.fromkeys(("StandardDescription", "Subject", *details), COALESCE),
    )


def _insert_absent(target: DataFrame, source: DataFrame, keys: Sequence[str], seq: str | None) -> DataFrame:
    """Insert the rows whose key is not there yet; equal keys inside the batch go in once.

    By plain equality a row with a missing key part is never there, so every such row goes in.
    """
    missing = reduce(or_, [F.col(k).isNull() for k in keys])
    order = [F.col(seq)] if seq else [F.col(c).asc_nulls_last() for c in source.columns if c not in keys]
    firsts = first_per_key(source.where(~missing), keys, order or [F.lit(0)])
    new = anti_join(firsts, target, keys).unionByName(source.where(missing))
    return target.unionByName(new.select(*[c for c in source.columns if c != seq]), allowMissingColumns=True)


def insert_absent_standard(standards: DataFrame, source: DataFrame, seq: str | None = None) -> DataFrame:
    return _insert_absent(standards, source, ["StandardSet", "StandardCodingNumber"], seq)


def insert_absent_assignment(assignments: DataFrame, source: DataFrame, seq: str | None = None) -> DataFrame:
    keys = ["ProgramName", "Component", "AssignmentName", "SchoolID"]
    return _insert_absent(assignments, source, keys, seq)


def update_from_latest_school(assignments: DataFrame, results: DataFrame) -> DataFrame:
    """School of the most recent result of each assignment's assessment; others keep theirs."""
    latest = (
        inner_latest(assignments.select("SourceAssessmentID").distinct(), results)
        .select("SourceAssessmentID", "LatestSchoolID")
    )
    joined = lookup_join(assignments, latest, ["SourceAssessmentID"])
    return joined.withColumn("SchoolID", F.coalesce("LatestSchoolID", "SchoolID")).select(*assignments.columns)


# --- earlier, normalised model ---------------------------------------------------------------------


def _upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str], seq: str) -> DataFrame:
    batch = collapse_batch(source, keys, update, seq)
    return merge_frames(target, batch, keys, dict.fromkeys(update, OVERWRITE))


def upsert_assessments(target: DataFrame, source: DataFrame, seq: str) -> DataFrame:
    """Assessments by id; a missing value overwrites, and one not marked deleted is not deleted."""
    update = (
        "title",
        "description",
        "subject_name",
        "scope_name",
        "author_name",
        "version",
        "modified_date",
        "deleted",
    )
    rows = source.where(F.col("assessment_id").isNotNull()).withColumn(
        "deleted", F.coalesce("deleted", F.lit(False))
    )
    return _upsert(target, rows, ["assessment_id"], update, seq)


def upsert_questions(target: DataFrame, source: DataFrame, seq: str) -> DataFrame:
    update = ("question_text", "question_type", "max_points", "correct_answer")
    return _upsert(target, source, ["assessment_id", "question_number"], update, seq)


def upsert_legacy_standards(target: DataFrame, source: DataFrame, seq: str) -> DataFrame:
    """Standards by id; the code of a known standard is not changed."""
    rows = source.where(F.col("standard_id").isNotNull())
    return _upsert(target, rows, ["standard_id"], ("standard_description", "subject", "grade_level"), seq)


def upsert_scores(target: DataFrame, source: DataFrame, seq: str) -> DataFrame:
    update = ("raw_score", "percent_correct", "performance_band", "version")
    return _upsert(target, source, ["student_id", "assessment_id", "test_date"], update, seq)


def insert_ignore_link(links: DataFrame, pairs: DataFrame) -> DataFrame:
    """Question and standard pairs that are not linked yet, each once."""
    keys = ["question_id", "standard_id"]
    return links.unionByName(anti_join(pairs.select(*keys).distinct(), links, keys, once=True), allowMissingColumns=True)


def metadata_mapping(headers: DataFrame) -> DataFrame:
    """Assessment headers as assignment rows."""
    title = first_text(F.col("title"), F.col("name"))
    extra = [c for c in headers.columns if c == "seq"]
    return headers.select(
        program_from_title(title).alias("ProgramName"),
        F.col("publisher").alias("Publisher"),
        F.col("scope").alias("Component"),
        title.alias("AssignmentName"),
        F.col("assessment_id").alias("SourceAssessmentID"),
        first_text(F.col("subject"), F.col("subject_name")).alias("Subject"),
        *extra,
    )


def insert_new_assessments(assignments: DataFrame, headers: DataFrame, seq: str = "seq") -> DataFrame:
    """Assessments not in the assignments yet; the first header of an id wins, one without id always goes in."""
    return _insert_absent(assignments, metadata_mapping(headers), ["SourceAssessmentID"], seq)
