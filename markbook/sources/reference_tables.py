"""Lookup inputs in the shape the joins need: one row per key, sentinel ids removed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import grade_from_level_id, nonzero_id
from ..operators.picks import last_per_key


def _last(raw: DataFrame, key: str, seq: str) -> DataFrame:
    """The last record of each key, by arrival; without an arrival column the greatest record, so that a key stays unique."""
    if seq in raw.columns:
        return last_per_key(raw, [key], [seq]).drop(seq)
    return last_per_key(raw, [key], raw.columns)


def _filled(name: str) -> Column:
    return F.col(name).isNotNull() & (F.col(name) != "")


def sites(raw: DataFrame, seq: str) -> DataFrame:
    """Sites by id; id 0 is no site; the last record of an id wins."""
    return _last(raw.where(F.col("site_id").isNotNull() & (F.col("site_id") != 0)), "site_id", seq)


def enrollment(raw: DataFrame, seq: str) -> DataFrame:
    """One row per student, the last record winning, with the grade converted and site 0 missing."""
    return _last(raw.where(_filled("district_student_id")), "district_student_id", seq).select(
        "district_student_id",
        "state_student_id",
        grade_from_level_id(F.col("grade_level_id")).alias("grade"),
        nonzero_id(F.col("site_id")).alias("site_id"),
        "school",
        "district",
    )


def users(raw: DataFrame, seq: str) -> DataFrame:
    """Teachers by user id, the last record winning."""
    return _last(raw.where(_filled("user_id")), "user_id", seq)


def roster(raw: DataFrame) -> DataFrame:
    """Every section of every student; the caller's arrival column is kept."""
    return raw.where(_filled("district_student_id"))


def section_roster(raw: DataFrame) -> DataFrame:
    """The eight section columns, plus the arrival column the first-wins rule orders by."""
    names = (
        "student_id",
        "section_id",
        "teacher_first",
        "teacher_last",
        "subject_area",
        "grade_level",
        "content_area",
        "course_name",
    )
    have = set(raw.columns)
    columns = [F.col(n) if n in have else F.lit(None).cast("string").alias(n) for n in names]
    return raw.select(*columns, *(["seq"] if "seq" in have else []))


def subject_map(raw: DataFrame) -> DataFrame:
    """Per subject its first code, and each course id with the place it takes in the search order.

    The search order is (code, course id), so ``priority`` is a struct that compares that way and
    no ranking over the whole table is needed.
    """
    courses = raw.groupBy("subject_area_name", "course_id_code").agg(F.min("sa_code").alias("own_code"))
    # One row per course by now, so a subject's window is as small as its list of courses.
    first_code = F.min("own_code").over(Window.partitionBy("subject_area_name"))
    return courses.select(
        "subject_area_name",
        first_code.alias("sa_code"),
        "course_id_code",
        F.struct("own_code", "course_id_code").alias("priority"),
    )


def catalogue(raw: DataFrame) -> DataFrame:
    return raw.select(
        "glce_code", "description", "content_area", "subject", "grade_level", "subject_desc1", "type"
    )
