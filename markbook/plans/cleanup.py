"""Corrections of the stored results that rewrite only the files with rows to correct.

The rows are found with the file they stand in. Those files are written anew and the others stay; the table changes by one snapshot. So
a correction of a few rows costs a scan of the columns that find them, and a rewrite of a few files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import lookups
from ..operators.joins import fits_broadcast
from ..operators.picks import DUPLICATE_KEY
from ..sources import snapshots, tables
from ..sources.snapshots import PLACE
from .weekly import Warehouse

_FILLED = ("TeacherFirstName", "TeacherLastName", "StudentGrade")


def _file_numbers(places: DataFrame) -> DataFrame:
    """A number for each file, in the order of their names: a row a file."""
    return tables.stage(places.select(PLACE[0]).distinct().withColumn("_at", F.row_number().over(Window.orderBy(PLACE[0]))))


def _drop_rows(warehouse: Warehouse, before: snapshots.Snapshot, bad: DataFrame, what: str) -> tuple[int, int]:
    """Rewrite the files with ``bad`` rows, given by place, without them.

    Where those are many, rows meet them by shuffle and by the number of the file; a task holds the bad places of its share and sorts no rows.
    """
    bad = tables.stage(bad.select(*PLACE))
    numbers = F.broadcast(_file_numbers(bad))
    gone = bad.join(numbers, PLACE[0]).select("_at", PLACE[1])
    gone = F.broadcast(gone) if fits_broadcast(gone) else gone.hint("shuffle_hash")
    without = lambda rows: rows.join(numbers, PLACE[0], "left").join(gone, ["_at", PLACE[1]], "left_anti").select(*rows.columns)
    return snapshots.rewrite_files(warehouse.spark, warehouse.path("results"), before, bad.select(PLACE[0]), without, {"what": what})


def delete_duplicates(warehouse: Warehouse) -> tuple[int, int]:
    """Delete re-ingested copies; the highest id of a key stays. Returns the files rewritten, and all files.

    Only the key, the id and the place of a row are shuffled, the file as a number.
    """
    before = snapshots.base(warehouse.spark, warehouse.path("results"))
    if before is None:
        return 0, 0
    rows = snapshots.with_places(warehouse.spark, warehouse.path("results"), before).select(*DUPLICATE_KEY, "ResultID", *PLACE)
    numbers = F.broadcast(_file_numbers(rows))
    rows = rows.join(numbers, PLACE[0]).drop(PLACE[0])
    # the place breaks ties, so that one of several copies under one id stays
    order = Window.partitionBy(*DUPLICATE_KEY).orderBy(F.col("ResultID").desc_nulls_last(), "_at", PLACE[1])
    copies = rows.withColumn("_nth", F.row_number().over(order)).where("_nth > 1").join(numbers, "_at")
    return _drop_rows(warehouse, before, copies, "duplicates")


def delete_null_school(warehouse: Warehouse) -> tuple[int, int]:
    before = snapshots.base(warehouse.spark, warehouse.path("results"))
    if before is None:
        return 0, 0
    rows = snapshots.with_places(warehouse.spark, warehouse.path("results"), before)
    return _drop_rows(warehouse, before, rows.where(F.col("SchoolID").isNull()), "no school")


def backfill_teacher_grade(warehouse: Warehouse, roster: DataFrame, users: DataFrame, convert_grade: bool = True) -> tuple[int, int]:
    """Fill missing teacher names and grades from the roster. Returns the files rewritten, and all files.

    A file is rewritten where at least one of its rows gets a value; ``lookups.backfill_teacher_grade`` says which.
    """
    spark, path = warehouse.spark, warehouse.path("results")
    before = snapshots.base(spark, path)
    if before is None:
        return 0, 0
    rows = snapshots.with_places(spark, path, before)
    lacking = tables.stage(lookups.students_lacking(rows))
    fill = lambda part: lookups.backfill_teacher_grade(part, roster, users, convert_grade, lacking)
    old = {c: f"_old_{c}" for c in _FILLED}
    open_ = rows.where(" or ".join(f"{c} is null" for c in _FILLED)).select("StudentID_LASID", *_FILLED, PLACE[0], *[F.col(c).alias(o) for c, o in old.items()])
    gained = fill(open_).where(" or ".join(f"({o} is null and {c} is not null)" for c, o in old.items()))
    return snapshots.rewrite_files(spark, path, before, tables.stage(gained.select(PLACE[0]).distinct()), fill, {"what": "backfill"})
