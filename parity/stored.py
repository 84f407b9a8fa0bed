"""Operators on stored tables: what a window, an archive or a correction leaves behind equals the same rows worked out whole."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from markbook import schemas
from markbook.plans import cleanup, weekly
from markbook.schemas import conform
from markbook.session import scratch_dir
from markbook.sources import tables

from .joins_merges import _BACKFILLED, _DEDUP_COLUMNS, DEDUPED, backfill_sql
from .registry import query
from .scalar_rules import GRADE_OF
from .scans_loads import SUMMARY_SQL

START, END = dt.date(1998, 6, 10), dt.date(1998, 7, 10)
CHANGED = "DateCompleted BETWEEN DATE '1998-06-10' AND DATE '1998-07-10'"


def stored(v, rows):
    warehouse = weekly.Warehouse(v.spark, scratch_dir(v.spark))
    tables.append_results(rows, warehouse.path("results"))
    return warehouse


def changed_window(rows):
    """The window's rows with other points; every tenth student is gone from it."""
    inside = rows.where(F.col("DateCompleted").between(F.lit(START), F.lit(END)))
    return inside.where("CAST(StudentID_LASID AS BIGINT) % 10 <> 0").withColumn("PointsAchieved", F.col("PointsPossible"))


CHANGED_ROWS = f"""(SELECT * REPLACE (CASE WHEN {CHANGED} THEN PointsPossible ELSE PointsAchieved END AS PointsAchieved) FROM results
                    WHERE NOT ({CHANGED} AND CAST(StudentID_LASID AS BIGINT) % 10 = 0) OR DateCompleted IS NULL) w"""


@query("window_twice", f"SELECT ResultID, AcademicYear, DateCompleted, PointsAchieved FROM {CHANGED_ROWS}")
def window_twice(v):
    """The same window replaced twice, once more under a run that is already known."""
    warehouse = stored(v, v.results)
    for run in ("a", "b", "b"):
        tables.replace_window(v.spark, warehouse.path("results"), changed_window(v.results), START, END, run=run)
    return warehouse.read("results").select("ResultID", "AcademicYear", "DateCompleted", "PointsAchieved")


@query("summary_by_changes", SUMMARY_SQL.replace("FROM results WHERE", f"FROM {CHANGED_ROWS} WHERE"))
def summary_by_changes(v):
    """A stored summary brought up by the rows that a window took out and put in."""
    warehouse = weekly.Warehouse(v.spark, scratch_dir(v.spark))
    tables.full_refresh(conform(v.results, schemas.LANDING), warehouse.path("results"))
    weekly.rebuild_summary(warehouse)
    batch = conform(changed_window(v.results), schemas.LANDING)
    tables.replace_window(v.spark, warehouse.path("results"), batch, START, END)
    weekly.refresh_summary(warehouse)
    return warehouse.table(schemas.SUMMARY)


@query(
    "archive_in_steps",
    """SELECT CASE WHEN AcademicYear < '1998-1999' THEN 'archive' ELSE 'live' END AS tier, ResultID, AcademicYear FROM results""",
)
def archive_in_steps(v):
    live, archive = stored(v, v.results).path("results"), scratch_dir(v.spark)
    for year in ("1995-1996", "1998-1999", "1998-1999"):
        tables.archive_years(v.spark, live, archive, year)
    kept, old = (tables.read_results(v.spark, p).select("ResultID", "AcademicYear") for p in (live, archive))
    return kept.withColumn("tier", F.lit("live")).unionByName(old.withColumn("tier", F.lit("archive")))


@query("delete_duplicates_stored", DEDUPED)
def delete_duplicates_stored(v):
    warehouse = stored(v, v.results)
    cleanup.delete_duplicates(warehouse)
    return warehouse.read("results").select(*_DEDUP_COLUMNS)


@query("backfill_stored", backfill_sql(GRADE_OF.format(t="CAST(f.level_id AS VARCHAR)")))
def backfill_stored(v):
    warehouse = stored(v, v.results)
    cleanup.backfill_teacher_grade(warehouse, v.roster, v.users)
    return warehouse.read("results").select(*_BACKFILLED)
