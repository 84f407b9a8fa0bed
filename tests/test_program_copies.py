"""Syncs that look only at what is new: the same copies as by a comparison with everything."""

import datetime as dt
import random

from pyspark.sql import functions as F

from markbook import schemas
from markbook.operators import program_sync
from markbook.plans import weekly
from markbook.schemas import conform
from markbook.session import scratch_dir
from markbook.sources import snapshots, tables

DAY = dt.date(2024, 1, 1)


def fact(spark, rows):
    """``(student, title, standard, day)`` of the program; a day of None is no date."""
    full = [(s, t, c, None if d is None else DAY + dt.timedelta(days=d), "2023-2024" if (d or 0) < 180 else "2024-2025") for s, t, c, d in rows]
    df = spark.createDataFrame(full, "StudentID_LASID string, AssignmentName string, StandardCodingNumber string, DateCompleted date, AcademicYear string")
    return conform(df.withColumns({"ProgramName": F.lit("HMH"), "StudentID_SASID": F.col("StudentID_LASID"), "AssessmentID": F.lit(1), "StandardSet": F.lit("set")}), schemas.LANDING)


def scanned(df):
    """Folders that a plan reads."""
    return {f.rpartition("/")[0].rpartition("/")[2] for f in df.inputFiles()}


def test_syncs_equal_a_comparison_with_everything(spark):
    rng = random.Random(2)
    w = weekly.Warehouse(spark, scratch_dir(spark))
    row = lambda lo, hi: (rng.choice("abc"), rng.choice("xy"), rng.choice(["1", None]), rng.choice([*range(lo, hi), None] if rng.random() < 0.2 else list(range(lo, hi))))
    tables.full_refresh(fact(spark, [row(0, 300) for _ in range(80)]), w.path("results"))
    whole = {"results": None, "summary": None}
    for turn in range(3):
        if turn:
            start = rng.randrange(250)
            batch = fact(spark, [r for r in (row(start, start + 40) for _ in range(30)) if r[3] is not None])
            tables.replace_window(spark, w.path("results"), batch, DAY + dt.timedelta(days=start), DAY + dt.timedelta(days=start + 39))
        weekly.update_lookups(w)
        weekly.refresh_summary(w)
        stored = {"results": w.read("results", schemas.LANDING), "summary": w.table(schemas.SUMMARY)}
        find = {"results": program_sync.new_program_results, "summary": program_sync.new_program_summary}
        for name, rows in stored.items():
            have = whole[name] if whole[name] is not None else rows.limit(0)
            whole[name] = tables.stage(have.unionByName(find[name](rows, have, True)))
        weekly.sync_program(w)
        for name, layout in (("results", schemas.LANDING), ("summary", schemas.SUMMARY.columns)):
            got = conform(w.read("program_" + name), layout)
            assert sorted(map(str, got.collect())) == sorted(map(str, whole[name].collect())), (turn, name)


def test_only_months_of_new_rows_are_scanned(spark):
    w = weekly.Warehouse(spark, scratch_dir(spark))
    tables.full_refresh(fact(spark, [("a", "x", "1", d) for d in range(0, 300, 10)] + [("a", "x", "1", None)]), w.path("results"))
    weekly.sync_program(w)
    batch = fact(spark, [("b", "x", "1", 95), ("a", "x", "1", 100)])
    tables.replace_window(spark, w.path("results"), batch, DAY + dt.timedelta(days=95), DAY + dt.timedelta(days=104))
    candidates = weekly.result_candidates(w, True)
    assert candidates.count() == 2
    copies = weekly.possible_copies(w, "results", candidates, schemas.LANDING)
    assert scanned(copies) == {"_month=2024-04"} and copies.count() == 3
    assert len(scanned(w.read("program_results"))) == 11
    weekly.sync_program(w)
    # the row that the copy had is not there twice
    assert w.read("program_results").count() == 32
    seen = snapshots.latest(spark, w.path("program_results")).note["seen"]
    assert seen == snapshots.latest(spark, w.path("results")).version
    weekly.sync_program(w)
    assert w.read("program_results").count() == 32


def test_many_syncs_are_compacted(spark):
    path = scratch_dir(spark)
    for i in range(4):
        snapshots.add_rows(spark.range(i, i + 1), path)
    assert not snapshots.compact(spark, path, most=4)
    snapshots.add_rows(spark.range(4, 5), path)
    assert snapshots.compact(spark, path, most=4)
    assert sorted(r.id for r in snapshots.read(spark, path).collect()) == list(range(5))
    assert len(snapshots.latest(spark, path).parts) == 1
