"""Stored tables under runs that break off: a reader has the old rows or the new ones, and a second run makes up for the first."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from markbook import schemas
from markbook.operators import quality
from markbook.operators.lookups import backfill_teacher_grade
from markbook.plans import cleanup, summary, weekly
from markbook.schemas import conform
from markbook.session import scratch_dir
from markbook.sources import snapshots, tables


class Broken(Exception):
    """The run ends here."""


class Break:
    """Ends a run before or after its n-th step that changes storage."""

    def __init__(self, monkeypatch):
        self.monkeypatch, self.left = monkeypatch, None
        for name in ("_write", "_put"):
            monkeypatch.setattr(snapshots, name, self.step(getattr(snapshots, name)))

    def step(self, do):
        def run(*args):
            if self.left is not None and self.left <= 0:
                raise Broken
            out = do(*args)
            if self.left is not None:
                self.left -= 1
                if self.left == 0 and self.after:
                    raise Broken
            return out

        return run

    def at(self, n, after, job):
        """Run the job until its n-th step, that one included or not; whether it came to its end."""
        self.left, self.after = n + after, after
        try:
            job()
            return True
        except Broken:
            return False
        finally:
            self.left = None


DAY = dt.date(2024, 1, 1)


def fact(spark, rows):
    """``(student, assessment, standard, day, points)``; the year of a day before 60 is the first."""
    full = [(s, a, c, DAY + dt.timedelta(days=d), "2023-2024" if d < 60 else "2024-2025", p) for s, a, c, d, p in rows]
    df = spark.createDataFrame(full, "StudentID_SASID string, AssessmentID int, StandardCodingNumber string, DateCompleted date, AcademicYear string, PointsAchieved double")
    named = df.withColumns({"StudentID_LASID": F.col("StudentID_SASID"), "PointsPossible": F.when(F.col("AssessmentID") > 0, F.lit(10)), "AssignmentName": F.lit("n"), "SchoolName": F.lit("s")})
    return conform(named, schemas.LANDING)


def seen(warehouse, name="results"):
    df = warehouse.read(name)
    columns = ["AcademicYear", "StudentID_SASID", "AssessmentID", "DateCompleted", *(["StandardCodingNumber", "PointsAchieved"] if name == "results" else ["TotalPointsAchieved", "TotalPointsPossible"])]
    return sorted(map(str, df.select(*columns).collect()))


def steps(warehouse, breaks, reset, job, states):
    """Break the job at every step; ``states()`` must be as before or as after, and a second run must give the whole result."""
    reset()
    old = states()
    job()
    new = states()
    assert old != new
    ways = set()
    for after in (0, 1):
        for n in range(30):
            reset()
            assert states() == old
            ended = breaks.at(n, after, job)
            now = states()
            assert all(x in (a, b) for x, a, b in zip(now, old, new, strict=True)), (n, after)
            ways.add(tuple(x == b for x, b in zip(now, new, strict=True)))
            if ended:
                break
            job()
            assert states() == new, (n, after)
        assert ended
    return ways


OLD = [("a", 1, "x", 0, 1.0), ("b", 1, "x", 70, 2.0), ("c", 2, "y", 5, None)]
NEW = [("a", 1, "x", 0, 5.0), ("d", 3, "z", 80, 4.0)]


def test_full_refresh_and_summary_break_off(spark, monkeypatch):
    warehouse, breaks = weekly.Warehouse(spark, scratch_dir(spark)), Break(monkeypatch)
    old, new = fact(spark, OLD), fact(spark, NEW)

    def load(rows):
        tables.full_refresh(rows, warehouse.path("results"))
        weekly.rebuild_summary(warehouse)

    ways = steps(warehouse, breaks, lambda: load(old), lambda: load(new), lambda: (seen(warehouse), seen(warehouse, "summary")))
    # the results may be a step ahead of the summary, which names the results it stands for
    assert ways == {(False, False), (True, False), (True, True)}
    assert snapshots.latest(spark, warehouse.path("summary")).note["results"] == snapshots.latest(spark, warehouse.path("results")).version


def test_first_load_that_breaks_off_stores_nothing(spark, monkeypatch):
    warehouse, breaks = weekly.Warehouse(spark, scratch_dir(spark)), Break(monkeypatch)
    assert not breaks.at(1, 0, lambda: tables.full_refresh(fact(spark, OLD), warehouse.path("results")))
    assert warehouse.read("results", schemas.LANDING).count() == 0
    assert not quality.table_presence(spark, {"results": warehouse.path("results")}).first().present
    tables.full_refresh(fact(spark, OLD), warehouse.path("results"))
    assert len(seen(warehouse)) == 3


def window(spark, warehouse, rows):
    start, end = DAY, DAY + dt.timedelta(days=65)
    tables.replace_window(spark, warehouse.path("results"), fact(spark, rows), start, end)
    weekly.refresh_summary(warehouse)


def test_window_breaks_off_and_runs_again(spark, monkeypatch):
    warehouse, breaks = weekly.Warehouse(spark, scratch_dir(spark)), Break(monkeypatch)

    def reset():
        tables.full_refresh(fact(spark, OLD), warehouse.path("results"))
        weekly.rebuild_summary(warehouse)

    # the first year loses its rows, the second one gains one: a run that starts anew must still know of the first
    steps(warehouse, breaks, reset, lambda: window(spark, warehouse, [("e", 4, "q", 62, 3.0)]), lambda: (seen(warehouse), seen(warehouse, "summary")))
    once = seen(warehouse), seen(warehouse, "summary")
    window(spark, warehouse, [("e", 4, "q", 62, 3.0)])
    assert (seen(warehouse), seen(warehouse, "summary")) == once
    notes = [json.loads(r.note) for r in snapshots.ledger(spark, warehouse.path("results")).orderBy("version").collect()]
    assert notes[-1]["window"] == "2024-01-01..2024-03-06" and notes[-1]["years"] == ["2024-2025"]


def test_a_named_run_is_done_once(spark):
    path = scratch_dir(spark)
    tables.full_refresh(fact(spark, OLD), path)
    put = lambda rows, run: tables.replace_window(spark, path, fact(spark, rows), DAY, DAY + dt.timedelta(days=20), run=run)
    assert put([("z", 9, "z", 3, 1.0)], "monday") == ["2023-2024"]
    version = snapshots.latest(spark, path).version
    assert put([("y", 9, "z", 3, 1.0)], "monday") == ["2023-2024"]
    assert snapshots.latest(spark, path).version == version
    assert put([("y", 9, "z", 3, 1.0)], "tuesday") == ["2023-2024"]
    assert {r[0] for r in tables.read_results(spark, path).select("StudentID_SASID").collect()} == {"b", "y"}


def test_archive_breaks_off_and_runs_again(spark, monkeypatch):
    breaks, where = Break(monkeypatch), {}

    def reset():
        where["live"], where["old"] = scratch_dir(spark), scratch_dir(spark)
        tables.append_results(fact(spark, OLD), where["live"])
        tables.full_refresh(fact(spark, [("k", 7, "k", 1, 7.0)]), where["old"])

    def state(path):
        return sorted(map(str, tables.read_results(spark, path).select("StudentID_SASID", "AcademicYear").collect()))

    steps(None, breaks, reset, lambda: tables.archive_years(spark, where["live"], where["old"], "2024-2025"), lambda: (state(where["live"]), state(where["old"])))
    assert len(state(where["old"])) == 3 and len(state(where["live"])) == 1


def test_rows_added_after_a_broken_archive_are_moved_too(spark, monkeypatch):
    breaks, live, old = Break(monkeypatch), scratch_dir(spark), scratch_dir(spark)
    tables.append_results(fact(spark, OLD), live)
    assert not breaks.at(2, 0, lambda: tables.archive_years(spark, live, old, "2024-2025"))
    tables.append_results(fact(spark, [("late", 1, "x", 2, 1.0)]), live)
    assert tables.archive_years(spark, live, old, "2024-2025") == ["2023-2024"]
    assert sorted(r[0] for r in tables.read_results(spark, old).select("StudentID_SASID").collect()) == ["a", "c", "late"]
    assert [r[0] for r in tables.read_results(spark, live).select("StudentID_SASID").collect()] == ["b"]


def test_second_writer_is_refused(spark):
    path = scratch_dir(spark)
    tables.full_refresh(fact(spark, OLD), path)
    before = snapshots.base(spark, path)
    snapshots.add_rows(fact(spark, NEW), path)
    with pytest.raises(snapshots.ConcurrentChange):
        snapshots.publish(spark, path, before, before.parts, before.columns)
    assert tables.read_results(spark, path).count() == 5


def test_expire_keeps_what_is_listed(spark):
    path = scratch_dir(spark)
    tables.append_results(fact(spark, OLD), path)
    assert snapshots.expire(spark, path) == []
    tables.overwrite_years(fact(spark, OLD[:1]), path, ["2023-2024"])
    assert snapshots.expire(spark, path, keep=1) == ["AcademicYear=2023-2024"]
    tables.full_refresh(fact(spark, NEW), path)
    assert tables.read_results(spark, path).count() == 2 == snapshots.read(spark, path, 1).count()
    assert len(snapshots.expire(spark, path, keep=1)) == 2
    assert tables.read_results(spark, path).count() == 2
    assert [p.name for p in spark.read.parquet(snapshots_path(path, spark)).schema] == [c for c in tables.read_results(spark, path).columns if c != "AcademicYear"]


def snapshots_path(path, spark):
    part = snapshots.latest(spark, path).parts[0]
    return f"{path}/{part.root}/{part.folder}"


def test_summary_by_changed_rows_equals_a_rebuild(spark):
    """Random windows, with missing points, rows that no summary has, groups that end and years that empty."""
    rng = random.Random(11)
    warehouse = weekly.Warehouse(spark, scratch_dir(spark))
    row = lambda d: (rng.choice("abcd"), rng.choice([0, 1, 2, None]), rng.choice("xy"), d, rng.choice([None, 0.0, 1.5, 2.25]))
    tables.full_refresh(fact(spark, [row(rng.randrange(120)) for _ in range(60)]), warehouse.path("results"))
    weekly.rebuild_summary(warehouse)
    for turn in range(4):
        start = rng.randrange(100)
        batch = [row(rng.randrange(start, start + 40)) for _ in range(0 if turn == 2 else 25)]
        tables.replace_window(spark, warehouse.path("results"), fact(spark, batch), DAY + dt.timedelta(days=start), DAY + dt.timedelta(days=start + 39))
        if turn == 1:
            continue  # the next one makes up for two windows
        weekly.refresh_summary(warehouse)
        assert snapshots.latest(spark, warehouse.path("summary")).note["what"] == "changes"
        want = summary.summary(conform(warehouse.read("results"), schemas.LANDING))
        assert sorted(map(str, warehouse.table(schemas.SUMMARY).collect())) == sorted(map(str, want.collect()))


def test_refresh_after_a_change_that_kept_no_rows(spark):
    warehouse = weekly.Warehouse(spark, scratch_dir(spark))
    tables.full_refresh(fact(spark, OLD), warehouse.path("results"))
    weekly.refresh_summary(warehouse)
    tables.append_results(fact(spark, NEW), warehouse.path("results"))
    weekly.refresh_summary(warehouse)
    assert snapshots.latest(spark, warehouse.path("summary")).note["what"] == "years"
    want = summary.summary(conform(warehouse.read("results"), schemas.LANDING))
    assert sorted(map(str, warehouse.table(schemas.SUMMARY).collect())) == sorted(map(str, want.collect()))


def stored(spark, rows, files=4):
    """Results with ids, in several files a year."""
    warehouse = weekly.Warehouse(spark, scratch_dir(spark))
    numbered = fact(spark, rows).withColumn("ResultID", F.xxhash64("StudentID_SASID", "StandardCodingNumber", "PointsAchieved"))
    numbered.repartition(files, "StudentID_SASID").write.partitionBy("AcademicYear").parquet(warehouse.path("results"))
    return warehouse


MANY = [(s, 1, "x", d, 1.0) for s in "abcdefgh" for d in (0, 70)]


def test_duplicates_rewrite_only_their_files(spark, rows):
    warehouse = stored(spark, [*MANY, ("a", 1, "x", 0, 3.0), ("a", 1, "x", 0, 3.0)])
    before = warehouse.read("results")
    want = rows(quality.delete_duplicates(before), "StudentID_SASID", "DateCompleted", "ResultID")
    rewritten, count = cleanup.delete_duplicates(warehouse)
    assert (rewritten, count > 4) == (1, True)
    after = warehouse.read("results")
    assert rows(after, "StudentID_SASID", "DateCompleted", "ResultID") == want
    untouched = {f for f in before.inputFiles()} & {f for f in after.inputFiles()}
    assert len(untouched) == count - 1
    assert cleanup.delete_duplicates(warehouse)[0] == 0
    assert set(after.columns) == set(before.columns)


def test_null_school_rewrites_only_its_files(spark):
    warehouse = stored(spark, MANY)
    tables.append_results(warehouse.read("results").withColumn("SchoolID", F.lit(1)).limit(0), warehouse.path("results"))
    rewritten, count = cleanup.delete_null_school(warehouse)
    assert rewritten == count and warehouse.read("results").count() == 0


def test_backfill_rewrites_only_its_files(spark, rows):
    warehouse = stored(spark, MANY)
    full = warehouse.read("results").withColumns({"TeacherLastName": F.when(F.col("StudentID_SASID") != "c", F.lit("T")), "StudentGrade": F.lit("4"), "TeacherFirstName": F.lit("F")})
    other = weekly.Warehouse(spark, scratch_dir(spark))
    full.repartition(4, "StudentID_SASID").write.partitionBy("AcademicYear").parquet(other.path("results"))
    roster = spark.createDataFrame([("c", 1, "s", "5", 1)], "district_student_id string, user_id int, section_id string, grade_level_id string, seq int")
    users = spark.createDataFrame([(1, "Ann", "Lee")], "user_id int, first_name string, last_name string")
    want = rows(backfill_teacher_grade(other.read("results"), roster, users), "StudentID_SASID", "DateCompleted", "TeacherLastName", "StudentGrade")
    rewritten, count = cleanup.backfill_teacher_grade(other, roster, users)
    # student c has one file in each of two years
    assert rewritten == 2 < count
    assert rows(other.read("results"), "StudentID_SASID", "DateCompleted", "TeacherLastName", "StudentGrade") == want
    assert other.read("results").where("TeacherLastName = 'Lee'").count() == 2
    assert cleanup.backfill_teacher_grade(other, roster, users)[0] == 0
