"""What the stored tables and the corrections do not shuffle, count twice or gather."""

import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from markbook.operators import joins, merges
from markbook.plans import cleanup
from markbook.plans.weekly import Warehouse
from markbook.sources import buckets, tables
from parity.joins_merges import _BACKFILLED
from parity.views import Views


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def jobs(spark, monkeypatch):
    """Frames that are written while the test runs."""
    seen = []
    write = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **k: (seen.append(self._df), write(self, path, *a, **k))[1])
    return seen


def results(spark):
    return spark.range(0, 400, 1, 4).select(
        (F.col("id") + 1).alias("ResultID"),
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("199"), F.col("id") % 3)).alias("AcademicYear"),
        (F.col("id") % 200).cast("string").alias("StudentID_LASID"),
        F.lit(1).alias("AssessmentID"),
        F.when(F.col("id") % 5 > 0, "c").alias("StandardCodingNumber"),
        F.lit("1999-01-01").cast("date").alias("DateCompleted"),
    )


def test_rows_are_written_by_year_without_a_shuffle(spark, tmp_path, jobs, rows):
    path = str(tmp_path / "t")
    tables.append_results(results(spark), path)
    tables.full_refresh(results(spark), path)
    assert jobs and not any("Exchange" in plan(df) for df in jobs)
    assert rows(tables.read_results(spark, path).select("ResultID", "AcademicYear")) == rows(results(spark).select("ResultID", "AcademicYear"))


@pytest.mark.parametrize("small", [True, False])
def test_duplicates_go_whether_their_places_are_broadcast_or_not(spark, tmp_path, monkeypatch, rows, small):
    monkeypatch.setattr(cleanup, "fits_broadcast", lambda df: small)
    warehouse = Warehouse(spark, str(tmp_path))
    # equal rows twice, also under one id: the later id of a key stays, once
    tables.append_results(results(spark).unionByName(results(spark)), warehouse.path("results"))
    rewritten, files = cleanup.delete_duplicates(warehouse)
    assert 0 < rewritten <= files
    assert rows(warehouse.read("results"), "ResultID") == [(i,) for i in range(201, 401)]


def test_many_bad_places_sort_no_rows(spark, tmp_path, monkeypatch, jobs):
    monkeypatch.setattr(cleanup, "fits_broadcast", lambda df: False)
    warehouse = Warehouse(spark, str(tmp_path))
    tables.append_results(results(spark), warehouse.path("results"))
    jobs.clear()
    cleanup.delete_duplicates(warehouse)
    assert "ShuffledHashJoin" in plan(jobs[-1]) and "SortMergeJoin" not in plan(jobs[-1])
    places = next(plan(df) for df in jobs if "Window" in plan(df) and "_nth" in plan(df))
    window = places[places.index("Window") :]
    assert not re.search(r"Exchange hashpartitioning.*\n.*Project \[.*_file", window)


def test_distinct_pairs_are_not_counted_for_hot_ones(spark, monkeypatch, rows):
    monkeypatch.setattr(joins, "fits_broadcast", lambda df, *a: False)
    links = spark.createDataFrame([(1, 1), (2, None)], "question_id int, standard_id int")
    pairs = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (2, None), (None, 3)], "question_id int, standard_id int")
    found = merges.insert_ignore_link(links, pairs)
    assert "_is_hot" not in plan(found)
    assert rows(found) == [(None, 3), (1, 1), (1, 2), (2, None), (2, None)]


def test_buckets_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(buckets, "BUCKET_ROWS", 10)
    assert buckets.buckets_for(spark.range(30)) == 8
    assert buckets.buckets_for(spark.range(101)) == 11


def test_backfill_works_out_its_lookup_once(spark, monkeypatch):
    from markbook.operators import lookups

    seen = []
    monkeypatch.setattr(lookups, "lookup_join", lambda df, lookup, keys, *a, **k: (seen.append(lookup), joins.lookup_join(df, lookup, keys, *a, **k))[1])
    v = Views(spark, "/root/testdata/sf0.001")
    found = lookups.backfill_teacher_grade(v.results.select(*_BACKFILLED, "StudentID_LASID"), v.roster, v.users)
    assert "Join" not in plan(seen[-1]) and "Exchange" not in plan(seen[-1])
    assert found.count() == v.results.count()
