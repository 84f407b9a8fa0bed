"""Weekly updates from pages as they land: each file counts once, whatever breaks off."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from markbook import schemas
from markbook.plans import weekly
from markbook.session import scratch_dir
from markbook.sources import snapshots

from test_enrichment import inputs, profile, raw_rows  # noqa: F401

AS_OF = dt.date(2024, 9, 3)


def land(rows, path):
    names = [f.name for f in schemas.DETAIL_RESULT.fields if f.name in rows.columns]
    rows.groupBy(F.lit(1).alias("g")).agg(F.collect_list(F.struct(*names)).alias("results")).select("results").write.mode("append").json(path)


def content(warehouse, rows):
    columns = ["StudentID_LASID", "AssessmentID", "StandardCodingNumber", "DateCompleted", "PointsAchieved"]
    return rows(warehouse.read("results"), *columns), rows(warehouse.table(schemas.SUMMARY))


def test_each_file_counts_once(spark, profile, rows):  # noqa: F811
    raw, path = raw_rows(spark), scratch_dir(spark)
    w, whole = (weekly.Warehouse(spark, scratch_dir(spark)) for _ in range(2))
    land(raw, path)
    weekly.weekly_from_pages(w, path, profile, AS_OF, 7, "2024-2025")
    weekly.weekly_update(whole, raw, profile, AS_OF, 7, "2024-2025")
    assert content(w, rows) == content(whole, rows)
    version = snapshots.latest(spark, w.path("results")).version
    weekly.weekly_from_pages(w, path, profile, AS_OF, 7, "2024-2025")
    assert snapshots.latest(spark, w.path("results")).version == version

    # the next pull of the window lands in two files, one row in both
    second = raw.where("result_seq < 3").withColumn("points", F.col("points") + 1)
    land(second.where("result_seq = 1").withColumn("points", F.lit(9).cast("decimal(10,2)")), path)
    weekly.incremental.new_pages(spark, path, schemas.DETAIL_RESULT, weekly.incremental.land_batches(w.path("landed_results")), w.path("landed_checkpoint"))
    land(second, path)
    weekly.weekly_from_pages(w, path, profile, AS_OF, 7, "2024-2025")
    weekly.weekly_update(whole, second, profile, AS_OF, 7, "2024-2025")
    assert content(w, rows) == content(whole, rows)


@pytest.mark.parametrize("step", ["update_lookups", "refresh_summary", "sync_program"])
def test_broken_off_after_the_results(spark, profile, rows, monkeypatch, step):  # noqa: F811
    raw, path = raw_rows(spark), scratch_dir(spark)
    w, whole = (weekly.Warehouse(spark, scratch_dir(spark)) for _ in range(2))
    land(raw, path)

    def broken(*_):
        raise RuntimeError("ends here")

    with monkeypatch.context() as patched:
        patched.setattr(weekly, step, broken)
        with pytest.raises(RuntimeError):
            weekly.weekly_from_pages(w, path, profile, AS_OF, 7, "2024-2025")
    weekly.weekly_from_pages(w, path, profile, AS_OF, 7, "2024-2025")
    weekly.weekly_update(whole, raw, profile, AS_OF, 7, "2024-2025")
    assert content(w, rows) == content(whole, rows)
