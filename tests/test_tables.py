import datetime as dt

import pytest
from pyspark.sql import functions as F

from markbook import schemas
from markbook.session import scratch_dir
from markbook.sources import pages, tables
from markbook.streaming import incremental

NAMES = "ResultID long, AcademicYear string, DateCompleted date, v int"


def landing(spark, rows):
    return spark.createDataFrame([(i, y, dt.date.fromisoformat(d) if d else None, v) for i, y, d, v in rows], NAMES)


BASE = [
    (1, "2022-2023", "2022-10-01", 0),
    (2, "2023-2024", "2024-06-29", 0),
    (3, "2024-2025", "2024-07-02", 0),
    (4, "2024-2025", "2024-09-01", 0),
    (5, None, None, 0),
]


def test_replace_window_rewrites_only_touched_years(spark, rows):
    path = scratch_dir(spark)
    tables.append_results(landing(spark, BASE), path)
    untouched = lambda: {f for f in spark.read.parquet(path).inputFiles() if "2022-2023" in f}
    before = untouched()
    batch = landing(spark, [(30, "2024-2025", "2024-07-02", 9), (31, "2024-2025", "2024-07-03", 9)])
    touched = tables.replace_window(spark, path, batch, dt.date(2024, 6, 25), dt.date(2024, 7, 5))
    assert touched == ["2023-2024", "2024-2025"]
    got = tables.read_results(spark, path)
    # 2023-2024 lost its only row: its folder must not keep the old file.
    assert rows(got, "ResultID", "v") == [(1, 0), (30, 9), (31, 9), (4, 0), (5, 0)]
    assert before == untouched()
    again = tables.replace_window(spark, path, batch, dt.date(2024, 6, 25), dt.date(2024, 7, 5))
    assert again == ["2024-2025"]
    assert rows(tables.read_results(spark, path), "ResultID") == [(1,), (30,), (31,), (4,), (5,)]


def test_replace_window_with_missing_year(spark, rows):
    path = scratch_dir(spark)
    tables.append_results(landing(spark, [*BASE, (6, None, "2024-07-01", 0)]), path)
    tables.replace_window(spark, path, landing(spark, []), dt.date(2024, 7, 1), dt.date(2024, 7, 1))
    assert rows(tables.read_results(spark, path), "ResultID") == [(1,), (2,), (3,), (4,), (5,)]


def test_replace_window_without_any_row(spark):
    path = scratch_dir(spark)
    tables.append_results(landing(spark, BASE), path)
    assert tables.replace_window(spark, path, landing(spark, []), dt.date(1990, 1, 1), dt.date(1990, 2, 1)) == []


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_reach_the_scan(spark):
    path = scratch_dir(spark)
    tables.append_results(landing(spark, BASE), path)
    stored = tables.read_results(spark, path)
    years = plan_of(stored.where(tables.in_years(["2022-2023", None])).select("ResultID"))
    assert "PartitionFilters: [((AcademicYear" in years and "ReadSchema: struct<ResultID:bigint>" in years
    window = plan_of(pages.source_filters(stored, F.col("DateCompleted"), F.col("v"), [0, 3], dt.date(2024, 1, 1)))
    pushed = window[window.index("PushedFilters") :]
    assert "GreaterThanOrEqual(DateCompleted" in pushed and "In(v, [0,3])" in pushed


def test_full_refresh_drops_old_years(spark, rows):
    path = scratch_dir(spark)
    tables.append_results(landing(spark, BASE), path)
    tables.full_refresh(landing(spark, BASE[2:4]), path)
    assert rows(tables.read_results(spark, path), "ResultID") == [(3,), (4,)]


def test_replace_table_from_itself(spark, rows):
    path = scratch_dir(spark)
    spark.range(5).write.parquet(path)
    tables.replace_table(spark.read.parquet(path).where("id > 2"), path)
    assert rows(spark.read.parquet(path)) == [(3,), (4,)]


def test_archive_years(spark, rows):
    path, archive = scratch_dir(spark), scratch_dir(spark)
    tables.append_results(landing(spark, BASE), path)
    assert tables.archive_years(spark, path, archive, "2024-2025") == ["2022-2023", "2023-2024"]
    assert rows(tables.read_results(spark, path), "ResultID") == [(3,), (4,), (5,)]
    assert rows(tables.read_results(spark, archive), "ResultID") == [(1,), (2,)]
    assert tables.archive_years(spark, path, archive, "2024-2025") == []


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_surrogate_key_is_dense_and_repeatable(spark, n):
    df = spark.range(n).select(F.col("id").cast("string").alias("k"))
    numbered = tables.surrogate_key(df, "ID", ["k"], start=100)
    first = {r.k: r.ID for r in numbered.collect()}
    assert sorted(first.values()) == list(range(100, 100 + n))
    again = tables.surrogate_key(df.repartition(7), "ID", ["k"], start=100)
    assert {r.k: r.ID for r in again.collect()} == first


def test_sparse_ids_and_next_id(spark):
    df = tables.sparse_ids(spark.range(100).repartition(4), "ID", 7)
    ids = [r.ID for r in df.collect()]
    assert len(set(ids)) == 100 and min(ids) == 7
    assert tables.next_id(df, "ID") == max(ids) + 1
    assert tables.next_id(df.limit(0), "ID") == 1


def test_logged_append(spark, rows):
    path, log = scratch_dir(spark), scratch_dir(spark)
    assert tables.logged_append(landing(spark, BASE), path, "results", log) == 5
    broken = landing(spark, BASE).withColumn("v", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        tables.logged_append(broken, path, "results", log)
    got = spark.read.parquet(log)
    assert rows(got, "endpoint", "records_extracted", "status") == [("results", 0, "error"), ("results", 5, "success")]


def test_audit_columns(spark):
    df = tables.audit_columns(spark.range(1))
    assert df.columns == ["id", "CreatedDate", "UpdatedDate"] and df.first().CreatedDate is not None


class FakeSession:
    """Settings of a session; the real one fixes them when it starts."""

    def __init__(self, master, **conf):
        self.conf = conf
        self.sparkContext = type("Context", (), {"master": master})


def test_scratch_dir_is_read_from_the_session():
    named = FakeSession("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/"})
    assert scratch_dir(named).startswith("hdfs:///shared/markbook-")
    assert scratch_dir(named) != scratch_dir(named)
    assert "markbook-" in scratch_dir(FakeSession("local[2]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(FakeSession("yarn"))


RECORD = schemas.SITES


def write_text(spark, path, lines):
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.mode("append").text(path)


def test_read_pages(spark, rows):
    path = scratch_dir(spark)
    write_text(
        spark,
        path,
        [
            '{"results": [{"site_id": 1, "site_name": "a"}, {"site_id": 2}], "num_pages": 3, "num_results": 2}',
            '{"results": [], "num_pages": 3}',
            '{"message": "no results"}',
        ],
    )
    assert rows(pages.read_pages(spark, path, RECORD), "site_id", "site_name") == [(1, "a"), (2, None)]
    found = {r.field: (r.type, r.non_null_rate) for r in pages.discover_pages(spark, path).collect()}
    assert found == {"site_id": ("bigint", 1.0), "site_name": ("string", 0.5)}


def test_read_bare_array(spark, rows):
    path = scratch_dir(spark)
    write_text(spark, path, ['[{"site_id": 1, "site_name": "a"},', '{"site_id": 0, "site_name": "b"}]'])
    got = pages.read_documents(spark, path, RECORD, multi_line=True)
    assert rows(got, "site_id", "site_name") == [(0, "b"), (1, "a")]


def test_new_pages_reads_each_file_once(spark, rows):
    source, landed, state = scratch_dir(spark), scratch_dir(spark), scratch_dir(spark)
    write_text(spark, source, ['{"results": [{"site_id": 1}]}'])
    handle = incremental.land_batches(landed)
    incremental.new_pages(spark, source, RECORD, handle, state)
    write_text(spark, source, ['{"results": [{"site_id": 2}, {"site_id": 3}]}'])
    incremental.new_pages(spark, source, RECORD, handle, state)
    incremental.new_pages(spark, source, RECORD, handle, state)
    assert rows(spark.read.parquet(landed), "site_id") == [(1,), (2,), (3,)]
