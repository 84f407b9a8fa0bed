"""Inputs of the queries on landed files: written where the rows are, whatever their number."""

import json

from pyspark.sql import functions as F

from parity import landing, page_loads, reporting, views  # noqa: F401
from parity.registry import ON_VIEWS
from parity.views import Views

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pages_are_put_together_without_a_shuffle(spark):
    rows = spark.range(0, 25, 1, 2).withColumn("empty", F.lit(None).cast("string"))
    lines = landing.envelopes(rows, 5, num_pages=6, num_results=25)
    assert "Exchange" not in plan(lines)
    read = [json.loads(r.value) for r in lines.collect()]
    assert [len(p["results"]) for p in read] == [5, 5, 2, 5, 5, 3]
    assert [r["id"] for p in read for r in p["results"]] == list(range(25))
    assert all((p["num_pages"], p["num_results"]) == (6, 25) and "page" not in p for p in read)


def test_parts_of_a_numbered_page_have_numbers_of_their_own(spark):
    rows = spark.range(0, 40, 1, 2)
    lines = landing.envelopes(rows, 6, page=F.col("id") % 2 + 1)
    read = [json.loads(r.value) for r in lines.collect()]
    assert max(len(p["results"]) for p in read) == 6
    assert len({(p["page"], p["part"]) for p in read}) == len(read)
    assert sorted((p["page"], r["id"]) for p in read for r in p["results"]) == sorted((i % 2 + 1, i) for i in range(40))


def test_landed_order_needs_no_task_with_all_rows(spark, tmp_path):
    path = str(tmp_path / "pages")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = spark.range(0, 9000, 1, 4).select((F.lit(9000) - F.col("id")).alias("n"), F.col("id").alias("seq"))
    try:
        page_loads.land(rows.repartition(4), "n", path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = sorted(p for p in (tmp_path / "pages").iterdir() if p.name.startswith("part-"))
    found = [r["n"] for p in files for line in spark.read.text(str(p)).collect() for r in json.loads(line.value)["results"]]
    assert found == list(range(1, 9001))
    assert len(files) > 1


def test_nested_records_meet_as_numbers_in_one_list(spark):
    text = plan(Views(spark, SF_DIR).sql(landing.NESTED_RECORDS))
    assert text.count(" collect_list(") + text.count("[collect_list(") == 1
    assert "Michigan" not in text[text.index("ObjectHashAggregate") + 1 :].split("collect_list")[-1]


def test_detail_documents_are_made_in_many_tasks(spark, rows, monkeypatch):
    """Parts lie in few, small files, but their documents are long."""
    v = Views(spark, SF_DIR)
    whole = landing.detail_documents(v)
    monkeypatch.setattr(landing, "TASK_PARTS", v.part.count() // 4)
    spread = landing.detail_documents(v)
    assert spread.rdd.getNumPartitions() >= 4
    assert rows(spread) == rows(whole)


def test_spread_views_are_made_in_more_tasks(spark, rows, monkeypatch):
    """A task that is sized by the numbers it reads holds no more than ``TASK_ITEMS`` line items."""
    v = Views(spark, SF_DIR)
    n = v.lineitem.count()
    assert plan(v.spread("results")).count("REPARTITION") == 0  # one task holds them all
    monkeypatch.setattr(views, "TASK_ITEMS", n // 12)
    spread = v.spread("results")
    tasks = -(-n // (n // 12))
    assert plan(spread).count(f"{tasks}), REPARTITION_BY_NUM") == 2  # the results and their second copies
    assert rows(spread) == rows(v.results)
    assert "REPARTITION_BY_NUM" in plan(ON_VIEWS["summary_vs_detail"](v))
