"""Pages that did not land, and a schema sketch of documents that disagree."""

import json
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from markbook import schemas
from markbook.plans import weekly
from markbook.session import scratch_dir
from markbook.sources import pages


def land(spark, path, *lines):
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.mode("append").text(path)


def page(n, records=2, **stated):
    fields = {"results": [{"site_id": i} for i in range(records)], **({"page": n} if n else {}), **stated}
    import json

    return json.dumps(fields)


def found(spark, path, rows):
    gaps = pages.page_gaps(pages.landed_pages(spark, path))
    return rows(gaps.withColumn("request", F.regexp_extract("request", "([^/]*)/?$", 1)), "request", "kind", "first", "last", "missing", "detail")


def test_numbered_pages(spark, rows):
    base = scratch_dir(spark)
    land(spark, f"{base}/whole", page(1, num_pages=2, num_results=4), page(2, num_pages=2, num_results=4), page(2, num_pages=2, num_results=4))
    land(spark, f"{base}/gaps", *[page(n, num_pages=9, num_results=18) for n in (2, 3, 6)])
    land(spark, f"{base}/short", page(1, num_pages=2, num_results=4), page(2, 1, num_pages=2, num_results=4))
    # the listing grew while it was paged, and one page states nothing
    land(spark, f"{base}/grew", page(1, num_pages=2), page(2, num_pages=4), page(3), page(7, num_pages=4))
    land(spark, f"{base}/unstated", page(1), page(3))
    assert found(spark, f"{base}/*", rows) == [
        ("gaps", "pages", 1, 1, 1, "page 1 of 9"),
        ("gaps", "pages", 4, 5, 2, "pages 4-5 of 9"),
        ("gaps", "pages", 7, 9, 3, "pages 7-9 of 9"),
        ("grew", "pages", 4, 4, 1, "page 4 of 4"),
        ("short", "records", None, None, 1, "3 of 4 records"),
    ]



def test_a_page_in_parts_has_the_records_of_all_parts_once(spark, tmp_path):
    def part(number, n, n_records):
        return json.dumps({"results": [{"id": i} for i in range(n_records)], "page": n, "part": number, "num_pages": 2, "num_results": 7})

    base = str(tmp_path)
    land(spark, f"{base}/whole", part(0, 1, 3), part(1, 1, 2), part(1, 1, 2), part(0, 2, 2))
    land(spark, f"{base}/short", part(0, 1, 3), part(1, 1, 2), part(0, 2, 1))
    found = pages.page_gaps(pages.landed_pages(spark, f"{base}/*")).collect()
    assert [(r.request.rsplit("/", 1)[1], r.kind, r.missing, r.detail) for r in found] == [("short", "records", 1, "6 of 7 records")]


def test_a_page_that_cannot_be_read_did_not_land(spark, rows):
    base = scratch_dir(spark)
    land(spark, f"{base}/page=1", page(None, num_pages=3))
    land(spark, f"{base}/page=2", page(None, num_pages=3)[:-9])
    land(spark, f"{base}/page=3", page(None, num_pages=3))
    assert [r[1:] for r in found(spark, f"{base}/*", rows)] == [("pages", 2, 2, 1, "page 2 of 3")]


def test_pages_without_a_number_are_counted(spark, rows):
    base = scratch_dir(spark)
    land(spark, f"{base}/a", page(None, num_pages=5, num_results=10), page(None, num_pages=5, num_results=10))
    land(spark, f"{base}/b", page(None, num_pages=1, num_results=3))
    land(spark, f"{base}/c", page(None), '{"message": "no results"}', '{"results": []}')
    got = found(spark, f"{base}/*", rows)
    assert sorted(r[1:] for r in got) == [("pages", None, None, 3, "2 of 5 pages"), ("records", None, None, 1, "2 of 3 records")]


def test_a_long_run_is_one_row(spark, rows):
    base = scratch_dir(spark)
    land(spark, f"{base}/a", page(1, num_pages=2_000_000_000))
    assert found(spark, f"{base}/a", rows) == [("a", "pages", 2, 2_000_000_000, 1_999_999_999, "pages 2-2000000000 of 2000000000")]


def test_load_keeps_missing_pages_and_stops_at_too_many(spark):
    base = scratch_dir(spark)
    for name in weekly.PAGES:
        land(spark, f"{base}/{name}", page(1, 0), page(2, 0, num_pages=3 if name == "roster" else 2))
    landed = {name: f"{base}/{name}" for name in weekly.PAGES}
    section = spark.createDataFrame([], "student_id string, section_id string, teacher_first string, teacher_last string, subject_area int, content_area int, seq int")
    subjects = spark.createDataFrame([], "subject_area_name string, sa_code int, course_id_code int")
    warehouse = weekly.Warehouse(spark, scratch_dir(spark))
    with pytest.raises(ValueError, match="1 pages of roster did not land"):
        weekly.load_from_pages(warehouse, landed, section, subjects)
    assert [(r.reason, r.detail) for r in warehouse.table(schemas.REJECTS).collect()] == [("missing_pages", "roster: page 3 of 3")]
    assert warehouse.read("results", schemas.LANDING).count() == 0
    weekly.load_from_pages(warehouse, landed, section, subjects, most_bad=0.5)
    assert warehouse.table(schemas.REJECTS).count() == 1


def test_pages_parsed_once_are_those_read_one_by_one(spark, rows):
    base = scratch_dir(spark)
    whole = '{"results": [{"site_id": 1, "site_name": "a"}, null, {"site_id": 2}], "num_pages": 3}'
    partly = '{"results": [{"site_id": "x", "site_name": "b"}, {"site_id": 3}]}'
    land(spark, f"{base}/1", whole, whole[:-30], partly, '{"results": []}', '{"results": null}', "", '{"message": "no results"}')
    land(spark, f"{base}/2", '{"results": {"site_id": 4}}', '{"results": [{"site_id": 5}], "num_pages": "many"}', "cut", whole)
    path, record = f"{base}/*", schemas.SITES
    parsed = pages.parsed_pages(spark, path, record)
    rejects = rows(pages.page_rejects(spark, path, record))
    assert len(rejects) >= 2 and rows(pages.page_rejects(spark, path, record, parsed=parsed)) == rejects
    records = rows(pages.read_pages(spark, path, record))
    assert len(records) >= 6 and rows(pages.read_pages(spark, path, record, parsed=parsed)) == records
    order = lambda df: [r[:-1] for r in df.orderBy("seq").collect()]
    assert order(pages.read_pages(spark, path, record, arrival="seq", parsed=parsed)) == order(pages.read_pages(spark, path, record, arrival="seq"))
    assert rows(pages.read_pages(spark, path, record, parsed=pages.parsed_pages(spark, path, record, arrival=False))) == records


def test_pages_are_counted_by_their_first_letters(spark):
    """A line is a page if it has more than blanks, however many it starts with; only those with many are looked at as a whole."""
    path = scratch_dir(spark)
    land(spark, path, "{}", "", " " * 63, " " * 500, " " * 63 + "x", " " * 64 + "x", " " * 500 + "x", "\t", "é" * 100)
    assert pages.page_count(spark, path) == 6


def test_a_load_parses_each_folder_twice_and_writes_the_fact_once(spark, monkeypatch):
    """Once for what its pages state and once for its records, whatever reads them."""
    base = scratch_dir(spark)
    sent = {
        "results": '{"local_student_id": "s1", "date_taken": "2024-09-01", "points": "1"}',
        "enrollment": '{"district_student_id": "s1", "site_id": 4}',
        "sites": '{"site_id": 4, "site_name": "North"}',
        "users": '{"user_id": "u1"}',
        "roster": '{"district_student_id": "s1", "user_id": "u1"}',
    }
    for name, record in sent.items():
        land(spark, f"{base}/{name}", '{"results": [' + record + "]}")
    section = spark.createDataFrame([], "student_id string, section_id string, teacher_first string, teacher_last string, subject_area int, content_area int, seq int")
    subjects = spark.createDataFrame([], "subject_area_name string, sa_code int, course_id_code int")
    written, write = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **k: (written.append(self._df), write(self, path, *a, **k))[1])
    warehouse = weekly.Warehouse(spark, scratch_dir(spark))
    weekly.load_from_pages(warehouse, {name: f"{base}/{name}" for name in sent}, section, subjects)
    assert warehouse.read("results").count() == 1 and warehouse.table(schemas.SUMMARY).count() == 0
    parses = sum(df._jdf.queryExecution().executedPlan().toString().count("FileScan json") for df in written)
    assert parses == 2 * len(weekly.PAGES)
    assert sum({"DateCompleted", "SectionID", "PercentCorrect"} <= set(df.columns) for df in written) == 1


def test_sketch_goes_into_arrays_and_keeps_types_by_file(spark, rows):
    one, two = scratch_dir(spark), scratch_dir(spark)
    land(spark, one, '{"id": 1, "q": [{"n": 1, "c": [{"l": "A", "ok": true}]}, {"n": 2, "c": null}], "x": {"y": 1.5}}', '{"id": 2, "q": []}')
    land(spark, two, '{"id": "three", "q": [{"n": "4"}], "x": {"y": 2}}', '{"id": 4', "", "[1, null]")
    merged = pages.merge_sketches(pages.schema_sketch(spark, one), pages.schema_sketch(spark, two))
    assert rows(merged.groupBy("field", "type").agg(F.sum("n").alias("n")), "field", "type", "n") == [
        ("$", "array", 1),
        ("$", "object", 3),
        ("$", "unreadable", 1),
        ("$[]", "bigint", 1),
        ("$[]", "null", 1),
        ("id", "bigint", 2),
        ("id", "string", 1),
        ("q", "array", 3),
        ("q[]", "object", 3),
        ("q[].c", "array", 1),
        ("q[].c", "null", 1),
        ("q[].c[]", "object", 1),
        ("q[].c[].l", "string", 1),
        ("q[].c[].ok", "boolean", 1),
        ("q[].n", "bigint", 2),
        ("q[].n", "string", 1),
        ("x", "object", 2),
        ("x.y", "bigint", 1),
        ("x.y", "decimal", 1),
    ]
    report = {r.field: r for r in pages.sketch_report(merged).collect()}
    assert report["id"].clash and [(p.type, p.n, p.files) for p in report["id"].places] == [("bigint", 2, 1), ("string", 1, 1)]
    assert report["id"].places[0].file.startswith("file:") and report["id"].places[0].file != report["id"].places[1].file
    assert not report["x.y"].clash and report["x.y"].types == ["bigint", "decimal"]
    assert report["q[].c"].non_null_rate == pytest.approx(1 / 3) and report["q[].n"].non_null_rate == 1.0
    assert report["x"].non_null_rate == pytest.approx(2 / 3)


def test_sketch_of_a_deep_document(spark):
    path = scratch_dir(spark)
    land(spark, path, '{"a":' * 30 + "1" + "}" * 30)
    assert pages.schema_sketch(spark, path, max_depth=4).agg(F.max(F.length("field"))).first()[0] == len("a.a.a")
    assert pages.schema_sketch(spark, path).count() == pages.MAX_DEPTH


def test_sketch_of_nothing(spark):
    path = scratch_dir(spark)
    land(spark, path, "")
    assert pages.schema_sketch(spark, path).count() == 0


def test_sketch_has_the_types_of_variants(spark):
    path = scratch_dir(spark)
    numbers = ["1e5", "1.5E2", "-0", "-0.0", "0." + "0" * 37 + "1", "0." + "0" * 38 + "1", "1" * 38 + ".5", "9" * 38, "1" * 39]
    numbers += ["9223372036854775807", "9223372036854775808", "-9223372036854775808", "-9223372036854775809"]
    odd = ['{"a": 1, "a": 2}', '{"a": 1} behind', "NaN", "01", ' \t"x"', '"\\ud800"', "[]", "{}", '{"$": {"b": 1}}', '{"a.b": {"": [[true]]}}', '{"é\\u0041": null}']
    land(spark, path, *numbers, *odd)
    want = spark.read.text(path).select(F.schema_of_variant(F.try_parse_json("value")).alias("t")).collect()
    want = Counter({None: "unreadable"}.get(r.t) or re.match("[A-Z]+", r.t)[0].lower() for r in want)
    sketch = pages.schema_sketch(spark, path).collect()
    assert {r.type: r.n for r in sketch if r.field == "$" and r.type != "object"} == {k: n for k, n in want.items() if k != "object"}
    inner = {(r.field, r.type): r.n for r in sketch if r.field != "$" or r.type == "object"}
    assert inner == {
        ("$", "object"): want["object"] + 1, ("a", "bigint"): 1, ("b", "bigint"): 1, ("a.b", "object"): 1, ("a.b.", "array"): 1,
        ("a.b.[]", "array"): 1, ("a.b.[][]", "boolean"): 1, ("éA", "null"): 1,
    }


def test_sketch_stages_counts_and_not_values(spark, monkeypatch):
    """Whatever the depth, one table is staged, and a task passes on a row for each field and type of a batch."""
    path, staged = scratch_dir(spark), []
    land(spark, path, *['{"q": [{"c": [{"l": "A"}, {"l": "B"}]}]}'] * 50)
    monkeypatch.setattr(pages, "stage", lambda rows: staged.append(rows) or rows)
    assert {(r.field, r.n) for r in pages.schema_sketch(spark, path).collect()} == {("$", 50), ("q", 50), ("q[]", 50), ("q[].c", 50), ("q[].c[]", 100), ("q[].c[].l", 100)}
    assert len(staged) == 1
