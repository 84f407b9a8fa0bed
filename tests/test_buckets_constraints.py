"""Joins of bucketed tables without a shuffle, and all constraints by one scan of each table."""

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from markbook import schemas
from markbook.operators import quality
from markbook.plans import enrichment
from markbook.session import scratch_dir
from markbook.sources import buckets

from test_enrichment import inputs, profile, raw_rows  # noqa: F401


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stored(spark, raw, known, n=4, other=None):
    name = f"t{uuid.uuid4().hex}"
    buckets.write_bucketed(raw, f"{name}_raw", scratch_dir(spark), "local_student_id", n)
    buckets.write_bucketed(known, f"{name}_profile", scratch_dir(spark), "local_student_id", other or n)
    return f"{name}_raw", f"{name}_profile"


def many(spark):
    """Enough students that the buckets are even."""
    raw = raw_rows(spark).where("local_student_id = 's1'")
    return raw.crossJoin(spark.range(64).withColumnRenamed("id", "k")).withColumn("local_student_id", F.concat(F.lit("s"), "k")).drop("k")


def test_bucketed_enrichment_has_no_exchange(spark, profile, rows):  # noqa: F811
    one = profile.where("local_student_id = 's1'").drop("local_student_id")
    known = one.crossJoin(spark.range(64).select(F.concat(F.lit("s"), "id").alias("local_student_id")))
    names = stored(spark, many(spark), known)
    got = enrichment.bucketed_enrichment(spark, *names, max_bytes=0)
    plan = plan_of(got)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert rows(got) == rows(enrichment.full_enrichment(many(spark), known))
    # small enough: broadcast, also without a shuffle of the results
    small = plan_of(enrichment.bucketed_enrichment(spark, *names))
    assert "BroadcastHashJoin" in small and "hashpartitioning" not in small


def test_other_layouts_take_the_scattered_join(spark, profile, rows):  # noqa: F811
    want = rows(enrichment.full_enrichment(raw_rows(spark), profile))
    for n, other in ((4, 8), (4, 4)):
        # bucket counts that differ, and one student with most of the rows
        names = stored(spark, raw_rows(spark), profile, n, other)
        assert buckets.alike(spark, "local_student_id", *names) == (n == other)
        got = enrichment.bucketed_enrichment(spark, *names, max_bytes=0)
        assert rows(got) == want


def test_even_looks_at_bucket_sizes(spark):
    skewed = spark.range(200000).select(F.when(F.col("id") < 190000, "one").otherwise(F.col("id").cast("string")).alias("k"), F.xxhash64("id").alias("v"))
    name = f"t{uuid.uuid4().hex}"
    buckets.write_bucketed(skewed, name, scratch_dir(spark), "k", 16)
    assert not buckets.even(spark, name)
    assert buckets.layout(spark, name)[1:] == (16, ("k",))


def test_registered_table_keeps_its_buckets(spark):
    path, name = scratch_dir(spark), f"t{uuid.uuid4().hex}"
    rows = spark.range(100).withColumn("v", F.col("id") * 2)
    buckets.write_bucketed(rows, name, path, "id", 4)
    spark.sql(f"DROP TABLE {name}")
    buckets.register(spark, name, path, rows.schema, "id", 4)
    assert spark.table(name).count() == 100 and buckets.alike(spark, "id", name)


TABLES = {
    "assessments": ("assessment_id int", [(1,), (2,), (2,), (None,)]),
    "assessment_questions": ("assessment_id int, question_id long", [(1, 10), (3, 11), (3, 11), (None, 12)]),
    "answer_choices": ("question_id long", [(10,), (99,), (99,), (98,)]),
    "assignments": ("ProgramName string, Component string, AssignmentName string, SchoolID int, Subject string", [("a", None, "n", 1, "x" * 101), ("a", None, "n", 1, None), ("a", "c", "n", 1, "y")]),
    "results": ("AcademicYear string, LastName string", [(None, "n"), ("2024-2025", "m" * 200)]),
}
LAYOUTS = [schemas.ASSESSMENTS, schemas.QUESTIONS, schemas.CHOICES, schemas.ASSIGNMENTS, replace(schemas.RESULTS, widths={"LastName": 100, "Absent": 1})]


def frames(spark, empty=False):
    return {n: spark.createDataFrame([] if empty else r, s) for n, (s, r) in TABLES.items()}


def test_constraints(spark):
    got = {(r.table_name, r.kind, r.columns): (r.violations, r["keys"]) for r in quality.constraint_report(frames(spark), LAYOUTS).collect()}
    assert got[("assessments", "unique", "assessment_id")] == (2, 1)
    assert got[("assessment_questions", "reference", "assessment_id")] == (2, 1)
    assert got[("answer_choices", "reference", "question_id")] == (3, 2)
    # missing parts of a key are equal
    assert got[("assignments", "unique", "ProgramName,Component,AssignmentName,SchoolID")] == (2, 1)
    assert got[("assignments", "length", "Subject")] == (1, 0) and got[("assignments", "length", "ProgramName")] == (0, 0)
    # a column that is absent is missing in every row, but too long in none
    assert got[("results", "required", "AcademicYear")] == (1, 0) and got[("results", "required", "SchoolName")] == (2, 0)
    assert got[("results", "length", "LastName")] == (1, 0) and got[("results", "length", "Absent")] == (0, 0)


def test_constraints_agree_with_the_single_reports(spark):
    tables = frames(spark)
    got = {(r.table_name, r.kind, r.columns): (r.violations, r["keys"]) for r in quality.constraint_report(tables, LAYOUTS).collect()}
    for r in quality.foreign_key_report(tables, [schemas.QUESTIONS, schemas.CHOICES]).collect():
        table, column = r.relation.split(".")
        assert got[(table, "reference", column)] == (r.orphan_rows, r.orphan_keys)
    for r in quality.length_violations(tables["assignments"], schemas.ASSIGNMENTS.widths).collect():
        assert got[("assignments", "length", r.column_name)][0] == r.violations
    keys = quality.unique_violations(tables["assignments"], schemas.ASSIGNMENTS.unique)
    assert got[("assignments", "unique", ",".join(schemas.ASSIGNMENTS.unique))] == (keys.agg(F.sum("n")).first()[0], keys.count())


def test_one_scan_a_table(spark):
    written = {}
    for name, df in frames(spark).items():
        path = scratch_dir(spark)
        df.write.parquet(path)
        written[name] = spark.read.parquet(path)
    plan = plan_of(quality.constraint_report(written, LAYOUTS))
    assert plan.count("FileScan") == len(TABLES)


def test_constraints_of_empty_tables(spark):
    got = quality.constraint_report(frames(spark, empty=True), LAYOUTS).collect()
    assert got and all((r.violations, r["keys"]) == (0, 0) for r in got)
