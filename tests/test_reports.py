import datetime as dt
import random

import pytest

from markbook import schemas
from markbook.operators import quality, reports

DAY = dt.date(2024, 9, 1)


def test_assessment_usage_equals_brute_force(spark):
    rng = random.Random(3)
    results = [
        (rng.randint(1, 6), rng.choice(["a", "b", "c", "d", None]), DAY + dt.timedelta(rng.randint(0, 9)), s, f"N{s}")
        for s in (rng.choice([1, 2, 3, None]) for _ in range(200))
    ] + [(1, "a", DAY, 3, "Second name")]
    assignments = [(rng.choice(["x", "y", None]), rng.choice(["P", None]), rng.choice([1, 2, 3, 9, None]), rng.choice([1, 2, 3, 8, None])) for _ in range(40)]
    rdf = spark.createDataFrame(results, "AssessmentID int, StudentID_LASID string, DateCompleted date, SchoolID int, SchoolName string")
    adf = spark.createDataFrame(assignments, "AssignmentName string, ProgramName string, SchoolID int, SourceAssessmentID int")

    names = {}
    for r in results:
        if r[3] is not None:
            names.setdefault(r[3], set()).add(r[4])
    lines = {}
    for name, program, school, assessment in assignments:
        for site in names.get(school, {None}):
            used = lines.setdefault((name, program, school, site), ([], []))
            for r in results:
                if assessment is not None and r[0] == assessment:
                    used[0].append(r[1])
                    used[1].append(r[2])
    want = {(*k, len(set(s) - {None}), max(d, default=None)) for k, (s, d) in lines.items()}
    got = [tuple(r) for r in reports.assessment_usage(adf, rdf).collect()]
    assert set(got) == want and len(got) == len(want)


def offset_rows(spark, pairs):
    return spark.createDataFrame([(n, g, DAY) for n, g in pairs], "AssignmentName string, StudentGrade string, DateCompleted date")


@pytest.mark.parametrize(
    "pairs, offset, verdict",
    [
        ([("5Math", "6"), ("5ELA", "6"), ("3ELA", "4"), ("12x", "9")], 1, "confirmed"),
        ([("5Math", "7"), ("10x", "11")], 2, "other offset"),
        ([("5Math", "5")], 0, "undetermined"),
        ([("5Math", "6"), ("5Math", "7"), ("3ELA", "K"), ("2x", None)], None, "undetermined"),
        ([("Unit", "6")], None, "undetermined"),
    ],
)
def test_grade_offset(spark, pairs, offset, verdict):
    row = reports.grade_offset(offset_rows(spark, pairs), DAY).first()
    assert (row.DetectedOffset, row.Verdict) == (offset, verdict)


def test_grade_offset_takes_the_lowest_grade_by_number(spark):
    row = reports.grade_offset(offset_rows(spark, [("10x", "12"), ("9x", "10")]), DAY).first()
    assert row.DetectedOffset == 1


def test_grade_prefix_and_sample(spark):
    names = ["12x"] * 8 + ["1x"] * 3 + ["5x", "x", None]
    df = spark.createDataFrame(
        [(i, n, "6", DAY, "L", "F", "S") for i, n in enumerate(names)],
        "ResultID long, AssignmentName string, StudentGrade string, DateCompleted date, LastName string, FirstName string, SchoolName string",
    )
    counts = {r[0]: r[1] for r in reports.grade_prefix_rows(df).groupBy("TargetGrade").count().collect()}
    assert counts == {1: 11, 12: 8, 5: 1}
    sample = lambda: {(r.TargetGrade, r.ResultID) for r in reports.random_sample_per_grade(df.repartition(3), DAY).collect()}
    first = sample()
    assert first == sample()
    assert sorted(g for g, _ in first) == [1] * 5 + [5] + [12] * 5


def test_population_status(spark):
    results = spark.createDataFrame([("P", "C", "N", "S", "1"), (None, "C", "M", "S", "Overall")], "ProgramName string, Component string, AssignmentName string, StandardSet string, StandardCodingNumber string")
    assignments = results.select("ProgramName", "Component", "AssignmentName")
    standards = results.select("StandardSet", "StandardCodingNumber")
    status = lambda a, b, **kw: reports.population_status(results, a, b, **kw).first().Status
    some = assignments.where("ProgramName IS NOT NULL")
    assert status(assignments, standards) == "SUCCESS"
    assert status(some, standards) == "SUCCESS"  # a key with a missing part is not looked for
    assert status(some, standards, null_safe=True) == "PARTIAL SUCCESS"
    assert status(assignments, standards.limit(0)) == "PARTIAL SUCCESS"
    assert status(assignments.limit(0), standards.limit(0)) == "FAILED"
    by_count = reports.population_status_by_count(results, assignments, standards).first()
    assert by_count.Status == "SUCCESS" and by_count.UniqueAssignments == 1


def test_class_statistics_on_no_rows(spark):
    df = spark.createDataFrame([], "TeacherLastName string, StudentID_LASID string, DateCompleted date, StudentGrade string")
    assert tuple(reports.class_statistics(df, "x", "6", DAY).first()) == (0, None, None, 0, 0)


def test_load_metrics(spark):
    raw = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "local_student_id string")
    known = spark.createDataFrame([("a",)], "local_student_id string")
    assert tuple(reports.load_metrics(raw, known).first()) == (2, 2)
    assert tuple(reports.load_metrics(raw.limit(0), known).first()) == (0, 0)


def test_quality_checks(spark, rows):
    df = spark.createDataFrame([("a", None), ("a", None), ("bbb", "x")], "k string, v string")
    assert rows(quality.unique_violations(df, ["k", "v"])) == [("a", None, 2)]
    assert rows(quality.required_violations(df, ["k", "v"])) == [("k", 0), ("v", 2)]
    assert rows(quality.length_violations(df, {"k": 2, "absent": 1})) == [("k", 1)]
    assert rows(quality.column_report(df), "column_name", "max_length", "data_type") == [("k", 3, "string"), ("v", 1, "string")]
    relaxed = quality.relax_required(schemas.RESULTS, "SchoolName")
    assert relaxed.required == ("AcademicYear",) and schemas.RESULTS.required == ("AcademicYear", "SchoolName")


def test_catalog_presence(spark, rows):
    spark.range(1).createOrReplaceTempView("there")
    assert rows(quality.catalog_presence(spark, ["there", "not_there"])) == [("not_there", False), ("there", True)]


def test_orphans(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "p int")
    parent = spark.createDataFrame([(1,)], "id int")
    assert tuple(quality.orphans(child, "p", parent, "id").first()) == (2, 1)


def test_top_lists_break_ties(spark):
    df = spark.createDataFrame([(i, DAY if i % 2 else None) for i in range(20)], "i int, d date")
    top = reports.top_recent_lookups(df.repartition(4), "d", "i")
    assert [r.i for r in top.collect()] == [1, 3, 5, 7, 9]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
