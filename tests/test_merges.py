import pytest
from pyspark.sql import functions as F

from markbook.operators import merges, quality, reports
from markbook.schemas import ASSIGNMENTS, STANDARDS, conform

RESULT = (
    "ResultID long, AssessmentID int, AssignmentName string, Subject string, ProgramName string, Publisher string,"
    " Component string, SchoolID int, StandardCodingNumber string, StandardDescription string"
)


@pytest.fixture(scope="module")
def results(spark):
    return spark.createDataFrame(
        [
            (1, 9, "A", None, None, None, None, 1, "ELA.1", "second"),
            (2, 7, "A", None, "", None, None, 1, "Math.1", "first"),
            (3, 7, "A", None, "", "P", None, 1, "Math.1", None),
            (4, 8, "B", "Art", "Prog", None, "C", 2, "X", "x"),
            (5, None, "B", "Art", "Prog", None, "C", 2, "", "x"),
            (6, 8, "B", "Art", "Prog", None, "C", None, None, "x"),
            (7, 8, "B", "Art", "Prog", None, "C", 3, "Math.1", "another"),
        ],
        RESULT,
    )


@pytest.fixture(scope="module")
def assignments(spark):
    rows = [("Prog", None, "C", "B", 100, "Old", 2), (None, "Pub", None, "A", 101, None, 1), ("Other", None, None, "Z", 102, "S", 5)]
    names = "ProgramName string, Publisher string, Component string, AssignmentName string, SourceAssessmentID int, Subject string, SchoolID int"
    return spark.createDataFrame(rows, names)


def test_merge_assignments(rows, assignments, results):
    got = merges.merge_assignments(assignments, results)
    assert rows(got, "ProgramName", "AssignmentName", "SchoolID", "SourceAssessmentID", "Publisher", "Subject") == sorted(
        [
            ("", "A", 1, 101, "P", "Math"),  # '' and missing are one key; the id of a match stays
            ("Other", "Z", 5, 102, None, "S"),
            ("Prog", "B", 2, 100, None, "Art"),
            ("Prog", "B", 3, 8, None, "Art"),
        ],
        key=str,
    )
    assert rows(merges.merge_assignments(got, results)) == rows(got)


def test_merge_standards_is_repeatable_with_two_descriptions(spark, rows, results):
    target = conform(spark.createDataFrame([("Set", "X", "old", "S")], "StandardSet string, StandardCodingNumber string, StandardDescription string, Subject string"), STANDARDS.columns)
    got = merges.merge_standards(target, results)
    assert rows(got, "StandardSet", "StandardCodingNumber", "StandardDescription", "Subject") == [
        (None, "ELA.1", "second", "ELA"),
        (None, "Math.1", "another", "Math"),
        ("Set", "X", "x", "S"),
    ]
    assert rows(merges.merge_standards(got, results)) == rows(got)


def test_merge_standards_catalogue(spark, rows, results):
    target = conform(spark.createDataFrame([], "StandardCodingNumber string"), STANDARDS.columns)
    catalogue = spark.createDataFrame(
        [("Math.1", "cat", "CatSet", "CatSubject", "4", "Strand", "T"), ("X", None, None, "CatX", None, None, None)],
        "glce_code string, description string, content_area string, subject string, grade_level string, subject_desc1 string, type string",
    )
    got = merges.merge_standards_catalogue(target, results, catalogue)
    assert rows(got, "StandardCodingNumber", "StandardDescription", "StandardSet", "Subject", "GradeLevel") == [
        ("ELA.1", "second", None, "ELA", None),
        ("Math.1", "cat", "CatSet", "Math", "4"),
        ("X", "x", None, "Art", None),
    ]
    assert rows(merges.merge_standards_catalogue(got, results, catalogue)) == rows(got)


def test_insert_absent_keeps_rows_without_key(spark, rows):
    names = "StandardSet string, StandardCodingNumber string, StandardDescription string, seq int"
    target = spark.createDataFrame([("S", "1", "old")], "StandardSet string, StandardCodingNumber string, StandardDescription string")
    source = spark.createDataFrame(
        [("S", "1", "new", 1), ("S", "2", "b", 3), ("S", "2", "a", 2), (None, "1", "n", 4), (None, "1", "n", 5)], names
    )
    got = merges.insert_absent_standard(target, source, "seq")
    assert rows(got) == [(None, "1", "n"), (None, "1", "n"), ("S", "1", "old"), ("S", "2", "a")]


def test_upsert_overwrites_with_missing_values(spark, rows):
    names = "standard_id int, standard_code string, standard_description string, subject string, grade_level string"
    target = spark.createDataFrame([(1, "c1", "d1", "s", "g")], names)
    source = spark.createDataFrame(
        [(1, "new", None, "t", "h", 1), (2, "first", "x", "a", "b", 2), (2, "last", "y", None, "b", 3), (None, "n", "n", "n", "n", 4)],
        names + ", seq int",
    )
    got = merges.upsert_legacy_standards(target, source, "seq")
    assert rows(got) == [(1, "c1", None, "t", "h"), (2, "first", "y", None, "b")]


def test_upsert_scores_inserts_every_row_without_key(spark, rows):
    names = "student_id int, assessment_id int, test_date date, raw_score int, percent_correct int, performance_band string, version int"
    target = spark.createDataFrame([], names)
    source = spark.createDataFrame([(None, 1, None, 5, 5, "b", 1, 1), (None, 1, None, 6, 6, "b", 1, 2)], names + ", seq int")
    assert len(rows(merges.upsert_scores(target, source, "seq"))) == 2


def test_insert_ignore_link(spark, rows):
    links = spark.createDataFrame([(1, 1)], "question_id int, standard_id int")
    pairs = spark.createDataFrame([(1, 1), (1, 2), (1, 2)], "question_id int, standard_id int")
    assert rows(merges.insert_ignore_link(links, pairs)) == [(1, 1), (1, 2)]


def test_delete_duplicates_leaves_none(spark):
    key = "StudentID_LASID string, AssessmentID int, StandardCodingNumber string, DateCompleted string, ResultID long"
    df = spark.createDataFrame([("a", 1, None, None, 1), ("a", 1, None, None, 2), ("a", 1, "x", None, 3), (None, None, None, None, 4), (None, None, None, None, 5)], key)
    once = quality.delete_duplicates(df)
    assert sorted(r.ResultID for r in once.collect()) == [2, 3, 5]
    assert tuple(reports.duplicate_count(df).first()) == (5, 3, 2)
    assert tuple(reports.duplicate_count(once).first()) == (3, 3, 0)
    assert sorted(r.ResultID for r in quality.delete_duplicates(once).collect()) == [2, 3, 5]


def test_update_from_latest_school(spark, rows, assignments):
    results = spark.createDataFrame([(100, 9, "2024-01-01"), (100, 4, "2024-02-01"), (102, None, "2024-02-01")], "AssessmentID int, SchoolID int, DateCompleted string")
    got = merges.update_from_latest_school(assignments, results)
    assert rows(got, "SourceAssessmentID", "SchoolID") == [(100, 4), (101, 1), (102, 5)]
    assert ASSIGNMENTS.columns.fieldNames() == got.columns


def test_merge_scatters_rows_without_key(spark, rows):
    target = spark.createDataFrame([(None, i) for i in range(50)] + [(1, 1)], "k int, v int").repartition(4)
    source = spark.createDataFrame([(None, 100 + i) for i in range(50)] + [(1, None), (2, 2)], "k int, v int").repartition(4)
    got = merges.merge_frames(target, source, ["k"], {"v": merges.COALESCE})
    assert got.count() == 102
    assert rows(got.where(F.col("k").isNotNull())) == [(1, 1), (2, 2)]
