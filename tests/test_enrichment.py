import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from markbook import schemas
from markbook.operators import joins, lookups, nested, quality, reports
from markbook.operators.program_sync import sync_program_results
from markbook.plans import enrichment, weekly
from markbook.plans.summary import summary
from markbook.schemas import conform
from markbook.session import scratch_dir
from markbook.sources import reference_tables as ref

SECTION = "student_id string, section_id string, teacher_first string, teacher_last string, subject_area int, content_area int, seq int"


@pytest.fixture(scope="module")
def inputs(spark):
    frame = spark.createDataFrame
    return {
        "enrollment": frame(
            [
                ("s1", "S1", "6", 4, "North", "D", 1),
                ("s1", "S1", "7", 5, "", "D", 2),  # the last record wins; its school has no name
                ("s2", None, "x", 4, "North", "D", 3),
                ("s3", "S3", "1", 0, "North", "D", 4),  # site 0 is no site
            ],
            "district_student_id string, state_student_id string, grade_level_id string, site_id int, school string, district string, seq int",
        ),
        "sites": frame([(5, "Old", 1), (5, "South", 2), (0, "None", 3)], "site_id int, site_name string, seq int"),
        "users": frame([("u1", "Uma", "One", 1), ("u2", "Uri", "Two", 2)], "user_id string, first_name string, last_name string, seq int"),
        "roster": frame(
            [("s1", "u2", "3", "r1", 2), ("s1", "u1", "4", "r0", 1), ("s2", "u9", "3", "r2", 1)],
            "district_student_id string, user_id string, grade_level_id string, section_id string, seq int",
        ),
        "section_roster": frame(
            [
                ("s1", "late", "L", "L", 1, 28, 5),
                ("s1", "first", None, None, 1, 28, 4),  # first of its content area, without a teacher
                ("s1", "other", "O", "O", 1, 30, 1),
                ("s1", "wrong", "W", "W", 1, 99, 0),  # content area not in the map
                ("s1", "noarea", "N", "N", 1, None, 0),
                ("s1", "math", "M", "M", 2, 40, 1),
            ],
            SECTION,
        ),
        "subject_map": frame(
            [("English Language Arts", 1, 30), ("English Language Arts", 1, 28), ("Mathematics", 2, 40), ("Art", 1, 28)],
            "subject_area_name string, sa_code int, course_id_code int",
        ),
    }


@pytest.fixture(scope="module")
def profile(inputs):
    return enrichment.build_profile(**inputs)


RAW = "result_seq long, local_student_id string, last_name string, first_name string, assessment_id int, title string, date_taken string, standard_code string, standard_set string, standard_description string, points decimal(10,2), points_possible decimal(10,2)"


def raw_rows(spark):
    d = Decimal
    rows = [
        (1, "s1", "L", "F", 1, "Unit", "2024-09-01", "ELA.1", None, "d", d(1), d(32)),
        (2, "s1", "L", "F", 1, "Unit", "2024-09-01", "Math.1", None, "d", d(5), d(0)),
        (3, "s1", "L", "F", 2, "Science", "9/2/2024", None, "X", None, None, d(5)),
        (4, "s2", "L", "F", 2, "Unit", "bad", "", "X", None, d(5), d(5)),
        (5, "s3", "L", "F", 2, "Unit", "2024-09-01", "", "X", None, d(5), d(5)),
        (6, None, "L", "F", 2, "Unit", "2024-09-01", "", "X", None, d(5), d(5)),
        (7, "unknown", "L", "F", 2, "Unit", "2024-09-01", "", "X", None, d(5), d(5)),
    ]
    return spark.createDataFrame(rows, RAW)


def test_full_enrichment(spark, profile):
    got = enrichment.full_enrichment(raw_rows(spark), profile)
    assert got.schema.fieldNames() == schemas.LANDING.fieldNames()
    by = {(r.StudentID_LASID, r.StandardCodingNumber): r for r in got.collect()}
    assert set(by) == {("s1", "ELA.1"), ("s1", "Math.1"), ("s1", None), ("s2", "")}

    ela = by["s1", "ELA.1"]
    assert (ela.SchoolName, ela.SchoolID, ela.StudentGrade, ela.StudentID_SASID) == ("South", 5, "6", "S1")
    # A matched section keeps its missing teacher: the roster does not fill it.
    assert (ela.SectionID, ela.TeacherLastName) == ("first", None)
    assert (ela.Subject, ela.PercentCorrect, ela.AcademicYear) == ("ELA", "3.12%", "2024-2025")
    assert (by["s1", "Math.1"].SectionID, by["s1", "Math.1"].PercentCorrect) == ("math", None)

    science = by["s1", None]  # no section for science: first roster row
    assert (science.SectionID, science.TeacherLastName, science.Subject) == ("r0", "One", "Science")
    assert (science.AcademicYear, science.DateCompleted) == (None, dt.date(2024, 9, 2))

    other = by["s2", ""]  # enrolled grade unreadable: roster level; unknown teacher; no date
    assert (other.StudentGrade, other.SectionID, other.TeacherLastName, other.DateCompleted) == ("2", "r2", None, None)


def test_academic_year_override(spark, profile):
    got = enrichment.full_enrichment(raw_rows(spark), profile, "1999-2000")
    assert {r.AcademicYear for r in got.select("AcademicYear").collect()} == {"1999-2000"}


def test_full_enrichment_by_shuffle_is_the_same(spark, profile, rows, monkeypatch):
    want = rows(enrichment.full_enrichment(raw_rows(spark), profile))
    monkeypatch.setattr(
        enrichment, "lookup_join", lambda a, b, k, how: joins.scattered_join(a, b, k, how, hot_rows=2, limit=1)
    )
    assert rows(enrichment.full_enrichment(raw_rows(spark), profile)) == want


def test_section_choice_forms_agree(inputs, rows):
    choices = lookups.section_choices(inputs["section_roster"], enrichment.ref.subject_map(inputs["subject_map"]))
    assert rows(choices.select("subject_name", "section.section_id")) == [
        ("English Language Arts", "first"),
        ("Mathematics", "math"),
    ]


RESULT_KEYS = "StudentID_LASID string, TeacherFirstName string, TeacherLastName string, StudentGrade string"


def test_backfill_teacher_grade(spark, inputs, rows):
    results = spark.createDataFrame(
        [("s1", "A", None, "9"), ("s1", None, "B", "9"), ("s2", "A", "B", None), ("s9", None, None, None), (None, None, None, None)],
        RESULT_KEYS,
    )
    users = inputs["users"].drop("seq")
    got = lookups.backfill_teacher_grade(results, inputs["roster"], users)
    assert rows(got) == [
        (None, None, None, None),
        ("s1", "A", "One", "9"),
        ("s1", "Uma", "B", "9"),
        ("s2", "A", "B", "2"),
        ("s9", None, None, None),
    ]
    raw = lookups.backfill_teacher_grade(results, inputs["roster"], users, convert_grade=False)
    assert rows(raw.where("StudentID_LASID = 's2'"), "StudentGrade") == [("3",)]


def test_backfill_leaves_complete_students(spark, inputs, rows):
    results = spark.createDataFrame([("s1", None, "B", "9")], RESULT_KEYS)
    got = lookups.backfill_teacher_grade(results, inputs["roster"], inputs["users"].drop("seq"))
    assert rows(got) == [("s1", None, "B", "9")]


def test_backfill_section_teacher(spark, inputs, rows):
    results = spark.createDataFrame([("s1", "Math", "A", "A"), ("s1", "Art", "A", "A"), (None, "Math", "A", "A")], "StudentID_LASID string, Subject string, TeacherFirstName string, TeacherLastName string")
    got = lookups.backfill_section_teacher(results, inputs["section_roster"])
    assert rows(got, "StudentID_LASID", "Subject", "TeacherLastName", "SectionID") == [
        (None, "Math", "A", None),
        ("s1", "Art", "A", None),
        ("s1", "Math", "M", "math"),
    ]


def nested_rows(spark):
    standard = lambda **kw: {f.name: kw.get(f.name) for f in schemas.NESTED_STANDARD.fields}
    d = Decimal
    records = [
        dict(local_student_id="a", standards=[standard(standard_code="x", points_achieved=d(0), score=d(2), points_possible=d(4))], points_achieved=d(0), overall_score=d(5), total_score=d(7), max_score=d(10)),
        dict(local_student_id="b", standards=[], standard_results=[standard(code="y", score=d(1), max_score=d(8)), standard(code="z")], points_achieved=d(0), overall_score=d(0), date_completed="2024-07-01"),
        dict(local_student_id="c", points_achieved=d(3), test_date="2024-06-30"),
    ]
    names = schemas.NESTED_RESULT.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], schemas.NESTED_RESULT)


def test_explode_standards(spark, rows):
    got = nested.explode_standards(nested_rows(spark))
    assert rows(got, "StudentID_LASID", "StandardCodingNumber", "PointsAchieved", "PercentCorrect", "AcademicYear") == [
        ("a", "x", Decimal("2.00"), "50.00%", None),  # 0 points fall through to the score
        ("b", "y", Decimal("1.00"), "12.50%", "2024-2025"),
        ("b", "z", None, None, "2024-2025"),
    ]


def test_overall_from_nested(spark, rows):
    got = nested.overall_from_nested(nested_rows(spark))
    assert rows(got, "StudentID_LASID", "TotalPointsAchieved", "OverallPercentCorrect", "AcademicYear") == [
        ("a", Decimal("7.00"), "70.00%", None),
        ("c", Decimal("3.00"), None, "2023-2024"),
    ]


def test_summary_keeps_totals(spark, profile):
    results = enrichment.full_enrichment(raw_rows(spark), profile)
    got = summary(results)
    kept = results.where("AssessmentID IS NOT NULL AND StudentID_SASID IS NOT NULL")
    total = lambda df, c: df.agg(F.sum(c)).first()[0]
    assert total(got, "TotalPointsAchieved") == total(kept, "PointsAchieved")
    assert {r.Subject for r in got.collect()} == {"ELA", "Math", "Science"}


def test_sync_program_results_repeats_rows_without_key(spark):
    names = "StudentID_LASID string, AssignmentName string, DateCompleted date, StandardCodingNumber string, ProgramName string, Publisher string"
    results = spark.createDataFrame([("a", "n", dt.date(2024, 1, 1), "x", "HMH", None), ("a", "n", dt.date(2024, 1, 1), None, "HMH", None)], names)
    target = results.limit(0)
    once = sync_program_results(results, target)
    assert sync_program_results(results, once).count() == 3
    safe = sync_program_results(results, target, null_safe=True)
    assert sync_program_results(results, safe, null_safe=True).count() == 2


# Longer methods are interpreted by the JVM and not compiled, several times slower.
JIT_BYTES = 8000


def test_the_landing_rows_are_compiled(spark, profile):
    """In every form of the join the generated code stays under the size that the JVM compiles."""
    path = scratch_dir(spark)
    raw_rows(spark).write.parquet(path)
    raw = spark.read.parquet(path)
    student = [enrichment.STUDENT]
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        for joined in (joins.lookup_join(raw, profile, student, "inner"), joins.scattered_join(raw, profile, student, "inner"), raw.join(profile.hint("merge"), student)):
            rows = weekly.with_ids(enrichment._landing_rows(joined, None))
            stages = debug.codegenStringSeq(rows._jdf.queryExecution().executedPlan())
            assert 1000 < max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())) < JIT_BYTES
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_weekly_update_is_repeatable(spark, profile, rows):
    warehouse = weekly.Warehouse(spark, scratch_dir(spark))
    raw, as_of = raw_rows(spark), dt.date(2024, 9, 3)
    counts = rows(weekly.weekly_update(warehouse, raw, profile, as_of, 7, "2024-2025"))
    assert counts == [("assignments", 2), ("results", 3), ("standards", 2), ("summary", 3)]
    own = lambda n: rows(warehouse.read(n).drop("ResultID", "CreatedDate", "UpdatedDate"))
    tables = {n: own(n) for n in ("results", "assignments", "standards", "summary")}
    rejected = rows(warehouse.table(schemas.REJECTS))
    assert [(r[0], r[3]) for r in rejected] == [("undated", "bad")]
    assert rows(weekly.weekly_update(warehouse, raw, profile, as_of, 7, "2024-2025")) == counts
    assert {n: own(n) for n in tables} == tables and rows(warehouse.table(schemas.REJECTS)) == rejected
    fewer = raw.where("result_seq <> 1")
    weekly.weekly_update(warehouse, fewer, profile, as_of, 7, "2024-2025")
    assert warehouse.read("results").count() == 2


def test_summary_of_touched_years_equals_a_full_rebuild(spark, profile, rows):
    warehouse = weekly.Warehouse(spark, scratch_dir(spark))
    raw = raw_rows(spark)
    older = raw.withColumn("date_taken", F.lit("2023-05-05")).withColumn("assessment_id", F.lit(50))
    weekly.full_load(warehouse, raw.unionByName(older), profile)
    weekly.rebuild_summary(warehouse)
    weekly.weekly_update(warehouse, raw.where("result_seq <> 1"), profile, dt.date(2024, 9, 3), 7, "2024-2025")
    # The date that cannot be read has no place in a window, so its row stays from the full load.
    by_year = rows(warehouse.table(schemas.SUMMARY))
    weekly.rebuild_summary(warehouse)
    assert rows(warehouse.table(schemas.SUMMARY)) == by_year


def test_full_load_and_program_sync(spark, profile):
    warehouse = weekly.Warehouse(spark, scratch_dir(spark))
    raw = raw_rows(spark).withColumn("title", F.when(F.col("result_seq") == 1, "Into Math").otherwise(F.col("title")))
    weekly.full_load(warehouse, raw, profile)
    weekly.full_load(warehouse, raw, profile)
    assert warehouse.read("results").count() == 4
    weekly.update_lookups(warehouse)
    weekly.rebuild_summary(warehouse)
    status = weekly.sync_program(warehouse, null_safe=True).first()
    assert status.Status == "Sync completed" and status.results_count == 1
    assert weekly.sync_program(warehouse, null_safe=True).first() == status


def test_weekly_update_after_a_full_load_leaves_a_whole_summary(spark, profile, rows):
    warehouse = weekly.Warehouse(spark, scratch_dir(spark))
    raw = raw_rows(spark)
    older = raw.withColumn("date_taken", F.lit("2023-05-05")).withColumn("assessment_id", F.lit(50))
    weekly.full_load(warehouse, raw.unionByName(older), profile)
    weekly.weekly_update(warehouse, raw, profile, dt.date(2024, 9, 3), 7, "2024-2025")
    stored = rows(warehouse.table(schemas.SUMMARY))
    weekly.rebuild_summary(warehouse)
    assert rows(warehouse.table(schemas.SUMMARY)) == stored
    years = lambda df: {r[0] for r in df.select("AcademicYear").distinct().collect()}
    assert years(warehouse.table(schemas.SUMMARY)) == years(warehouse.read("results", schemas.LANDING).where("AssessmentID IS NOT NULL AND StudentID_SASID IS NOT NULL"))


def test_broken_table_raises_and_a_missing_one_is_empty(spark, tmp_path):
    warehouse = weekly.Warehouse(spark, str(tmp_path))
    assert warehouse.table(schemas.ASSIGNMENTS).count() == 0
    (tmp_path / "assignments").mkdir()
    with pytest.raises(AnalysisException):
        warehouse.table(schemas.ASSIGNMENTS)
    with pytest.raises(AnalysisException):
        quality.table_presence(spark, {"assignments": warehouse.path("assignments")}).collect()


def test_sync_finds_nothing_new_twice(spark, profile):
    warehouse = weekly.Warehouse(spark, scratch_dir(spark))
    raw = raw_rows(spark).withColumn("title", F.lit("Into Math")).withColumn("standard_code", F.lit(None).cast("string"))
    weekly.full_load(warehouse, raw, profile)
    weekly.rebuild_summary(warehouse)
    weekly.update_lookups(warehouse)
    status = weekly.sync_program(warehouse).first()
    assert weekly.sync_program(warehouse).first() == status


def test_reports_on_the_stored_fact(spark, profile):
    """The load gives ids and times, so what needs them runs on what is stored."""
    warehouse = weekly.Warehouse(spark, scratch_dir(spark))
    raw = raw_rows(spark)
    weekly.full_load(warehouse, raw.unionByName(raw), profile)
    weekly.window_load(warehouse, raw, profile, dt.date(2024, 8, 27), dt.date(2024, 9, 3))
    stored = warehouse.read("results")
    assert stored.select("ResultID").distinct().count() == stored.count()
    assert stored.where("CreatedDate IS NULL OR UpdatedDate IS NULL").count() == 0
    assert quality.delete_duplicates(stored).count() < stored.count()
    reports.top_null_school(stored).collect()
    for report in (reports.top50_grade_names, reports.random_sample_per_grade):
        report(stored, dt.date(2024, 1, 1)).collect()


def test_points_are_not_rounded_before_the_percent(spark, profile):
    raw = raw_rows(spark).withColumns({"points": F.lit("12.345"), "points_possible": F.lit("16")})
    got = enrichment.full_enrichment(raw, profile).select("PointsAchieved", "PercentCorrect").distinct().collect()
    assert [tuple(r) for r in got] == [(Decimal("12.35"), "77.16%")]
    bad = enrichment.full_enrichment(raw.withColumn("points", F.lit("n/a")), profile)
    assert bad.where("PointsAchieved IS NULL AND PercentCorrect IS NULL").count() == bad.count() > 0


def test_lookup_without_arrival_keeps_keys_unique(spark):
    listed = spark.createDataFrame([(7, "a"), (7, "b"), (8, "c"), (0, "d")], "site_id int, site_name string")
    assert sorted(map(tuple, ref.sites(listed, "seq").collect())) == [(7, "b"), (8, "c")]


def test_conform(spark):
    got = conform(spark.range(1).withColumn("AssessmentID", F.lit("7")), schemas.LANDING)
    assert got.schema.fieldNames() == schemas.LANDING.fieldNames()
    assert got.first().AssessmentID == 7
