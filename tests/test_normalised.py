import datetime as dt

from markbook import schemas
from markbook.operators import quality
from markbook.plans import normalised
from markbook.plans.weekly import Warehouse
from markbook.session import scratch_dir
from markbook.sources import pages

DETAIL = [
    '{"assessment_id": 1, "performance_band_sets": [{"bands": [{"name": "low", "min_score": 0, "max_score": 5}, {"name": "high"}]}],'
    ' "questions": [{"question_number": 1, "question_text": "a", "answer_choices": [{"letter": "A", "is_correct": true}, {"letter": "B"}],'
    ' "standards": [{"standard_id": 7, "code": "c7", "subject": "x"}, {"standard_id": 0}, {"code": "none"}]},'
    ' {"question_number": 2, "question_text": "b", "standards": [{"standard_id": 7, "code": "other", "subject": "y"}]},'
    ' {"question_text": "no number", "answer_choices": [{"letter": "Z"}]}]}',
    '{"assessment_id": 2, "questions": [{"question_number": 1, "question_text": "c"}, {"question_number": 1, "question_text": "d"}]}',
    '{"assessment_id": 3}',
]


def documents(spark, lines):
    path = scratch_dir(spark)
    spark.createDataFrame([(line,) for line in lines], "value string").write.text(path)
    return pages.assessment_detail(spark, path)


def test_load_details_twice(spark, rows):
    w = Warehouse(spark, scratch_dir(spark))
    normalised.load_details(w, documents(spark, DETAIL))
    read = lambda table, *columns: rows(w.read(table.name), *columns)

    assert read(schemas.QUESTIONS, "assessment_id", "question_number", "question_text") == [(1, 1, "a"), (1, 2, "b"), (2, 1, "d")]
    ids = {(r.assessment_id, r.question_number): r.question_id for r in w.read(schemas.QUESTIONS.name).collect()}
    assert sorted(ids.values()) == [1, 2, 3]
    assert read(schemas.BANDS, "assessment_id", "band_name") == [(1, "high"), (1, "low")]
    assert read(schemas.CHOICES, "question_id", "choice_letter", "is_correct") == [(ids[1, 1], "A", True), (ids[1, 1], "B", False)]
    # The first record of a standard gives its code, the last one the rest.
    assert read(schemas.LEGACY_STANDARDS, "standard_id", "standard_code", "subject") == [(7, "c7", "y")]
    links = read(schemas.QUESTION_STANDARDS)
    assert links == sorted([(ids[1, 1], 7), (ids[1, 2], 7)])

    changed = DETAIL[1].replace('"d"', '"e"').replace("}]}", '}, {"question_number": 5}]}')
    normalised.load_details(w, documents(spark, [DETAIL[0], changed]))
    again = {(r.assessment_id, r.question_number): r.question_id for r in w.read(schemas.QUESTIONS.name).collect()}
    assert again == {**ids, (2, 5): 4}
    assert read(schemas.QUESTIONS, "question_text")[-1] == ("e",)
    assert read(schemas.QUESTION_STANDARDS) == links

    orphans = quality.orphans(
        w.read(schemas.CHOICES.name), "question_id", w.read(schemas.QUESTIONS.name), "question_id"
    )
    assert tuple(orphans.first()) == (0, 0)


def test_load_assessments_and_scores(spark, rows):
    w = Warehouse(spark, scratch_dir(spark))
    names = "assessment_id int, title string, seq int"
    normalised.load_assessments(w, spark.createDataFrame([(1, "a", 1), (1, "b", 2), (None, "x", 3)], names).selectExpr("*", "cast(null as boolean) AS deleted"))
    assert rows(w.read("assessments"), "assessment_id", "title", "deleted") == [(1, "b", False)]
    score = "student_id int, assessment_id int, test_date date, raw_score int, seq int"
    day = dt.date(2024, 1, 1)
    for value in (5, 6):
        normalised.load_scores(w, spark.createDataFrame([(1, 1, day, value, 1)], score))
    assert rows(w.read("student_scores"), "student_id", "raw_score") == [(1, 6)]
