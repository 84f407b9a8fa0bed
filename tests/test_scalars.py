import datetime as dt
from decimal import ROUND_HALF_EVEN, Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from markbook.functions import predicates as pred
from markbook.functions import scalars as s


def apply(spark, values, kind, *columns):
    df = spark.createDataFrame([(i, *v) for i, v in enumerate(values)], f"i int, {kind}")
    out = df.select("i", *[c.alias(f"c{n}") for n, c in enumerate(columns)]).orderBy("i").collect()
    return [r[1] if len(columns) == 1 else tuple(r)[1:] for r in out]


def one(spark, values, column, kind="x string"):
    return apply(spark, [(v,) for v in values], kind, column)


X = F.col


def test_academic_year(spark):
    texts = ["2024-07-01", "2024-06-30", "2024-7-1", "2024-06-30T23:00:00", "7/1/2024", "", None, "2024-13-01"]
    texts += ["2024-07-1 08:00", "2024-07-1T08", "2024-07", "02024-07-01", " 2024-07-01", "2024-07-01x"]
    want = ["2024-2025", "2023-2024", "2024-2025", "2023-2024", None, None, None, None]
    want += [None, None, None, None, None, "2024-2025"]
    assert one(spark, texts, s.academic_year(X("x"))) == want
    assert one(spark, texts[:2], s.academic_year(X("x"), "2000-2001")) == ["2000-2001"] * 2


def test_academic_year_asof(spark):
    year = lambda d: s.academic_year_asof(d)
    assert one(spark, ["a"], year(dt.date(2025, 7, 1))) == ["2025-2026"]
    assert one(spark, ["a"], year(dt.date(2025, 6, 30))) == ["2024-2025"]


def test_grade_from_level_id(spark):
    texts = ["1", "2", "13", "0", "-3", "6.0", "", "x", None, " 6 "]
    assert one(spark, texts, s.grade_from_level_id(X("x"))) == ["K", "1", "12", None, None, None, None, None, None, "5"]


def test_parse_date(spark):
    d = dt.date(2024, 1, 5)
    texts = {
        "2024-01-05": d,
        "1/5/2024": d,
        "2024-01-05T08:30:00": d,
        "2024-01-05T08:30:00.123Z": d,
        "2024-01-05 08:30:00": d,
        "2024-01-05 99:99:99": d,  # the first ten characters are still a date
        "2024-1-5": d,
        "2024-1-5T8:3:0": d,
        "2024-1-5 8:3:0": d,
        "2024-01-05/x": d,
        "01/05/2024": d,
        "1/5/2024 08:30": None,
        "2024-13-45": None,
        "yesterday": None,
        "": None,
        None: None,
    }
    got = apply(spark, [(t,) for t in texts], "x string", s.parse_date(X("x")), s.date_unparsed(X("x")))
    assert [g[0] for g in got] == list(texts.values())
    assert [t for t, g in zip(texts, got) if g[1]] == ["1/5/2024 08:30", "2024-13-45", "yesterday"]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.dates(dt.date(1950, 1, 1), dt.date(2099, 12, 31)), min_size=1, max_size=20))
def test_date_rules_agree_with_python(spark, days):
    texts = [(d.isoformat(), f"{d.month}/{d.day}/{d.year}", f"{d.isoformat()}T01:02:03") for d in days]
    got = apply(
        spark,
        texts,
        "a string, b string, c string",
        *[s.parse_date(X(c)) for c in "abc"],
        s.academic_year(X("a")),
    )
    for d, row in zip(days, got):
        first = d.year if d.month >= 7 else d.year - 1
        assert row == (d, d, d, f"{first}-{first + 1}")


def test_safe_decimal(spark):
    got = one(spark, ["1.5", "", "abc", None, "12.345", "-3"], s.safe_decimal(X("x")))
    assert got == [Decimal("1.50"), None, None, None, Decimal("12.35"), Decimal("-3.00")]


def python_percent(a, p):
    if a is None or p is None or p == 0:
        return None
    return f"{(a / p * 100).quantize(Decimal('0.01'), ROUND_HALF_EVEN)}%"


points = st.one_of(st.none(), st.decimals(0, 9999, places=2))


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(points, points), min_size=1, max_size=50))
def test_percent_text_agrees_with_python(spark, pairs):
    got = apply(spark, pairs, "a decimal(10,2), p decimal(10,2)", s.percent_text(X("a"), X("p")))
    assert got == [python_percent(a, p) for a, p in pairs]


def test_percent_text_rounds_halves_to_even_and_keeps_raw_places(spark):
    pairs = [(Decimal("1"), Decimal("32")), (Decimal("3"), Decimal("32")), (Decimal("0.125"), Decimal("10"))]
    got = apply(spark, pairs, "a decimal(20,6), p decimal(20,6)", s.percent_text(X("a"), X("p")))
    assert got == ["3.12%", "9.38%", "1.25%"]


def test_overall_percent_text(spark):
    pairs = [(Decimal("1"), Decimal("3")), (Decimal("5"), Decimal("0")), (None, Decimal("5")), (Decimal("2000"), Decimal("1"))]
    got = apply(spark, pairs, "a decimal(20,2), p decimal(20,2)", s.overall_percent_text(X("a"), X("p")))
    assert got == ["33.333333%", None, None, "200000.000000%"]


@pytest.mark.parametrize(
    "code, subject, standard_set",
    [
        ("ELA-Literacy.RL.3", "ELA", "Michigan State Standards"),
        ("ELA.1", "ELA", "given"),
        ("MI.ELA.K", "ELA", "given"),
        ("CCSS.ELA-Literacy", "ELA", "Common Core State Standards"),
        ("Math.Content.G", "Math", "Michigan State Standards"),
        ("CCSS.Math.Content", "Math", "Common Core State Standards"),
        ("CCSS.ELAB", "ELA", "Common Core State Standards"),
        ("ela-1", None, "given"),
        ("HS-LS1", None, "given"),
        ("", None, None),
        (None, None, None),
    ],
)
def test_code_rules(spark, code, subject, standard_set):
    got = apply(
        spark, [(code,)], "x string", s.subject_from_code(X("x")), s.infer_standard_set(X("x"), F.lit("given"))
    )
    assert got == [(subject, standard_set)]


def test_subject_from_title_keeps_substring_quirks(spark):
    titles = {
        "Discipline Survey": "Science",
        "SS Unit": "Social Studies",
        "ssunit": "Social Studies",
        "Class history": "Social Studies",
        "Relay race": "ELA",
        "READING": "ELA",
        "Unit math": "Math",
        "Unit": None,
        None: None,
    }
    assert one(spark, list(titles), s.subject_from_title(X("x"))) == list(titles.values())


def test_subject_precedence(spark):
    rows = [("Given", "ELA.1"), (None, "ELA.1"), ("Given", "X"), (None, None)]
    got = apply(
        spark,
        rows,
        "subject string, code string",
        s.subject_or_code(X("subject"), X("code")),
        s.subject_code_first(X("code"), X("subject")),
        s.subject_code_first(X("code")),
    )
    assert got == [("Given", "ELA", "ELA"), ("ELA", "ELA", "ELA"), ("Given", "Given", None), (None, None, None)]


def test_subject_from_assignment_overrides(spark):
    rows = [("Unit Math ELA", "Art"), ("Velar", "Art"), ("English", None), ("Social", "Art"), ("social", "Art"), (None, "Art")]
    got = apply(spark, rows, "n string, s string", s.subject_from_assignment(X("n"), X("s")))
    assert got == ["Mathematics", "English Language Arts", "English Language Arts", "Social Studies", "Art", "Art"]


def test_first_truthy(spark):
    texts = [("", "b", "c"), (None, "", "c"), (None, None, ""), ("a", "b", "c")]
    assert apply(spark, texts, "a string, b string, c string", s.first_text(X("a"), X("b"), X("c"))) == ["b", "c", "", "a"]
    numbers = [(0, 5), (None, 0), (3, 5), (0, None)]
    assert apply(spark, numbers, "a int, b int", s.first_number(X("a"), X("b"))) == [5, 0, 3, None]


def test_keys_and_texts(spark):
    got = apply(
        spark,
        [("a", None), ("a", "b")],
        "x string, y string",
        s.null_safe_key(X("x"), X("y")),
        s.null_propagating_key(X("x"), X("y")),
        s.person_name(X("x"), X("y")),
    )
    assert got == [("a|", None, None), ("a|b", "a|b", "a, b")]
    long = "x" * 50
    assert one(spark, [long, "ab", None], s.truncate_long_text(X("x"))) == [long + "...", "ab", None]
    assert one(spark, ["ab"], s.truncate_text(X("x"))) == ["ab..."]
    assert one(spark, ["12abc", "3x", "123", "x", None], s.leading_grade(X("x"))) == ["12", "3", "12", None, None]


def test_program_filters(spark):
    program = pred.program_any_field(X("a"), X("b"))
    got = apply(spark, [("x", "My HMH unit"), ("Harcourt", None), (None, None), ("x", "y")], "a string, b string", program)
    assert got == [True, True, False, False]
    assert one(spark, ["Into Math", None, "nwea"], pred.program_name_only(X("x"))) == [True, False, False]


def test_has_overall(spark):
    rows = [(0, 0), (None, None), (0, 3), (5, None)]
    got = apply(spark, rows, "a int, b int", pred.has_overall(X("a"), X("b")))
    assert got == [False, False, True, True]
