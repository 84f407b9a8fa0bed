"""Scalar rules as ``Column -> Column`` functions.

ANSI mode is on by default in Spark 4, so every "bad text becomes missing" rule uses a ``try_`` function.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed

POINTS = "decimal(10,2)"
WIDE_POINTS = "decimal(20,6)"


def _blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _zero_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(0))


def _first_truthy(cols, empty) -> Column:
    *firsts, last = cols
    return F.coalesce(*[empty(c) for c in firsts], last)


def first_text(*cols: Column) -> Column:
    """First alternative that is neither NULL nor ''; the last one is returned whatever it holds."""
    return _first_truthy(cols, _blank_to_null)


def first_number(*cols: Column) -> Column:
    """First alternative that is neither NULL nor 0; the last one is returned whatever it holds."""
    return _first_truthy(cols, _zero_to_null)


def truthy_number(c: Column) -> Column:
    return F.coalesce(c != F.lit(0), F.lit(False))


def nonzero_id(c: Column) -> Column:
    """An id of 0 counts as no id."""
    return _zero_to_null(c)


# --- dates -----------------------------------------------------------------------------------------


def _school_year(date: Column) -> Column:
    start = F.year(date) - F.when(F.month(date) >= fixed.ACADEMIC_YEAR_FIRST_MONTH, 0).otherwise(1)
    return F.concat(start.cast("string"), F.lit("-"), (start + 1).cast("string"))


def _iso_date(date_text: Column) -> Column:
    """DATE from the first ten characters, if they are a year, month and day between hyphens.

    Two-digit months and days, by far the most rows, take the plain cast, which is several times faster
    than a pattern; the shape is tested first because the cast alone is more lenient.
    """
    head = F.substring(date_text, 1, 10)
    hyphen = lambda at: F.substring(date_text, at, 1) == "-"
    full = hyphen(5) & hyphen(8) & F.substring(date_text, 10, 1).between("0", "9")
    return F.when(full, head.try_cast("date")).when(hyphen(5), F.try_to_date(head, "yyyy-M-d"))


def academic_year(date_text: Column, override: str | None = None) -> Column:
    """``YYYY-YYYY`` of a text that starts with an ISO date, NULL for any other text."""
    if override:
        return F.lit(override)
    return _school_year(_iso_date(date_text))


def academic_year_asof(as_of: dt.date | Column) -> Column:
    """``YYYY-YYYY`` of a run date."""
    return _school_year(as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date"))


def parse_date(date_text: Column) -> Column:
    """DATE from ISO, m/d/Y, or ISO with a time after 'T' or a blank; only the first 19 characters count.

    A text that starts with a whole ISO date has that date, whatever follows it. The other branches are
    chosen by the separator, so a row pays for one parse and not for four failed ones.
    """
    head = F.substring(date_text, 1, 19)
    other = (
        F.when(F.contains(head, F.lit("/")), F.try_to_date(head, "M/d/yyyy"))
        .when(F.contains(head, F.lit("T")), F.to_date(F.try_to_timestamp(head, F.lit("yyyy-M-d'T'H:m:s"))))
        .when(F.contains(head, F.lit(" ")), F.to_date(F.try_to_timestamp(head, F.lit("yyyy-M-d H:m:s"))))
    )
    return F.coalesce(_iso_date(date_text), other)


def date_unparsed(date_text: Column) -> Column:
    """True where there is a date text but no date could be read from it."""
    return F.coalesce(_blank_to_null(date_text).isNotNull() & parse_date(date_text).isNull(), F.lit(False))


# --- grades and numbers ----------------------------------------------------------------------------


def grade_from_level_id(level_id: Column) -> Column:
    """Level 1 is 'K', level n is grade n-1; 0, negatives and non-integers are missing."""
    level = level_id.try_cast("int")
    return F.when(level == 1, F.lit("K")).when(level > 1, (level - 1).cast("string"))


def safe_decimal(c: Column) -> Column:
    return _blank_to_null(c.cast("string")).try_cast(POINTS)


def percent_text(achieved: Column, possible: Column) -> Column:
    """Percent with two places, halves rounded to even, e.g. '42.50%'."""
    a = achieved.try_cast(WIDE_POINTS)
    p = _zero_to_null(possible.try_cast(WIDE_POINTS))
    return F.concat(F.bround(a / p * 100, 2).cast("decimal(30,2)").cast("string"), F.lit("%"))


def ratio_pct(achieved: Column, possible: Column) -> Column:
    """Percent as DOUBLE, NULL where nothing was possible."""
    return achieved.cast("double") / _zero_to_null(possible) * 100


def overall_percent_text(sum_achieved: Column, sum_possible: Column) -> Column:
    """Percent of two totals with six places, e.g. '42.500000%'."""
    ratio = sum_achieved.cast("double") / F.when(sum_possible > 0, sum_possible.cast("double")) * 100
    return F.concat(F.call_function("format_number", ratio, F.lit("0.000000")), F.lit("%"))


# --- subjects and standards ------------------------------------------------------------------------


def _by_pattern(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The label of the first pattern that the text matches, NULL if none does."""
    labels = [F.when(text.like(pattern), label) for pattern, label in rules]
    return F.coalesce(*labels)


def subject_from_code(code: Column) -> Column:
    return _by_pattern(code, fixed.CODE_SUBJECTS)


def subject_from_title(title: Column) -> Column:
    return _by_pattern(F.lower(title), fixed.TITLE_SUBJECTS)


def subject_of_result(code: Column, title: Column) -> Column:
    return F.coalesce(subject_from_code(code), subject_from_title(title))


def _subject_from_code_prefix(code: Column) -> Column:
    return _by_pattern(code, fixed.CODE_PREFIX_SUBJECTS)


def subject_or_code(subject: Column, code: Column) -> Column:
    """The stored subject wins; the code fills the gap."""
    return F.coalesce(subject, _subject_from_code_prefix(code))


def subject_code_first(code: Column, subject: Column | None = None) -> Column:
    """The code wins; the stored subject, if any, fills the gap."""
    derived = _subject_from_code_prefix(code)
    return derived if subject is None else F.coalesce(derived, subject)


def subject_from_assignment(name: Column, subject: Column) -> Column:
    """Long subject name by words in the assignment name, even over a stored subject."""
    return F.coalesce(_by_pattern(name, fixed.ASSIGNMENT_SUBJECTS), subject)


def infer_standard_set(code: Column, given: Column) -> Column:
    return F.when(code.startswith("CCSS."), fixed.COMMON_CORE_SET).when(
        code.startswith("ELA-Literacy.") | code.startswith("Math.Content."), fixed.MICHIGAN_SET
    ).when(code != "", _blank_to_null(given))


def program_from_title(title: Column) -> Column:
    upper = F.upper(title)
    return F.when(F.contains(upper, F.lit("ELA")), "ELA").when(F.contains(upper, F.lit("MATH")), "Math")


def canonical_subject(label: Column) -> Column:
    """Result label -> subject name of the subject map, NULL for a label the map does not know."""
    chain = None
    for short, full in fixed.SUBJECT_LABELS.items():
        chain = F.when(label == short, full) if chain is None else chain.when(label == short, full)
    return chain


# --- texts and keys --------------------------------------------------------------------------------


def person_name(last: Column, first: Column) -> Column:
    """'Last, First', NULL if either is missing."""
    return F.concat(last, F.lit(", "), first)


def null_safe_key(*cols: Column) -> Column:
    """Parts joined by '|', a missing part counting as ''."""
    return F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])


def null_propagating_key(*cols: Column) -> Column:
    """Parts joined by '|', NULL if any part is missing."""
    parts = [cols[0].cast("string")]
    for c in cols[1:]:
        parts += [F.lit("|"), c.cast("string")]
    return F.concat(*parts)


def truncate_text(text: Column, width: int = 50) -> Column:
    """First characters and '...', always."""
    return F.concat(F.substring(text, 1, width), F.lit("..."))


def truncate_long_text(text: Column, width: int = 50) -> Column:
    """First characters, with '...' only when the text fills the width."""
    head = F.substring(text, 1, width)
    return F.when(F.length(head) >= width, F.concat(head, F.lit("..."))).otherwise(head)


def leading_grade(name: Column) -> Column:
    return _blank_to_null(F.regexp_extract(name, r"^(\d{1,2})", 1))


def school_name(enrolled_school: Column, site_name: Column) -> Column:
    return F.coalesce(_blank_to_null(enrolled_school), site_name)
