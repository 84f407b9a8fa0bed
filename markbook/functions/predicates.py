"""Row predicates as Columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed


def contains_any(field: Column, terms: Iterable[str]) -> Column:
    """True where the lower-cased field holds any of the terms; a missing field holds none."""
    lower = F.lower(field)
    return F.coalesce(reduce(or_, [F.contains(lower, F.lit(t)) for t in terms]), F.lit(False))


def program_view(program: Column, publisher: Column, name: Column) -> Column:
    """The default program filter over program, publisher and assignment name."""
    return (
        contains_any(program, fixed.PROGRAM_TERMS)
        | contains_any(publisher, fixed.PUBLISHER_TERMS)
        | contains_any(name, fixed.PROGRAM_TERMS)
    )


def program_name_only(program: Column) -> Column:
    return contains_any(program, fixed.PROGRAM_TERMS)


def program_any_field(*fields: Column) -> Column:
    return reduce(or_, [contains_any(f, fixed.ANY_FIELD_TERMS) for f in fields])


def program_keyword(keywords: Iterable[str], *fields: Column) -> Column:
    """The same kind of filter for any program."""
    terms = [k.lower() for k in keywords]
    return reduce(or_, [contains_any(f, terms) for f in fields])


def valid_standard(code: Column, allow_overall: bool = True) -> Column:
    ok = code.isNotNull() & (code != "")
    return ok if allow_overall else ok & (code != fixed.OVERALL_CODE)


def between_dates(date: Column, start: dt.date | None = None, end: dt.date | None = None) -> Column:
    keep = F.lit(True)
    if start is not None:
        keep = keep & (date >= F.lit(start))
    if end is not None:
        keep = keep & (date <= F.lit(end))
    return keep


def recent_days(date: Column, as_of: dt.date, days: int) -> Column:
    return date >= F.lit(as_of - dt.timedelta(days=days))


def starts_with_digit(name: Column) -> Column:
    return F.rlike(name, F.lit("^[0-9]"))


def teacher_like(last_name: Column, part: str) -> Column:
    return F.contains(last_name, F.lit(part))


def needs_enrichment(student: Column, teacher_last: Column, grade: Column) -> Column:
    return student.isNotNull() & (teacher_last.isNull() | grade.isNull())


def has_overall(overall_score: Column, points_achieved: Column) -> Column:
    """True where a whole-assessment score is present; a score of 0 counts as absent."""
    present = lambda c: F.coalesce(c != 0, F.lit(False))
    return present(overall_score) | present(points_achieved)
