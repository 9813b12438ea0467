"""Dates, months and quarter labels as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cumulative quarter labels and the quarter they end in.
QUARTER_LABELS = (
    ("第1季度", 1),
    ("第1-1季度", 1),
    ("第1-2季度", 2),
    ("第1-3季度", 3),
    ("第1-4季度", 4),
)


# The date forms that are read, each over the whole text: year, month and day apart by one of - / .
# or eight digits, then a time of day or nothing.
_TIME = r"(?:[ T][0-9]{1,2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]+)?)?(?:Z|[+-][0-9]{2}:?[0-9]{2})?)?"
_FORM = rf"^\s*([0-9]{{4}})(?:([-/.])([0-9]{{1,2}})\2([0-9]{{1,2}})|([0-9]{{2}})([0-9]{{2}})){_TIME}\s*\z"
_EIGHT = r"^[0-9]{8}\z"


def parse_date(text: Column) -> Column:
    """Date from text, null when it cannot be read.

    Eight digits, and ten characters with dashes in their places, are read by position; only other text is tried
    against the forms. ``try_cast`` reports unreadable text without raising, so rows of it cost no more than
    good ones.
    """
    bare = F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))
    # the cast reads a space or T as the end of the date, so the last character has to be a digit
    dashed = (
        (F.length(text) == 10) & (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
        & F.substring(text, 10, 1).between("0", "9")
    )
    return (
        F.when(dashed, text.try_cast("date"))
        .when(text.rlike(_EIGHT), bare.try_cast("date"))
        .otherwise(_date_of_form(text))
    )


def _date_of_form(text: Column) -> Column:
    """Date from text in any of the forms."""
    return F.when(text.rlike(_FORM), F.regexp_replace(text, _FORM, "$1-$3$5-$4$6").try_cast("date"))


def parse_compact_date(text: Column) -> Column:
    """Date from eight bare digits, null for any other text."""
    return F.when(text.rlike("^[0-9]{8}$"), parse_date(text))


def month_text_to_date(text: Column) -> Column:
    """``2024.1`` or ``2024.10`` to the first day of that month."""
    dashed = F.concat(F.replace(text, F.lit("."), F.lit("-")), F.lit("-01"))
    return F.when(text.rlike(r"^[0-9]{4}[.-][0-9]{1,2}$"), dashed.try_cast("date"))


def date_text(day: Column, compact: bool = False) -> Column:
    """``YYYY-MM-DD``, or ``YYYYMMDD`` when compact."""
    dashed = day.cast("date").cast("string")
    return F.replace(dashed, F.lit("-"), F.lit("")) if compact else dashed


def day_year(day: Column) -> Column:
    """Year of a date or timestamp; text goes through ``parse_date`` first."""
    return F.year(day)


def day_quarter(day: Column) -> Column:
    """Quarter of a date or timestamp; text goes through ``parse_date`` first."""
    return F.quarter(day)


def label_year(label: Column) -> Column:
    """Year text at the head of a quarter label."""
    return F.substring(label, 1, 4)


def label_quarter(label: Column) -> Column:
    """Quarter number a cumulative label ends in, null for an unknown label."""
    branches = F.when(label.isNull(), None)
    for text, number in QUARTER_LABELS:
        branches = branches.when(label.contains(text), number)
    return branches


def quarter_end(year: Column, quarter: Column) -> Column:
    """Last day of a quarter."""
    return F.last_day(F.make_date(year.try_cast("int"), quarter.cast("int") * 3, F.lit(1)))
