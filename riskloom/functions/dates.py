"""Dates in feeds and fiscal years."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Shapes of dates and how they are read. A text is parsed in the form of its shape only.
DATE_FORMATS = (
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{8}$", "yyyyMMdd"),
    (r"^\d{1,2}-[A-Za-z]{3}-\d{4}$", "d-MMM-yyyy"),
    (r"^\d{1,2}-[A-Za-z]{3}-\d{2}$", "d-MMM-yy"),
    (r"^[A-Za-z]{3} \d{1,2}, \d{4}$", "MMM d, yyyy"),
    (r"^[A-Za-z]{4,} \d{1,2}, \d{4}$", "MMMM d, yyyy"),
    (r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM yyyy"),
    (r"^\d{1,2} [A-Za-z]{4,} \d{4}$", "d MMMM yyyy"),
)
#: The form of slashed dates in a column that puts the day first.
DAY_FIRST = "d/M/yyyy"
ISO = r"^\d{4}(-\d{1,2}){0,2}([T ].*)?$"
CLOCK = r"[T ]\d{1,2}:\d{2}.*$"


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value evaluated once per row instead of once per test."""
    return F.element_at(F.transform(F.array(value), body), 1)


def to_date(
    value: Column, formats: tuple[tuple[str, str], ...] = DATE_FORMATS, day_first: bool = False
) -> Column:
    """Date of a text in ISO form or one of ``formats``, with or without a time; text that is no date becomes null.

    Years have four digits. ISO text goes through the zone-free timestamp so that the result does not depend on the
    session's time zone. ``day_first`` is how the column writes slashed dates, see :func:`puts_day_first`.
    """
    if day_first:
        formats = tuple((shape, DAY_FIRST if form == "M/d/yyyy" else form) for shape, form in formats)

    def by_shape(day: Column) -> Column:
        result = F.lit(None).cast("date")
        for shape, form in reversed(formats):
            result = F.when(day.rlike(shape), F.try_to_date(day, form)).otherwise(result)
        return result

    def parsed(text: Column) -> Column:
        iso = text.try_cast(T.TimestampNTZType()).cast("date")
        return F.when(text.rlike(ISO), iso).otherwise(_bound(F.regexp_replace(text, CLOCK, ""), by_shape))

    return _bound(F.trim(value.cast("string")), parsed)


def puts_day_first(df: DataFrame, value: Column) -> bool:
    """Whether the slashed dates of a column can only be read with the day first: one aggregate over the column.

    That is so if a first number is above 12 and no second number is.
    """
    text, above = F.trim(value.cast("string")), r"(1[3-9]|[2-9]\d)"
    first, second = df.agg(
        F.bool_or(text.rlike(rf"^{above}/\d{{1,2}}/\d{{4}}")), F.bool_or(text.rlike(rf"^\d{{1,2}}/{above}/\d{{4}}"))
    ).first()
    return bool(first) and not second


def fiscal_year(date: Column, first_month: int = 7) -> Column:
    """Year in which the fiscal year of a date ends, for fiscal years that begin in ``first_month``."""
    return (F.year(date) + (F.month(date) >= first_month).cast("int")).cast("int")
