"""Numeric column functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from riskloom.vocabulary import RISK_BINS


def round_half_even(value: Column, digits: int) -> Column:
    """Round the scaled double to the nearest even integer; ``+ 0.0`` turns a negative zero into zero."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale + F.lit(0.0)


def round_settled(value: Column, digits: int) -> Column:
    """Round a mean, share or slope half to even, after removing the noise of floating-point addition.

    Spark adds in the order in which tasks finish, so a value that lies midway between two results (``24.95``) comes
    out a hair above or below it by chance. Rounding to nine digits first makes the result reproducible.
    """
    return round_half_even(round_half_even(value, 9), digits)


#: Shape of a number. Text of any other shape is not cast at all, which spares an exception per row.
NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf(inity)?))\s*$"


def to_double(value: Column) -> Column:
    """Parse a number; text that is no number, and NaN, become null."""
    number = F.when(value.cast("string").rlike(NUMBER), value.try_cast("double"))
    return F.when(~F.isnan(number), number)


def to_int(value: Column) -> Column:
    return F.when(value.cast("string").rlike(NUMBER), value.try_cast("int"))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def mean_of_present(*values: Column) -> Column:
    """Mean over the non-null values of a row, null where all are null."""
    total = sum((F.coalesce(v, F.lit(0.0)) for v in values[1:]), F.coalesce(values[0], F.lit(0.0)))
    present = sum((v.isNotNull().cast("int") for v in values[1:]), values[0].isNotNull().cast("int"))
    return F.try_divide(total, present)


def percent_of(part: Column, whole: Column) -> Column:
    return F.try_divide(part, whole) * 100.0


def risk_bin(score: Column, bins=RISK_BINS) -> Column:
    """Label of the bin ``(low, high]`` the score falls in, null outside all bins."""
    label = F.lit(None).cast("string")
    for name, low, high in reversed(bins):
        label = F.when((score > low) & (score <= high), name).otherwise(label)
    return label


def risk_band(score: Column) -> Column:
    """Presentation band of a risk score; its limits are closed below, unlike those of ``risk_bin``."""
    return F.when(score >= 67, "high").when(score >= 34, "medium").otherwise("low")
