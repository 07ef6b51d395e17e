"""Star-rating expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The rating scale and its neutral point.
LOWEST, NEUTRAL, HIGHEST = 1, 3, 5


def parse_rating(rating: Column) -> Column:
    """A float, or null where the text is no number."""
    return rating.try_cast("float")


def normalize_rating(rating: Column) -> Column:
    """Clamp a rating text into 1..5 and truncate it to an int; null where it is no number.

    NaN sorts above every number, so it becomes 5.
    """
    value = parse_rating(rating)
    clamped = F.least(F.greatest(value, F.lit(float(LOWEST))), F.lit(float(HIGHEST)))
    return F.when(value.isNotNull(), clamped.cast("int"))


def as_int(rating: Column) -> Column:
    return rating.try_cast("int")


def repair_rating(rating: Column) -> Column:
    """Null below zero, at most 5, else unchanged; always double."""
    value = rating.try_cast("double")
    return F.when(value >= 0, F.least(value, F.lit(float(HIGHEST))))


def is_polar(rating: Column) -> Column:
    """Rated and not neutral; never null."""
    return rating.isNotNull() & (rating != NEUTRAL)


def binary_label(rating: Column) -> Column:
    """1 above the neutral point, else 0."""
    return F.when(rating > NEUTRAL, 1).otherwise(0)
