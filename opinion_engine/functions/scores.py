"""Score expressions for two-class (or wider) classifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The class names, by class number.
CLASS_NAMES = {0: "negative", 1: "positive"}
UNKNOWN = "unknown"
# Keeps a logarithm finite for a probability of zero.
SMALLEST_PROBABILITY = 1e-15


def softmax(logits: Column) -> Column:
    """Probabilities of an array of logits, stable for large values."""
    shifted = F.transform(logits, lambda v: F.exp(v - F.array_max(logits)))
    return F.transform(shifted, lambda e: e / F.aggregate(shifted, F.lit(0.0), lambda acc, v: acc + v))


def argmax(values: Column) -> Column:
    """Position of the largest value from zero; the first of equals."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def name_label(label: Column, names: dict[int, str] | None = None, default: str = UNKNOWN) -> Column:
    """The class name of a class number, ``default`` where there is none."""
    pairs = [F.lit(x) for pair in (names or CLASS_NAMES).items() for x in pair]
    return F.coalesce(F.create_map(*pairs)[label], F.lit(default))


def cross_entropy(label: Column, positive_score: Column) -> Column:
    """Loss of one row: minus the logarithm of the probability given to its true class."""
    p = F.when(label == 1, positive_score).otherwise(1 - positive_score)
    return -F.ln(F.greatest(p, F.lit(SMALLEST_PROBABILITY)))


def ratio(numerator: Column, denominator: Column) -> Column:
    """A quotient that is zero where the denominator is zero."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))
