"""Audits and flags. Every audit is one aggregate over its unfiltered input."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import ratings, text

# The bounds of an ordinary review length.
SHORTEST = 10
TIMES_AVERAGE = 1.5


def drop_audit(df: DataFrame, reasons: Mapping[str, Column], **extra: Column) -> DataFrame:
    """Count the rows that an ordered chain of filters drops, in one pass.

    ``reasons`` maps a name to the condition that drops a row. A row counts for the first
    reason that holds. ``extra`` are conditions counted among the rows that remain.
    """
    kept = F.lit(True)
    counts = [F.count(F.lit(1)).alias("original_rows")]
    for name, dropped in reasons.items():
        hit = F.coalesce(dropped, F.lit(False))
        counts.append(F.count_if(kept & hit).alias(name))
        kept = kept & ~hit
    counts += [F.count_if(kept & flag).alias(name) for name, flag in extra.items()]
    return df.agg(*counts, F.count_if(kept).alias("retained_rows"))


def observed(df: DataFrame, counts: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """The frame with aggregates that its write yields; read them from the observation once it is written.

    Only for a frame whose last stage holds the counted rows: a task of the last stage counts once, whatever runs
    again, while tasks before a shuffle count again when their output is lost.
    """
    seen = Observation()
    return df.observe(seen, *[c.alias(name) for name, c in counts.items()]), seen


def preprocess_audit(df: DataFrame, column: str = "review_body") -> DataFrame:
    """Row counts before and after dropping empty texts and copies.

    The distinct count is combined in each task before digests move, as in ``dedup_text``.
    """
    raw = F.col(column)
    kept = raw.isNotNull() & (raw != "")
    digest = F.when(kept, text.text_digest(text.normalize_text(raw)))
    counts = df.select(kept.alias("kept"), digest.alias("digest")).agg(
        F.count(F.lit(1)).alias("original_rows"),
        F.count_if(F.col("kept")).alias("with_text"),
        F.count_distinct("digest").alias("retained_rows"),
    )
    return counts.select(
        "original_rows",
        (F.col("original_rows") - F.col("with_text")).alias("dropped_empty"),
        (F.col("with_text") - F.col("retained_rows")).alias("dropped_duplicates"),
        "retained_rows",
    )


def rating_range_audit(df: DataFrame, column: str = "star_rating") -> DataFrame:
    """Ratings out of range. Missing ratings and fives are not mixed into these counts."""
    return df.agg(*[c.alias(name) for name, c in range_counts(column).items()])


def range_counts(column: str = "star_rating") -> dict[str, Column]:
    value = ratings.parse_rating(F.col(column))
    return {"n_rows": F.count(F.lit(1)), "below_zero": F.count_if(value < 0),
            "above_five": F.count_if(value > ratings.HIGHEST), "null_before": F.count_if(value.isNull())}


def with_length(df: DataFrame, column: str = "review_body") -> DataFrame:
    return df.withColumn("review_length", text.text_length(F.col(column)))


def length_stats(df: DataFrame, column: str = "review_length") -> DataFrame:
    return df.agg(F.avg(column).alias("avg_review_length"))


def flag_anomalies(df: DataFrame, average: DataFrame | None = None) -> DataFrame:
    """Flag texts shorter than 10 characters or longer than one and a half times the average.

    The average is a scalar subquery: no trip through the driver or a file. It comes from a
    stored document if one is given, else from the frame. It is null for an empty table, and
    then no text counts as long.
    """
    length = F.col("review_length")
    mean = (length_stats(df) if average is None else average.select("avg_review_length")).scalar()
    odd = (length < SHORTEST) | (length > mean * TIMES_AVERAGE)
    return df.withColumn("anomaly_flag", F.coalesce(odd, F.lit(False)))


def repair_ratings(df: DataFrame, column: str = "star_rating") -> DataFrame:
    return df.withColumn(column, ratings.repair_rating(F.col(column)))


def flag_short(df: DataFrame, column: str = "review_clean") -> DataFrame:
    return df.withColumn("short_review", text.is_short(F.col(column)))
