"""Column contracts of review tables, row filters, and removal of copies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ratings, text
from ..schema import RAW_REVIEW_COLUMNS


def project_reviews(df: DataFrame) -> DataFrame:
    """Keep the review columns, and the row id if there is one."""
    ids = [c for c in ("review_id",) if c in df.columns]
    return df.select(*ids, *RAW_REVIEW_COLUMNS)


def normalize_ratings(df: DataFrame, column: str = "star_rating") -> DataFrame:
    return df.withColumn(column, ratings.normalize_rating(F.col(column)))


def normalize_texts(df: DataFrame, columns: Sequence[str] = ("review_body", "review_headline")) -> DataFrame:
    return df.withColumns({c: text.normalize_text(F.col(c)) for c in columns})


def drop_empty(df: DataFrame, column: str = "review_body") -> DataFrame:
    """Drop null and empty texts; a text of spaces stays. Reaches the Parquet scan."""
    return df.filter(F.col(column).isNotNull() & (F.col(column) != ""))


def drop_blank(df: DataFrame, column: str = "review_clean") -> DataFrame:
    return df.filter(text.text_length(F.col(column)) > 0)


def drop_digits_only(df: DataFrame, column: str = "review_clean") -> DataFrame:
    return df.filter(~text.is_digits_only(F.col(column)))


def require_text(df: DataFrame, columns: Sequence[str] = ("review_body", "review_headline")) -> DataFrame:
    return df.na.drop(subset=list(columns))


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop rows that miss any value."""
    return df.na.drop("any")


def to_training_frame(df: DataFrame) -> DataFrame:
    """The names that a classifier expects: ``text`` and ``label``."""
    return df.withColumnsRenamed({"review_body": "text"})


def dedup_text(df: DataFrame, column: str = "review_body", row_id: str = "review_id") -> DataFrame:
    """One row per text: the one with the lowest id, or one without an id where no row of the text has one.

    Digests and ids alone tell which rows stay: how many rows each pair of both has, and the lowest id of each digest.
    Rows are picked by digest and id, null-safe, so an id that several texts share loses none of them. Texts
    move once and are never sorted, and columns that are not used later are not read. Only a text whose lowest id
    itself comes more than once needs a choice among its rows; where there is none, that branch is empty at run time.
    Counts are combined in each task and by digest and id first, so a text that makes up a third of the table is
    never gathered in one task.
    """
    rows = df.withColumn("_digest", text.text_digest(F.col(column)))
    counted = rows.groupBy("_digest", row_id).agg(F.count(F.lit(1)).alias("_n"))
    missing = F.max(F.when(F.col(row_id).isNull(), F.col("_n")))
    kept = counted.groupBy(F.col("_digest").alias("_kept_digest")).agg(
        F.min(row_id).alias("_kept_id"), F.coalesce(F.min_by("_n", row_id), missing).alias("_n"))

    def picked(which: Column) -> DataFrame:
        same = F.col("_digest").eqNullSafe(F.col("_kept_digest")) & F.col(row_id).eqNullSafe(F.col("_kept_id"))
        return rows.join(kept.filter(which).hint("shuffle_hash"), same, "left_semi")

    one = Window.partitionBy("_digest").orderBy(F.lit(1))
    chosen = picked(F.col("_n") > 1).withColumn("_row", F.row_number().over(one)).filter("_row = 1").drop("_row")
    return picked(F.col("_n") == 1).unionByName(chosen).select(df.columns)


def dedup_key(df: DataFrame, key: str, row_id: str) -> DataFrame:
    """One row per key value: the one with the lowest id, which must be unique.

    Meant for narrow columns of fixed width, which a hash aggregate carries. Each is an aggregate of its own, so
    columns that are not used later are pruned and never shuffled.
    """
    columns = [F.min_by(c, row_id).alias(c) for c in df.columns if c != key]
    return df.groupBy(key).agg(*columns)
