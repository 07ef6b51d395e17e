"""Labels from ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ratings


def drop_neutral(df: DataFrame, rating: str = "star_rating") -> DataFrame:
    """Drop unrated and neutral reviews."""
    return df.filter(ratings.is_polar(F.col(rating)))


def label_reviews(df: DataFrame, rating: str = "star_rating") -> DataFrame:
    """Rated, non-neutral reviews with their 0/1 label."""
    return drop_neutral(df, rating).withColumn("label", ratings.binary_label(F.col(rating)))


def class_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def distribution_document(distribution: DataFrame, label: str = "label") -> DataFrame:
    """The class counts as one map; its size is the number of classes."""
    entries = F.collect_list(F.struct(F.col(label), F.col("n")))
    return distribution.agg(F.map_from_entries(F.array_sort(entries)).alias("original_class_distribution"))
