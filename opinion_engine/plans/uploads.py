"""From an uploaded review file to scored reviews and dashboard tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import quality, reviews, scoring, serving
from ..operators.model import TokenModel
from ..sources import readers, writers


def clean_upload(df: DataFrame) -> DataFrame:
    """Cleaned, non-blank, non-numeric reviews with a short flag; works on a stream as well.

    Every upload column stays. The review text is trimmed, ``review_clean`` is its lower case.
    """
    name = readers.resolve_text_column(df)
    return (df.withColumn(name, F.trim(name))
            .withColumn("review_clean", F.lower(name))
            .transform(reviews.drop_blank)
            .transform(reviews.drop_digits_only)
            .transform(quality.flag_short))


def _drop_reasons(clean: Column) -> dict[str, Column]:
    return {"dropped_null_or_empty": clean.isNull() | (clean == ""),
            "dropped_numeric_only": text.is_digits_only(clean)}


def clean_summary(df: DataFrame) -> DataFrame:
    """The cleaning document, from one pass over the raw upload."""
    clean = F.col("_clean")
    raw = df.select(text.clean_review(F.col(readers.resolve_text_column(df))).alias("_clean"))
    audit = quality.drop_audit(raw, _drop_reasons(clean), short_reviews_flagged=text.is_short(clean))
    return audit.withColumnRenamed("retained_rows", "retained_clean_reviews")


def score_upload(df: DataFrame, model: TokenModel) -> DataFrame:
    """Predictions on the same rows, with all upload columns kept."""
    return scoring.score_rows(df, model, "review_clean")


def run(spark: SparkSession, csv_path: str, user: str, model: TokenModel, out: str) -> dict[str, DataFrame]:
    """Clean, score and summarise one upload; store rows and documents; return the dashboard tables."""
    upload = readers.with_row_id(readers.read_reviews_csv(spark, csv_path), "upload_id")
    upload = upload.withColumn("user_name", F.lit(user))
    writers.write_metrics(clean_summary(upload), f"{out}/metadata/{user}/preprocessing_summary")
    writers.write_scored(score_upload(clean_upload(upload), model), f"{out}/served")

    served = readers.read_user_partition(spark, f"{out}/served", user)
    tables = serving.dashboard_tables(served)
    writers.write_metrics(tables["summary"], f"{out}/metadata/{user}/inference_summary")
    return tables
