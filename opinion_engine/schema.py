"""Column contracts of the stage tables and of the JSON documents."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_REVIEW_COLUMNS = ["product_category", "star_rating", "review_body", "review_headline"]

RAW_REVIEWS = T.StructType([T.StructField(c, T.StringType()) for c in RAW_REVIEW_COLUMNS])

UPLOADS = T.StructType([
    T.StructField("upload_id", T.LongType()),
    T.StructField("user_name", T.StringType()),
    T.StructField("review", T.StringType()),
])

TRAINING = T.StructType([
    T.StructField("review_body", T.StringType()),
    T.StructField("label", T.IntegerType()),
])

# Types of the columns that a scored table may have; a column not named here is text.
SCORED_TYPES = {
    "upload_id": "bigint",
    "review_id": "bigint",
    "short_review": "boolean",
    "label": "int",
    "prediction_label": "int",
    "positive_score": "double",
    "negative_score": "double",
}

PREPROCESS_AUDIT = T.StructType([
    T.StructField(c, T.LongType()) for c in ("original_rows", "dropped_empty", "dropped_duplicates", "retained_rows")
])

RATING_RANGE_AUDIT = T.StructType([
    T.StructField(c, T.LongType()) for c in ("n_rows", "below_zero", "above_five", "null_before")
])

AVERAGE_LENGTH = T.StructType([T.StructField("avg_review_length", T.DoubleType())])

CLASS_COUNTS = T.StructType([
    T.StructField("positive", T.LongType()),
    T.StructField("negative", T.LongType()),
])

CLASS_DISTRIBUTION = T.StructType([
    T.StructField("dropped_3_star_reviews", T.LongType()),
    T.StructField("dropped_unrated", T.LongType()),
    T.StructField("dropped_neutral", T.LongType()),
    # The keys are labels; a JSON key is a text.
    T.StructField("original_class_distribution", T.MapType(T.StringType(), T.LongType())),
    T.StructField("sampled_class_counts", CLASS_COUNTS),
    T.StructField("remaining_after_sampling", T.LongType()),
])

CLEANING_SUMMARY = T.StructType([
    T.StructField(c, T.LongType()) for c in (
        "original_rows", "dropped_null_or_empty", "dropped_numeric_only",
        "short_reviews_flagged", "retained_clean_reviews")
])

INFERENCE_SUMMARY = T.StructType(
    [T.StructField(c, T.LongType()) for c in (
        "total_reviews", "positive_reviews", "negative_reviews", "neutral_reviews")]
    + [T.StructField("average_review_length", T.DoubleType()),
       T.StructField("short_reviews_flagged", T.LongType()),
       T.StructField("top_positive_reviews", T.ArrayType(T.StringType())),
       T.StructField("top_negative_reviews", T.ArrayType(T.StringType()))]
)

EVALUATION_SUMMARY = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("model_name", T.StringType()),
    T.StructField("metrics", T.StructType([
        T.StructField(c, T.DoubleType()) for c in (
            "eval_loss", "eval_accuracy", "eval_precision", "eval_recall", "eval_f1")])),
    T.StructField("class_summary", T.StructType([
        T.StructField(c, T.LongType()) for c in (
            "actual_positive", "actual_negative", "predicted_positive", "predicted_negative")])),
    T.StructField("sample_reviews", T.StructType([
        T.StructField(c, T.ArrayType(T.StringType())) for c in (
            "top_predicted_positive", "top_predicted_negative")])),
])
