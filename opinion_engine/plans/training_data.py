"""From raw reviews to a labelled, balanced training set.

Each stage is a lazy function; ``run`` stores every stage, so that a stage is computed once
and a later one starts from a table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema
from ..functions import ratings, text
from ..operators import labels, quality, reviews, sampling
from ..sources import readers, writers
from .stages import Stage, run_stages


def ingest(df: DataFrame, row_id: str = "review_id") -> DataFrame:
    """Review columns, texts that are not empty, ratings in 1..5, and a split."""
    return (df.transform(reviews.project_reviews)
            .transform(reviews.drop_empty)
            .transform(reviews.normalize_ratings)
            .transform(sampling.hash_split, row_id))


def preprocess(df: DataFrame, drop_blank: bool = False) -> DataFrame:
    """Normalised texts without copies. A text of spaces becomes empty and stays, unless asked."""
    texts = df.transform(reviews.drop_empty).transform(reviews.normalize_texts)
    if drop_blank:
        texts = texts.transform(reviews.drop_blank, "review_body")
    return texts.transform(reviews.dedup_text)


def validate(df: DataFrame) -> DataFrame:
    """Rows with both texts, an int rating and the length of the body."""
    return (df.transform(reviews.require_text)
            .withColumn("star_rating", ratings.as_int(F.col("star_rating")))
            .transform(quality.with_length))


def flag(df: DataFrame, average: DataFrame | None = None) -> DataFrame:
    """Flag odd lengths and repair ratings; measures the texts where the frame has no lengths yet."""
    measured = df if "review_length" in df.columns else quality.with_length(df)
    return measured.transform(quality.flag_anomalies, average).transform(quality.repair_ratings)


def one_line(df: DataFrame, column: str = "review_body") -> DataFrame:
    return df.withColumn(column, text.strip_line_breaks(F.col(column)))


@dataclass(frozen=True)
class TrainingSet:
    labelled: DataFrame
    sample: DataFrame
    remaining: DataFrame


def build_training_set(
    df: DataFrame, cap: int = sampling.CLASS_CAP, exclude_anomalies: bool = False, seed: int = sampling.SEED
) -> TrainingSet:
    """Label, draw a balanced sample, and hold out every other text; bodies lose their line breaks.

    The input is read three times (ids and ratings, the sample, the rest): pass a stored stage.
    Rows are chosen by id, so only the chosen texts are rewritten for the sample.
    """
    kept = df.filter(~F.col("anomaly_flag")) if exclude_anomalies else df
    raw = labels.label_reviews(kept)
    labelled = one_line(raw)
    sample = one_line(sampling.balanced_sample(raw, cap=cap, seed=seed))
    return TrainingSet(labelled, sample,
                       sampling.holdout_remaining(labelled, sample))


def sampling_document(
    stage: DataFrame, labelled: DataFrame, sample: DataFrame, remaining: DataFrame
) -> DataFrame:
    """What was dropped, the class counts, the sample's size and what remains."""
    rating = F.col("star_rating")
    dropped = F.struct(
        F.count_if(~ratings.is_polar(rating)).alias("all"),
        F.count_if(rating.isNull()).alias("unrated"),
        F.count_if(rating == ratings.NEUTRAL).alias("neutral"))
    sizes = F.struct(F.count_if(F.col("label") == 1).alias("positive"),
                     F.count_if(F.col("label") == 0).alias("negative"))
    classes = labels.distribution_document(labels.class_distribution(labelled))
    rest = remaining.agg(F.count(F.lit(1)).alias("n"))
    return stage.agg(dropped.alias("d")).select(
        F.col("d.all").alias("dropped_3_star_reviews"),
        F.col("d.unrated").alias("dropped_unrated"),
        F.col("d.neutral").alias("dropped_neutral"),
        classes.scalar().alias("original_class_distribution"),
        sample.agg(sizes.alias("s")).scalar().alias("sampled_class_counts"),
        rest.scalar().alias("remaining_after_sampling"))


def store_ingested(raw: DataFrame, out: str) -> dict[str, int]:
    """Write the splits; how many raw rows there were, and how many of the training split have a text."""
    kept = F.col("review_body").isNotNull() & (F.col("review_body") != "")
    counted = raw.select("*", kept.alias("_kept"))
    counted, before = quality.observed(counted, {"original_rows": F.count(F.lit(1)), "with_text": F.count_if("_kept")})
    rows, after = quality.observed(ingest(counted.drop("_kept")), {"train_rows": F.count_if(F.col("split") == "train")})
    writers.write_split(rows, f"{out}/split")
    return {**before.get, **after.get}


def store_preprocessed(rows: DataFrame, n_rows: int, out: str, n_empty: int = 0) -> dict[str, int]:
    """Write the distinct normalised texts; the audit of the ``n_rows`` rows with a text and ``n_empty`` without."""
    clean, seen = quality.observed(preprocess(rows), {"retained_rows": F.count(F.lit(1))})
    writers.write_stage(clean, f"{out}/pre_processed")
    retained = seen.get["retained_rows"]
    return {"original_rows": n_rows + n_empty, "dropped_empty": n_empty, "dropped_duplicates": n_rows - retained,
            "retained_rows": retained}


def store_flagged(clean: DataFrame, out: str) -> dict[str, dict]:
    """Write the validated and the flagged rows; the documents of both and the counts of the ratings."""
    spark = clean.sparkSession
    valid, seen = quality.observed(validate(clean), {
        "avg_review_length": F.avg("review_length"), **quality.range_counts()})
    writers.write_stage(valid, f"{out}/schema_validated")
    found = seen.get
    average = writers.document(spark, found, schema.AVERAGE_LENGTH)
    rating = F.col("star_rating")
    flagged, rated = quality.observed(flag(readers.read_stage(spark, f"{out}/schema_validated"), average), {
        **_rating_counts(rating), **{f"label_{name}": F.count_if(ratings.is_polar(rating) & (ratings.binary_label(rating) == v))
                                     for name, v in (("positive", 1), ("negative", 0))}})
    writers.write_stage(flagged, f"{out}/anomaly_flagged")
    return {"average": found, "ranges": found, "ratings": rated.get}


def _rating_counts(rating: Column) -> dict[str, Column]:
    return {"dropped_3_star_reviews": F.count_if(~ratings.is_polar(rating)), "dropped_unrated": F.count_if(rating.isNull()),
            "dropped_neutral": F.count_if(rating == ratings.NEUTRAL)}


def store_training_set(flagged: DataFrame, out: str, cap: int = sampling.CLASS_CAP) -> dict:
    """Write the sample, its export and the remaining rows; the counts of both."""
    spark = flagged.sparkSession
    parts = build_training_set(flagged, cap)
    label = F.col("label")
    taken, sampled = quality.observed(parts.sample, {
        "positive": F.count_if(label == 1), "negative": F.count_if(label == 0)})
    writers.write_stage(taken, f"{out}/train_final")
    sample = readers.read_stage(spark, f"{out}/train_final")
    remaining, rest = quality.observed(sampling.holdout_remaining(parts.labelled, sample), {"rows": F.count(F.lit(1))})
    writers.write_stage(remaining, f"{out}/remaining")
    writers.export_csv(sampling.shuffle_rows(sample), f"{out}/sampled_csv", ["review_body", "label"])
    return {"sampled_class_counts": sampled.get, "remaining_after_sampling": rest.get["rows"]}


INGESTED = T.StructType([T.StructField(c, T.LongType()) for c in ("original_rows", "with_text", "train_rows")])
RATED = T.StructType([T.StructField(c, T.LongType()) for c in (
    "dropped_3_star_reviews", "dropped_unrated", "dropped_neutral", "label_positive", "label_negative")])


def _write(spark: SparkSession, out: str, name: str, values: dict, fields: T.StructType) -> None:
    writers.write_metrics(writers.document(spark, values, fields), f"{out}/documents/{name}")


def _read(spark: SparkSession, out: str, name: str, fields: T.StructType) -> dict:
    return readers.read_metrics_json(spark, f"{out}/documents/{name}", fields).first().asDict()


def job(spark: SparkSession, csv_path: str, out: str, cap: int = sampling.CLASS_CAP, multi_line: bool = True) -> list[Stage]:
    """The stages from review CSVs to the exported sample, the remaining rows and the documents under ``out``.

    The documents' counts come out of the writes: no stage is read again for them. A file that brings a
    ``review_id`` keeps it.
    """

    def ingested() -> None:
        raw = readers.with_id(readers.read_reviews_csv(spark, csv_path, multi_line))
        _write(spark, out, "ingested", store_ingested(raw, out), INGESTED)

    def preprocessed() -> None:
        train = readers.read_stage(spark, f"{out}/split").filter(F.col("split") == "train").drop("split")
        rows = _read(spark, out, "ingested", INGESTED)["train_rows"]
        _write(spark, out, "preprocess_audit", store_preprocessed(train, rows, out), schema.PREPROCESS_AUDIT)

    def flagged() -> None:
        found = store_flagged(readers.read_stage(spark, f"{out}/pre_processed"), out)
        _write(spark, out, "avg_review_length", found["average"], schema.AVERAGE_LENGTH)
        _write(spark, out, "rating_range_audit", found["ranges"], schema.RATING_RANGE_AUDIT)
        _write(spark, out, "ratings", found["ratings"], RATED)

    def sampled() -> None:
        taken = store_training_set(readers.read_stage(spark, f"{out}/anomaly_flagged"), out, cap)
        rated = _read(spark, out, "ratings", RATED)
        classes = {"1": rated["label_positive"], "0": rated["label_negative"]}
        values = {**rated, **taken, "original_class_distribution": {k: n for k, n in classes.items() if n}}
        _write(spark, out, "class_distribution", values, schema.CLASS_DISTRIBUTION)

    return [Stage("ingested", ingested), Stage("preprocessed", preprocessed, ("ingested",)),
            Stage("flagged", flagged, ("preprocessed",)), Stage("sampled", sampled, ("flagged",))]


def run(spark: SparkSession, csv_path: str, out: str, cap: int = sampling.CLASS_CAP, multi_line: bool = True,
        resume: bool = False) -> None:
    """Run all stages of ``job``; with ``resume`` those that an earlier run has not completed."""
    run_stages(spark, out, job(spark, csv_path, out, cap, multi_line), resume)
