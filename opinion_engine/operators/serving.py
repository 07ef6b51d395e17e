"""What a dashboard shows: summary, distribution, histogram and top reviews."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from .ranking import first_rows, texts_in_order

TOP = 5
BINS = 30
NAMES = ("positive", "negative")
COUNTS = ("total_reviews", "positive_reviews", "negative_reviews", "neutral_reviews", "measured_reviews", "total_length",
          "short_reviews_flagged")
_TOP_COLUMNS = [f"top_{name}_reviews" for name in NAMES]


def sentiment_distribution(df: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Reviews per predicted class, most frequent first."""
    return (df.groupBy(prediction).agg(F.count(F.lit(1)).alias("n_reviews"))
            .orderBy(F.desc("n_reviews"), prediction))


def length_histogram(df: DataFrame, text: str = "review_clean", bins: int = BINS) -> DataFrame:
    """Equal-width bins of the text length, empty bins included; the last bin is closed.

    Texts are read once, into a count per distinct length; range and bins come from that.
    """
    lengths = (df.filter(F.col(text).isNotNull())
               .groupBy(tx.text_length(F.col(text)).alias("length"))
               .agg(F.count(F.lit(1)).alias("n")))
    half = F.when(F.min("length") == F.max("length"), 0.5).otherwise(0.0)
    # The total is not used. It keeps the counts in the subquery, which then reuses their exchange.
    span = lengths.agg(F.struct((F.min("length") - half).alias("low"),
                                (F.max("length") + half).alias("high"),
                                F.sum("n").alias("total"))).scalar()
    share = (F.col("length") - span["low"]) * float(bins) / (span["high"] - span["low"])
    filled = (lengths.select(F.least(F.floor(share).cast("int"), F.lit(bins - 1)).alias("bin"), "n")
              .groupBy("bin").agg(F.sum("n").alias("n")))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    width = (span["high"] - span["low"]) / float(bins)
    return (every.join(filled, "bin", "left")
            .select("bin",
                    (span["low"] + width * F.col("bin")).alias("from_length"),
                    (span["low"] + width * (F.col("bin") + 1)).alias("to_length"),
                    F.coalesce("n", F.lit(0)).alias("n_reviews")))


def summary_counts(df: DataFrame, by: Sequence[str] = (), text: str = "review_clean") -> DataFrame:
    """Counts that add up: of parts of a table, or of batches of a stream."""
    prediction = F.col("prediction")
    short = F.col("short_review") if "short_review" in df.columns else F.lit(False)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_reviews"),
        *[F.count_if(prediction == name).alias(f"{name}_reviews") for name in (*NAMES, "neutral")],
        F.count(text).alias("measured_reviews"),
        F.coalesce(F.sum(tx.text_length(F.col(text))), F.lit(0)).alias("total_length"),
        F.count_if(short).alias("short_reviews_flagged"))


def first_k(
    df: DataFrame, k: int = TOP, by: Sequence[str] = (), text: str = "review_clean", row_id: str = "upload_id"
) -> DataFrame:
    """The first ``k`` reviews of each predicted class in id order."""
    narrow = df.select(*by, "prediction", row_id, text).filter(F.col("prediction").isin(*NAMES))
    return first_rows(narrow, k, [F.col(row_id)], [*by, "prediction"])


def merge_counts(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    columns = [c for c in parts.columns if c.endswith(("_reviews", "_length", "_flagged"))]
    return parts.groupBy(*by).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in columns])


def id_order(row_id: str) -> tuple:
    """The order of ids that are written as texts: numbers by value, before other texts."""
    return (0, int(row_id), "") if row_id.lstrip("-").isdigit() else (1, 0, row_id)


def summary_share(df: DataFrame, by: str, text: str = "review_clean", row_id: str = "upload_id") -> DataFrame:
    """One row per ``by``: counts that add up, and the first reviews of each class with their ids as texts."""
    entry = F.struct("rank", F.col(row_id).cast("string").alias("upload_id"), F.col(text).alias("text"))
    lists = [F.transform(F.array_sort(F.collect_list(F.when(F.col("prediction") == name, entry))),
                         lambda t: F.struct(t["upload_id"].alias("upload_id"), t["text"].alias("text"))).alias(f"tops_{name}")
             for name in NAMES]
    tops = first_k(df, TOP, [by], text, row_id).groupBy(by).agg(*lists).withColumnRenamed(by, "_by")
    joined = summary_counts(df, [by], text).join(tops, F.col(by).eqNullSafe(F.col("_by")), "left")
    none = F.array().cast("array<struct<upload_id:string,text:string>>")
    return joined.select(by, *COUNTS, *[F.coalesce(f"tops_{name}", none).alias(f"tops_{name}") for name in NAMES])


def summary_of_share(shares: DataFrame, by: str) -> DataFrame:
    """The eight summary fields of rows like those of ``summary_share``."""
    average = F.round(F.try_divide(F.col("total_length"), F.col("measured_reviews")), 2)
    return shares.select(
        by, "total_reviews", "positive_reviews", "negative_reviews", "neutral_reviews",
        average.alias("average_review_length"), "short_reviews_flagged",
        *[F.col(f"tops_{name}.text").alias(c) for name, c in zip(NAMES, _TOP_COLUMNS)])


def summary_document(
    counts: DataFrame, tops: DataFrame, by: Sequence[str] = (), text: str = "review_clean"
) -> DataFrame:
    """The eight summary fields from counts and ranked reviews, one row per ``by`` group."""
    lists = [texts_in_order(text, F.col("prediction") == name).alias(c)
             for name, c in zip(NAMES, _TOP_COLUMNS)]
    if by:
        listed = tops.groupBy(*by).agg(*lists).withColumnsRenamed({c: f"_{c}" for c in by})
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
        joined = counts.join(listed, reduce(and_, same), "left").drop(*[f"_{c}" for c in by])
    else:
        joined = counts.withColumn("_tops", tops.agg(F.struct(*lists)).scalar()).select("*", "_tops.*")
    average = F.round(F.try_divide(F.col("total_length"), F.col("measured_reviews")), 2)
    return joined.select(
        *by, "total_reviews", "positive_reviews", "negative_reviews", "neutral_reviews",
        average.alias("average_review_length"), "short_reviews_flagged",
        *[F.coalesce(c, F.array().cast("array<string>")).alias(c) for c in _TOP_COLUMNS])


def summarize(
    df: DataFrame, by: Sequence[str] = (), text: str = "review_clean", row_id: str = "upload_id", k: int = TOP
) -> DataFrame:
    """The upload summary, overall or for example per user."""
    return summary_document(summary_counts(df, by, text), first_k(df, k, by, text, row_id), by, text)


def top_confident(
    df: DataFrame, k: int = TOP, row_id: str = "doc_id", prediction: str = "prediction"
) -> DataFrame:
    """The ``k`` rows of each predicted class with the highest score for that class."""
    own = F.when(F.col(prediction) == 1, F.col("positive_score")).otherwise(F.col("negative_score"))
    return first_rows(df.withColumn("confidence", own), k,
                      [F.desc("confidence"), F.col(row_id)], [prediction])


def dashboard_tables(df: DataFrame, text: str = "review_clean", row_id: str = "upload_id") -> dict[str, DataFrame]:
    """The tables behind a dashboard page of one scored upload."""
    return {"summary": summarize(df, (), text, row_id),
            "distribution": sentiment_distribution(df),
            "histogram": length_histogram(df, text),
            "top_reviews": first_k(df, TOP, (), text, row_id)}
