"""Quality of predictions. Each operator is one aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scores import cross_entropy, ratio


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))


def class_summary(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.agg(*_class_counts(label, prediction))


def _class_counts(label: str, prediction: str) -> list[Column]:
    return [F.count_if(F.col(c) == v).alias(f"{kind}_{name}")
            for kind, c in (("actual", label), ("predicted", prediction))
            for name, v in (("positive", 1), ("negative", 0))]


def _outcomes(label: Column, prediction: Column) -> dict[str, Column]:
    return {"tp": F.count_if((label == 1) & (prediction == 1)),
            "fp": F.count_if((label == 0) & (prediction == 1)),
            "fn": F.count_if((label == 1) & (prediction == 0)),
            "tn": F.count_if((label == 0) & (prediction == 0))}


def _metrics(tp: Column, fp: Column, fn: Column, tn: Column) -> list[Column]:
    return [ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
            ratio(tp, tp + fp).alias("precision"),
            ratio(tp, tp + fn).alias("recall"),
            ratio(2 * tp, 2 * tp + fp + fn).alias("f1")]


def classification_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy, precision, recall and F1; zero where undefined."""
    counts = df.agg(*[c.alias(n) for n, c in _outcomes(F.col(label), F.col(prediction)).items()])
    return counts.select(*_metrics(*[F.col(c) for c in ("tp", "fp", "fn", "tn")]))


def log_loss(df: DataFrame, label: str = "label", positive_score: str = "positive_score") -> DataFrame:
    """Mean cross entropy."""
    return df.agg(F.avg(cross_entropy(F.col(label), F.col(positive_score))).alias("log_loss"))


def metrics_and_loss(
    df: DataFrame, label: str = "label", prediction: str = "prediction", positive_score: str = "positive_score"
) -> DataFrame:
    """Mean cross entropy, accuracy, precision, recall and F1 from one aggregate."""
    loss = F.avg(cross_entropy(F.col(label), F.col(positive_score))).alias("log_loss")
    counts = df.agg(loss, *[c.alias(n) for n, c in _outcomes(F.col(label), F.col(prediction)).items()])
    return counts.select("log_loss", *_metrics(*[F.col(c) for c in ("tp", "fp", "fn", "tn")]))


def candidate_metrics(df: DataFrame, smoothing: Sequence[float], label: str = "label") -> DataFrame:
    """Metrics of every candidate (``logit_0``, ``logit_1``, ...) from one pass over the scores."""
    counted = df.agg(*[
        F.struct(F.lit(a).alias("smoothing"), *[
            c.alias(n) for n, c in _outcomes(F.col(label), (F.col(f"logit_{i}") > 0).cast("int")).items()
        ]).alias(f"c{i}")
        for i, a in enumerate(smoothing)])
    rows = counted.select(F.inline(F.array(*[f"c{i}" for i in range(len(smoothing))])))
    return rows.select("smoothing", *_metrics(*[F.col(c) for c in ("tp", "fp", "fn", "tn")]))


def select_best(candidates: DataFrame) -> DataFrame:
    """The candidate with the highest F1; of equals, the least smoothed."""
    order = F.struct(F.col("f1"), -F.col("smoothing"))
    return candidates.agg(F.max_by(F.struct(*candidates.columns), order).alias("_best")).select("_best.*")
