"""Train, evaluate and choose a classifier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evaluation, model, reviews, sampling, scoring, serving
from ..operators.ranking import texts_in_order
from ..sources import readers, writers
from .stages import Stage, run_stages


def train_and_evaluate(
    train: DataFrame,
    test: DataFrame,
    row_id: str = "doc_id",
    text: str = "text",
    label: str = "label",
    smoothing: Sequence[float] = model.SMOOTHING_GRID,
) -> tuple[model.TokenModel, DataFrame]:
    """All candidates from one training pass, and their metrics from one scoring pass."""
    candidates = model.train_nb(train, row_id, text, label, smoothing)
    scored = scoring.score_weights(test, candidates, row_id, text, [label])
    return candidates, evaluation.candidate_metrics(scored, smoothing, label)


def chosen(candidates: model.TokenModel, best: DataFrame, smoothing: Sequence[float]) -> model.TokenModel:
    """The stored model that the best candidate row names."""
    position = list(smoothing).index(best.first()["smoothing"])
    weight = F.col(candidates.columns[position]).alias("weight_0")
    return model.stored_model(candidates.weights.select("token", "n_docs", weight))


def score_test_set(
    test: DataFrame,
    trained: model.TokenModel,
    n: int | None = None,
    row_id: str = "doc_id",
    text: str = "text",
    label: str = "label",
    strict: bool = False,
) -> DataFrame:
    """All test rows with their predictions, or only a balanced sample of ``n`` per class if one is asked for.

    The text is carried: the document quotes from it.
    """
    rows = test.select(row_id, text, label)
    if n is not None:
        rows = sampling.per_class_sample(rows, row_id, label, n, strict=strict)
    return scoring.score_rows(rows, trained, text)


def evaluation_document(
    scored: DataFrame,
    model_name: str,
    row_id: str = "doc_id",
    text: str = "text",
    label: str = "label",
    prediction: str = "prediction_label",
) -> DataFrame:
    """Loss, metrics, class counts and the most confident reviews, as one row."""
    m = evaluation.classification_metrics(scored, label, prediction)
    loss = evaluation.log_loss(scored, label)
    tops = serving.top_confident(scored.select(row_id, text, prediction, "positive_score", "negative_score"),
                                 serving.TOP, row_id, prediction)
    quoted = tops.agg(F.struct(
        texts_in_order(text, F.col(prediction) == 1).alias("top_predicted_positive"),
        texts_in_order(text, F.col(prediction) == 0).alias("top_predicted_negative")))
    classes = evaluation.class_summary(scored, label, prediction)
    return m.select(
        F.lit(model_name).alias("model_name"),
        F.struct(loss.scalar().alias("eval_loss"),
                 *[F.col(c).alias(f"eval_{c}") for c in m.columns]).alias("metrics"),
        classes.agg(F.first(F.struct(*classes.columns))).scalar().alias("class_summary"),
        quoted.scalar().alias("sample_reviews"))


def evaluate_model(
    test: DataFrame,
    trained: model.TokenModel,
    model_name: str,
    out: str,
    n: int | None = None,
    row_id: str = "review_id",
    strict: bool = False,
) -> None:
    """Judge a stored model on all test rows (or ``n`` per class); store the tested rows and the document."""
    writers.write_stage(score_test_set(test, trained, n, row_id, strict=strict), f"{out}/tested")
    tested = readers.read_stage(test.sparkSession, f"{out}/tested")
    writers.export_csv(tested.withColumn("prediction", F.col("prediction_label")), f"{out}/tested_csv",
                       ["text", "label", "prediction"])
    document = evaluation_document(tested, model_name, row_id)
    writers.write_metrics(writers.stamped(document), f"{out}/documents/model_evaluation")


def job(
    spark: SparkSession,
    training_csv: str,
    holdout: str,
    out: str,
    smoothing: Sequence[float] = model.SMOOTHING_GRID,
    n: int | None = None,
) -> list[Stage]:
    """Train on an exported sample, choose by F1 on one half of the hold-out, judge the stored model on the other.

    The hold-out is halved by text, so that no text is in both halves. The halves and the candidates are scratch.
    """

    def halved() -> None:
        rest = readers.read_stage(spark, holdout).select("review_id", "review_body", "label")
        rest = reviews.to_training_frame(reviews.drop_incomplete(rest))
        halves = sampling.hash_split(rest.withColumn("_text", F.sha2("text", 256)), "_text", {"choose": 50, "judge": 50})
        writers.write_split(halves.drop("_text"), f"{out}/halves")

    def half(name: str) -> DataFrame:
        return readers.read_stage(spark, f"{out}/halves").filter(F.col("split") == name).drop("split")

    def chosen_model() -> None:
        train = readers.with_row_id(reviews.drop_incomplete(readers.read_training_csv(spark, training_csv)))
        candidates, metrics = train_and_evaluate(
            reviews.to_training_frame(train), half("choose"), "review_id", smoothing=smoothing)
        writers.write_stage(metrics, f"{out}/candidates")
        best = evaluation.select_best(readers.read_stage(spark, f"{out}/candidates"))
        model.save_model(chosen(candidates, best, smoothing), f"{out}/model")

    def judged() -> None:
        evaluate_model(half("judge"), model.load_model(spark, f"{out}/model"), "naive-bayes", out, n)

    return [Stage("halved", halved, (), (f"{out}/halves",)), Stage("chosen", chosen_model, ("halved",)),
            Stage("judged", judged, ("halved", "chosen"))]


def run(
    spark: SparkSession,
    training_csv: str,
    holdout: str,
    out: str,
    smoothing: Sequence[float] = model.SMOOTHING_GRID,
    n: int | None = None,
    resume: bool = False,
) -> None:
    """Run all stages of ``job``; with ``resume`` those that an earlier run has not completed."""
    run_stages(spark, out, job(spark, training_csv, holdout, out, smoothing, n), resume)
