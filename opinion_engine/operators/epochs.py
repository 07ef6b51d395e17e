"""A linear classifier trained in epochs: mini-batches, a checkpoint per epoch, the best epoch by F1.

Texts become hashed features once and are stored in folders by mini-batch, so an epoch reads the table once and a step
reads its folder. A task adds up the gradient of its rows, features are summed by shuffle, and the driver gets one number
per feature: at most ``features`` of them, whatever the table's size. Weights go to the tasks by broadcast.

An epoch is complete when its metrics are there, which are written last. A run that is broken off continues after
the last complete epoch; the results are the same, because rows belong to mini-batches by their id and every sum is
rounded to ``DIGITS``.
"""

from __future__ import annotations

import dataclasses
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import files
from ..functions import keys
from ..functions import text as tx
from ..sources import readers, tables, writers
from . import evaluation, scoring

# Digits that do not depend on the order in which rows are added.
DIGITS = 9


@dataclass(frozen=True)
class Settings:
    """``features`` folds tokens into so many columns by hash; ``batches`` are the steps of an epoch."""

    features: int = 1 << 18
    epochs: int = 2
    batches: int = 16
    rate: float = 4.0
    shrink: float = 0.0
    seed: int = 42


def hash_token(token: Column) -> Column:
    return F.xxhash64(token)


def digest_token(token: Column) -> Column:
    """Slower than ``hash_token``; a number that any database can compute."""
    return keys.leading_number(F.md5(token), 8)


def prepare(docs: DataFrame, settings: Settings, row_id: str = "doc_id", text: str = "text", label: str = "label",
            hashed: Callable[[Column], Column] = hash_token) -> DataFrame:
    """``row_id``, ``label``, ``features`` (distinct numbers) and ``batch`` of the rows that have a label.

    A missing text has no features. Rows without an id share a mini-batch.
    """
    numbers = F.transform(tx.tokens(F.col(text)), lambda t: F.pmod(hashed(t), F.lit(settings.features)).cast("int"))
    features = F.coalesce(F.array_sort(F.array_distinct(numbers)), F.array().cast("array<int>"))
    key = F.coalesce(keys.leading_number(keys.order_key(F.col(row_id), settings.seed), 8), F.lit(0))
    return docs.filter(F.col(label).isNotNull()).select(
        row_id, F.col(label).cast("int").alias("label"), features.alias("features"),
        F.pmod(key, F.lit(settings.batches)).cast("int").alias("batch"))


def _logits(features: pa.Array, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The logit of each row, its features in one array, and which row each belongs to. The last weight is the bias."""
    sizes = features.value_lengths().to_numpy(zero_copy_only=False)
    flat = features.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(features)), sizes)
    return np.bincount(owner, weights[flat], minlength=len(features)) + weights[-1], flat, owner


def gradient(rows: DataFrame, weights: np.ndarray) -> tuple[np.ndarray, int]:
    """The summed gradient of the cross entropy over prepared rows, and their number."""
    spark, n = rows.sparkSession, len(weights)
    sent = spark.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, total = sent.value, np.zeros(n + 1)
        for batch in batches:
            logit, flat, owner = _logits(batch.column(0), weights)
            error = 1 / (1 + np.exp(-logit)) - batch.column(1).to_numpy(zero_copy_only=False)
            total[:n] += np.bincount(flat, error[owner], minlength=n)
            total[n - 1] += error.sum()
            total[n] += len(error)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["feature", "g"])

    # One row per feature that occurs.
    summed = rows.select("features", "label").mapInArrow(run, "feature long, g double").groupBy("feature").agg(
        F.round(F.sum("g"), DIGITS).alias("g")).toPandas()
    sent.unpersist()
    out = np.zeros(n + 1)
    out[summed["feature"].to_numpy(np.int64)] = summed["g"].to_numpy(float)
    return out[:n], int(out[n])


def step(rows: DataFrame, weights: np.ndarray, settings: Settings) -> np.ndarray:
    """The weights after one mini-batch; an empty one changes nothing."""
    total, n = gradient(rows, weights)
    if not n:
        return weights
    return np.round(weights - settings.rate * (total / n + settings.shrink * weights), DIGITS)


def score(rows: DataFrame, weights: np.ndarray) -> DataFrame:
    """Prepared rows with class probabilities, class number and name."""
    sent = rows.sparkSession.sparkContext.broadcast(weights)

    def load() -> Callable[[pa.Array], np.ndarray]:
        return lambda features: np.round(_logits(features, sent.value)[0], DIGITS)

    return scoring.with_scores(scoring.score_with_model(rows, load, "features")).drop("logit_0")


def epoch_metrics(rows: DataFrame, weights: np.ndarray, epoch: int) -> DataFrame:
    """``epoch``, the loss and the metrics of prepared rows, from one pass; no rows give a missing loss."""
    scored = score(rows, weights)
    return evaluation.metrics_and_loss(scored, prediction="prediction_label").select(F.lit(epoch).alias("epoch"), "*")


# --- stored runs ---------------------------------------------------------------------------


def _folder(out: str, epoch: int) -> str:
    return f"{out}/epochs/epoch={epoch}"


def save_weights(spark: SparkSession, weights: np.ndarray, path: str) -> None:
    used = np.flatnonzero(weights)
    rows = spark.createDataFrame(list(zip(used.tolist(), weights[used].tolist())), "feature long, weight double")
    writers.write_stage(rows.coalesce(1), path)


def read_weights(spark: SparkSession, out: str, epoch: int) -> DataFrame:
    """``feature`` and ``weight`` of a run's epoch, where the weight is not zero."""
    return readers.read_stage(spark, f"{_folder(out, epoch)}/weights")


def load_weights(spark: SparkSession, path: str, settings: Settings) -> np.ndarray:
    """One number per feature and the bias."""
    rows = readers.read_stage(spark, path).toPandas()
    weights = np.zeros(settings.features + 1)
    weights[rows["feature"].to_numpy(np.int64)] = rows["weight"].to_numpy(float)
    return weights


def _start(spark: SparkSession, out: str, settings: Settings) -> None:
    """Note the settings of a new run; an old one must have the same but for the number of epochs."""
    wanted = {k: v for k, v in dataclasses.asdict(settings).items() if k != "epochs"}
    if files.exists(spark, f"{out}/settings.json"):
        found = json.loads(files.read(spark, f"{out}/settings.json"))
        if found != wanted:
            raise ValueError(f"{out} was begun with {found}, not {wanted}")
    else:
        files.create(spark, f"{out}/settings.json", json.dumps(wanted))


def complete_epochs(spark: SparkSession, out: str) -> int:
    epoch = 0
    while files.exists(spark, f"{_folder(out, epoch + 1)}/metrics/_SUCCESS"):
        epoch += 1
    return epoch


def train(
    docs: DataFrame,
    judged_on: DataFrame,
    out: str,
    settings: Settings = Settings(),
    row_id: str = "doc_id",
    text: str = "text",
    label: str = "label",
    hashed: Callable[[Column], Column] = hash_token,
) -> DataFrame:
    """Train on ``docs`` and judge each epoch on ``judged_on``; returns the metrics of all epochs so far.

    Everything is stored under ``out``. Called again after a failure it goes on after the last complete epoch, and
    with more epochs it trains on.
    """
    spark = docs.sparkSession
    _start(spark, out, settings)
    for name, rows in (("train", docs), ("judge", judged_on)):
        if not tables.exists(spark, f"{out}/{name}"):
            writers.write_stage(prepare(rows, settings, row_id, text, label, hashed), f"{out}/{name}", ["batch"])
    rows, judge = (stored_rows(spark, f"{out}/{name}", row_id, docs) for name in ("train", "judge"))
    done = complete_epochs(spark, out)
    weights = load_weights(spark, f"{_folder(out, done)}/weights", settings) if done else np.zeros(settings.features + 1)
    for epoch in range(done + 1, settings.epochs + 1):
        for k in range(settings.batches):
            # Another first mini-batch in every epoch.
            weights = step(rows.filter(F.col("batch") == (epoch + k) % settings.batches), weights, settings)
        save_weights(spark, weights, f"{_folder(out, epoch)}/weights")
        writers.write_metrics(epoch_metrics(judge, weights, epoch), f"{_folder(out, epoch)}/metrics")
    return read_metrics(spark, out)


def stored_rows(spark: SparkSession, path: str, row_id: str, docs: DataFrame) -> DataFrame:
    kind = docs.schema[row_id].dataType.simpleString()
    return spark.read.schema(f"{row_id} {kind}, label int, features array<int>, batch int").parquet(
        tables.current(spark, path))


METRICS = "epoch int, log_loss double, accuracy double, precision double, recall double, f1 double"


def read_metrics(spark: SparkSession, out: str) -> DataFrame:
    """The metrics of all complete epochs."""
    paths = [f"{_folder(out, k)}/metrics" for k in range(1, complete_epochs(spark, out) + 1)]
    return spark.read.schema(METRICS).json(paths) if paths else spark.createDataFrame([], METRICS)


def best_epoch(metrics: DataFrame) -> DataFrame:
    """The epoch with the highest F1; of equals, the first."""
    order = F.struct(F.col("f1"), -F.col("epoch"))
    return metrics.agg(F.max_by(F.struct(*metrics.columns), order).alias("_best")).select("_best.*")


def load_best(spark: SparkSession, out: str, settings: Settings) -> np.ndarray:
    """The weights of the best epoch of a run."""
    best = best_epoch(read_metrics(spark, out)).first()
    if best is None or best["epoch"] is None:
        raise ValueError(f"no complete epoch in {out}")
    return load_weights(spark, f"{_folder(out, best['epoch'])}/weights", settings)
