"""Scores, predictions and label names."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scores
from ..functions import text as tx
from ..session import materialize
from . import model as token_models
from .model import PRIOR, TokenModel

# Digits of a score that do not depend on the order in which weights are added.
SCORE_DIGITS = 9


def _row_tokens(text: str) -> Column:
    """A text's tokens and the one that stands for the class prior; a missing text has only that."""
    return F.concat(F.coalesce(tx.tokens(F.col(text)), F.array().cast("array<string>")), F.array(F.lit(PRIOR)))


def fits_in_task(model: TokenModel) -> bool:
    """Whether all weights fit in the packed arrays of a task: a hash and a number per token."""
    return 16 * model.n_tokens <= token_models.BROADCAST_BYTES


def score_weights(
    df: DataFrame, model: TokenModel, row_id: str = "doc_id", text: str = "text", keep: Sequence[str] = ()
) -> DataFrame:
    """The summed token weights per ``row_id``: ``logit_0``, ``logit_1``, ... per weight column.

    Rows are told apart by ``row_id``, which must be unique; ``score_rows`` takes any rows. A small model is
    broadcast whole. Of a larger one the frequent tokens are, and the others are joined by shuffle after one
    left join has set the frequent ones aside (AQE splits a token that is not rare here). Texts never move: the
    sums travel with the id and the ``keep`` columns.
    """
    tokens = df.select(row_id, *keep, F.explode(_row_tokens(text)).alias("token"))
    frequent = F.col("n_docs") >= model.head_docs
    head = F.broadcast(model.weights.filter(frequent).drop("n_docs"))
    weighted = tokens.join(head, "token", "left")
    if model.head_docs > 1:
        # Tokens with a weight need no second look-up; the key is null for them, and they are not sent.
        known = F.col(model.columns[0]).isNotNull()
        rare = model.weights.filter(~frequent).select(
            F.col("token").alias("_token"), *[F.col(c).alias(f"_{c}") for c in model.columns])
        open_ = weighted.filter(~known).join(rare, F.col("token") == F.col("_token"))
        found = weighted.filter(known).select(row_id, *keep, *model.columns)
        weighted = found.unionByName(open_.select(row_id, *keep, *[F.col(f"_{c}").alias(c) for c in model.columns]))
    sums = [F.round(F.coalesce(F.sum(c), F.lit(0.0)), SCORE_DIGITS).alias(f"logit_{i}")
            for i, c in enumerate(model.columns)]
    return weighted.groupBy(row_id, *keep).agg(*sums)


def with_scores(df: DataFrame, logit: str = "logit_0") -> DataFrame:
    """Class probabilities, the class number and its name, from the logits ``[0, logit]``."""
    p = F.col("_probabilities")
    return (df.withColumn("_probabilities", scores.softmax(F.array(F.lit(0.0), F.col(logit))))
            .withColumns({"positive_score": p[1],
                          "negative_score": p[0],
                          "prediction_label": scores.argmax(p)})
            .withColumn("prediction", scores.name_label(F.col("prediction_label")))
            .drop("_probabilities"))


def score_with_model(df: DataFrame, load: Callable[[], Callable], text: str, output: str = "logit_0") -> DataFrame:
    """Add a model's output to each row, in Arrow batches and without a shuffle.

    ``load`` runs once per task and returns a function from an Arrow array of texts to as
    many numbers. Other columns pass through untouched.
    """
    out = T.StructType([*df.schema.fields, T.StructField(output, T.DoubleType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        score = load()
        for batch in batches:
            values = pa.array(score(batch.column(text)), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, values], names=[*batch.schema.names, output])

    return df.mapInArrow(run, out)


def token_scorer(model: TokenModel) -> Callable[[], Callable]:
    """Load a token model inside tasks, as arrays of token hashes and weights.

    The function that is returned takes an Arrow array of lists of token hashes; its sums are not rounded. Refused where the model is too
    large for a task.
    """
    if not fits_in_task(model):
        raise ValueError(f"{model.n_tokens} tokens; use score_rows")
    rows = model.weights.select(F.xxhash64("token").alias("hash"), F.col(model.columns[0]).alias("w")).toPandas()
    rows = rows.sort_values("hash")
    shared = model.weights.sparkSession.sparkContext.broadcast(
        (rows["hash"].to_numpy("int64"), rows["w"].to_numpy("float64")))

    def load() -> Callable:
        import numpy as np

        hashes, weights = shared.value

        def score(lists) -> np.ndarray:
            tokens = lists.flatten().to_numpy(zero_copy_only=False)
            if not len(hashes) or not len(tokens):
                return np.zeros(len(lists))
            at = np.minimum(np.searchsorted(hashes, tokens), len(hashes) - 1)
            found = np.where(hashes[at] == tokens, weights[at], 0.0)
            # Every list holds the prior's token, so none is empty.
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            return np.add.reduceat(found, np.concatenate([[0], ends[:-1]]))

        return score

    return load


def _scored_in_task(df: DataFrame, model: TokenModel, text: str) -> DataFrame:
    """``logit_0`` added to each row; tokens are found and hashed in the JVM."""
    hashed = df.withColumn("_hashes", F.transform(_row_tokens(text), lambda t: F.xxhash64(t)))
    scored = score_with_model(hashed, token_scorer(model), "_hashes").drop("_hashes")
    return scored.withColumn("logit_0", F.round("logit_0", SCORE_DIGITS))  # as ``score_weights`` rounds


def _scored_by_join(df: DataFrame, model: TokenModel, text: str) -> DataFrame:
    """``logit_0`` added to each row; rows are stored and numbered, and tokens joined to their weights."""
    stored = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "rows-to-score")
    first = TokenModel(model.weights.select("token", "n_docs", F.col(model.columns[0]).alias("weight_0")),
                       ("weight_0",), model.n_tokens, model.head_docs)
    logits = score_weights(stored, first, "_row", text)
    return stored.join(logits, "_row").select(*df.columns, "logit_0")


def score_rows(df: DataFrame, model: TokenModel, text: str) -> DataFrame:
    """Every row once with its columns in order, then scores, class and name.

    Ids play no part, so missing and repeated ones change nothing. Weights that fit in a task are applied where
    the rows are read; others are joined by token to stored, numbered rows. Results are the same.
    """
    in_task = fits_in_task(model)
    return with_scores((_scored_in_task if in_task else _scored_by_join)(df, model, text)).drop("logit_0")


def score_lr(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Scores of the Spark ML model, row by row in the JVM."""
    p = vector_to_array(F.col("_probability"))
    label = F.col("_prediction").cast("int")
    scored = model.transform(df)
    return scored.select(*df.columns, p[1].alias("positive_score"), p[0].alias("negative_score"),
                         label.alias("prediction_label"), scores.name_label(label).alias("prediction"))
