"""Token models: training as aggregates, and a linear model of Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..session import materialize

SMOOTHING = 1.0
SMOOTHING_GRID = (0.1, 0.5, 1.0, 2.0)
# A documented bound of the fit: rarer tokens carry no weight.
MIN_DOCUMENTS = 5
# Stands for the class prior among the tokens; no text has this token, every text is given it.
PRIOR = ""

# Weights of this size, as the packed arrays or hash tables that tasks hold, may be sent to every task.
BROADCAST_BYTES = 64 << 20
# A hash table of rows is larger than their bytes.
TABLE_FACTOR = 4


@dataclass(frozen=True)
class TokenModel:
    """Stored token weights, one weight column per candidate, and their measured size.

    The weights of tokens in at least ``head_docs`` training documents fit in a broadcast;
    1 says that all do.
    """

    weights: DataFrame
    columns: tuple[str, ...]
    n_tokens: int
    head_docs: int


def tokenize(df: DataFrame, row_id: str, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per document and distinct token."""
    return df.select(row_id, *keep, F.explode(tx.tokens(F.col(text))).alias("token"))


def token_counts(df: DataFrame, row_id: str, text: str) -> DataFrame:
    """In how many documents each token occurs; counted in each task before tokens move."""
    return tokenize(df, row_id, text).groupBy("token").agg(F.count(F.lit(1)).alias("n_docs"))


def token_class_counts(
    docs: DataFrame, row_id: str, text: str, label: str, min_docs: int = MIN_DOCUMENTS
) -> DataFrame:
    """Documents of either class per token, for tokens in at least ``min_docs`` documents."""
    return (tokenize(docs, row_id, text, [label])
            .groupBy("token")
            .agg(F.count_if(F.col(label) == 1).alias("positive_docs"),
                 F.count_if(F.col(label) == 0).alias("negative_docs"))
            .filter(F.col("positive_docs") + F.col("negative_docs") >= min_docs))


def _log_share(with_token: Column, docs: Column, smoothing: float) -> Column:
    return F.ln((with_token + F.lit(smoothing)) / (docs + F.lit(2 * smoothing)))


def nb_weights(
    docs: DataFrame,
    row_id: str = "doc_id",
    text: str = "text",
    label: str = "label",
    smoothing: Sequence[float] = (SMOOTHING,),
    min_docs: int = MIN_DOCUMENTS,
) -> DataFrame:
    """Naive Bayes weights: the log odds that a token's presence adds for the positive class.

    One column per smoothing value (``weight_0``, ``weight_1``, ...), all from the same counts.
    """
    sizes = docs.agg(F.struct(F.count_if(F.col(label) == 1).alias("positive"),
                              F.count_if(F.col(label) == 0).alias("negative"))).scalar()
    counts = token_class_counts(docs, row_id, text, label, min_docs)
    return counts.select("token", "positive_docs", "negative_docs", *[
        (_log_share(F.col("positive_docs"), sizes["positive"], a)
         - _log_share(F.col("negative_docs"), sizes["negative"], a)).alias(f"weight_{i}")
        for i, a in enumerate(smoothing)])


def class_prior(docs: DataFrame, label: str = "label", smoothing: Sequence[float] = (SMOOTHING,)) -> DataFrame:
    """One row like those of ``nb_weights``: the log odds of the classes, zero where they are balanced."""
    counts = docs.agg(F.count_if(F.col(label) == 1).alias("positive_docs"),
                      F.count_if(F.col(label) == 0).alias("negative_docs"))
    return counts.select(F.lit(PRIOR).alias("token"), "positive_docs", "negative_docs", *[
        F.ln((F.col("positive_docs") + F.lit(a)) / (F.col("negative_docs") + F.lit(a))).alias(f"weight_{i}")
        for i, a in enumerate(smoothing)])


def train_nb(
    docs: DataFrame,
    row_id: str = "doc_id",
    text: str = "text",
    label: str = "label",
    smoothing: Sequence[float] = (SMOOTHING,),
    min_docs: int = MIN_DOCUMENTS,
) -> TokenModel:
    """Train, store the weights and the class prior, and measure them."""
    columns = [f"weight_{i}" for i in range(len(smoothing))]
    trained = nb_weights(docs, row_id, text, label, smoothing, min_docs).unionByName(
        class_prior(docs, label, smoothing))
    n_docs = F.col("positive_docs") + F.col("negative_docs")
    return stored_model(trained.select("token", n_docs.alias("n_docs"), *columns))


def stored_model(weights: DataFrame) -> TokenModel:
    """A model from ``token``, ``n_docs``, ``weight_0``, ``weight_1``, ..."""
    return _measured(materialize(weights, "token-model"))


def _measured(weights: DataFrame) -> TokenModel:
    columns = tuple(c for c in weights.columns if c.startswith("weight_"))
    width = TABLE_FACTOR * (F.octet_length("token") + 8 * (1 + len(columns)))
    octave = F.floor(F.log2("n_docs")).alias("octave")
    # At most 64 rows: sizes by the number of documents, from frequent to rare.
    sizes = (weights.groupBy(octave).agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b"))
             .orderBy(F.desc("octave")).collect())
    head_docs, taken = 1, 0
    for size in sizes:
        taken += size["b"]
        if taken > BROADCAST_BYTES:
            head_docs = 2 ** (size["octave"] + 1)
            break
    return TokenModel(weights, columns, sum(size["n"] for size in sizes), head_docs)


def save_model(model: TokenModel, path: str) -> None:
    model.weights.write.mode("overwrite").parquet(path)


def load_model(spark: SparkSession, path: str) -> TokenModel:
    return _measured(spark.read.parquet(path))


def train_lr(
    docs: DataFrame, text: str = "text", label: str = "label", features: int = 1 << 18, min_docs: int = MIN_DOCUMENTS
) -> PipelineModel:
    """Hashed term frequencies, IDF and logistic regression.

    ``features`` folds tokens into so many columns by hash, and tokens in fewer than ``min_docs`` documents have
    no weight.

    The coefficient vector has a fixed size and gradients are summed in a tree.
    """
    return Pipeline(stages=[
        RegexTokenizer(inputCol=text, outputCol="_words", pattern=tx.NON_LETTERS),
        HashingTF(inputCol="_words", outputCol="_counts", numFeatures=features),
        IDF(inputCol="_counts", outputCol="_features", minDocFreq=min_docs),
        LogisticRegression(featuresCol="_features", labelCol=label, probabilityCol="_probability",
                           predictionCol="_prediction", rawPredictionCol="_raw",
                           maxIter=20, regParam=0.01, aggregationDepth=3),
    ]).fit(docs)
