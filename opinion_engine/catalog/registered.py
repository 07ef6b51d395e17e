"""The registered queries. Each takes (spark, folder) and reads the whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from importlib.util import find_spec

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ratings, scores, text
from ..operators import epochs, evaluation, labels, model, quality, ranking, reviews, sampling, scoring, serving, subwords
from ..plans import modelling, training_data, uploads, whole
from ..schema import CLEANING_SUMMARY, EVALUATION_SUMMARY, PREPROCESS_AUDIT
from ..session import materialize, scratch_path
from ..sources import readers, writers
from ..streaming import summary
from ..streaming import uploads as stream
from . import adapters

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Rows per class in the registered samples of the labels table.
SAMPLE_ROWS = 50
# Few features and mini-batches, so that SQL can replay every step.
REPLAYED = epochs.Settings(features=64, epochs=2, batches=2, rate=1.0)


def registered(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


# --- shared inputs ---------------------------------------------------------------------


def _rated(spark: SparkSession, folder: str) -> DataFrame:
    return reviews.normalize_ratings(adapters.reviews(spark, folder))


def _measured(spark: SparkSession, folder: str) -> DataFrame:
    """Id, rating and body length of validated reviews; bodies are measured before copies are removed."""
    body = text.normalize_text(F.col("review_body"))
    narrow = reviews.drop_empty(_rated(spark, folder)).select(
        "review_id", ratings.as_int(F.col("star_rating")).alias("star_rating"),
        text.text_length(body).alias("review_length"), F.col("review_headline").isNotNull().alias("headed"),
        text.text_digest(body).alias("digest"))
    return reviews.dedup_key(narrow, "digest", "review_id").filter("headed").drop("digest", "headed")


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    return labels.label_reviews(reviews.drop_empty(_rated(spark, folder)))


def _cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return uploads.clean_upload(adapters.uploads(spark, folder))


def _served(spark: SparkSession, folder: str) -> DataFrame:
    """All cleaned uploads with their stored predictions, ``unknown`` where there is none.

    Stored: counts and lists are taken from the same rows.
    """
    predicted = adapters.scored(spark, folder).select(F.col("doc_id").alias("upload_id"), "prediction")
    joined = _cleaned(spark, folder).drop("review").join(predicted, "upload_id", "left")
    return materialize(joined.withColumn("prediction", scores.name_label(F.col("prediction"))), "served")


def _parts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A balanced sample of the training part, the part to choose on, and the part to judge on.

    Split by text, so that no text is in two parts. Stored: they are read several times.
    """
    documents = adapters.labelled_documents(spark, folder).withColumn("_text", F.sha2("text", 256))
    stage = materialize(sampling.hash_split(documents, "_text").drop("_text"), "labelled-documents")
    train, choose, judge = (stage.filter(F.col("split") == name) for name in sampling.SPLITS)
    return materialize(sampling.balanced_sample(train, "doc_id"), "training-sample"), choose, judge


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# --- reviews ---------------------------------------------------------------------------


@registered
def category_sentiment(spark: SparkSession, folder: str) -> DataFrame:
    """Sentiment and length per category over distinct reviews.

    Only the length of a text is carried through the removal of copies, not the text.
    """
    body = text.normalize_text(F.col("review_body"))
    narrow = reviews.drop_empty(adapters.reviews(spark, folder)).select(
        "review_id", "product_category",
        ratings.normalize_rating(F.col("star_rating")).alias("star_rating"),
        text.text_length(body).alias("review_length"),
        text.text_digest(body).alias("digest"))
    labelled = labels.label_reviews(reviews.dedup_key(narrow, "digest", "review_id"))
    return labelled.groupBy("product_category").agg(
        F.count(F.lit(1)).alias("n_reviews"),
        F.count_if(F.col("label") == 1).alias("n_positive"),
        F.count_if(F.col("label") == 0).alias("n_negative"),
        F.round(F.avg("review_length"), 2).alias("avg_length"))


@registered
def review_projection(spark: SparkSession, folder: str) -> DataFrame:
    return adapters.reviews(spark, folder).transform(reviews.project_reviews).transform(reviews.drop_empty)


@registered
def rating_normalize(spark: SparkSession, folder: str) -> DataFrame:
    return _rated(spark, folder).select("review_id", "star_rating")


@registered
def rating_repair(spark: SparkSession, folder: str) -> DataFrame:
    return adapters.reviews(spark, folder).select("review_id", "star_rating").transform(quality.repair_ratings)


@registered
def rating_range_audit(spark: SparkSession, folder: str) -> DataFrame:
    return quality.rating_range_audit(adapters.reviews(spark, folder))


@registered
def text_normalize(spark: SparkSession, folder: str) -> DataFrame:
    return (adapters.reviews(spark, folder).select("review_id", "review_body", "review_headline")
            .transform(reviews.drop_empty).transform(reviews.normalize_texts))


@registered
def line_break_strip(spark: SparkSession, folder: str) -> DataFrame:
    return adapters.reviews(spark, folder).select(
        "review_id", text.strip_line_breaks(F.col("review_body")).alias("review_body"))


@registered
def text_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return training_data.preprocess(adapters.reviews(spark, folder))


@registered
def preprocess_audit(spark: SparkSession, folder: str) -> DataFrame:
    return quality.preprocess_audit(adapters.reviews(spark, folder))


@registered
def observed_audit(spark: SparkSession, folder: str) -> DataFrame:
    """The audit of the stored stages, from counts that came out of their writes."""
    out = scratch_path(spark, "observed")
    source = adapters.reviews(spark, folder)
    counts = training_data.store_ingested(source, out)
    audit = training_data.store_preprocessed(readers.read_stage(spark, f"{out}/split"), counts["with_text"], out,
                                             counts["original_rows"] - counts["with_text"])
    return writers.document(spark, audit, PREPROCESS_AUDIT)


@registered
def required_text(spark: SparkSession, folder: str) -> DataFrame:
    return (adapters.reviews(spark, folder).transform(reviews.require_text)
            .transform(quality.with_length).select("review_id", "review_length"))


@registered
def drop_incomplete(spark: SparkSession, folder: str) -> DataFrame:
    rating = F.col("star_rating")
    return (_rated(spark, folder)
            .select("review_id", "review_body",
                    F.when(ratings.is_polar(rating), ratings.binary_label(rating)).alias("label"))
            .transform(reviews.drop_incomplete).transform(reviews.to_training_frame))


@registered
def length_stats(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(quality.length_stats(_measured(spark, folder)), "avg_review_length")


@registered
def anomaly_flags(spark: SparkSession, folder: str) -> DataFrame:
    """The stored stage is read twice, for the average and for the flags; copies are removed once."""
    stage = materialize(_measured(spark, folder), "validated")
    return training_data.flag(stage).select("review_id", "star_rating", "review_length", "anomaly_flag")


# --- labels and samples ----------------------------------------------------------------


@registered
def binary_labels(spark: SparkSession, folder: str) -> DataFrame:
    return labels.label_reviews(_rated(spark, folder)).select("review_id", "label")


@registered
def class_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return labels.class_distribution(labels.label_reviews(_rated(spark, folder)))


@registered
def hash_split(spark: SparkSession, folder: str) -> DataFrame:
    return training_data.ingest(adapters.reviews(spark, folder)).select("review_id", "star_rating", "split")


@registered
def random_split_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold for any random split: every row in one part, and parts of about the sizes asked for."""
    ids = materialize(adapters.reviews(spark, folder).select("review_id"), "ids-to-split")
    parts = sampling.random_split(ids)
    named = [p.withColumn("split", F.lit(name)) for name, p in zip(sampling.SPLITS, parts)]
    rows = named[0].unionByName(named[1]).unionByName(named[2])
    found = rows.groupBy("review_id").agg(F.count(F.lit(1)).alias("n"), F.first("split").alias("split"))
    n = F.count(F.lit(1))
    near = [F.abs(F.count_if(F.col("split") == name) / n - share / 100) < 4 * F.sqrt(F.lit(share * (100 - share)) / n) / 100
            for name, share in sampling.SPLITS.items()]
    return found.agg(n.alias("n_rows"), F.count_if(F.col("n") > 1).alias("n_in_two_parts"),
                     (near[0] & near[1] & near[2]).alias("sizes_as_asked"))


@registered
def balanced_sample(spark: SparkSession, folder: str) -> DataFrame:
    sample = training_data.one_line(sampling.balanced_sample(_labelled(spark, folder)))
    return sample.select("review_id", "label", "review_body")


@registered
def balanced_size(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.balanced_size(_labelled(spark, folder))


@registered
def per_class_sample(spark: SparkSession, folder: str) -> DataFrame:
    picked = sampling.per_class_sample(adapters.scored(spark, folder), "doc_id", n=SAMPLE_ROWS)
    return sampling.shuffle_rows(picked.select("doc_id", "label"), "doc_id")


def _training_set(spark: SparkSession, folder: str) -> tuple[DataFrame, training_data.TrainingSet]:
    """The stored stage with its parts; the sample is stored too, as it is counted and excluded."""
    stage = materialize(reviews.drop_empty(_rated(spark, folder)).select(
        "review_id", "star_rating", "review_body"), "with-text")
    parts = training_data.build_training_set(stage)
    sample = materialize(parts.sample, "training-set")
    return stage, training_data.TrainingSet(parts.labelled, sample,
                                            sampling.holdout_remaining(parts.labelled, sample))


@registered
def holdout_remaining(spark: SparkSession, folder: str) -> DataFrame:
    _, parts = _training_set(spark, folder)
    return parts.remaining.select("review_id", "label")


@registered
def sampling_summary(spark: SparkSession, folder: str) -> DataFrame:
    stage, parts = _training_set(spark, folder)
    classes, taken = F.col("original_class_distribution"), F.col("sampled_class_counts")
    return training_data.sampling_document(stage, parts.labelled, parts.sample, parts.remaining).select(
        "dropped_3_star_reviews", "dropped_unrated", "dropped_neutral",
        classes[1].alias("n_positive"), classes[0].alias("n_negative"),
        taken["positive"].alias("sampled_positive"), taken["negative"].alias("sampled_negative"),
        "remaining_after_sampling")


# --- uploads ---------------------------------------------------------------------------


@registered
def upload_clean(spark: SparkSession, folder: str) -> DataFrame:
    return _cleaned(spark, folder)


@registered
def short_reviews(spark: SparkSession, folder: str) -> DataFrame:
    clean = text.clean_review(F.col("review"))
    return adapters.uploads(spark, folder).select("upload_id", text.is_short(clean).alias("short_review"))


@registered
def upload_clean_summary(spark: SparkSession, folder: str) -> DataFrame:
    return uploads.clean_summary(adapters.uploads(spark, folder))


@registered
def label_names(spark: SparkSession, folder: str) -> DataFrame:
    """Class 2 has no name."""
    return adapters.table(spark, folder, "labels").select(
        "doc_id", scores.name_label(F.col("quality") + F.col("toxic")).alias("prediction"))


@registered
def sentiment_distribution(spark: SparkSession, folder: str) -> DataFrame:
    named = adapters.scored(spark, folder).select(scores.name_label(F.col("prediction")).alias("prediction"))
    return serving.sentiment_distribution(named)


@registered
def length_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(serving.length_histogram(_cleaned(spark, folder)), "from_length", "to_length")


def _joined_lists(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.array_join(c, "\n")
                           for c in ("top_positive_reviews", "top_negative_reviews")})


@registered
def sentiment_summary(spark: SparkSession, folder: str) -> DataFrame:
    return _joined_lists(serving.summarize(_served(spark, folder)))


@registered
def user_sentiment_summary(spark: SparkSession, folder: str) -> DataFrame:
    return _joined_lists(serving.summarize(_served(spark, folder), ["user_name"]))


@registered
def first_k_per_class(spark: SparkSession, folder: str) -> DataFrame:
    return serving.first_k(_served(spark, folder))


@registered
def top_confident(spark: SparkSession, folder: str) -> DataFrame:
    top = serving.top_confident(adapters.scored(spark, folder))
    return _rounded(top.select("prediction", "rank", "doc_id", "confidence"), "confidence")


# --- models ----------------------------------------------------------------------------


@registered
def token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return model.token_counts(adapters.table(spark, folder, "documents"), "doc_id", "text")


def subword_vocabulary() -> str:
    """The vocabulary file of the registered query; the operator takes any."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def subword_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Every document as 512 numbers; a digest stands for them."""
    vocabulary = subwords.read_vocabulary(subword_vocabulary())
    rows = subwords.encode(adapters.table(spark, folder, "documents").select("doc_id", "text"), "text", vocabulary)
    return rows.select("doc_id", "n_tokens", F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("n_used"),
                       F.md5(F.array_join(F.col("input_ids").cast("array<string>"), ",")).alias("ids_md5"))


if find_spec("public_tokenizers") is not None:  # where the vocabulary files are
    registered(subword_ids)


@registered
def nb_weights(spark: SparkSession, folder: str) -> DataFrame:
    weights = model.nb_weights(adapters.labelled_documents(spark, folder))
    return _rounded(weights.withColumnRenamed("weight_0", "weight"), "weight")


@registered
def nb_scores(spark: SparkSession, folder: str) -> DataFrame:
    trained = model.train_nb(adapters.labelled_documents(spark, folder))
    scored = scoring.with_scores(scoring.score_weights(adapters.table(spark, folder, "documents"), trained))
    return _rounded(scored.withColumnRenamed("logit_0", "logit"), "logit", "positive_score", "negative_score")


@registered
def model_scoring_map(spark: SparkSession, folder: str) -> DataFrame:
    """The stored model inside tasks: each document keeps its columns and gains its prediction."""
    trained = model.train_nb(adapters.labelled_documents(spark, folder))
    documents = adapters.table(spark, folder, "documents").select("doc_id", "lang", "source", "text")
    scored = scoring.score_rows(documents, trained, "text").drop("text")
    return _rounded(scored, "positive_score", "negative_score")


@registered
def upload_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned uploads with their predictions."""
    trained = model.train_nb(adapters.labelled_documents(spark, folder))
    scored = uploads.score_upload(_cleaned(spark, folder), trained)
    return _rounded(scored.drop("review"), "positive_score", "negative_score")


@registered
def confusion_counts(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.confusion(adapters.scored(spark, folder))


@registered
def class_summary(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.class_summary(adapters.scored(spark, folder))


@registered
def classification_metrics(spark: SparkSession, folder: str) -> DataFrame:
    metrics = evaluation.classification_metrics(adapters.scored(spark, folder))
    return _rounded(metrics, *metrics.columns)


@registered
def log_loss(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(evaluation.log_loss(adapters.scored(spark, folder)), "log_loss")


@registered
def candidate_models(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics of every smoothing value on the part that is there to choose on."""
    train, choose, _ = _parts(spark, folder)
    _, metrics = modelling.train_and_evaluate(train, choose)
    return _rounded(metrics, "accuracy", "precision", "recall", "f1")


@registered
def best_model(spark: SparkSession, folder: str) -> DataFrame:
    train, choose, _ = _parts(spark, folder)
    _, metrics = modelling.train_and_evaluate(train, choose)
    return _rounded(evaluation.select_best(metrics), "accuracy", "precision", "recall", "f1")


@registered
def model_evaluation(spark: SparkSession, folder: str) -> DataFrame:
    """A model trained on a balanced sample of one part and judged on all of another."""
    train, _, judge = _parts(spark, folder)
    trained = model.train_nb(train)
    scored = materialize(modelling.score_test_set(judge, trained), "tested")
    return _flat_document(modelling.evaluation_document(scored, "naive-bayes"))


def _flat_document(document: DataFrame) -> DataFrame:
    quoted = F.col("sample_reviews")
    flat = document.select(
        "model_name", "metrics.*", "class_summary.*",
        F.array_join(quoted["top_predicted_positive"], "\n").alias("top_predicted_positive"),
        F.array_join(quoted["top_predicted_negative"], "\n").alias("top_predicted_negative"))
    return _rounded(flat, "eval_loss", "eval_accuracy", "eval_precision", "eval_recall", "eval_f1")


@registered
def whole_chain(spark: SparkSession, folder: str) -> DataFrame:
    """From CSV files to the stored evaluation document; its time stamp is only asked to be one."""
    out = scratch_path(spark, "whole-chain")
    writers.export_csv(adapters.reviews(spark, folder), f"{out}/raw")
    whole.run(spark, f"{out}/raw", out)
    document = readers.read_metrics_json(spark, f"{out}/model/documents/model_evaluation", EVALUATION_SUMMARY)
    stamped = document.withColumn("model_name", F.when(
        F.try_to_timestamp("timestamp").isNotNull(), F.concat(F.col("model_name"), F.lit(", stamped"))))
    return _flat_document(stamped)


def _trained_in_epochs(spark: SparkSession, folder: str) -> tuple[str, DataFrame]:
    """The folder of a run over the training sample, judged on the part to choose on; and the part to judge on."""
    train, choose, judge = _parts(spark, folder)
    out = scratch_path(spark, "epochs")
    epochs.train(train, choose, out, REPLAYED, hashed=epochs.digest_token)
    return out, judge


@registered
def epoch_metrics(spark: SparkSession, folder: str) -> DataFrame:
    out, _ = _trained_in_epochs(spark, folder)
    return _rounded(epochs.read_metrics(spark, out), "log_loss", "accuracy", "precision", "recall", "f1")


@registered
def epoch_weights(spark: SparkSession, folder: str) -> DataFrame:
    """The stored weights of every epoch; the last feature is the bias."""
    out, _ = _trained_in_epochs(spark, folder)
    stored = [epochs.read_weights(spark, out, k).withColumn("epoch", F.lit(k)) for k in range(1, REPLAYED.epochs + 1)]
    return _rounded(reduce(DataFrame.unionByName, stored), "weight")


@registered
def best_epoch(spark: SparkSession, folder: str) -> DataFrame:
    out, _ = _trained_in_epochs(spark, folder)
    best = epochs.best_epoch(epochs.read_metrics(spark, out))
    return _rounded(best, "log_loss", "accuracy", "precision", "recall", "f1")


@registered
def lr_confusion(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions of the best epoch's weights on the part to judge on."""
    out, judge = _trained_in_epochs(spark, folder)
    rows = epochs.prepare(judge, REPLAYED, hashed=epochs.digest_token)
    scored = epochs.score(rows, epochs.load_best(spark, out, REPLAYED))
    return evaluation.confusion(scored.select("label", F.col("prediction_label").alias("prediction")))


# --- round trips and streams -----------------------------------------------------------


@registered
def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "uploads-csv")
    writers.export_csv(adapters.uploads(spark, folder), path)
    return readers.read_scored_csv(spark, path)


def _exported_sample(spark: SparkSession, folder: str) -> str:
    """The balanced sample in shuffled order as CSV files whose names are in that order."""
    path = scratch_path(spark, "training-csv")
    sample = training_data.one_line(sampling.balanced_sample(_labelled(spark, folder)))
    writers.export_csv(sampling.shuffle_rows(sample), path, ["review_body", "label"])
    return path


@registered
def training_csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    return readers.read_training_csv(spark, _exported_sample(spark, folder))


@registered
def training_csv_order(spark: SparkSession, folder: str) -> DataFrame:
    """Where each text of the export stands, from one count per file; a digest stands for the text."""
    rows = readers.read_in_order(spark, _exported_sample(spark, folder))
    stored = materialize(rows.select("part", "place", F.md5("review_body").alias("text_md5")), "export-places")
    return ranking.numbered(stored)


@registered
def inferred_types(spark: SparkSession, folder: str) -> DataFrame:
    """The types found in a CSV export of orders, with codes that have leading zeros and a column without texts."""
    path = scratch_path(spark, "orders-csv")
    rows = adapters.view(adapters.MIXED, adapters.table(spark, folder, "orders"))
    writers.export_csv(rows, path)
    found = readers.infer_types(readers.read_reviews_csv(spark, path))
    return spark.createDataFrame(sorted(found.items()), "name string, type string")


@registered
def user_partition_read(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "processed")
    writers.write_scored(_cleaned(spark, folder).select("upload_id", "user_name", "review_clean"), path)
    return readers.read_user_partition(spark, path, "user3")


@registered
def user_bucket_read(spark: SparkSession, folder: str) -> DataFrame:
    """One user of a table in buckets, some of whose users were written twice."""
    path = scratch_path(spark, "by-user")
    rows = _cleaned(spark, folder).select("upload_id", "user_name", "review_clean")
    writers.write_by_user(rows, path)
    writers.write_by_user(rows.filter("user_name in ('user3', 'user5') and upload_id % 2 = 1"), path)
    return readers.read_by_user(spark, path, rows.schema).groupBy("user_name").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("upload_id").alias("ids")).unionByName(
        readers.read_one_user(spark, path, "user3", rows.schema).select(
            F.concat(F.lit("only "), "user_name").alias("user_name"), F.lit(1).cast("long").alias("n_rows"),
            F.col("upload_id").alias("ids")))


@registered
def upload_times(spark: SparkSession, folder: str) -> DataFrame:
    named = adapters.table(spark, folder, "documents").selectExpr("doc_id", f"{adapters.FILE_NAME} as file_name")
    return named.select("doc_id", F.date_format(text.upload_time(F.col("file_name")), "yyyy-MM-dd HH:mm:ss").alias("uploaded_at"))


@registered
def dashboard(spark: SparkSession, folder: str) -> DataFrame:
    """All dashboard tables of the served uploads as rows of table, entry and value."""
    tables = serving.dashboard_tables(_served(spark, folder))

    def rows(name: str, entry: F.Column, value: F.Column) -> DataFrame:
        return tables[name].select(F.lit(name).alias("name"), entry.cast("string").alias("entry"),
                                   value.cast("long").alias("value"))

    parts = [rows("summary", F.lit("total_reviews"), F.col("total_reviews")),
             rows("summary", F.lit("short_reviews_flagged"), F.col("short_reviews_flagged")),
             rows("distribution", F.col("prediction"), F.col("n_reviews")),
             rows("histogram", F.col("bin"), F.col("n_reviews")),
             rows("top_reviews", F.concat_ws("-", "prediction", "rank"), F.col("upload_id"))]
    return reduce(DataFrame.unionByName, parts)


@registered
def partitioned_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "processed")
    writers.write_scored(_cleaned(spark, folder).select("upload_id", "user_name", "review_clean"), path)
    return readers.read_partitioned(spark, path, ["user_name"])


@registered
def split_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "split")
    writers.write_split(training_data.ingest(adapters.reviews(spark, folder)), path)
    return readers.read_stage(spark, path).groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("star_rating").alias("total_rating"))


@registered
def metrics_json_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "cleaning-summary")
    writers.write_metrics(uploads.clean_summary(adapters.uploads(spark, folder)), path)
    return readers.read_metrics_json(spark, path, CLEANING_SUMMARY)


def _as_files(df: DataFrame) -> DataFrame:
    """A stream over the rows, written as upload files of a user ``guest``, half of them in reversed column order."""
    path = scratch_path(df.sparkSession, "incoming")
    half = F.pmod(F.xxhash64(df.columns[0]), F.lit(2)) == 0
    writers.export_csv(df.filter(half), f"{path}/one/guest")
    writers.export_csv(df.filter(~half), f"{path}/two/guest", df.columns[::-1])
    return stream.upload_stream(df.sparkSession, path)


@registered
def stream_upload_clean(spark: SparkSession, folder: str) -> DataFrame:
    out = scratch_path(spark, "cleaned")
    stream.clean_uploads(_as_files(adapters.uploads(spark, folder)), out, f"{out}-checkpoint").awaitTermination()
    return (readers.read_partitioned(spark, out, ["user_name"])
            .select("upload_id", "user_name", "review", "review_clean", "short_review"))


@registered
def stream_turn_clean(spark: SparkSession, folder: str) -> DataFrame:
    """Files with other columns than the usual upload."""
    out = scratch_path(spark, "turns")
    stream.clean_uploads(_as_files(adapters.turns(spark, folder)), out, f"{out}-checkpoint").awaitTermination()
    return (readers.read_partitioned(spark, out, ["user_name"])
            .select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                    "user_name", "review", "review_clean", "short_review"))


@registered
def stream_upload_summary(spark: SparkSession, folder: str) -> DataFrame:
    out = scratch_path(spark, "served")
    trained = model.train_nb(adapters.labelled_documents(spark, folder))
    stream.score_uploads(_as_files(adapters.uploads(spark, folder)), lambda batch: uploads.score_upload(batch, trained),
                         out, f"{out}-checkpoint").awaitTermination()
    summary.update(spark, out).awaitTermination()
    return _joined_lists(summary.read(spark, out))
