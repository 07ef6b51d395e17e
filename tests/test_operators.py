"""Row operators, audits, samples and rankings."""

import hashlib

import pytest
from pyspark.sql import functions as F

from opinion_engine.functions import scores
from opinion_engine.operators import labels, quality, ranking, reviews, sampling, serving
from opinion_engine.plans import training_data, uploads

LAYOUTS = (1, 3, 8)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def key(i, seed=42):
    return hashlib.md5(f"{seed}:{i}".encode()).hexdigest()


@pytest.fixture(scope="module")
def raw(spark):
    """300 reviews; a third of them carry the same text, some texts are missing."""
    def body(i):
        if i % 3 == 0:
            return "The  same TEXT"
        return {1: None, 2: "", 5: "   "}.get(i % 20, f"Review number {i % 90}\tis  fine")

    data = [(i, f"cat{i % 4}", [None, "abc", "3", "5", "1", "4.9", "-2"][i % 7], body(i),
             None if i % 11 == 0 else f" Head {i} ") for i in range(300)]
    return spark.createDataFrame(
        data, "review_id long, product_category string, star_rating string, review_body string, review_headline string")


def test_project_and_empty(raw):
    wide = raw.withColumn("extra", F.lit(1))
    assert reviews.project_reviews(wide).columns == raw.columns
    assert reviews.project_reviews(wide.drop("review_id")).columns == raw.columns[1:]
    kept = reviews.drop_empty(raw)
    assert kept.filter("review_body is null or review_body = ''").count() == 0
    assert kept.filter("review_body = '   '").count() > 0


def test_dedup_keeps_lowest_id_on_any_layout(raw):
    texts = {}
    for r in raw.collect():
        if r["review_body"]:
            text = " ".join(r["review_body"].split())
            texts.setdefault(text.lower(), r["review_id"])
    for n in LAYOUTS:
        got = training_data.preprocess(raw.repartition(n))
        assert sorted(r["review_id"] for r in got.collect()) == sorted(texts.values())
    assert training_data.preprocess(raw, drop_blank=True).count() == len(texts) - 1


def test_dedup_treats_missing_texts_as_equal(spark):
    df = spark.createDataFrame([(2, None), (1, None), (3, "a")], "review_id long, review_body string")
    assert rows(reviews.dedup_text(df)) == [(1, None), (3, "a")]


def test_preprocess_audit_adds_up(raw):
    audit = quality.preprocess_audit(raw).first()
    assert audit["original_rows"] == 300
    assert audit["retained_rows"] == training_data.preprocess(raw).count()
    assert audit["original_rows"] == audit["dropped_empty"] + audit["dropped_duplicates"] + audit["retained_rows"]


def test_range_audit(spark):
    df = spark.createDataFrame([("-1",), ("6",), ("5",), ("x",), (None,), ("0",)], "star_rating string")
    assert tuple(quality.rating_range_audit(df).first()) == (6, 1, 1, 2)


def test_validate_and_flag(spark):
    df = spark.createDataFrame(
        [(1, "c", 5, "a" * 9, "h"), (2, "c", 4, "a" * 10, "h"), (3, "c", 9, "a" * 100, "h"),
         (4, "c", -1, "", "h"), (5, "c", 3, None, "h"), (6, "c", 3, "text", None)],
        "review_id long, product_category string, star_rating int, review_body string, review_headline string")
    valid = training_data.validate(df)
    assert quality.length_stats(valid).first()[0] == (9 + 10 + 100) / 4
    flagged = {r["review_id"]: (r["anomaly_flag"], r["star_rating"]) for r in training_data.flag(valid).collect()}
    assert flagged == {1: (True, 5.0), 2: (False, 4.0), 3: (True, 5.0), 4: (True, None)}


def test_flag_uses_a_stored_average(spark):
    df = spark.createDataFrame([(1, 20), (2, 40)], "review_id long, review_length int")
    stored = spark.createDataFrame([(20.0,)], "avg_review_length double")
    assert [r["anomaly_flag"] for r in quality.flag_anomalies(df, stored).orderBy("review_id").collect()] == [False, True]
    empty = spark.createDataFrame([(None,)], "avg_review_length double")
    assert not quality.flag_anomalies(df, empty).filter("anomaly_flag").count()
    assert quality.flag_anomalies(df.limit(0)).count() == 0


def test_labels_and_distribution(raw):
    rated = reviews.normalize_ratings(raw)
    labelled = labels.label_reviews(rated)
    assert labelled.filter("star_rating = 3 or star_rating is null").count() == 0
    document = labels.distribution_document(labels.class_distribution(labelled)).first()[0]
    assert document == {int(r["label"]): r["n"] for r in labels.class_distribution(labelled).collect()}


def test_hash_split_is_a_partition_of_the_rows(spark):
    df = spark.range(20_000).withColumnRenamed("id", "review_id")
    want = rows(sampling.hash_split(df))
    for n in LAYOUTS:
        assert rows(sampling.hash_split(df.repartition(n))) == want
    counts = {r["split"]: r["count"] for r in sampling.hash_split(df).groupBy("split").count().collect()}
    assert set(counts) == {"train", "test", "serve"} and sum(counts.values()) == 20_000
    assert abs(counts["train"] - 16_000) < 300 and abs(counts["test"] - 2_000) < 200
    with pytest.raises(ValueError):
        sampling.hash_split(df, shares={"a": 50})


def test_random_split_covers_the_rows(spark):
    df = spark.range(1000).withColumnRenamed("id", "review_id")
    parts = sampling.random_split(df)
    assert sorted(r[0] for p in parts for r in p.collect()) == list(range(1000))


@pytest.mark.parametrize("cap", [0, 1, 7, 400, 10_000])
def test_balanced_sample_takes_the_smallest_keys(spark, cap):
    df = spark.range(3000).select(F.col("id").alias("review_id"), (F.col("id") % 4 == 0).cast("int").alias("label"))
    want = []
    for label in (0, 1):
        ids = [i for i in range(3000) if (i % 4 == 0) == bool(label)]
        want += sorted(ids, key=key)[:min(cap, 750)]
    for n in LAYOUTS:
        got = sampling.balanced_sample(df.repartition(n), cap=cap)
        assert sorted(r["review_id"] for r in got.collect()) == sorted(want)
    assert sampling.balanced_size(df, cap=cap).first()[0] == min(cap, 750)


def test_balanced_sample_needs_both_classes(spark):
    df = spark.range(50).select(F.col("id").alias("review_id"), F.lit(1).alias("label"))
    assert sampling.balanced_sample(df).count() == 0
    assert sampling.per_class_sample(df, n=20).count() == 20


def test_per_class_sample_strict(spark):
    df = spark.range(60).select(F.col("id").alias("review_id"), (F.col("id") < 20).cast("int").alias("label"))
    assert sampling.per_class_sample(df, n=20, strict=True).count() == 40
    assert sampling.per_class_sample(df, n=30).count() == 50
    with pytest.raises(ValueError):
        sampling.per_class_sample(df, n=30, strict=True)


def test_shuffle_keeps_the_rows(spark):
    df = spark.range(100).withColumnRenamed("id", "review_id")
    got = [r[0] for r in sampling.shuffle_rows(df).collect()]
    assert got != sorted(got) and sorted(got) == list(range(100))
    assert got == [r[0] for r in sampling.shuffle_rows(df.repartition(5)).collect()]


def test_holdout_shares_no_text_with_the_sample(spark):
    data = [(i, 5 if i % 3 else 1, "copy" if i % 3 == 0 else f"text\n{i % 200}") for i in range(900)]
    df = spark.createDataFrame(data + [(1000, 5, None)], "review_id long, star_rating int, review_body string")
    parts = training_data.build_training_set(df, cap=50)
    sampled = {r["review_body"] for r in parts.sample.collect()}
    remaining = rows(parts.remaining.select("review_id", "review_body"))
    assert parts.sample.count() == 100 and "copy" in sampled
    labelled = rows(parts.labelled.select("review_id", "review_body"))
    assert remaining == [r for r in labelled if r[1] not in sampled]
    assert not any("\n" in (r[1] or "") for r in labelled)
    assert (1000, None) in remaining or None in sampled
    unbounded = sampling.holdout_remaining(parts.labelled, parts.sample)
    assert rows(unbounded.select("review_id", "review_body")) == remaining
    document = training_data.sampling_document(df, parts.labelled, parts.sample, parts.remaining).first()
    assert document["remaining_after_sampling"] == len(remaining)
    assert document["sampled_class_counts"].asDict() == {"positive": 50, "negative": 50}
    assert document["original_class_distribution"] == {0: 300, 1: 601}
    assert document["dropped_3_star_reviews"] == 0


def test_sample_may_leave_out_anomalies(spark):
    df = spark.createDataFrame([(1, 5, "a", True), (2, 1, "b", False), (3, 5, "c", False)],
                               "review_id long, star_rating int, review_body string, anomaly_flag boolean")
    assert training_data.build_training_set(df).labelled.count() == 3
    assert training_data.build_training_set(df, exclude_anomalies=True).labelled.count() == 2


def test_clean_upload_and_summary(spark):
    data = [(0, "  A perfectly fine PRODUCT that works as it should  "), (1, None), (2, ""), (3, "   "),
            (4, "123 456"), (5, "Bad"), (6, "1 2\t3")]
    df = spark.createDataFrame(data, "upload_id long, review string").withColumn("stars", F.lit(4))
    clean = uploads.clean_upload(df)
    assert clean.columns == ["upload_id", "review", "stars", "review_clean", "short_review"]
    assert rows(clean.select("upload_id", "review", "review_clean", "short_review")) == [
        (0, "A perfectly fine PRODUCT that works as it should",
         "a perfectly fine product that works as it should", False),
        (5, "Bad", "bad", True)]
    assert uploads.clean_summary(df).first().asDict() == {
        "original_rows": 7, "dropped_null_or_empty": 3, "dropped_numeric_only": 2,
        "short_reviews_flagged": 1, "retained_clean_reviews": 2}


def test_first_rows_with_one_hot_group(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 10 == 0, "rare").otherwise("hot").alias("g"))
    for n in (1, 40):
        got = ranking.first_rows(df.repartition(n), 3, [F.desc("id")], ["g"])
        assert rows(got.select("g", "rank", "id")) == [
            ("hot", 1, 4999), ("hot", 2, 4998), ("hot", 3, 4997),
            ("rare", 1, 4990), ("rare", 2, 4980), ("rare", 3, 4970)]
        overall = ranking.first_rows(df.repartition(n), 2, [F.col("id")])
        assert rows(overall.select("rank", "id")) == [(1, 0), (2, 1)]


def served(spark):
    data = [(i, f"user{i % 2}", "x" * (i + 1), i % 5 == 0, "positive" if i % 3 else "negative") for i in range(30)]
    return spark.createDataFrame(
        data, "upload_id long, user_name string, review_clean string, short_review boolean, prediction string")


def test_summary(spark):
    df = served(spark)
    got = serving.summarize(df.repartition(7)).first().asDict()
    positive = ["x" * (i + 1) for i in range(30) if i % 3]
    negative = ["x" * (i + 1) for i in range(30) if i % 3 == 0]
    assert got == {
        "total_reviews": 30, "positive_reviews": 20, "negative_reviews": 10, "neutral_reviews": 0,
        "average_review_length": 15.5, "short_reviews_flagged": 6,
        "top_positive_reviews": positive[:5], "top_negative_reviews": negative[:5]}
    users = {r["user_name"]: r for r in serving.summarize(df, ["user_name"]).collect()}
    assert users["user0"]["top_negative_reviews"] == ["x" * (i + 1) for i in range(0, 30, 6)]
    assert sum(u["total_reviews"] for u in users.values()) == 30


def test_summary_without_short_flag_or_class(spark):
    df = served(spark).filter("prediction = 'positive'").drop("short_review")
    got = serving.summarize(df).first()
    assert got["short_reviews_flagged"] == 0 and got["top_negative_reviews"] == []
    by_user = serving.summarize(df.filter("upload_id < 0"), ["user_name"])
    assert by_user.count() == 0
    nothing = serving.summarize(df.filter("upload_id < 0")).first()
    assert nothing["total_reviews"] == 0 and nothing["average_review_length"] is None


def test_summary_parts_add_up(spark):
    df = served(spark)
    halves = [df.filter("upload_id < 11"), df.filter("upload_id >= 11")]
    counts = serving.summary_counts(halves[0], ["user_name"]).unionByName(serving.summary_counts(halves[1], ["user_name"]))
    merged = serving.merge_counts(counts, ["user_name"])
    assert rows(merged) == rows(serving.summary_counts(df, ["user_name"]))


def test_distribution_and_dashboard(spark):
    tables = serving.dashboard_tables(served(spark))
    assert [tuple(r) for r in tables["distribution"].collect()] == [("positive", 20), ("negative", 10)]
    assert tables["top_reviews"].count() == 10
    histogram = tables["histogram"].orderBy("bin").collect()
    assert len(histogram) == 30 and sum(r["n_reviews"] for r in histogram) == 30
    assert histogram[0]["from_length"] == 1.0 and histogram[-1]["to_length"] == pytest.approx(30.0)


def test_histogram_of_equal_lengths(spark):
    df = spark.createDataFrame([("abcd",)] * 6 + [(None,)], "review_clean string")
    filled = [tuple(r) for r in serving.length_histogram(df).collect() if r["n_reviews"]]
    assert filled == [(15, pytest.approx(4.0), pytest.approx(4.0 + 1 / 30), 6)]


def test_top_confident_breaks_ties_by_id(spark):
    df = spark.range(40).select(
        F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("prediction"),
        F.lit(0.9).alias("positive_score"), F.lit(0.1).alias("negative_score"))
    got = serving.top_confident(df.repartition(6))
    assert rows(got.select("prediction", "rank", "doc_id", "confidence")) == (
        [(0, r + 1, 2 * r, 0.1) for r in range(5)] + [(1, r + 1, 2 * r + 1, 0.9) for r in range(5)])


def test_named_label_defaults(spark):
    df = spark.createDataFrame([(7,)], "label int")
    assert df.select(scores.name_label(F.col("label"), {7: "seven"})).first()[0] == "seven"
    assert df.select(scores.name_label(F.col("label"), default="?")).first()[0] == "?"
