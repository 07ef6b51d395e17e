"""Training, scoring, evaluation."""

import math

import pytest
from pyspark.sql import functions as F

from opinion_engine.operators import evaluation, model, scoring
from opinion_engine.plans import modelling

TEXTS = ["good good product", "really GOOD thing", "bad thing", "awful bad product", "good, not bad", "123"]
LABELS = [1, 1, 0, 0, 1, 0]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(zip(range(6), TEXTS, LABELS)), "doc_id long, text string, label int")


def words_of(text):
    return set("".join(c if c.isalpha() else " " for c in (text or "").lower()).split())


def brute_weights(a, min_docs):
    sets = [words_of(t) for t in TEXTS]
    n1, n0 = sum(LABELS), LABELS.count(0)
    out = {"": math.log((n1 + a) / (n0 + a))}
    for w in set().union(*sets):
        c1 = sum(1 for s, l in zip(sets, LABELS) if l and w in s)
        c0 = sum(1 for s, l in zip(sets, LABELS) if not l and w in s)
        if c1 + c0 >= min_docs:
            out[w] = math.log((c1 + a) / (n1 + 2 * a)) - math.log((c0 + a) / (n0 + 2 * a))
    return out, sets


@pytest.mark.parametrize("min_docs", [1, 2])
def test_weights_and_scores_by_hand(docs, min_docs):
    want, sets = brute_weights(0.5, min_docs)
    trained = model.train_nb(docs, smoothing=[0.5], min_docs=min_docs)
    got = {r["token"]: r["weight_0"] for r in trained.weights.collect()}
    assert got == pytest.approx(want, abs=1e-12)
    assert trained.n_tokens == len(want)
    scored = {r["doc_id"]: r["logit_0"] for r in scoring.score_weights(docs, trained).collect()}
    assert scored == pytest.approx({i: sum(want.get(w, 0) for w in [*s, ""]) for i, s in enumerate(sets)}, abs=1e-8)


def test_prior(spark, docs):
    """Zero for balanced classes; else the log odds of the classes, which a text without words gets."""
    assert model.class_prior(docs).first()["weight_0"] == 0
    skewed = docs.filter("label = 1 or doc_id = 2")
    prior = model.class_prior(skewed, smoothing=[0.5, 1.0]).first()
    assert (prior["weight_0"], prior["weight_1"]) == pytest.approx((math.log(3.5 / 1.5), math.log(4 / 2)))
    empty = spark.createDataFrame([(None, 1), ("", 1), ("?!", 2)], "text string, doc_id int")
    scored = scoring.score_rows(empty, model.train_nb(skewed), "text").collect()
    assert {round(r["positive_score"], 9) for r in scored} == {round(4 / 6, 9)}


def test_token_counts(docs):
    got = {r["token"]: r["n_docs"] for r in model.token_counts(docs, "doc_id", "text").collect()}
    assert got["good"] == 3 and got["bad"] == 3 and got["not"] == 1 and "" not in got


def tricky(spark):
    """Null and repeated ids, missing texts, other scripts, long texts."""
    texts = TEXTS + [None, "", "GOOD-BAD", "Know good", "goİod bad", "naïve good", "Привет, schön", "z" * 100_000,
                     "good " * 20_000]
    ids = [None, None, 3, 3, 3, *range(5, len(texts))]
    return spark.createDataFrame(list(zip(ids, texts, range(len(texts)))), "doc_id long, text string, place int")


def test_all_scoring_paths_agree(spark, docs, monkeypatch):
    extra = spark.createDataFrame([("know", 1, 3.0), ("od", 2, 5.0), ("go", 9, -2.0), ("привет", 1, 1.5), ("schön", 3, 0.25),
                                   ("naïve", 1, 0.125)], "token string, n_docs long, weight_0 double")
    weights = model.train_nb(docs, min_docs=1).weights.unionByName(extra)
    trained = model.stored_model(weights)
    rows = tricky(spark).repartition(3)
    known = {r["token"]: r["weight_0"] for r in weights.collect()}
    want = {r["place"]: sum(known.get(w, 0) for w in words_of(r["text"])) + known[""] for r in rows.collect()
            if r["text"] is None or "İ" not in r["text"]}

    def logits(df):
        return {r["place"]: r["logit_0"] for r in df.collect()}

    joined = logits(scoring.score_weights(rows, trained, "place"))
    assert {p: joined[p] for p in want} == pytest.approx(want, abs=1e-8) and len(joined) == rows.count()
    assert logits(scoring._scored_in_task(rows, trained, "text")) == joined and trained.head_docs == 1
    assert logits(scoring._scored_by_join(rows, trained, "text")) == joined
    small = scoring.score_rows(rows, trained, "text")
    assert small.columns == [*rows.columns, "positive_score", "negative_score", "prediction_label", "prediction"]
    in_task = sorted(map(tuple, small.collect()), key=lambda r: r[2])
    assert [r[2] for r in in_task] == list(range(rows.count()))

    # Only the frequent tokens, then none, fit in a broadcast; neither fits in a task.
    for limit in (400, 0):
        monkeypatch.setattr(model, "BROADCAST_BYTES", limit)
        split = model.stored_model(weights)
        assert split.head_docs > 1 and split.n_tokens == trained.n_tokens
        assert logits(scoring.score_weights(rows, split, "place")) == joined
        monkeypatch.setattr(model, "BROADCAST_BYTES", min(limit, 16))
        large = scoring.score_rows(rows, split, "text")
        assert large.columns == small.columns
        assert sorted(map(tuple, large.collect()), key=lambda r: r[2]) == in_task
    with pytest.raises(ValueError):
        scoring.token_scorer(trained)


def test_tokens_do_not_move_the_texts_in_task(spark, docs):
    plan = scoring.score_rows(tricky(spark), model.train_nb(docs), "text")._jdf.queryExecution().toString()
    assert "Exchange" not in plan.split("== Physical Plan ==")[1]


def test_own_model_in_tasks(spark):
    df = spark.createDataFrame([("abc", 1), ("", 2), (None, 3)], "text string, other int")

    def load():
        return lambda texts: [float(len(t or "")) for t in texts.to_pylist()]

    got = scoring.with_scores(scoring.score_with_model(df, load, "text"))
    assert [tuple(r)[:3] for r in got.orderBy("other").collect()] == [("abc", 1, 3.0), ("", 2, 0.0), (None, 3, 0.0)]
    assert [r["prediction"] for r in got.orderBy("other").collect()] == ["positive", "negative", "negative"]


def test_published_metrics(spark):
    """20,000 predictions with 9,178 true and 550 false positives, 822 false and 9,450 true negatives."""
    n = F.col("id")
    df = spark.range(20_000).select(
        (n < 10_000).cast("int").alias("label"),
        ((n < 9_178) | ((n >= 10_000) & (n < 10_550))).cast("int").alias("prediction"))
    got = evaluation.classification_metrics(df).first().asDict()
    assert got == pytest.approx({"accuracy": 0.9314, "precision": 0.9434621710526315, "recall": 0.9178,
                                 "f1": 0.9304541768045418}, abs=1e-12)
    assert evaluation.class_summary(df).first().asDict() == {
        "actual_positive": 10_000, "actual_negative": 10_000, "predicted_positive": 9_728, "predicted_negative": 10_272}
    assert {(r["label"], r["prediction"]): r["n"] for r in evaluation.confusion(df).collect()} == {
        (1, 1): 9_178, (0, 1): 550, (1, 0): 822, (0, 0): 9_450}


@pytest.mark.parametrize("rows", [[(1, 0), (0, 0)], [(0, 1), (0, 0)], [(0, 0)]])
def test_undefined_metrics_are_zero(spark, rows):
    got = evaluation.classification_metrics(spark.createDataFrame(rows, "label int, prediction int")).first()
    assert (got["precision"], got["recall"], got["f1"]) == (0.0, 0.0, 0.0)


def test_log_loss(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.2), (1, 0.0)], "label int, positive_score double")
    want = -(math.log(0.9) + math.log(0.8) + math.log(1e-15)) / 3
    assert evaluation.log_loss(df).first()[0] == pytest.approx(want, abs=1e-9)


def test_best_of_equals_is_the_least_smoothed(spark):
    df = spark.createDataFrame([(2.0, 0.8), (0.5, 0.9), (0.1, 0.7), (1.0, 0.9)], "smoothing double, f1 double")
    assert evaluation.select_best(df).first().asDict() == {"smoothing": 0.5, "f1": 0.9}


def test_train_choose_evaluate(spark):
    n = F.col("id")
    words = F.when(n % 2 == 0, F.concat(F.lit("great lovely item "), n)).otherwise(F.concat(F.lit("poor broken item "), n))
    df = spark.range(400).select(n.alias("doc_id"), words.alias("text"), (n % 2 == 0).cast("int").alias("label"))
    grid = model.SMOOTHING_GRID
    candidates, metrics = modelling.train_and_evaluate(df.filter("doc_id < 300"), df.filter("doc_id >= 300"))
    table = metrics.orderBy("smoothing").collect()
    assert [r["smoothing"] for r in table] == list(grid) and {r["f1"] for r in table} == {1.0}
    best = evaluation.select_best(metrics)
    chosen = modelling.chosen(candidates, best, grid)
    assert chosen.columns == ("weight_0",) and chosen.n_tokens == candidates.n_tokens
    assert modelling.score_test_set(df.filter("doc_id >= 300"), chosen).count() == 100
    scored = modelling.score_test_set(df.filter("doc_id >= 300"), chosen, n=20)
    document = modelling.evaluation_document(scored, "demo").first()
    assert document["metrics"]["eval_f1"] == 1.0 and document["metrics"]["eval_loss"] < 0.1
    assert document["class_summary"].asDict() == {"actual_positive": 20, "actual_negative": 20,
                                                  "predicted_positive": 20, "predicted_negative": 20}
    assert len(document["sample_reviews"]["top_predicted_positive"]) == 5
    assert all("great" in t for t in document["sample_reviews"]["top_predicted_positive"])
    with pytest.raises(ValueError):
        modelling.score_test_set(df.filter("doc_id >= 300"), chosen, n=60, strict=True)


def test_logistic_regression_learns(spark):
    n = F.col("id")
    words = F.when(n % 2 == 0, "great lovely item").otherwise("poor broken item")
    df = spark.range(60).select(n.alias("doc_id"), words.alias("text"), (n % 2 == 0).cast("int").alias("label"))
    scored = scoring.score_lr(df, model.train_lr(df, features=1 << 10))
    assert evaluation.classification_metrics(scored, "label", "prediction_label").first()["accuracy"] == 1.0
    assert scored.columns == [*df.columns, "positive_score", "negative_score", "prediction_label", "prediction"]
