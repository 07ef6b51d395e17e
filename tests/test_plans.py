"""Whole jobs from CSV files to stored tables and documents."""

from opinion_engine import schema
from opinion_engine.operators import model
from opinion_engine.plans import modelling, training_data, uploads
from opinion_engine.sources import readers


def test_training_data_job(spark, tmp_path):
    lines = ["product_category,star_rating,review_body,review_headline"]
    for i in range(400):
        body = "" if i % 20 == 0 else f'"Review {i % 150}, ""quoted""\nwith  lines {"x" * (i % 60)}"'
        lines.append(f"c{i % 3},{[1, 2, 3, 4, 5, 'bad', 9][i % 7]},{body},Head {i}")
    source = tmp_path / "raw.csv"
    source.write_text("\n".join(lines) + "\n")
    out = f"{tmp_path}/out"
    training_data.run(spark, str(source), out, cap=30)

    split = readers.read_stage(spark, f"{out}/split")
    assert split.count() == 380
    audit = spark.read.json(f"{out}/documents/preprocess_audit").first()
    clean = readers.read_stage(spark, f"{out}/pre_processed")
    assert audit["retained_rows"] == clean.count() == clean.select("review_body").distinct().count()
    flagged = readers.read_stage(spark, f"{out}/anomaly_flagged")
    assert {"review_length", "anomaly_flag"} <= set(flagged.columns)
    average = readers.read_metrics_json(spark, f"{out}/documents/avg_review_length", schema.AVERAGE_LENGTH)
    assert average.first()[0] > 0
    sample = readers.read_stage(spark, f"{out}/train_final")
    exported = readers.read_training_csv(spark, f"{out}/sampled_csv")
    assert sorted(map(tuple, exported.collect())) == sorted(
        map(tuple, sample.select("review_body", "label").collect()))
    counts = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    assert counts == {0: 30, 1: 30}
    document = readers.read_metrics_json(
        spark, f"{out}/documents/class_distribution", schema.CLASS_DISTRIBUTION).first()
    remaining = readers.read_stage(spark, f"{out}/remaining")
    assert document["remaining_after_sampling"] == remaining.count()
    assert sum(document["original_class_distribution"].values()) + document["dropped_3_star_reviews"] == flagged.count()
    assert not set(r[0] for r in remaining.select("review_body").collect()) & set(
        r[0] for r in sample.select("review_body").collect())


def test_upload_job(spark, tmp_path):
    docs = spark.createDataFrame([(i, "good nice" if i % 2 else "bad poor", i % 2) for i in range(20)],
                                 "doc_id long, text string, label int")
    trained = model.train_nb(docs)
    source = tmp_path / "upload.csv"
    source.write_text('stars,review\n1,"A good and really nice thing, it does all it should"\n2,Bad poor\n3,\n4,42\n5,?\n')
    out = f"{tmp_path}/out"
    tables = uploads.run(spark, str(source), "someone", trained, out)
    summary = readers.read_metrics_json(
        spark, f"{out}/metadata/someone/inference_summary", schema.INFERENCE_SUMMARY).first()
    assert (summary["total_reviews"], summary["positive_reviews"], summary["negative_reviews"]) == (3, 1, 2)
    assert summary["top_negative_reviews"] == ["bad poor", "?"]
    cleaning = readers.read_metrics_json(
        spark, f"{out}/metadata/someone/preprocessing_summary", schema.CLEANING_SUMMARY).first()
    assert cleaning.asDict() == {"original_rows": 5, "dropped_null_or_empty": 1, "dropped_numeric_only": 1,
                                 "short_reviews_flagged": 2, "retained_clean_reviews": 3}
    assert set(tables) == {"summary", "distribution", "histogram", "top_reviews"}
    assert {"stars", "review", "prediction"} <= set(readers.read_user_partition(spark, f"{out}/served", "someone").columns)


def test_modelling_job(spark, tmp_path):
    lines = ["product_category,star_rating,review_body,review_headline"]
    for i in range(300):
        word = "great lovely" if i % 2 else "poor broken"
        lines.append(f"c,{5 if i % 2 else 1},A {word} item number {i},Head")
    source = tmp_path / "raw.csv"
    source.write_text("\n".join(lines) + "\n")
    data, out = f"{tmp_path}/data", f"{tmp_path}/model"
    training_data.run(spark, str(source), data, cap=60)
    modelling.run(spark, f"{data}/sampled_csv", f"{data}/remaining", out)
    document = readers.read_metrics_json(
        spark, f"{out}/documents/model_evaluation", schema.EVALUATION_SUMMARY).first()
    assert document["metrics"]["eval_f1"] == 1.0 and document["model_name"] == "naive-bayes"
    tested_rows = readers.read_stage(spark, f"{out}/tested")
    classes = document["class_summary"]
    assert classes["actual_positive"] + classes["actual_negative"] == tested_rows.count() and document["timestamp"]
    remaining = readers.read_stage(spark, f"{data}/remaining")
    assert 0 < tested_rows.count() < remaining.count()
    assert readers.read_stage(spark, f"{out}/candidates").count() == len(model.SMOOTHING_GRID)
    tested = readers.read_scored_csv(spark, f"{out}/tested_csv")
    assert tested.columns == ["text", "label", "prediction"] and tested.count() == tested_rows.count()
    loaded = model.load_model(spark, f"{out}/model")
    assert loaded.columns == ("weight_0",) and loaded.n_tokens > 0
