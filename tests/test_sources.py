"""Readers and writers, through round trips."""

import glob

import pytest
from pyspark.sql import functions as F

from opinion_engine import schema, session
from opinion_engine.plans import training_data, uploads
from opinion_engine.sources import readers, writers

CELLS = ['he said "hi", ok', "line1\nline2", "line1\r\nline2", "back\\slash", "null", "nan", "NaN", "", None,
         "  spaces kept  ", '"', '""', ",", "\\", '\\"', "tab\tend\t", "#not a comment", "naïve 😀"]


def explained(df) -> str:
    return df._jdf.queryExecution().toString()


def test_csv_cells_survive(spark, tmp_path):
    df = spark.createDataFrame(list(enumerate(CELLS)), "upload_id long, review string")
    writers.export_csv(df, f"{tmp_path}/a")
    got = readers.read_scored_csv(spark, f"{tmp_path}/a").orderBy("upload_id").collect()
    assert [tuple(r) for r in got] == list(enumerate(CELLS))


def test_scored_columns_are_typed(spark, tmp_path):
    df = spark.createDataFrame([("1", "true", "0.5", "x")],
                               "upload_id string, short_review string, positive_score string, review string")
    writers.export_csv(df, f"{tmp_path}/a")
    assert dict(readers.read_scored_csv(spark, f"{tmp_path}/a").dtypes) == {
        "upload_id": "bigint", "short_review": "boolean", "positive_score": "double", "review": "string"}


def test_one_file_is_asked_for(spark, tmp_path):
    df = spark.range(100).repartition(5)
    writers.export_csv(df, f"{tmp_path}/one", single_file=True)
    writers.export_csv(df, f"{tmp_path}/many")
    parts = [len(glob.glob(f"{tmp_path}/{d}/part-*.csv")) for d in ("one", "many")]
    assert parts == [1, 5]


def test_one_file_keeps_the_order(spark, tmp_path):
    df = spark.range(5000).repartition(7).orderBy("id")
    writers.export_csv(df, f"{tmp_path}/one", single_file=True)
    (file,) = glob.glob(f"{tmp_path}/one/part-*.csv")
    assert open(file).read().split() == ["id", *map(str, range(5000))]


def test_files_with_other_column_orders(spark, tmp_path):
    (tmp_path / "a.csv").write_text("review_body,label\ngood,1\n")
    (tmp_path / "b.csv").write_text("label,extra,review_body\n0,x,\"bad, 1\"\n")
    (tmp_path / "empty.csv").write_text("")
    got = readers.read_training_csv(spark, str(tmp_path))
    assert got.schema == schema.TRAINING and sorted(map(tuple, got.collect())) == [("bad, 1", 0), ("good", 1)]
    named = readers.read_reviews_csv(spark, str(tmp_path)).select("label", "extra", "review_body")
    assert sorted(map(tuple, named.collect())) == [("0", "x", "bad, 1"), ("1", None, "good")]


def test_header_names_the_columns_whatever_their_order(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text("extra,review_headline,review_body,star_rating,product_category\n"
                    "1,Head,\"Body, with \"\"quotes\"\"\nand a line\",4.7,toys\n2,H2,,3,toys\n")
    df = readers.with_row_id(readers.read_reviews_csv(spark, str(path)))
    assert {t for _, t in df.drop("review_id").dtypes} == {"string"}
    got = training_data.ingest(df).collect()
    assert [(r["product_category"], r["star_rating"], r["review_body"]) for r in got] == [
        ("toys", 4, 'Body, with "quotes"\nand a line')]


def test_resolve_text_column(spark):
    both = spark.createDataFrame([("a", "b")], "review string, review_body string")
    assert readers.resolve_text_column(both) == "review_body"
    assert readers.resolve_text_column(both.drop("review_body")) == "review"
    with pytest.raises(ValueError):
        uploads.clean_upload(both.select(F.lit(1).alias("other")))


def test_user_partition_reads_one_folder(spark, tmp_path):
    df = spark.createDataFrame([(i, ["007", "42", "a b"][i % 3], f"t{i}") for i in range(30)],
                               "upload_id long, user_name string, review_clean string")
    writers.write_scored(df, f"{tmp_path}/t")
    got = readers.read_user_partition(spark, f"{tmp_path}/t", "007")
    assert {r["user_name"] for r in got.collect()} == {"007"} and got.count() == 10
    assert "PartitionFilters: [isnotnull(user_name" in explained(got)
    writers.write_scored(df.filter("user_name = '42'").limit(1), f"{tmp_path}/t")
    back = readers.read_partitioned(spark, f"{tmp_path}/t", ["user_name"])
    counts = {r["user_name"]: r["count"] for r in back.groupBy("user_name").count().collect()}
    assert counts == {"007": 10, "42": 1, "a b": 10}


def test_split_table_is_pruned(spark, tmp_path):
    df = spark.createDataFrame([(i, "c", "5", f"b{i}", "h") for i in range(200)],
                               "review_id long, product_category string, star_rating string, "
                               "review_body string, review_headline string")
    writers.write_split(training_data.ingest(df), f"{tmp_path}/s")
    back = readers.read_stage(spark, f"{tmp_path}/s")
    assert back.count() == 200
    assert "PartitionFilters: [isnotnull(split" in explained(back.filter("split = 'test'").select("review_id"))


def test_filters_reach_the_scan(spark, tmp_path):
    from opinion_engine.operators import labels, reviews
    df = spark.createDataFrame([(1, 5, "a", "h")], "review_id long, star_rating int, review_body string, review_headline string")
    writers.write_stage(df, f"{tmp_path}/t")
    stage = readers.read_stage(spark, f"{tmp_path}/t")
    plan = explained(reviews.drop_empty(labels.drop_neutral(stage)).select("review_id"))
    for pushed in ("Not(EqualTo(star_rating,3))", "Not(EqualTo(review_body,))"):
        assert pushed in plan
    assert "review_headline" not in plan.split("== Physical Plan ==")[1]


def test_json_documents(spark, tmp_path):
    document = spark.createDataFrame([(12.5,)], schema.AVERAGE_LENGTH)
    writers.write_metrics(document, f"{tmp_path}/m")
    assert readers.read_metrics_json(spark, f"{tmp_path}/m", schema.AVERAGE_LENGTH).first()[0] == 12.5
    indented = tmp_path / "i.json"
    indented.write_text('{\n  "total_reviews": 3,\n  "top_positive_reviews": ["a", "b"]\n}')
    got = readers.read_metrics_json(spark, str(indented), schema.INFERENCE_SUMMARY).first()
    assert got["total_reviews"] == 3 and got["top_positive_reviews"] == ["a", "b"]
    stamped = writers.stamped(document).first()
    assert stamped["timestamp"][10] == "T" and stamped["avg_review_length"] == 12.5


class Stub:
    """As much of a session as ``scratch_path`` asks for."""

    def __init__(self, setting=None, master="local[2]", context_dir=None):
        self.conf = self.sparkContext = self
        self.setting, self.master, self.context_dir = setting, master, context_dir

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.setting or default

    def getCheckpointDir(self):
        return self.context_dir

    def setCheckpointDir(self, path):
        self.context_dir = path


def test_scratch_folder():
    assert session.scratch_path(Stub("/shared/"), "x").startswith("/shared/x-")
    assert session.scratch_path(Stub("/shared", "yarn"), "x").startswith("/shared/x-")
    assert session.scratch_path(Stub(None, "yarn", "/set"), "x").startswith("/set/x-")
    local = Stub()
    assert session.scratch_path(local, "x").startswith(local.context_dir)
    with pytest.raises(ValueError):
        session.scratch_path(Stub(None, "yarn"), "x")


def test_materialize(spark):
    kept = session.materialize(spark.range(3), "r")
    assert sorted(r[0] for r in kept.collect()) == [0, 1, 2]
    assert "FileScan parquet" in explained(kept) or "Relation" in explained(kept)
