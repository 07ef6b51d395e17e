"""File streams give what the batch operators give."""

from pyspark.sql import functions as F

from opinion_engine.functions import scores, text
from opinion_engine.operators import serving
from opinion_engine.plans import uploads
from opinion_engine.sources import readers
from opinion_engine.streaming import summary
from opinion_engine.streaming import uploads as stream


def put(folder, stamp, rows):
    lines = ["user_name,review"] + [f'{u},"{t}"' for u, t in rows]
    (folder / f"{stamp}_reviews.csv").write_text("\n".join(lines) + "\n")


def score(df):
    """Longer than 40 characters is positive."""
    label = (text.text_length(F.col("review_clean")) > 40).cast("int")
    return df.withColumn("prediction", scores.name_label(label))


def batch(user, start, n):
    return [(user, f"Review {i:03d} of a thing\nthat is {'really quite nice' if i % 3 else 'bad'}")
            for i in range(start, start + n)] + [(user, " "), (user, "123")]


def test_cleaned_stream_equals_batch(spark, tmp_path):
    incoming = tmp_path / "in"
    incoming.mkdir()
    put(incoming, "20240131235959", batch("a", 0, 7))
    put(incoming, "undated", batch("b", 7, 3))
    out, check = f"{tmp_path}/out", f"{tmp_path}/check"
    stream.clean_uploads(stream.upload_stream(spark, str(incoming)), out, check).awaitTermination()
    put(incoming, "20240201000000", batch("a", 10, 4))
    stream.clean_uploads(stream.upload_stream(spark, str(incoming)), out, check).awaitTermination()
    got = readers.read_partitioned(spark, out, ["user_name"])
    want = uploads.clean_upload(readers.read_reviews_csv(spark, str(incoming)))
    columns = ["user_name", "review", "review_clean", "short_review"]
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, want.select(*columns).collect()))
    stamps = {r["file_name"]: str(r["uploaded_at"]) for r in got.select("file_name", "uploaded_at").distinct().collect()}
    assert stamps == {"20240131235959_reviews.csv": "2024-01-31 23:59:59", "undated_reviews.csv": "None",
                      "20240201000000_reviews.csv": "2024-02-01 00:00:00"}


def summarized(spark, out):
    summary.update(spark, out).awaitTermination()
    return summary.read(spark, out).orderBy("user_name").collect()


def by_user(rows):
    """The batch summary of the same rows."""
    return serving.summarize(rows, ["user_name"]).orderBy("user_name").collect()


def test_summary_over_batches_equals_one_pass(spark, tmp_path):
    incoming = tmp_path / "in"
    incoming.mkdir()
    out, check = f"{tmp_path}/out", f"{tmp_path}/check"
    for day, (user, start, n) in enumerate([("a", 0, 9), ("b", 9, 5), ("a", 14, 8)]):
        put(incoming, f"2024010{day + 1}000000", batch(user, start, n))
    files = stream.upload_stream(spark, str(incoming), files_per_batch=1)
    stream.score_uploads(files, score, out, check).awaitTermination()
    rows = spark.read.parquet(f"{out}/scored")
    assert rows.select("batch").distinct().count() == 3
    got = summarized(spark, out)
    assert got == by_user(rows) and [r["total_reviews"] for r in got] == [17, 5]
    assert got[0]["top_positive_reviews"][0].startswith("review 001 ")
    # Nothing new: nothing changes.
    stream.score_uploads(stream.upload_stream(spark, str(incoming)), score, out, check).awaitTermination()
    assert summarized(spark, out) == got
    # A later file is added to the totals, and a user comes anew.
    put(incoming, "20240104000000", batch("a", 40, 4) + batch("0", 50, 2) + [("", "No user is named here, in a long text")])
    stream.score_uploads(stream.upload_stream(spark, str(incoming)), score, out, check).awaitTermination()
    assert summarized(spark, out) == by_user(spark.read.parquet(f"{out}/scored"))
    # A stream with another checkpoint adds its own rows.
    other = tmp_path / "other"
    other.mkdir()
    put(other, "20240105000000", batch("c", 0, 4))
    stream.score_uploads(stream.upload_stream(spark, str(other)), score, out, f"{tmp_path}/check2").awaitTermination()
    users = {r["user_name"]: r["total_reviews"] for r in summarized(spark, out)}
    assert {u: n for u, n in users.items() if u in ("a", "b", "c")} == {"a": 21, "b": 5, "c": 4}


def test_a_share_counts_once_and_goes(spark, tmp_path):
    """A batch that ran again leaves its share a second time; shares that were taken up are deleted."""
    out = f"{tmp_path}/out"

    def share(number, user, n):
        rows = spark.createDataFrame([(i, user, "a good and quite long review text", "positive", False) for i in range(n)],
                                     "upload_id long, user_name string, review_clean string, prediction string, short_review boolean")
        folder = f"stream=s1/batch={number}"
        made = serving.summary_share(rows, "user_name").withColumn("source", F.lit(folder))
        made.coalesce(1).write.mode("append").parquet(f"{out}/shares/{folder}")

    for number in range(3):
        share(number, "a", number + 1)
        assert summarized(spark, out)[0]["total_reviews"] == (number + 1) * (number + 2) // 2
    share(1, "a", 2)
    assert summarized(spark, out)[0]["total_reviews"] == 6
    share(3, "b", 2)
    share(3, "a", 1)
    assert [r["total_reviews"] for r in summarized(spark, out)] == [7, 2]
    assert summarized(spark, out)[0]["top_positive_reviews"] == ["a good and quite long review text"] * 1 + [
        "a good and quite long review text"] * 2
    left = [p for p in (tmp_path / "out" / "shares").rglob("part-*.parquet")]
    assert len(left) <= 2  # of five; the last ones go with the next update


def test_files_by_header_and_users_by_folder(spark, tmp_path):
    incoming = tmp_path / "in files"
    (incoming / "bob+co").mkdir(parents=True)
    (incoming / "20240131235959_a.csv").write_text("review,upload_id,user_name\n\"A text, long\",1,eve\nnone,2,\n")
    (incoming / "bob+co" / "x.csv").write_text("stars,review\n5,Fine\n1,Poor\n")
    (incoming / "notes.txt").write_text("not an upload")
    out = f"{tmp_path}/out"
    stream.clean_uploads(stream.upload_stream(spark, str(incoming)), out, f"{tmp_path}/check").awaitTermination()
    got = readers.read_partitioned(spark, out, ["user_name"]).select("user_name", "review", "file_name", "upload_id").collect()
    assert sorted((str(r[0]), r[1], r[2]) for r in got) == [
        ("None", "none", "20240131235959_a.csv"), ("bob+co", "Fine", "x.csv"), ("bob+co", "Poor", "x.csv"),
        ("eve", "A text, long", "20240131235959_a.csv")]
