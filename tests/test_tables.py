"""Tables that survive a failed write, tables by user, ordered exports, headers, types, resumable jobs."""

import duckdb
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F
from pyspark.sql.functions import udf

from opinion_engine import files
from opinion_engine.operators import quality, ranking, reviews
from opinion_engine.plans import stages, training_data, whole
from opinion_engine.session import materialize, scratch_path
from opinion_engine.sources import readers, tables, writers


def failing(df):
    """A frame whose last task fails after the others have written."""
    broken = udf(lambda i: 1 // (99 - i), "long")
    return df.withColumn("x", broken("id"))


def test_a_write_that_fails_leaves_the_old_table(spark):
    path = scratch_path(spark, "test-table")
    writers.write_stage(spark.range(5), path)
    old = readers.read_stage(spark, path)
    with pytest.raises(Exception) as error:
        writers.write_stage(failing(spark.range(100).repartition(4)), path)
    assert isinstance(error.value, PythonException) or "ZeroDivisionError" in str(error.value)
    assert sorted(r[0] for r in readers.read_stage(spark, path).collect()) == list(range(5))
    writers.write_stage(readers.read_stage(spark, path).filter("id > 2"), path)  # read while it is replaced
    assert sorted(r[0] for r in readers.read_stage(spark, path).collect()) == [3, 4]
    assert old.count() == 5  # the version that was opened before is still there
    for k in range(4):
        writers.write_stage(spark.range(k), path)
    assert readers.read_stage(spark, path).count() == 3
    assert len([n for n in files.children(spark, path) if n.startswith("data-")]) <= tables.KEPT + 1
    assert len(files.children(spark, f"{path}/_versions")) == tables.KEPT


def test_an_unpublished_folder_is_no_table(spark):
    path = scratch_path(spark, "test-table")
    writers.write_stage(spark.range(3), path)
    spark.range(50).write.parquet(tables.new_folder(path))  # complete, but the switch is missing
    assert readers.read_stage(spark, path).count() == 3
    with pytest.raises(FileExistsError):
        name = files.children(spark, f"{path}/_versions")[-1]
        files.create(spark, f"{path}/_versions/{name}", "{}")
    plain = scratch_path(spark, "test-table")
    spark.range(7).write.parquet(plain)
    assert readers.read_stage(spark, plain).count() == 7 and not tables.exists(spark, plain)


def test_tables_by_user(spark):
    path = scratch_path(spark, "test-users")
    rows = spark.range(20_000).select(
        F.col("id").alias("upload_id"), F.concat(F.lit("user"), (F.col("id") % 997).cast("string")).alias("user_name"),
        F.md5(F.col("id").cast("string")).alias("review_clean"))
    rows = rows.unionByName(spark.createDataFrame([(-1, None, "none"), (-2, "007", "x")], rows.schema))
    spark.conf.set("parquet.block.size", str(1 << 14))
    try:
        writers.write_by_user(rows, path, buckets=8)
    finally:
        spark.conf.unset("parquet.block.size")
    folders = tables.parts(spark, path)
    assert set(folders) == {"-1", *map(str, range(8))}
    one = readers.read_one_user(spark, path, "user5", rows.schema, buckets=8)
    assert {r["upload_id"] for r in one.collect()} == {i for i in range(20_000) if i % 997 == 5}
    read = scanned_rows(one)
    bucket = spark.read.parquet(f"{path}/{folders[str(number(spark, 'user5'))]}").count()
    assert bucket > 2_000 and read < bucket / 2  # row groups of other users are not read
    # New rows replace those of their users, in their buckets only.
    writers.write_by_user(spark.createDataFrame([(5, "user5", "new"), (-3, None, "also")], rows.schema), path, buckets=8)
    now = tables.parts(spark, path)
    assert {b for b in now if now[b] != folders[b]} == {"-1", str(number(spark, "user5"))}
    got = readers.read_by_user(spark, path, rows.schema)
    assert got.count() == rows.filter("coalesce(user_name, '') not in ('user5', '')").count() + 2
    assert readers.read_one_user(spark, path, "user5", rows.schema, buckets=8).collect()[0]["review_clean"] == "new"
    assert readers.read_one_user(spark, path, "nobody", rows.schema, buckets=8).count() == 0
    empty = scratch_path(spark, "test-users")
    assert readers.read_by_user(spark, empty, rows.schema).count() == 0
    assert readers.read_one_user(spark, empty, "user5", rows.schema).count() == 0


def number(spark, user):
    return spark.range(1).select(readers.user_bucket(F.lit(user), 8)).first()[0]


def scanned_rows(df):
    """Rows that the scan of a plan has put out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    while plan.children().size():
        plan = plan.children().head()
    return plan.metrics().apply("numOutputRows").value()


def test_positions(spark):
    path = scratch_path(spark, "test-order")
    rows = spark.range(3_000).select(F.col("id"), F.md5(F.col("id").cast("string")).alias("key")).repartition(7).orderBy("key")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        writers.export_csv(rows, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    stored = materialize(readers.read_in_order(spark, path), "test-places")
    assert stored.select("part").distinct().count() > 1
    got = ranking.numbered(stored).collect()
    want = {r["key"]: i for i, r in enumerate(sorted(got, key=lambda r: r["key"]))}
    assert {r["key"]: r["position"] for r in got} == want and len(want) == 3_000
    plan = ranking.numbered(stored)._jdf.queryExecution().toString()
    assert "Window" not in plan and "SinglePartition" not in plan
    none = spark.createDataFrame([], "part long, place long, x int")
    assert ranking.numbered(none).columns == ["x", "position"] and ranking.numbered(none).count() == 0


def jobs_of(spark, run):
    group = scratch_path(spark, "group")
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_headers_take_one_job_whatever_the_number_of_files(spark, tmp_path):
    counts = []
    for n in (2, 200):
        folder = tmp_path / f"n{n}"
        folder.mkdir()
        for i in range(n):
            (folder / f"{i}.csv").write_text("a,b\n1,2\n" if i % 2 else 'b,"c, d",a\n3,4,5\n')
        paths = [str(p) for p in folder.iterdir()]
        found = {}
        counts.append(jobs_of(spark, lambda: found.update(readers.file_headers(spark, paths))))
        assert {h: len(f) for h, f in found.items()} == {("a", "b"): n // 2, ("b", "c, d", "a"): n // 2}
        rows = readers.read_reviews_csv(spark, str(folder))
        assert rows.count() == n and rows.filter("a = 5 and b = 3 and `c, d` = 4").count() == n // 2
    assert counts[0] == counts[1] <= 2


def test_odd_headers(spark, tmp_path):
    import gzip

    (tmp_path / "blank.csv").write_text("\n\nx,y\n1,2\n")
    (tmp_path / "lines.csv").write_text('"a\nb",x,,X\n1,2,3,4\n')
    (tmp_path / "packed.csv.gz").write_bytes(gzip.compress(b"x,y\n5,6\n"))
    (tmp_path / "empty.csv").write_text("")
    found = readers.file_headers(spark, [str(p) for p in tmp_path.iterdir()])
    assert set(found) == {("x", "y"), ("a\nb", "x", "", "X")} and len(found["x", "y"]) == 2
    assert readers.column_names(("a\nb", "x", "", "X")) == ["a\nb", "x1", "_c2", "X3"]
    got = readers.read_reviews_csv(spark, str(tmp_path)).collect()
    assert sorted((r["x"], r["y"], r["x1"], r["_c2"], r["X3"]) for r in got if r["x"]) == [
        ("1", "2", None, None, None), ("5", "6", None, None, None)]
    assert [(r["a\nb"], r["x1"], r["_c2"], r["X3"]) for r in got if r["x1"]] == [("1", "2", "3", "4")]
    (tmp_path / "spaces").mkdir()
    (tmp_path / "spaces" / "s.csv").write_text("  \nx,y\n1,2\n")
    for multi_line in (False, True):  # what Spark's own reader takes for the header
        got = readers.read_reviews_csv(spark, str(tmp_path / "spaces"), multi_line)
        own = spark.read.options(**readers.CSV_READING, multiLine=multi_line).csv(str(tmp_path / "spaces"))
        assert got.columns == own.columns and got.collect() == own.collect()
    with pytest.raises(ValueError, match="no CSV file"):
        readers.read_csv_files(spark, [str(tmp_path / "empty.csv")])


def test_types_like_a_database_finds_them(spark, tmp_path):
    file = tmp_path / "mixed.csv"
    file.write_text("i,d,e,b,day,time,t,word,code,none,big,late\n"
                    "1,1.5,1e3,true,2024-01-31,2024-01-31 10:20:30,2024-02-29,x,007,,9223372036854775807,1\n"
                    "-20,3,2,False,2024-02-29,2024-02-29 00:00:00,2024-01-31 10:00:00,5,12,,1,2\n"
                    ",,7,,,,,,,,,x\n")
    rows = readers.read_reviews_csv(spark, str(file))
    got = readers.infer_types(rows)
    sniffed = dict(duckdb.sql(f"select unnest(columns).name, unnest(columns).type from sniff_csv('{file}')").fetchall())
    names = {"BIGINT": "bigint", "DOUBLE": "double", "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp",
             "VARCHAR": "string"}
    assert got == {c: names[t] for c, t in sniffed.items()} and got["code"] == "string"
    typed = readers.read_inferred_csv(spark, str(file))
    assert dict(typed.dtypes) == got
    assert typed.filter("i = 1").first().asDict()["code"] == "007" and typed.filter("i = -20").first()["d"] == 3.0
    assert readers.infer_types(spark.createDataFrame([], "a string, b int")) == {"a": "string"}
    odd = spark.createDataFrame([("9223372036854775808", "2024-02-30", "NaN", "1e999")], "a string, `b.c` string, d string, e string")
    assert readers.infer_types(odd) == {"a": "double", "b.c": "string", "d": "string", "e": "double"}


def test_texts_without_a_usable_id_are_kept_once(spark):
    rows = [(1, "a", 5), (1, "b", 4), (1, "b", 3), (2, "a", 2), (None, "c", 1), (None, "c", 2), (None, "d", 1), (7, "d", 3),
            (None, None, 1), (None, None, 2), (3, None, 3), (9, "e", 1), (9, "e", 1), (8, "f", 0), (8, "g", 0)]
    df = spark.createDataFrame(rows, "review_id long, review_body string, star_rating int").repartition(3)
    got = [(r["review_body"], r["review_id"]) for r in reviews.dedup_text(df).collect()]
    assert sorted(got, key=str) == sorted([("a", 1), ("b", 1), ("c", None), ("d", 7), (None, 3), ("e", 9), ("f", 8), ("g", 8)], key=str)
    unique = spark.range(500).select(F.col("id").alias("review_id"), (F.col("id") % 50).cast("string").alias("review_body"))
    kept = reviews.dedup_text(unique)
    assert sorted(r["review_id"] for r in kept.collect()) == list(range(50))
    final = kept._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    main, choice = final[:final.index("Window [")], final[final.index("Window ["):]
    assert "Sort" not in main and "EmptyRelation" in choice  # there is nothing to choose among


# --- jobs ----------------------------------------------------------------------------------


def raw_csv(tmp_path, n=300):
    lines = ["product_category,star_rating,review_body,review_headline"]
    for i in range(n):
        word = "great lovely" if i % 2 else "poor broken"
        stars = 3 if i % 7 == 0 else "" if i % 11 == 0 else 5 if i % 2 else 1
        lines.append(f"c,{stars},A {word} item {i % 250},{'Head' if i % 13 else ''}")
    source = tmp_path / "raw.csv"
    source.write_text("\n".join(lines) + "\n")
    return str(source)


def test_a_job_that_is_broken_off_goes_on(spark, tmp_path, monkeypatch):
    source = raw_csv(tmp_path)
    expected, out = f"{tmp_path}/expected", f"{tmp_path}/out"
    names = ["ingested", "preprocessed", "flagged", "sampled", "halved", "chosen", "judged"]
    assert whole.run(spark, source, expected, cap=60) == names

    def lost(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(training_data, "store_training_set", lost)
        with pytest.raises(RuntimeError):
            whole.run(spark, source, out, cap=60)
    assert files.children(spark, f"{out}/_done") == ["flagged", "ingested", "preprocessed"]
    with monkeypatch.context() as patch:
        patch.setattr(whole.modelling, "evaluate_model", lost)
        with pytest.raises(RuntimeError):
            whole.run(spark, source, out, cap=60)
    assert files.exists(spark, f"{out}/model/halves")  # still needed
    assert whole.run(spark, source, out, cap=60) == ["judged"]
    assert not files.exists(spark, f"{out}/model/halves")  # nothing reads it any more
    assert whole.run(spark, source, out, cap=60) == []
    got, want = ({k: v for k, v in spark.read.json(f"{o}/model/documents/model_evaluation").first().asDict(True).items()
                  if k != "timestamp"} for o in (out, expected))
    assert got == want and got["metrics"]["eval_f1"] == 1.0
    assert whole.run(spark, source, out, cap=60, resume=False) == names


def test_stages_are_checked(spark):
    one = stages.Stage("a", lambda: None)
    with pytest.raises(ValueError, match="stage b"):
        stages.run_stages(spark, scratch_path(spark, "test"), [one, stages.Stage("b", lambda: None, ("c",))])
    with pytest.raises(ValueError, match="stage a"):
        stages.run_stages(spark, scratch_path(spark, "test"), [one, one])


def test_documents_take_no_second_scan(spark, tmp_path, monkeypatch):
    """Every stage is read by the write of the next one; documents are made of counts alone."""
    scans = {}

    def spy(module, name, label):
        real = getattr(module, name)

        def counted(df, path, *args, **kwargs):
            plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
            scans[path.rsplit("/", 1)[1]] = plan.count("FileScan")
            return real(df, path, *args, **kwargs)

        monkeypatch.setattr(module, name, counted)

    spy(writers, "write_metrics", "document")
    spy(writers, "write_stage", "stage")
    spy(writers, "write_split", "split")
    training_data.run(spark, raw_csv(tmp_path), f"{tmp_path}/out", cap=60)
    documents = ("ingested", "preprocess_audit", "avg_review_length", "rating_range_audit", "ratings", "class_distribution")
    assert {scans[d] for d in documents} == {0}
    assert scans["split"] == scans["schema_validated"] == scans["anomaly_flagged"] == 1
    counted = spark.read.json(f"{tmp_path}/out/documents/preprocess_audit").first()
    train = readers.read_stage(spark, f"{tmp_path}/out/split").filter("split = 'train'")
    assert counted.asDict() == quality.preprocess_audit(train).first().asDict()


def test_observed_counts_of_an_empty_table(spark):
    none = spark.createDataFrame([], "review_id long, product_category string, star_rating string, review_body string, review_headline string")
    out = scratch_path(spark, "test-observed")
    assert training_data.store_ingested(none, out) == {"original_rows": 0, "with_text": 0, "train_rows": 0}
    assert training_data.store_preprocessed(none, 0, out)["retained_rows"] == 0
