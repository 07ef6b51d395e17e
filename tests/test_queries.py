"""Every registered query against its SQL, and against plans that would not scale."""

import pytest

import __spark_entry__ as contract
from opinion_engine.catalog import registered
from opinion_engine.catalog.oracle import ORACLE
from opinion_engine.catalog.registered import QUERIES
from tests.compare import difference, duck

FOLDER = "/root/testdata/sf0.001"
@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, con, name):
    assert difference(contract.queries()[name](spark, FOLDER), con, contract.oracle_sql()[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["category_sentiment", "text_dedup", "balanced_sample", "holdout_remaining",
                                  "sentiment_summary", "length_histogram", "nb_scores"])
def test_plans(spark, name):
    plan = contract.queries()[name](spark, FOLDER)._jdf.queryExecution().toString()
    for slow in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ExistingRDD"):
        assert slow not in plan


def physical(df) -> str:
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def test_dedup_sorts_no_texts_and_reads_only_what_is_used(spark):
    """Only the branch for texts whose lowest id is not unique sorts, and at run time it has no rows."""
    df = contract.queries()["text_dedup"](spark, FOLDER)
    assert "SortAggregate" not in physical(df)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    main, choice = final[:final.index("Window [")], final[final.index("Window ["):]
    assert "Sort [" not in main and "EmptyRelation" in choice
    narrow = physical(df.select("star_rating"))
    assert "review_headline" not in narrow and "split_part" not in narrow


@pytest.mark.parametrize("name", ["length_stats"])
def test_lengths_are_measured_before_texts_could_move(spark, name):
    plan = physical(contract.queries()[name](spark, FOLDER))
    assert "SortAggregate" not in plan and "Sort [" not in plan
    above = plan[:plan.index("Exchange hashpartitioning(digest")]
    assert "min(review_body" not in above and "review_headline" not in above


def test_no_text_is_in_two_parts(spark):
    train, choose, judge = (df.select("text") for df in registered._parts(spark, "/root/testdata/sf0.01"))
    for a, b in ((train, choose), (train, judge), (choose, judge)):
        assert a.intersect(b).count() == 0 and b.count() > 0


def test_every_cleaned_upload_is_summarised(spark):
    total = contract.queries()["sentiment_summary"](spark, FOLDER).first()["total_reviews"]
    assert total == contract.queries()["upload_clean"](spark, FOLDER).count()


@pytest.mark.parametrize("name", ["sampling_summary", "holdout_remaining"])
def test_sampling_reads_stored_stages(spark, name):
    assert "documents.parquet" not in physical(contract.queries()[name](spark, FOLDER))


def test_histogram_reads_the_texts_once(spark):
    df = contract.queries()["length_histogram"](spark, FOLDER)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan


def test_sample_moves_no_text(spark):
    """Only ids of one key size are ranked; the chosen rows are compared with the last one taken."""
    plan = physical(contract.queries()["balanced_sample"](spark, FOLDER))
    for line in plan.splitlines():
        assert not ("Exchange hashpartitioning" in line and "text" in line)
    assert "Sort [" in plan and plan.count("row_number()") == 1
