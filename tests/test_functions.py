"""Edge values of the column expressions."""

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinion_engine.functions import keys, ratings, scores, text


def apply(spark, expression, values, kind=None):
    """The expression's value for each input, in order."""
    kind = kind or T.StringType()
    rows = spark.createDataFrame(list(enumerate(values)), T.StructType([
        T.StructField("i", T.IntegerType()), T.StructField("v", kind)]))
    return [r[1] for r in rows.select("i", expression(F.col("v"))).orderBy("i").collect()]


def test_normalize_rating(spark):
    given = ["abc", "5.5", "-1", "0.5", "3.7", None, "NaN", "", "inf", " 4 ", "1", "5", "-inf"]
    assert apply(spark, ratings.normalize_rating, given) == [
        None, 5, 1, 1, 3, None, 5, None, 5, 4, 1, 5, 1]


def test_repair_rating(spark):
    assert apply(spark, ratings.repair_rating, [-1.0, 0.0, 5.0, 6.0, None, 2.5], T.DoubleType()) == [
        None, 0.0, 5.0, 5.0, None, 2.5]


def test_labels(spark):
    given = [1, 2, 3, 4, 5, None]
    assert apply(spark, ratings.is_polar, given, T.IntegerType()) == [True, True, False, True, True, False]
    assert apply(spark, ratings.binary_label, given, T.IntegerType()) == [0, 0, 0, 1, 1, 0]


def test_normalize_text(spark):
    given = ["\t a\t\tb \n", "a\x0bb", "A B", "  Two  Words  ", "   ", None]
    assert apply(spark, text.normalize_text, given) == [" a b ", "a b", "a b", "two words", "", None]


def test_line_breaks_and_length(spark):
    assert apply(spark, text.strip_line_breaks, ["a\r\n\nb", "a b", None]) == ["a b", "a b", None]
    assert apply(spark, text.text_length, ["é", "😀", "", None]) == [1, 1, 0, None]


def test_digits_only(spark):
    assert apply(spark, text.is_digits_only, ["123\n", "12 3", "", "12a", "１２", None]) == [
        True, True, False, False, False, None]


def test_short_review(spark):
    four_long = "aaaaaaaaa bbbbbbbbb ccccccccc dddddddddd"
    five_29, five_30 = "aaaaa bbbbb ccccc ddddd eeeee", "aaaaa bbbbb ccccc ddddd eeeeee"
    nbsp = "aaaaa bbbbb ccccc ddddd eeeeee"
    separator = "aaaaa\x1cbbbbb ccccc ddddd eeeeee"
    lead = "    aaaaa bbbbb ccccc ddddd eeeeee"
    assert (len(four_long), len(five_29), len(five_30)) == (40, 29, 30)
    assert apply(spark, text.is_short, [None, "", four_long, five_29, five_30, nbsp, separator, lead]) == [
        True, True, True, True, False, False, False, False]


def test_word_test_agrees_with_split(spark):
    given = ["", " ", "a", "a b", " a  b ", "a b c", "x" * 50_000, "a b c d", "a b c d e", "\x1f a\x1eb c d e\n"]
    for n in (1, 2, 5):
        assert apply(spark, lambda c, n=n: text.has_words(c, n), given) == [len(t.split()) >= n for t in given]


def test_tokens(spark):
    got = apply(spark, text.tokens, ["Good, good bad!", "123", "", None, "naïve", "schön gut für", "Привет мир"])
    assert [sorted(t) if t is not None else None for t in got] == [
        ["bad", "good"], [], [], None, ["naïve"], ["für", "gut", "schön"], ["мир", "привет"]]


def test_digest(spark):
    a, b, c, missing = apply(spark, text.text_digest, ["x", "x", "y", None])
    assert a == b != c and len(a) == 16 and missing is None


def test_softmax_argmax(spark):
    kind = T.ArrayType(T.DoubleType())
    (p, big, tie) = apply(spark, scores.softmax, [[0.0, 1.0], [1000.0, -1000.0], [2.0, 2.0]], kind)
    assert p == pytest.approx([1 / (1 + math.e), math.e / (1 + math.e)], abs=1e-15)
    assert big == [1.0, 0.0] and tie == [0.5, 0.5]
    assert apply(spark, scores.argmax, [[0.1, 0.9], [0.5, 0.5], [3.0, 2.0, 9.0]], kind) == [1, 0, 2]


def test_label_names(spark):
    assert apply(spark, scores.name_label, [0, 1, 2, None], T.IntegerType()) == [
        "negative", "positive", "unknown", "unknown"]


def test_keys_are_even_and_monotone(spark):
    keyed = spark.range(200_000).select(keys.order_key(F.col("id")).alias("k"))
    shares = [r["count"] for r in keyed.groupBy(keys.percent_bucket(F.col("k"))).count().collect()]
    assert len(shares) == 100 and max(shares) < 2400 and min(shares) > 1600
    rows = keyed.select("k", keys.size_bucket(F.col("k")).alias("b")).orderBy("k").collect()
    buckets = [r["b"] for r in rows]
    assert buckets == sorted(buckets) and buckets[-1] < keys.SIZE_BUCKETS
    # The bucket of the n-th smallest key holds a small part of n, here with n = 25,000.
    assert sum(1 for b in buckets if b == buckets[25_000]) < 3000
