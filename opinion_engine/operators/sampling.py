"""Splits, samples and the hold-out. All depend on row ids and a seed, not on the layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import keys, text

# Fixed values that the results depend on.
SEED = 42
SPLITS = {"train": 80, "test": 10, "serve": 10}
CLASS_CAP = 25_000


def hash_split(
    df: DataFrame, row_id: str = "review_id", shares: dict[str, int] | None = None, seed: int = SEED
) -> DataFrame:
    """Add a ``split`` column with shares in percent. A projection: nothing moves."""
    bucket = keys.percent_bucket(keys.order_key(F.col(row_id), seed))
    named = F.lit(None).cast("string")
    upper = 100
    shares = shares or SPLITS
    if sum(shares.values()) != 100:
        raise ValueError(f"shares must add up to 100: {shares}")
    for name, share in reversed(shares.items()):
        named = F.when(bucket < upper, name).otherwise(named)
        upper -= share
    return df.withColumn("split", named)


def random_split(df: DataFrame, shares: Sequence[float] = (0.8, 0.1, 0.1), seed: int = SEED) -> list[DataFrame]:
    """Spark's own split. It follows the partition layout and scans once per part."""
    return df.randomSplit(list(shares), seed=seed)


def _size_counts(df: DataFrame, row_id: str, label: str, seed: int) -> DataFrame:
    """Rows per class and key size: at most 961 rows per class, from ids and labels alone."""
    return (df.select(F.col(label).alias("_label"),
                      keys.size_bucket(keys.order_key(F.col(row_id), seed)).alias("_bucket"))
            .groupBy("_label", "_bucket").agg(F.count(F.lit(1)).alias("_n")))


def _class_total(label: int) -> Column:
    everything = Window.partitionBy()  # over the size counts only, whose number is fixed
    return F.coalesce(F.sum(F.when(F.col("_label") == label, F.col("_n"))).over(everything), F.lit(0))


def _smallest_keys(df: DataFrame, row_id: str, label: str, seed: int, wanted: Column) -> DataFrame:
    """The ``wanted`` rows of each class with the smallest keys, exactly.

    The counts tell which key sizes are taken whole, which one in part, and which not at all. Only the ids of
    the one in part, about a sixteenth of the sample, are ranked. The chosen rows are then picked out in the scan
    by a comparison with that limit, and do not move.
    """
    counts = _size_counts(df.filter(F.col(label).isin(0, 1)), row_id, label, seed)
    up_to = Window.partitionBy("_label").orderBy("_bucket")
    cuts = (counts
            .withColumn("_wanted", wanted)
            .withColumn("_before", F.sum("_n").over(up_to) - F.col("_n"))
            .filter(F.col("_before") < F.col("_wanted"))
            .select("_label", "_bucket", "_n", (F.col("_wanted") - F.col("_before")).alias("_take")))
    key = keys.order_key(F.col(row_id), seed)
    # The key size that is taken in part, at most one per class: its ids are ranked, to find the last row taken.
    split = F.broadcast(cuts.filter("_take < _n").drop("_n"))
    last = (df.select(F.col(label).alias("_label"), key.alias("_key"), F.col(row_id).alias("_id"))
            .withColumn("_bucket", keys.size_bucket(F.col("_key"))).join(split, ["_label", "_bucket"])
            .withColumn("_rank", F.row_number().over(Window.partitionBy("_label").orderBy("_key", "_id")))
            .filter(F.col("_rank") == F.col("_take")).select("_label", F.struct("_key", "_id").alias("_last")))
    # Two rows: the largest key size taken whole, and the last row of the one taken in part.
    whole = cuts.groupBy("_label").agg(F.max(F.when(F.expr("_take >= _n"), F.col("_bucket"))).alias("_whole"))
    limits = whole.join(F.broadcast(last), "_label", "left").withColumnRenamed("_label", label)
    taken = (keys.size_bucket(F.col("_key")) <= F.col("_whole")) | (
        F.struct(F.col("_key").alias("_key"), F.col(row_id).alias("_id")) <= F.col("_last"))
    return df.withColumn("_key", key).join(F.broadcast(limits), label).filter(taken).select(*df.columns)


def balanced_size(df: DataFrame, label: str = "label", cap: int = CLASS_CAP) -> DataFrame:
    """Rows to take per class: the smaller class, or the cap."""
    size = F.least(F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0), F.lit(cap))
    return df.agg(size.alias("per_class"))


def balanced_sample(
    df: DataFrame, row_id: str = "review_id", label: str = "label", cap: int = CLASS_CAP, seed: int = SEED
) -> DataFrame:
    """As many rows of either class: all of the smaller class, or ``cap``."""
    return _smallest_keys(df, row_id, label, seed, F.least(_class_total(0), _class_total(1), F.lit(cap)))


def per_class_sample(
    df: DataFrame,
    row_id: str = "review_id",
    label: str = "label",
    n: int = CLASS_CAP,
    seed: int = SEED,
    strict: bool = False,
) -> DataFrame:
    """``n`` rows of either class, or what there is; ``strict`` refuses a shortage at once."""
    if strict:
        have = df.agg(*[F.count_if(F.col(label) == c).alias(str(c)) for c in (0, 1)]).first()
        if min(have) < n:
            raise ValueError(f"{n} rows per class asked, found {have['0']} and {have['1']}")
    return _smallest_keys(df, row_id, label, seed, F.lit(n))


def shuffle_rows(df: DataFrame, row_id: str = "review_id", seed: int = SEED) -> DataFrame:
    """A seeded order of all rows (a range-partitioned sort), for ordered exports."""
    return df.orderBy(keys.order_key(F.col(row_id), seed + 1), row_id)


def holdout_remaining(labelled: DataFrame, sample: DataFrame, column: str = "review_body") -> DataFrame:
    """Labelled rows whose text is not in the sample, so that no text is in both.

    Only digests of the sample take part. Spark picks the join by their size, and AQE splits a text with many copies.
    """
    digest = text.text_digest(F.col(column))
    taken = sample.select(digest.alias("_digest"))
    return labelled.withColumn("_digest", digest).join(taken, "_digest", "left_anti").drop("_digest")
