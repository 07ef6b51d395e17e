"""Writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import files
from . import readers, tables
from .readers import CSV_QUOTING


def write_stage(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a Parquet table; its old rows are there until the new ones are complete. ``read_stage`` reads it.

    With partition columns the rows are first rebalanced on them, so that each folder gets
    few files; AQE splits a column value that holds too many rows over several tasks.
    """
    tables.replace(df.hint("rebalance", *partition_by) if partition_by else df, path, tuple(partition_by))


def write_split(df: DataFrame, path: str, column: str = "split") -> None:
    """Write train, test and serve in one pass, as folders of one table, without a shuffle."""
    tables.replace(df, path, (column,))


def export_csv(
    df: DataFrame,
    path: str,
    columns: Sequence[str] | None = None,
    single_file: bool = False,
) -> None:
    """Write CSV with a header and doubled quotes; every text survives a round trip.

    Each task writes its own file, in the order of the rows. ``single_file`` asks for one file instead,
    written by one task; it keeps the order of a sorted frame and is meant for tables of known size.
    """
    out = df.select(*columns) if columns else df
    if single_file:
        out = out.coalesce(1)
    (out.write.mode("overwrite")
        .options(**CSV_QUOTING, ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
        .csv(path))


def write_scored(df: DataFrame, path: str, user_column: str = "user_name") -> None:
    """Scored reviews as a Parquet table with one folder per user; other users' folders stay.

    For some thousand users; ``write_by_user`` takes any number.
    """
    (df.hint("rebalance", user_column).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(user_column).parquet(path))


def write_by_user(
    df: DataFrame, path: str, user_column: str = "user_name", buckets: int = readers.USER_BUCKETS
) -> None:
    """Put the rows of some users into a table of any number of users, in place of what those had before.

    Users are dealt to ``buckets`` folders by hash, a fixed number for a table. Rows lie in the order of users, with
    Bloom filters on the user, so a reader of one user skips most row groups. Only the buckets of these users are
    written anew; AQE splits one that holds too many rows. Bucket ``-1`` has the rows without a user.
    """
    spark = df.sparkSession
    bucket = readers.user_bucket(F.col(user_column), buckets)
    before = tables.parts(spark, path)
    rows = df
    if before:
        touched = [str(r[0]) for r in df.select(bucket.alias("b")).distinct().collect()]  # at most ``buckets`` + 1
        old = [f"{path}/{before[b]}" for b in touched if b in before]
        if old:
            new = df.select(F.col(user_column).alias("_user")).distinct()
            kept = spark.read.schema(df.schema).parquet(*old)
            rows = kept.join(new, F.col(user_column).eqNullSafe(F.col("_user")), "left_anti").unionByName(df)
    folder = tables.new_folder(path)
    (rows.withColumn("_bucket", bucket).hint("rebalance", "_bucket").sortWithinPartitions("_bucket", user_column)
        .write.option(f"parquet.bloom.filter.enabled#{user_column}", "true").partitionBy("_bucket").parquet(folder))
    name = folder.rsplit("/", 1)[1]
    written = [c for c in files.children(spark, folder) if c.startswith("_bucket=")]
    tables.publish(spark, path, {c.split("=")[1]: f"{name}/{c}" for c in written})


def stamped(document: DataFrame, name: str = "timestamp") -> DataFrame:
    """Put the time of writing first, as an ISO text."""
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return document.select(now.alias(name), *document.columns)


def document(spark: SparkSession, values: dict, schema: T.StructType) -> DataFrame:
    """A one-row frame of values that are known, such as observed counts; nothing is read for it."""
    return spark.createDataFrame([tuple(values[f.name] for f in schema)], schema)


def write_metrics(document: DataFrame, path: str) -> None:
    """Write a one-row frame as one JSON document."""
    document.coalesce(1).write.mode("overwrite").json(path)
