"""The first k rows, overall or per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Groups of input partitions that are cut down to k rows each before the last step.
FAN_IN = 32


def first_rows(df: DataFrame, k: int, order: Sequence[Column], by: Sequence[str] = ()) -> DataFrame:
    """The first ``k`` rows per group, with their ``rank``; for a small ``k``.

    Each task keeps at most k rows per group before anything moves (a window group limit).
    With very many tasks one group would still gather k rows from all of them in one place,
    so partitions are merged in ``FAN_IN`` lots first and the lots are merged last.
    """
    lot = df.withColumn("_lot", F.spark_partition_id() % FAN_IN)
    in_lot = Window.partitionBy(*by, "_lot").orderBy(*order)
    reduced = lot.withColumn("rank", F.row_number().over(in_lot)).filter(F.col("rank") <= k)
    in_group = Window.partitionBy(*by).orderBy(*order)
    return (reduced.drop("_lot")
            .withColumn("rank", F.row_number().over(in_group))
            .filter(F.col("rank") <= k))


def numbered(rows: DataFrame, part: str = "part", place: str = "place", name: str = "position") -> DataFrame:
    """Row numbers from zero over a whole table, for stored rows that know their part and their place in it.

    Places are consecutive within a part, from any number on. One row per part goes to the driver, which adds up the
    counts in the order of the parts; nothing is sorted, and no task sees more than its own rows.
    """
    sizes = rows.groupBy(part).agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).orderBy(part).collect()
    shifts, before = [], 0
    for size in sizes:
        shifts.append((size[part], before - size["first"]))
        before += size["n"]
    spark = rows.sparkSession
    kind = rows.schema[part].dataType.simpleString()
    shift = spark.createDataFrame(shifts, f"`{part}` {kind}, _shift long")
    return (rows.join(F.broadcast(shift), part).withColumn(name, F.col(place) + F.col("_shift"))
            .drop(part, place, "_shift"))


def texts_in_order(text: str, where: Column | None = None) -> Column:
    """Aggregate ranked rows into an array of texts; ``first_rows`` bounds its size."""
    row = F.struct("rank", F.col(text).alias("text"))
    picked = row if where is None else F.when(where, row)
    return F.transform(F.array_sort(F.collect_list(picked)), lambda r: r["text"])
