"""Line dedup: windows of consecutive lines that occur earlier are removed. DataFrame functions only.

A window is ``size`` consecutive lines of one document. A window that also starts earlier (at a smaller id, or
in the same document at an earlier line) covers its lines, and covered lines are removed; windows are judged on
the input. A text is cut at line feeds; a document of fewer lines has no window and stays as it is.

Windows are two 64-bit hashes of the lines' hashes. Per window hash one aggregate, combined in each task, finds
the number of occurrences and the first one; only hashes that occur more than once are joined back to their
windows. That join has one small row per hash on one side, and Spark splits a hash with very many windows. Full
texts move once, to meet the starts of their covered windows, which are at most one short row per window.

Edge values: a null text stays null and an empty one is a single empty line. A null id counts as the greatest
id. Rows that share an id are one document written twice: windows at equal (id, line) do not remove each other.
Columns of ``docs`` pass through under their names, whatever these are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIZE = 3
_LAST_ID = (1 << 63) - 1


def _line_hashes(lines: Column) -> Column:
    """Two hashes of each line."""
    return F.transform(lines, lambda line: F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit("b"), line).alias("b")))


def _uncovered(lines: Column, starts: Column, size: int) -> Column:
    """The lines outside ``[start, start + size)`` of all starts, which are ascending."""
    n = F.size(starts)
    begin = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(starts, i - 1) + size)
    end = lambda i: F.when(i == n, F.size(lines)).otherwise(F.get(starts, i))
    gaps = F.transform(F.sequence(F.lit(0), n), lambda i: F.slice(
        lines, begin(i) + 1, F.greatest(end(i) - begin(i), F.lit(0))))
    return F.flatten(gaps)


def _windows(keyed: DataFrame, size: int) -> DataFrame:
    """``key``, ``pos`` and the two hashes ``a``, ``b`` of every window of the ``text``."""
    hashes = keyed.select("key", _line_hashes(F.split("text", "\n", -1)).alias("h"))
    shifted = F.arrays_zip(*[F.slice("h", k + 1, F.size("h")).alias(f"l{k}") for k in range(size)])
    rows = hashes.filter(F.size("h") >= size).select("key", F.posexplode(shifted).alias("pos", "w"))
    line = [F.col(f"w.l{k}") for k in range(size)]
    return rows.filter(line[-1].isNotNull()).select(
        "key", "pos", *[F.xxhash64(*[c.getField(n) for c in line]).alias(n) for n in ("a", "b")])


def dedup_lines(docs: DataFrame, size: int = SIZE, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` with covered lines removed from the text, and ``n_lines`` and ``n_removed``.

    A column of ``docs`` named like one of these two is replaced.
    """
    names = docs.columns
    text_name = f"in_{names.index(text_column)}"
    inner = docs.select(*[F.col(f"`{c}`").alias(f"in_{i}") for i, c in enumerate(names)])
    key = F.coalesce(F.col(f"in_{names.index(id_column)}").cast("long"), F.lit(_LAST_ID))
    text = F.col(text_name)

    windows = _windows(inner.select(key.alias("key"), text.alias("text")).filter(text.isNotNull()), size)
    # (id, line) as one number, so that the aggregate needs no sort
    place = F.col("key").cast("decimal(19,0)") * F.lit(1 << 31).cast("decimal(10,0)") + F.col("pos").cast("decimal(10,0)")
    placed = windows.withColumn("place", place)
    first = (placed.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
             .filter(F.col("n") > 1).drop("n"))
    later = (placed.join(first, ["a", "b"]).filter(F.col("place") > F.col("first"))
             .groupBy("key").agg(F.array_sort(F.collect_list(F.struct("pos", "a"))).alias("later")))

    joined = inner.withColumn("key", key).join(later.hint("shuffle_hash"), "key", "left")
    # The one-row generator holds the split text, which is then not split again for each element below.
    held = joined.withColumn("held", F.explode(F.array(F.struct(
        F.when(F.col("later").isNotNull(), F.split(text, "\n", -1)).alias("lines"), "later"))))
    lines = F.col("held.lines")

    def window_hash(pos: Column) -> Column:
        return F.xxhash64(*[F.xxhash64(F.get(lines, pos + k)) for k in range(size)])

    # Of rows that share an id, each keeps only the starts that its own windows have.
    mine = F.transform(F.filter(F.col("held.later"), lambda w: (
        w["pos"] + size <= F.size(lines)) & (window_hash(w["pos"]) == w["a"])), lambda w: w["pos"])
    started = held.withColumn("starts", F.explode(F.array(mine)))
    kept = F.when(F.size("starts") > 0, F.array_join(_uncovered(lines, F.col("starts"), size), "\n"))
    cut = started.withColumn("kept", F.explode(F.array(kept)))
    breaks = lambda t: F.octet_length(t) - F.octet_length(F.replace(t, F.lit("\n"), F.lit("")))
    count = F.when(text.isNull(), F.lit(0)).otherwise(breaks(text) + 1)
    removed = F.when(F.col("kept").isNull(), F.lit(0)).otherwise(_n_covered(F.col("starts"), size))
    out = [(F.coalesce("kept", text) if c == text_column else F.col(f"in_{i}")).alias(c)
           for i, c in enumerate(names) if c not in ("n_lines", "n_removed")]
    return cut.select(*out, count.cast("long").alias("n_lines"), removed.cast("long").alias("n_removed"))


def _n_covered(starts: Column, size: int) -> Column:
    """How many lines the windows at ascending starts cover."""
    n = F.size(starts)
    steps = F.transform(F.arrays_zip(starts.alias("s"), F.slice(starts, 2, n).alias("t")),
                        lambda w: F.least(F.coalesce(w["t"] - w["s"], F.lit(size)), F.lit(size)))
    return F.aggregate(steps, F.lit(0), lambda total, step: total + step)
