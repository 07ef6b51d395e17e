"""Hard negatives by threshold joins over an inverted index, after L2AP.

A vector's components become integers, floor(scale * x), and a score is the exact integer inner product. For each
anchor the ``positives`` best rows of its label are found first, and then, for each of them, the ``negatives`` best
rows of other labels whose score lies in a window below the positive's.

A threshold join (``Index``). Dimensions are ordered by energy and taken ``CHUNK`` at a time. The inverted index of a
block of rows omits a row's last dimensions, as many as the norms of both sides' rest cover: by themselves they cannot
lift any anchor of the search over its threshold. A search adds partial scores dimension by dimension, drops a pair as
soon as its sum and the product of the remaining norms stay below the threshold, goes on with a list of pairs once
few are left, and computes the exact scores of those that remain.

Thresholds. Each anchor's first threshold is an estimate, from a sample of ``SAMPLE`` rows, of what ``EXTRA`` times as
many rows as are asked for reach. A window is full if it got its number of rows at or above its threshold, and then
they are its best rows for certain. For windows that are not, the threshold is lowered to one that ``LOWER`` times as
many rows should reach, and so on down to the window's end. Within a task a threshold rises when the windows are full.

Anchors are taken ``BLOCK`` at a time. A block is broadcast (its size is fixed) and every row is compared where it
lies: no vector is shuffled, and a label or a vector that makes up a third of all rows is a third of each task. A task
sends on at most ``negatives`` rows per window. The number of passes over the table is the number of blocks times the
rounds, and the work is that of the stated anchors against all rows.

Edge values: rows with a null id, label, vector or component, with a component that is not finite, or whose integers
have a norm of 2^31 or more (their score need not fit) take no part. Of rows that share an id one takes part, that
with the least (label, vector). A shorter vector counts as filled up with zeros; an empty one has score 0 with every
row. Fewer rows than asked for give what there is. A negative positive score leaves an empty window, and zero leaves
the rows of score zero. Ties go to the smaller id. Other columns are ignored. An empty table, or one without
anchors, gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import first_rows
from ..session import materialize, scratch_path

CHUNK = 8
ROWS = 4096
TOGETHER = 256
BLOCK = 4096
SAMPLE = 1024
EXTRA = 4
LOWER = 64
SPARSE = 8
VERIFIED = 1 << 14
LIMIT = float(1 << 31)
_ANY = 1 << 62  # beyond every score
_SLACK = 1e-9  # of the product of two norms, for sums of floating numbers

OUTPUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


# --- vectors -------------------------------------------------------------------------------


def integer_vectors(table: DataFrame, id_column: str, vector_column: str, label_column: str,
                    scale: float) -> DataFrame:
    """``vec_id``, ``label`` and ``vec`` (little-endian 32-bit integers) of the rows that take part, one per id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2)
            sizes = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            flat = column.flatten()
            values = np.floor(scale * flat.fill_null(math.nan).to_numpy(zero_copy_only=False).astype(np.float64))
            owner = np.repeat(np.arange(batch.num_rows), sizes)
            finite = np.isfinite(values)
            squares = np.bincount(owner, np.where(finite, np.square(np.where(finite, values, 0.0)), np.inf),
                                  minlength=batch.num_rows)
            good = np.flatnonzero(squares < LIMIT * LIMIT)
            first = np.cumsum(sizes) - sizes
            with np.errstate(invalid="ignore"):
                whole = values.astype("<i4")
            packed = [whole[first[i]:first[i] + sizes[i]].tobytes() for i in good]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(good)), batch.column(1).take(pa.array(good)),
                 pa.array(packed, pa.binary())], ["vec_id", "label", "vec"])

    named = table.select(F.col(id_column).cast("long").alias("vec_id"), F.col(label_column).cast("long").alias("label"),
                         F.col(vector_column).cast("array<double>").alias("vec"))
    rows = named.filter("vec_id is not null and label is not null and vec is not null").mapInArrow(
        run, "vec_id long, label long, vec binary")
    rows = materialize(rows, "integer-vectors")
    repeated = materialize(rows.groupBy("vec_id").count().filter("count > 1").select("vec_id"), "repeated-ids")
    if repeated.isEmpty():
        return rows
    one = rows.join(repeated, "vec_id", "left_semi").groupBy("vec_id").agg(
        F.min(F.struct("label", "vec")).alias("one")).select("vec_id", "one.label", "one.vec")
    return materialize(rows.join(repeated, "vec_id", "left_anti").unionByName(one), "integer-vectors")


def _matrix(column: pa.Array | list[bytes], width: int) -> np.ndarray:
    """Packed vectors as rows of 64-bit integers, filled up with zeros."""
    raw = column if isinstance(column, list) else column.to_pylist()
    if all(len(r) == 4 * width for r in raw):
        return np.frombuffer(b"".join(raw), "<i4").reshape(len(raw), width).astype(np.int64)
    out = np.zeros((len(raw), width), np.int64)
    for i, r in enumerate(raw):
        out[i, :len(r) // 4] = np.frombuffer(r, "<i4")
    return out


def dimensions(rows: DataFrame) -> tuple[int, np.ndarray]:
    """Number of rows, and the dimensions in descending order of energy."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(1), 0
        for batch in batches:
            raw = batch.column(0).to_pylist()
            width = max([len(total), *(len(r) // 4 for r in raw)])
            total = np.pad(total, (0, width - len(total)))
            for k in range(0, len(raw), ROWS):
                total += np.square(_matrix(raw[k:k + ROWS], width).astype(float)).sum(0)
            n += len(raw)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(total))), pa.array(np.append(float(n), total))],
                                         ["dim", "energy"])

    found = rows.select("vec").mapInArrow(run, "dim long, energy double").groupBy("dim").agg(
        F.sum("energy").alias("energy")).toPandas().sort_values("dim")
    energy = found["energy"].to_numpy()[1:]
    return int(found["energy"].iloc[0]), np.argsort(-energy, kind="stable")


def _chunked(vectors: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Columns in the given order, filled up to whole chunks."""
    return np.pad(vectors[:, order], ((0, 0), (0, -len(order) % CHUNK)))


def _rest_norms(vectors: np.ndarray) -> np.ndarray:
    """Norms of what is left from each chunk on; the last column is zero."""
    squares = np.square(vectors.astype(np.float64)).reshape(len(vectors), -1, CHUNK).sum(2)
    rest = np.cumsum(squares[:, ::-1], 1)[:, ::-1]
    return np.sqrt(np.pad(rest, ((0, 0), (0, 1))))


# --- the threshold join --------------------------------------------------------------------


@dataclass
class Search:
    """Anchors of a block with the windows of scores they look for; ``k`` rows for each window."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray  # integers, chunked
    threshold: np.ndarray  # per anchor
    low: np.ndarray  # anchors x windows; a window with low > high is closed
    high: np.ndarray
    k: int
    same: bool  # rows of the anchor's label, or of the others

    def __post_init__(self) -> None:
        self.rest = _rest_norms(self.vectors)

    def part(self, chosen: np.ndarray) -> Search:
        return Search(self.ids[chosen], self.labels[chosen], self.vectors[chosen], self.threshold[chosen],
                      self.low[chosen], self.high[chosen], self.k, self.same)


class Index:
    """The inverted index of a block of rows, for one search.

    ``height[c]`` rows have the dimensions of chunk c in the index. Rows are ordered by how many chunks they have there,
    so that a dimension's list is the head of its column.
    """

    def __init__(self, vectors: np.ndarray, search: Search) -> None:
        rest = _rest_norms(vectors)
        with np.errstate(divide="ignore", invalid="ignore"):
            reach = np.where(search.threshold[:, None] > 0, search.threshold[:, None] / search.rest, 0.0)
        slack = 1 - _SLACK
        covered = rest < np.nan_to_num(reach, nan=np.inf, posinf=np.inf).min(0, initial=np.inf) * slack
        indexed = np.where(covered.any(1), covered.argmax(1), rest.shape[1] - 1)
        self.order = np.argsort(-indexed, kind="stable")
        self.indexed, self.rest = indexed[self.order], rest[self.order]
        self.whole = vectors[self.order]
        self.columns = self.whole.astype(np.float64)
        self.height = [int((indexed > c).sum()) for c in range(rest.shape[1] - 1)]

    def pairs(self, search: Search, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchors, rows and exact scores of all ``allowed`` pairs that reach the anchor's threshold."""
        n = self.height[0] if self.height else 0  # the others reach no threshold at all
        if not n or not len(search.ids):
            none = np.zeros(0, np.int64)
            return none, none, none
        allowed = allowed[:, self.order[:n]]
        anchors = search.vectors.astype(np.float64)
        limit = search.threshold - _SLACK * search.rest[:, 0] * self.rest[:, 0].max()
        sums = np.zeros((len(anchors), n))
        for chunk, height in enumerate(self.height):
            place = slice(chunk * CHUNK, (chunk + 1) * CHUNK)
            sums[:, :height] += anchors[:, place] @ self.columns[:height, place].T
            stop = np.minimum(chunk + 1, self.indexed[:n])
            alive = allowed & (sums + search.rest[:, stop] * self.rest[np.arange(n), stop] >= limit[:, None])
            if alive.sum() * SPARSE <= alive.size:
                break
        a, r = np.nonzero(alive)
        found = sums[a, r]
        for later in range(chunk + 1, len(self.height)):
            place = slice(later * CHUNK, (later + 1) * CHUNK)
            for k in range(0, len(a), VERIFIED):
                part = slice(k, k + VERIFIED)
                more = np.einsum("ij,ij->i", anchors[a[part], place], self.columns[r[part], place])
                found[part] += np.where(self.indexed[r[part]] > later, more, 0.0)
            stop = np.minimum(later + 1, self.indexed[r])
            keep = found + search.rest[a, stop] * self.rest[r, stop] >= limit[a]
            a, r, found = a[keep], r[keep], found[keep]
        score = np.zeros(len(a), np.int64)
        for k in range(0, len(a), VERIFIED):
            part = slice(k, k + VERIFIED)
            score[part] = np.einsum("ij,ij->i", search.vectors[a[part]], self.whole[r[part]])
        keep = score >= search.threshold[a]
        return a[keep], self.order[r[keep]], score[keep]


class Best:
    """The best rows found so far in a task for each window of a search."""

    def __init__(self, search: Search) -> None:
        self.search = search
        self.rows = np.zeros((0, 4), np.int64)  # anchor, window, score, id

    def add(self, anchor: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        search, windows = self.search, self.search.low.shape[1]
        parts = [self.rows]
        for w in range(windows):
            inside = (score >= search.low[anchor, w]) & (score <= search.high[anchor, w])
            parts.append(np.stack([anchor[inside], np.full(int(inside.sum()), w), score[inside], ids[inside]], 1))
        rows = np.concatenate(parts)
        rows = rows[np.lexsort([rows[:, 3], -rows[:, 2], rows[:, 1], rows[:, 0]])]
        group = rows[:, 0] * windows + rows[:, 1]
        rank = np.arange(len(rows)) - np.searchsorted(group, group)
        self.rows = rows[rank < search.k]
        # An anchor whose open windows are all full needs nothing below the least of their last scores.
        last = np.where(search.low <= search.high, -math.inf, math.inf)
        full = rows[rank == search.k - 1]
        last[full[:, 0], full[:, 1]] = full[:, 2]
        search.threshold = np.maximum(search.threshold, last.min(1))


def _search(sent, order: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole: Search = sent.value
        parts = [whole.part(np.arange(k, min(k + TOGETHER, len(whole.ids)))) for k in range(0, len(whole.ids), TOGETHER)]
        best = [Best(part) for part in parts]
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                rows = batch.slice(k, ROWS)
                ids, labels = (rows.column(c).to_numpy() for c in (0, 1))
                vectors = _chunked(_matrix(rows.column(2), len(order)), order)
                for part, kept in zip(parts, best):
                    allowed = (part.labels[:, None] == labels) == part.same
                    allowed &= part.ids[:, None] != ids
                    anchor, row, score = Index(vectors, part).pairs(part, allowed)
                    kept.add(anchor, ids[row], score)
        for part, kept in zip(parts, best):
            anchor, window, score, ids = kept.rows.T
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.ids[anchor]), pa.array(window.astype(np.int32)), pa.array(ids), pa.array(score)],
                ["anchor_id", "window", "vec_id", "score"])

    return run


# --- windows -------------------------------------------------------------------------------


@dataclass
class Table:
    """What the driver knows: the stored rows, their number, the order of dimensions, and a sample."""

    rows: DataFrame
    total: int
    order: np.ndarray
    sample: np.ndarray
    sample_labels: np.ndarray


def _thresholds(table: Table, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, low: np.ndarray,
                high: np.ndarray, wanted: float, same: bool) -> np.ndarray:
    """For each window a score that about ``wanted`` rows of the window should reach, by a normal tail."""
    scores = vectors.astype(float) @ table.sample.T.astype(float)
    mean, spread = scores.mean(1)[:, None], scores.std(1)[:, None] + 1e-9
    equal = (labels[:, None] == table.sample_labels).mean(1)[:, None]
    rows = np.maximum(table.total * np.clip(equal if same else 1 - equal, 1 / len(table.sample), 1), 1.0)
    normal = NormalDist()
    above = np.vectorize(lambda z: 1 - normal.cdf(z), otypes=[float])((high - mean) / spread)
    share = above + wanted / rows
    z = np.vectorize(lambda p: normal.inv_cdf(1 - p) if 0 < p < 1 else -math.inf, otypes=[float])(share)
    return np.maximum(np.ceil(mean + spread * z), low)


def _fill(table: Table, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, low: np.ndarray, high: np.ndarray,
          k: int, same: bool) -> list[DataFrame]:
    """``anchor_id``, ``window``, ``vec_id``, ``score`` and ``rank`` of each window's best rows, a table per round."""
    spark = table.rows.sparkSession
    open_, wanted, out = low <= high, float(EXTRA * k), []
    place = {int(i): n for n, i in enumerate(ids)}
    while open_.any():
        threshold = np.where(open_, _thresholds(table, ids, labels, vectors, low, high, wanted, same), math.inf)
        active = open_.any(1)
        search = Search(ids, labels, vectors, threshold.min(1), np.where(open_, low, 1), np.where(open_, high, 0), k, same)
        sent = spark.sparkContext.broadcast(search.part(np.flatnonzero(active)))  # at most BLOCK anchors
        found = table.rows.mapInArrow(_search(sent, table.order), "anchor_id long, window int, vec_id long, score long")
        ranked = materialize(first_rows(found, k, [F.desc("score"), F.asc("vec_id")], ["anchor_id", "window"]),
                             "best-in-window")
        count = np.zeros(open_.shape, np.int64)
        # At most BLOCK anchors times their windows.
        for anchor, window, n in ranked.groupBy("anchor_id", "window").count().collect():
            count[place[anchor], window] = n
        done = open_ & ((count >= k) | (threshold <= low))
        finished = [(int(ids[a]), int(w)) for a, w in np.argwhere(done)]
        if finished:
            out.append(ranked.join(F.broadcast(spark.createDataFrame(finished, "anchor_id long, window int")),
                                   ["anchor_id", "window"], "left_semi"))
        open_ &= ~done
        wanted *= LOWER
        sent.unpersist()
    return out


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def window_of(positive: int, low: int, high: int) -> tuple[int, int]:
    """The integers s with low * positive <= 100 * s <= high * positive."""
    return -(-low * positive // 100), high * positive // 100


def mine(table: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
         scale: float = 256, id_column: str = "vec_id", vector_column: str = "embedding",
         label_column: str = "label") -> DataFrame:
    """Per anchor, positive and rank a hard negative with both scores; see ``OUTPUT``.

    ``is_anchor`` is a condition on ``vec_id`` and ``label``. The window of a positive are the scores from ``low`` to
    ``high`` per cent of its own.
    """
    spark = table.sparkSession
    rows = integer_vectors(table, id_column, vector_column, label_column, scale)
    total, order = dimensions(rows)
    anchors = rows.filter(is_anchor)
    n_anchors = anchors.count()
    blocks = math.ceil(n_anchors / BLOCK)
    root = scratch_path(spark, "hard-negatives")
    if not blocks:
        return spark.createDataFrame([], OUTPUT)
    anchor_path = scratch_path(spark, "anchors")
    anchors.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks))).repartition("block").write.partitionBy(
        "block").parquet(anchor_path)
    sample = rows.orderBy(F.xxhash64("vec_id", F.lit(1))).limit(SAMPLE).collect()
    known = Table(rows, total, order, _chunked(_matrix([bytes(r["vec"]) for r in sample], len(order)), order),
                  np.array([r["label"] for r in sample]))
    stored = spark.read.schema("vec_id long, label long, vec binary, block long").parquet(anchor_path)
    for block in range(blocks):
        # About BLOCK anchors: blocks are dealt by hash of distinct ids.
        chosen = stored.filter(F.col("block") == block).collect()
        if chosen:
            _mine_block(known, chosen, positives, negatives, low, high).write.mode("overwrite").parquet(
                f"{root}/block={block}")
    return spark.read.schema(f"{OUTPUT}, block long").parquet(root).drop("block")


def _mine_block(table: Table, chosen: list, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    spark = table.rows.sparkSession
    ids, labels = (np.array([r[c] for r in chosen], np.int64) for c in ("vec_id", "label"))
    vectors = _chunked(_matrix([bytes(r["vec"]) for r in chosen], len(table.order)), table.order)
    every = np.full((len(ids), 1), _ANY)
    best = _union(_fill(table, ids, labels, vectors, -every, every, positives, True))
    place = {int(i): n for n, i in enumerate(ids)}
    lows, highs = np.ones((2, len(ids), positives), np.int64)
    highs[:] = 0
    # At most BLOCK anchors times ``positives``.
    pairs = [(r["anchor_id"], r["rank"] - 1, r["vec_id"], r["score"]) for r in best.collect()]
    for anchor, window, _, score in pairs:
        if score >= 0:
            lows[place[anchor], window], highs[place[anchor], window] = window_of(score, low, high)
    found = _fill(table, ids, labels, vectors, lows, highs, negatives, False)
    if not found:
        return spark.createDataFrame([], OUTPUT)
    named = spark.createDataFrame(pairs, "anchor_id long, window int, positive_id long, positive_score long")
    return _union(found).join(F.broadcast(named), ["anchor_id", "window"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
