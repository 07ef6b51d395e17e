"""Approximate nearest neighbours by multiprobe p-stable hashing.

Each of ``TABLES`` tables hashes a vector to the cell of ``K`` random projections cut into steps of width ``w``.
A query visits its own cell and perturbed cells (a step up or down in some projections) in the order of their
estimated success, by the squared distances from the query to the borders that are crossed. Candidates of all
visited cells are ranked by exact Euclidean distance in double precision.

Equal vectors are one class with its ``k + 1`` smallest ids, so copies are never compared with each other. The
number of projections grows with the logarithm of the number of classes. A sample of ``SAMPLE`` vectors is
compared with every row, which gives the width (twice their distance to the k-th neighbour) and the number of
probes at which they would find ``TARGET`` of their neighbours. Every row is indexed.

A cell's candidates meet its queries in one group; a cell of more than ``CELL`` candidates is dealt out in
parts, each of which its queries visit. A group sends on at most ``k + 1`` candidates per query.

Edge values: vectors that are null, zero, of another length than the most frequent one, or with null or
non-finite components take no part, nor do rows without an id. Rows that share an id are one candidate at the
least distance, and a query's own id is never its neighbour. Fewer candidates give fewer rows, none give none.
Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .wordhash import mix

K = 10
TABLES = 4
CELL = 16_384
SAMPLE = 100
TARGET = 0.97
ROWS_PER_CELL = 1_000
PERTURBATIONS = 8_192
SEED = 7


def valid_vectors(table: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``id``, ``vec`` (doubles, no minus zero) and a digest ``d1``, ``d2`` of the vectors that take part."""
    vec = F.transform(F.col(vector_column), lambda x: x.cast("double") + F.lit(0.0))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = table.select(F.col(id_column).cast("long").alias("id"), vec.alias("vec")).filter(
        F.col("id").isNotNull() & F.col("vec").isNotNull() & ~bad & F.exists("vec", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    return rows.filter(F.size("vec") == (sizes[0]["size"] if sizes else 0)).withColumns(
        {"d1": F.xxhash64(F.lit("a"), "vec"), "d2": F.xxhash64(F.lit("b"), "vec")})


def vector_classes(rows: DataFrame, k: int) -> DataFrame:
    """One row per distinct vector: least id ``cls``, the ``k + 1`` smallest ids, and the vector."""
    order = Window.partitionBy("d1", "d2").orderBy("id")
    few = rows.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k + 1)
    return few.groupBy("d1", "d2").agg(F.min("id").alias("cls"), F.array_sort(F.collect_list("id")).alias("ids"),
                                       F.min_by("vec", "id").alias("vec"))


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def distances(queries: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Exact distances from one query after another to all rows."""
    for i, query in enumerate(queries):
        yield i, np.sqrt(np.square(rows - query).sum(1))


def nearest(dist: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indices of the ``k`` least (distance, id)."""
    at = np.arange(len(dist))
    if len(dist) > k:
        at = np.flatnonzero(dist <= np.partition(dist, k - 1)[k - 1])
    return at[np.lexsort([ids[at], dist[at]])][:k]


@dataclass
class Index:
    """Projections of all tables, and the perturbations in no order."""

    directions: np.ndarray  # tables x projections x dimension
    shifts: np.ndarray  # tables x projections
    width: float
    moves: np.ndarray  # perturbations x projections, -1, 0 or 1
    probes: int

    def cells(self, vectors: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
        """Cell coordinates, and how far above its lower border each vector lies (0 to 1)."""
        at = (vectors @ self.directions[table].T + self.shifts[table]) / self.width
        cell = np.floor(at)
        return cell.astype(np.int64), at - cell

    @staticmethod
    def keys(cells: np.ndarray, table: int) -> np.ndarray:
        key = np.full(len(cells), table + 1, np.uint64)
        for column in cells.T:
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.uint64))
        return key.view(np.int64)

    def order(self, above: np.ndarray) -> np.ndarray:
        """For each query the perturbations, likeliest first."""
        up, down = np.square(1 - above), np.square(above)
        cost = up @ (self.moves == 1).T.astype(float) + down @ (self.moves == -1).T.astype(float)
        return np.argsort(cost, axis=1, kind="stable")


def perturbations(projections: int, most: int = PERTURBATIONS) -> np.ndarray:
    """Moves by one step in as many projections as ``most`` perturbations allow."""
    out = [np.zeros((1, projections), np.int8)]
    for moved in range(1, projections + 1):
        if sum(map(len, out)) + math.comb(projections, moved) * 2 ** moved > most and moved > 2:
            break
        rows = np.zeros((math.comb(projections, moved) * 2 ** moved, projections), np.int8)
        for row, (places, signs) in zip(rows, product(combinations(range(projections), moved),
                                                      product((-1, 1), repeat=moved))):
            row[list(places)] = signs
        out.append(rows)
    return np.concatenate(out)


def _sample_neighbours(classes: DataFrame, sample: np.ndarray, own: np.ndarray, k: int) -> DataFrame:
    """The true neighbours of a few vectors among all classes: ``q``, ``dist``, ``cls``, ``vec``."""
    sent = classes.sparkSession.sparkContext.broadcast((sample, own))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, own = sent.value
        for batch in batches:
            ids, rows = batch.column(0).to_numpy(), _matrix(batch.column(1))
            for i, dist in distances(queries, rows):
                dist[ids == own[i]] = np.inf
                at = nearest(dist, ids, k)
                at = at[np.isfinite(dist[at])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), i)), pa.array(dist[at]), batch.column(0).take(pa.array(at)),
                     batch.column(1).take(pa.array(at))], ["q", "dist", "cls", "vec"])

    found = classes.select("cls", "vec").mapInArrow(run, "q long, dist double, cls long, vec array<double>")
    order = Window.partitionBy("q").orderBy("dist", "cls")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def build_index(classes: DataFrame, k: int = K, tables: int = TABLES) -> Index | None:
    """Choose width, projections and probes from a bounded sample; None for fewer than two classes."""
    total = classes.count()
    if total < 2:
        return None
    rows = classes.select("cls", "vec").orderBy(F.xxhash64("cls"), "cls").limit(SAMPLE).collect()
    sample = np.array([r["vec"] for r in rows])
    own = np.array([r["cls"] for r in rows])
    true = _sample_neighbours(classes, sample, own, k).collect()  # SAMPLE * k rows
    query = np.array([r["q"] for r in true])
    near = np.array([r["vec"] for r in true])
    last = {r["q"]: r["dist"] for r in sorted(true, key=lambda r: r["rank"])}
    width = 2 * float(np.median(list(last.values())))
    random = np.random.default_rng(SEED)
    most = max(1, round(math.log2(total / ROWS_PER_CELL))) if total > ROWS_PER_CELL else 1
    for projections in range(most, 0, -1):
        directions = random.normal(size=(tables, projections, sample.shape[1]))
        index = Index(directions, random.uniform(0, width, (tables, projections)), width,
                      perturbations(projections), 0)
        step = np.full(len(true), len(index.moves))  # the probe at which a neighbour is found
        code = {tuple(m): i for i, m in enumerate(index.moves.tolist())}
        for table in range(tables):
            cell, above = index.cells(sample, table)
            place = np.argsort(index.order(above), axis=1)
            moved = index.cells(near, table)[0] - cell[query]
            at = np.array([code.get(tuple(m), -1) for m in moved.tolist()])
            step = np.minimum(step, np.where(at >= 0, place[query, at], len(index.moves)))
        found = np.cumsum(np.bincount(step, minlength=len(index.moves) + 1)[:-1]) / len(true)
        if found[-1] >= TARGET or projections == 1:
            index.probes = int(np.searchsorted(found, min(TARGET, found[-1]))) + 1
            return index
    return None


def search(classes: DataFrame, queries: DataFrame, index: Index, k: int = K) -> DataFrame:
    """``q`` (a class), ``id`` and ``dist``: at most ``k`` nearest ids found per class in ``queries``."""
    sent = classes.sparkSession.sparkContext.broadcast(index)
    kind = "key long, query boolean, cls long, ids array<long>, vec array<double>"

    def send(query: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = sent.value
            for batch in batches:
                for start in range(0, batch.num_rows, 512):
                    part = batch.slice(start, 512)
                    vectors = _matrix(part.column(2))
                    for table in range(len(index.directions)):
                        cell, above = index.cells(vectors, table)
                        if query:
                            moves = index.moves[index.order(above)[:, :index.probes]]
                            keys = index.keys((cell[:, None, :] + moves).reshape(-1, cell.shape[1]), table)
                            rows = pa.array(np.repeat(np.arange(part.num_rows), moves.shape[1]))
                        else:
                            keys, rows = index.keys(cell, table), pa.array(np.arange(part.num_rows))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(keys), pa.array(np.full(len(keys), query)),
                             *[part.column(c).take(rows) for c in range(3)]], ["key", "query", "cls", "ids", "vec"])

        return run

    narrow = ["cls", "ids", "vec"]
    rows = classes.select(*narrow).mapInArrow(send(False), kind)
    large = (rows.groupBy("key").count().filter(F.col("count") > CELL)
             .select("key", F.ceil(F.col("count") / F.lit(CELL)).cast("int").alias("parts")))
    asked = queries.select(*narrow).mapInArrow(send(True), kind)
    parts = F.coalesce("parts", F.lit(1))
    dealt = rows.join(large, "key", "left").withColumn("part", F.pmod(F.xxhash64("cls"), parts).cast("int"))
    visits = asked.join(large, "key", "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))

    def rank(key: tuple, table: pa.Table) -> pa.Table:
        query = table.column("query").to_numpy()
        there, here = np.flatnonzero(query), np.flatnonzero(~query)
        out = [[], [], []]
        if len(there) and len(here):
            ids = table.column("cls").to_numpy()
            vectors = _matrix(table.column("vec"))
            lists = table.column("ids").take(pa.array(here)).to_pylist()
            for i, dist in distances(vectors[there], vectors[here]):
                for at in nearest(dist, ids[here], k).tolist():
                    out[0] += [ids[there[i]]] * len(lists[at])
                    out[1] += lists[at]
                    out[2] += [dist[at]] * len(lists[at])
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())],
                        names=["q", "id", "dist"])

    columns = ["key", "part", "query", *narrow]
    found = dealt.select(*columns).unionByName(visits.select(*columns)).groupBy("key", "part").applyInArrow(
        rank, "q long, id long, dist double")
    best = found.groupBy("q", "id").agg(F.min("dist").alias("dist"))
    order = Window.partitionBy("q").orderBy("dist", "id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).drop("rank")


def nearest_neighbours(table: DataFrame, is_query: F.Column, k: int = K, id_column: str = "vec_id",
                       vector_column: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the ``k`` nearest rows found for each query.

    ``is_query`` is a condition over ``id``.
    """
    rows = valid_vectors(table, id_column, vector_column)
    classes = materialize(vector_classes(rows, k), "vector-classes")
    queries = materialize(rows.filter(is_query).select(F.col("id").alias("query_id"), "d1", "d2").distinct().join(
        classes.select("d1", "d2", F.col("cls").alias("q")), ["d1", "d2"]).select("query_id", "q"), "queries")
    index = build_index(classes, k)
    if index is None:  # one class: its members are at distance 0 of each other
        found = classes.select(F.col("cls").alias("q"), F.explode("ids").alias("id"), F.lit(0.0).alias("dist"))
    else:
        asked = classes.join(queries.select(F.col("q").alias("cls")).distinct(), "cls", "left_semi")
        found = search(classes, asked, index, k + 1)
    order = Window.partitionBy("query_id").orderBy("dist", "id")
    return (queries.join(found, "q").filter(F.col("id") != F.col("query_id"))
            .groupBy("query_id", "id").agg(F.min("dist").alias("dist"))
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias("vec_id"), F.col("dist").alias("score")))
