"""SimHash near-duplicates by a self-join of a binary trie over the fingerprints.

1. A text's fingerprint is the bitwise majority of the XXH64 values of its word shingles.
2. Equal fingerprints become one, with the least id, so copies never meet as pairs.
3. The distinct fingerprints form a binary trie. Its top ``depth`` levels are cut into node pairs whose prefixes
   differ in at most ``max_bits`` bits; each fingerprint goes to the pairs of its node, and a node with too many
   fingerprints is split into parts, of which every two are paired.
4. In a task, the subtries of a pair of nodes are traversed together, level by level: a pair of nodes splits into
   pairs of children, differing bits add up, and pairs over the budget are dropped. Links that are found become
   a spanning forest of the pair of nodes, so a dense group sends on fewer edges than it has members.
5. The edges are joined into components with the least id.

A task holds two parts of at most about ``PART`` fingerprints. A fingerprint is sent to at most
1 + depth + depth * (depth - 1) / 2 node pairs for two bits, with depth growing as the logarithm of the table.

Edge values: null and empty texts and texts without words have fingerprint zero and link to each other like any
others. Rows without an id link nothing and have no component. Rows that share an id are
one node; each row comes out with its own fingerprint. Other columns are dropped. ``one_per_group`` keeps the rows whole,
one of those that share an id; rows without an id stay. An empty table gives an empty one. Texts are shingled whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import type_of
from .components import components
from .wordhash import slices

SHINGLE = 3
MAX_BITS = 2
SEED = 42
PART = 4096
FRONTIER = 1 << 14
COMPARED = 1 << 16
_LOWER = bytes(b + 0x20 if 0x41 <= b <= 0x5A else b for b in range(256))


def shingles(raw: bytes, size: int) -> list[bytes]:
    """Runs of ``size`` lower-cased words with repeats; a shorter text is one shingle, an empty one has none."""
    words = raw.translate(_LOWER).split()
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*[words[k:] for k in range(size)])))


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The majority bits of the shingles' hashes, as an unsigned number."""
    from xxhash import xxh64_intdigest

    found = shingles((text or "").encode(), size)
    votes, step = np.zeros(64, np.int64), 1 << 16
    for k in range(0, len(found), step):
        part = found[k:k + step]
        hashes = np.fromiter((xxh64_intdigest(s, SEED) for s in part), "<u8", len(part))
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(found), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed 64-bit number."""
    kind = type_of(docs, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                prints = np.array([fingerprint(t, size) for t in part.column(1).to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(prints.view(np.int64))], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp long")


# --- the trie ------------------------------------------------------------------------------


def _root(parent: np.ndarray, x: np.ndarray) -> np.ndarray:
    while True:
        up = parent[x]
        if (up == x).all():
            return x
        x = parent[up]


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Unite the sets of a[i] and b[i]; roots are the least members."""
    while len(a):
        a, b = _root(parent, a), _root(parent, b)
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


def trie_links(left: np.ndarray, right: np.ndarray | None, max_bits: int) -> np.ndarray:
    """A spanning forest, as index pairs, of all links within ``max_bits`` between two sorted arrays.

    Indices of ``right`` follow those of ``left``; without ``right`` the array is joined with itself, whose
    diagonal node pairs split into three.
    """
    values = left if right is None else np.concatenate([left, right])
    parent = np.arange(len(values))
    n = len(left)
    start = [0, n, 0, n] if right is None else [0, n, n, len(values)]
    todo = [(np.array([start], np.int64), 0)]
    while todo:
        pairs, bit = todo.pop()
        while len(pairs):
            a0, a1, b0, b1 = pairs.T
            small = (a1 - a0) * (b1 - b0) <= 64
            if bit == 64 or small.any():
                _leaves(values, parent, pairs if bit == 64 else pairs[small], max_bits)
            if bit == 64:
                break
            pairs = pairs[~small]
            if len(pairs) > FRONTIER:  # go deep with one part before the others, to bound the frontier
                todo += [(pairs[k:k + FRONTIER].copy(), bit) for k in range(FRONTIER, len(pairs), FRONTIER)]
                pairs = pairs[:FRONTIER].copy()
            pairs = _children(values, pairs, bit, max_bits)
            bit += 1
    roots = _root(parent, np.arange(len(values)))
    members = np.flatnonzero(roots != np.arange(len(values)))
    return np.stack([members, roots[members]], 1)


def _split(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: int) -> np.ndarray:
    """Where the children with bit 1 begin in each node lo:hi of the sorted values."""
    place = np.uint64(63 - bit)
    above = (values[lo] >> place | np.uint64(1)) << place
    # values of a node share the bits before ``bit``; a binary search by node
    lo, hi = lo.copy(), hi.copy()
    while (lo < hi).any():
        mid = (lo + hi) // 2
        less = (lo < hi) & (values[np.minimum(mid, len(values) - 1)] < above)
        open_ = lo < hi
        lo = np.where(less, mid + 1, lo)
        hi = np.where(open_ & ~less, mid, hi)
    return lo


def _children(values: np.ndarray, pairs: np.ndarray, bit: int, max_bits: int) -> np.ndarray:
    a0, a1, b0, b1 = pairs.T
    am, bm = _split(values, a0, a1, bit), _split(values, b0, b1, bit)
    same = (a0 == b0) & (a1 == b1)
    zero = np.stack([a0, am, b0, bm], 1)
    one = np.stack([am, a1, bm, b1], 1)
    cross = np.stack([a0, am, bm, b1], 1)
    back = np.stack([am, a1, b0, bm], 1)[~same]
    out = np.concatenate([zero, one, cross, back])
    out = out[(out[:, 0] < out[:, 1]) & (out[:, 2] < out[:, 3])]
    # differing bits so far are those of any two members
    place = np.uint64(63 - bit)
    differ = np.bitwise_count((values[out[:, 0]] ^ values[out[:, 2]]) >> place)
    return out[differ <= max_bits]


def _leaves(values: np.ndarray, parent: np.ndarray, pairs: np.ndarray, max_bits: int) -> None:
    """Compare the members of node pairs, a bounded number at a time."""
    width = pairs[:, 3] - pairs[:, 2]
    step = np.maximum(1, COMPARED // np.maximum(width, 1))
    blocks = -(-(pairs[:, 1] - pairs[:, 0]) // step)  # of rows of the first node
    pairs, step = np.repeat(pairs, blocks, 0), np.repeat(step, blocks)
    number = np.arange(len(pairs)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    a0 = pairs[:, 0] + number * step
    a1 = np.minimum(a0 + step, pairs[:, 1])
    sizes = (a1 - a0) * (pairs[:, 3] - pairs[:, 2])
    for k in np.split(np.arange(len(pairs)), np.flatnonzero(np.diff(np.cumsum(sizes) // COMPARED)) + 1):
        b0, b1 = pairs[k, 2], pairs[k, 3]
        size = sizes[k]
        inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        width = np.repeat(b1 - b0, size)
        a, b = np.repeat(a0[k], size) + inner // width, np.repeat(b0, size) + inner % width
        near = np.bitwise_count(values[a] ^ values[b]) <= max_bits
        _unite(parent, a[near], b[near])


def _masks(depth: int, max_bits: int) -> np.ndarray:
    """All ways in which two prefixes of ``depth`` bits differ by at most ``max_bits``, in the top bits."""
    found = {0}
    for _ in range(max_bits):
        found |= {m ^ (1 << (63 - k)) for m in found for k in range(depth)}
    return np.array(sorted(found), np.uint64)


def _link_pair(table: pa.Table, max_bits: int) -> pa.Table:
    values = table.column("fp").to_numpy().view(np.uint64)
    ids = table.column("id").to_numpy()
    side = table.column("side").to_numpy()
    order = np.lexsort([values, side])
    values, ids, side = values[order], ids[order], side[order]
    n = int(np.searchsorted(side, 1))
    found = trie_links(values[:n], values[n:] if n < len(values) else None, max_bits) if n else (
        np.zeros((0, 2), np.int64))
    return pa.table({"u": ids[found[:, 0]], "v": ids[found[:, 1]]})


def links(values: DataFrame, total: int, max_bits: int = MAX_BITS, part: int = PART) -> DataFrame:
    """Edges ``u``, ``v`` between ids that link, from ``total`` rows ``fp`` and ``id``.

    The edges span the same components as all links do; of links that close a circle within a pair of nodes only a
    spanning forest comes out.
    """
    depth = min(64, max(0, math.ceil(math.log2(max(total, 1) / part))))
    shifts = [int(m) >> (64 - depth) if depth else 0 for m in _masks(depth, max_bits)]
    prefix = F.shiftrightunsigned("fp", 64 - depth) if depth else F.lit(0).cast("long")
    nodes = values.withColumn("node", prefix)
    # A node of the cut may hold more than its share: it is dealt out in parts.
    parts = nodes.groupBy("node").agg(F.ceil(F.count(F.lit(1)) / F.lit(part)).cast("int").alias("parts"))
    dealt = nodes.join(parts, "node").withColumn(
        "part", F.pmod(F.xxhash64("fp", "id"), F.col("parts")).cast("int"))
    other = (dealt.withColumn("mask", F.explode(F.array(*[F.lit(m).cast("long") for m in shifts])))
             .withColumn("other", F.col("node").bitwiseXOR(F.col("mask"))))
    # Only pairs with a node that exists; the number of its parts says how many pairs of parts there are.
    paired = other.join(parts.select(F.col("node").alias("other"), F.col("parts").alias("other_parts")), "other")
    spread = paired.withColumn("other_part", F.explode(F.sequence(F.lit(0), F.col("other_parts") - 1)))
    mine, its = F.struct("node", "part"), F.struct(F.col("other").alias("node"), F.col("other_part").alias("part"))
    keyed = spread.select(
        F.least(mine, its).alias("low"), F.greatest(mine, its).alias("high"),
        (mine > its).cast("int").alias("side"), "fp", "id").select(
        F.col("low.node").alias("n1"), F.col("low.part").alias("p1"),
        F.col("high.node").alias("n2"), F.col("high.part").alias("p2"), "side", "fp", "id")

    def run(key: tuple, table: pa.Table) -> pa.Table:
        return _link_pair(table, max_bits)

    return keyed.groupBy("n1", "p1", "n2", "p2").applyInArrow(run, "u long, v long")


def _grouped(prints: DataFrame, distinct: DataFrame, found: DataFrame) -> DataFrame:
    """``prints`` with ``component_id``, from edges between the ids of distinct fingerprints."""
    named = prints.filter("doc_id is not null")
    # An id with several fingerprints joins them.
    repeated = named.groupBy("doc_id").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).filter("a != b")
    shared = (named.join(repeated.select("doc_id"), "doc_id", "left_semi").join(distinct.select("fp", "id"), "fp")
              .filter(F.col("doc_id") != F.col("id")).select(F.col("doc_id").alias("u"), F.col("id").alias("v")))
    least = components(found.unionByName(shared), "near-duplicate-edges")
    group = distinct.join(least, distinct["id"] == least["u"], "left").select(
        "fp", F.coalesce("v", "id").alias("component_id"))
    return prints.join(group, "fp", "left").withColumn(
        "component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))


def _distinct(prints: DataFrame) -> DataFrame:
    return materialize(prints.filter("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("id")),
                       "distinct-fingerprints")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """Per row: ``doc_id``, ``fp`` and ``component_id``, the least id that links of ``max_bits`` bits reach."""
    prints = materialize(fingerprints(docs, size), "fingerprints")
    distinct = _distinct(prints)
    found = links(distinct, distinct.count(), max_bits)
    return _grouped(prints, distinct, found).select("doc_id", "fp", "component_id")


def one_per_group(docs: DataFrame, size: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` with the least id of each group; of rows that share an id, one. Rows without an id stay."""
    stay = near_duplicates(docs, size, max_bits).filter("component_id = doc_id").select("doc_id").distinct()
    id_name, text = (f"in_{docs.columns.index(c)}" for c in ("doc_id", "text"))
    inner = docs.select(*[F.col(f"`{c}`").alias(f"in_{i}") for i, c in enumerate(docs.columns)])
    order = Window.partitionBy(id_name).orderBy(F.xxhash64(text))
    named = inner.join(stay.withColumnRenamed("doc_id", id_name), id_name, "left_semi").withColumn(
        "row", F.row_number().over(order)).filter("row = 1").drop("row")
    kept = named.unionByName(inner.filter(F.col(id_name).isNull()))
    return kept.select(*[F.col(f"in_{i}").alias(c) for i, c in enumerate(docs.columns)])
