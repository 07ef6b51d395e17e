"""Hard negatives against brute force, and the threshold join against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinion_engine.llm import hard_negatives as hn
from opinion_engine.llm.queries import QUERIES
from tests.compare import duck

SCHEMA = "vec_id long, embedding array<float>, label int, anchor_id long, score double, rank int, vec string, window int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, l, 1, 2.0, 3, "v", 4) for i, v, l in rows], SCHEMA).repartition(3)


def plain(rows, every=100, positives=5, negatives=10):
    """All rows (id, vector, label) by exact integers; an id that repeats counts once, with its least (label, vector)."""
    best = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = tuple(math.floor(256 * float(np.float32(x))) for x in v)
        if sum(x * x for x in whole) < 1 << 62:
            key = (label, np.array(whole, "<i4").tobytes())
            best[i] = min(best.get(i, (key, whole)), (key, whole))
    good = {i: (key[0], whole) for i, (key, whole) in best.items()}
    out = set()
    for anchor in (i for i in good if i % every == 0):
        label, x = good[anchor]
        scored = sorted((-sum(a * b for a, b in zip(x, y)), i, other) for i, (other, y) in good.items() if i != anchor)
        for p, positive, _ in [s for s in scored if s[2] == label][:positives]:
            inside = [(n, i) for n, i, other in scored if other != label and 30 * -p <= 100 * -n <= 90 * -p]
            out |= {(anchor, positive, k + 1, i, -p, -n) for k, (n, i) in enumerate(inside[:negatives])}
    return out


def mined(spark, rows, **options):
    got = hn.mine(table(spark, rows), F.col("vec_id") % 100 == 0, **options).collect()
    assert len(got) == len(set(got))
    return {tuple(r) for r in got}


def clustered(n, d, seed, labels=7):
    chosen = np.random.default_rng(seed)
    label = chosen.integers(0, labels, n)
    centers = chosen.normal(size=(labels, d)) * np.linspace(1, 0.1, d)
    data = centers[label] * chosen.random((n, 1)) + chosen.normal(0, 0.3, (n, d))
    return [(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(data.astype(np.float32), label))]


def test_brute_force(spark):
    rows = clustered(3_000, 37, 5)
    assert mined(spark, rows) == plain(rows)


def test_blocks_and_rounds(spark, monkeypatch):
    """Anchors in many blocks, first thresholds that are far too high, and a join that always goes on with lists."""
    for name, value in (("BLOCK", 3), ("EXTRA", 1e-6), ("SPARSE", 1), ("ROWS", 100), ("TOGETHER", 2), ("SAMPLE", 5)):
        monkeypatch.setattr(hn, name, value)
    rows = clustered(1_200, 11, 6, 3)
    assert mined(spark, rows) == plain(rows)


def test_edge_values(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(k, [1.0, 0.5, -0.25], k % 2) for k in range(0, 700)]  # a hot vector: all scores tie
    rows += [(1000 + k, v, 1) for k, v in enumerate(
        [None, [], [0.0, 0.0, 0.0], [None, 1.0, 2.0], [nan, 1.0, 1.0], [inf, 1.0, 1.0], [1.0, 0.4], [0.9, 0.4, 0.0, 5.0],
         [3e38, 1.0, 1.0], [-1.0, -1.0, 1.0], [0.5, 0.5, 0.5], [1e4, 1e4, 1e4]])]
    rows += [(1100, [0.0, 0.0, 0.0], 2), (1200, [-1.0, 0.0, 0.0], 9), (None, [1.0, 1.0, 1.0], 1), (2, [1.0, 1.0, 1.0], None),
             (3, [9.0, 9.0, 9.0], 0), (3, [9.0, 9.0, 9.0], 0), (100, [0.3, 0.2, 0.1], 0), (1300, [0.2, 0.1, 0.0], 2),
             (1400, [0.7, 0.5, 0.1], 5), (1401, [0.7, 0.5, 0.1], 5), (1402, [0.1, -0.9, 0.0], 5)]
    assert mined(spark, rows) == plain(rows)


def test_tables_without_rows_or_anchors(spark):
    assert mined(spark, []) == set() and mined(spark, [(1, [1.0], 1), (3, None, 2)]) == set()
    assert mined(spark, [(100, [1.0], 1)]) == set()


@pytest.mark.parametrize("share", [0.0, 0.4, 0.8, 0.97])
def test_the_join_finds_all_pairs_and_prunes(share):
    chosen = np.random.default_rng(8)
    d = 40
    rows = np.floor(chosen.normal(size=(500, d)) * 300 * np.linspace(1, 0.02, d)).astype(np.int64)
    anchors = np.floor(chosen.normal(size=(20, d)) * 300 * np.linspace(1, 0.02, d)).astype(np.int64)
    scores = anchors @ rows.T
    threshold = np.quantile(scores, share, axis=1) if share else np.full(20, -math.inf)
    low, high = np.full((20, 1), -hn._ANY), np.full((20, 1), hn._ANY)
    search = hn.Search(np.arange(20), np.zeros(20), anchors, threshold, low, high, 5, True)
    allowed = chosen.random((20, 500)) < 0.9
    index = hn.Index(rows, search)
    a, r, score = index.pairs(search, allowed)
    want = np.argwhere(allowed & (scores >= threshold[:, None]))
    assert sorted(zip(a, r)) == sorted(map(tuple, want)) and (score == scores[a, r]).all()
    if share > 0.9:
        assert sum(index.height) < 0.9 * 500 * len(index.height)  # dimensions are left out


def test_query(spark):
    rows = duck("/root/testdata/sf0.001").execute("select vec_id, embedding, label from embeddings").fetchall()
    rows = [(i, v, (c + 1) % 10 if i % 7 == 0 and c is not None else c) for i, v, c in rows]
    got = QUERIES["op13_hard_negatives"](spark, "/root/testdata/sf0.001")
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert {tuple(r) for r in got.collect()} == plain(rows)
