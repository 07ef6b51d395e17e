"""Nearest neighbours against brute force, and URL rules against a plain version."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinion_engine.llm import ann_search, url_rules
from opinion_engine.llm.queries import LISTED_RULES, PATTERN_RULES

SCHEMA = "vec_id long, embedding array<float>, label int, q long, rank int, cls long, vec string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 2, 3, "v") for i, v in rows], SCHEMA).repartition(3)


def plain_neighbours(rows, k, every=100):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows
            if i is not None and v is not None and None not in v and np.isfinite(v).all() and any(v)]
    size = max({len(v) for _, v in good}, key=lambda n: (sum(len(v) == n for _, v in good), n), default=0)
    good = [(i, v) for i, v in good if len(v) == size]
    out = {}
    for i in {i for i, _ in good if i % every == 0}:
        best = {}
        for own in (v for j, v in good if j == i):
            for j, v in good:
                if j != i:
                    best[j] = min(best.get(j, np.inf), float(np.sqrt(np.square(v - own).sum())))
        out[i] = sorted((d, j) for j, d in best.items())[:k]
    return out


def compare(got, want):
    hits = total = 0
    for query, best in want.items():
        found = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == query)
        assert [r for r, _, _ in found] == list(range(1, len(best) + 1))
        assert [(s, v) for _, v, s in found] == sorted((s, v) for _, v, s in found)
        hits += len({v for _, v, _ in found} & {j for _, j in best})
        total += len(best)
    assert {r["query_id"] for r in got} == {q for q, b in want.items() if b}
    return hits / max(total, 1)


def test_recall(spark):
    chosen = np.random.default_rng(3)
    centers = chosen.normal(size=(8, 24))
    data = centers[chosen.integers(0, 8, 4000)] + chosen.normal(0, 0.5, (4000, 24))
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(data)]
    got = ann_search.nearest_neighbours(vectors(spark, rows), F.col("id") % 100 == 0).collect()
    assert compare(got, plain_neighbours(rows, 10)) >= 0.9


def test_copies_ties_and_bad_vectors(spark):
    hot = [1.0, 2.0, 0.0]
    rows = [(i, hot) for i in range(0, 700)] + [(1000, [1.0, 2.0, -0.0]), (1001, [1.5, 2.0, 0.0]), (1001, [9.0, 0.0, 0.0])]
    rows += [(2000 + k, v) for k, v in enumerate([None, [], [0.0, 0.0, 0.0], [None, 1.0, 2.0], [float("nan"), 1.0, 1.0],
                                                   [float("inf"), 1.0, 1.0], [1.0, 2.0], [1.0, 2.0, 0.0, 0.0]])]
    rows += [(None, hot), (3000, [0.0, 2.0, 0.0]), (3001, [2.0, 2.0, 0.0])]
    got = ann_search.nearest_neighbours(vectors(spark, rows), F.col("id") % 100 == 0).collect()
    want = plain_neighbours(rows, 10)
    assert compare(got, want) >= 0.9
    exact = {q: [(r["score"], r["vec_id"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] for q in want}
    assert all(exact[q] == want[q] for q in want if q <= 1000)


def test_large_cells_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(ann_search, "CELL", 20)
    rows = [(i, v.tolist()) for i, v in enumerate(np.random.default_rng(1).normal(size=(500, 4)))]
    got = ann_search.nearest_neighbours(vectors(spark, rows), F.col("id") % 100 == 0).collect()
    assert compare(got, plain_neighbours(rows, 10)) >= 0.9


@pytest.mark.parametrize("rows", [[], [(0, [1.0])], [(0, [1.0]), (100, [1.0])], [(0, [1.0]), (7, [2.0])], [(5, [1.0])]])
def test_few_rows(spark, rows):
    got = ann_search.nearest_neighbours(vectors(spark, rows), F.col("id") % 100 == 0).collect()
    assert compare(got, plain_neighbours(rows, 10)) == (1.0 if len(rows) > 1 else 0.0)


def test_probes_come_in_order_of_cost():
    index = ann_search.Index(np.zeros((1, 3, 2)), np.zeros((1, 3)), 1.0, ann_search.perturbations(3), 5)
    assert len(index.moves) == 27 and len({tuple(m) for m in index.moves}) == 27
    above = np.array([[0.1, 0.5, 0.8]])
    moves = index.moves[index.order(above)[0]]
    cost = [sum((1 - x) ** 2 if m > 0 else x ** 2 if m < 0 else 0 for m, x in zip(move, above[0])) for move in moves]
    assert moves[0].tolist() == [0, 0, 0] and moves[1].tolist() == [-1, 0, 0] and cost == sorted(cost)


# --- URL rules -----------------------------------------------------------------------------

URLS = [None, "", "no-scheme.org/x", "://", "http://", "https://Sub.Example.ORG/es/1?x#y", "http://example.org/en/1",
        "http://example.org/en/2", "http://notexample.org/es/", "http://example.com/fr/", "http://a.com/de/x", "x://com/de/",
        "http://org", "http://org/", "ftp://a.b.org?x=/y", "http://spam-farm.example.net/", "http://my.spam-farm.org/",
        "http://a.net/spam-farm.", "HTTP://CHEAP-PILLS.x.net/a?b", "http://x.net/?SessionID=1", "http://x.net/?utm_source=spam",
        "http://x.net/?utm_source=spammer", "http://ex.com/fr/?q=http://spam-farm.x", "http://é.org/É", "a://b://c.org/",
        "http://x.net/" + "a" * 30_000, "http://best.casino-x.net", "casino.net", "\n://org/\n"]


def plain_verdict(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.sub("[A-Z]", lambda m: m[0].lower(), re.match(r"[^/?#]*", rest)[0])
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    fits = [r for r in LISTED_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if fits:
        best = max(fits, key=lambda r: len(r.text))
        return host, path, best.text, best.verdict
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), url or "")
    return host, path, None, next((r.verdict for r in PATTERN_RULES if re.search(r.pattern, lower)), "allow")


def test_urls(spark):
    rows = [(i, u, "<html>", "h", "v", 1) for i, u in enumerate(URLS)] + [(None, URLS[5], "", "h", "v", 1)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, verdict string, rule int")
    got = url_rules.judge(pages.repartition(2), LISTED_RULES, PATTERN_RULES).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((r[0], *plain_verdict(r[1])) for r in rows), key=repr)
    assert url_rules.judge(pages.limit(0), LISTED_RULES, PATTERN_RULES).count() == 0
    assert {r["rule"] for r in url_rules.judge(pages, (), ()).collect()} == {None}


def test_rules_are_filed_under_their_rarest_token():
    index = url_rules.PatternIndex(PATTERN_RULES, {"spam": 9, "farm": 3, "cheap": 1, "pills": 2, "utm": 5, "source": 5})
    assert set(index.by_token) == {"farm", "cheap", "casino", "sessionid", "source"}
