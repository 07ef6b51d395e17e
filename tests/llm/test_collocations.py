"""Phrase collocations against plain counting, and the double array against a dictionary."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from opinion_engine.llm import collocations, counting
from opinion_engine.llm.queries import QUERIES
from tests.compare import duck

from .cases import SCHEMA, documents, edge_rows, words

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
_LOWER = bytes(b + 0x20 if 0x41 <= b <= 0x5A else b for b in range(256))


def plain(rows, least, longest=5, first=2000):
    """rows: (text, lang)."""
    count, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(rb"[.,;:!?\n-\r]", (text or "").encode().translate(_LOWER)):
            found = re.findall(rb"[^ \t]+", piece)
            total[lang] += len(found)
            for k in range(1, longest + 1):
                count.update((lang, *found[i:i + k]) for i in range(len(found) - k + 1))
    phrases = {p: a for p, a in count.items() if a >= least and len(p) > 2}
    hidden = set()
    for p, a in phrases.items():
        for size in range(2, len(p) - 1):
            for i in range(1, len(p) - size + 1):
                part = (p[0], *p[i:i + size])
                if 100 * a >= 100 * phrases[part]:
                    hidden.add(part)
    out = []
    for lang in total:
        scored = []
        for p, a in phrases.items():
            if p[0] == lang and p not in hidden:
                cuts = []
                for k in range(1, len(p) - 1):
                    left, right = count[p[:k + 1]], count[(lang, *p[k + 1:])]
                    cuts.append((1000 * a * total[lang] // (left * right), k, left, right))
                score, _, left, right = min(cuts)
                scored.append((-score, -a, b" ".join(p[1:]), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def mined(docs, **options):
    got = collocations.mine(docs, **options)
    assert got.columns == COLUMNS
    return sorted(tuple(r) for r in got.collect())


def prose(n, seed, size=14):
    """Texts with few words, fixed phrases, breaks and letters of both cases."""
    chosen = random.Random(seed)
    vocabulary = [*words(size, seed), "été", "\U0001f600", "á"]
    fixed = [" ".join(chosen.choices(vocabulary, k=chosen.randint(2, 7))) for _ in range(5)]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(chosen.randint(0, 40)):
            parts.append(chosen.choice(fixed) if chosen.random() < 0.2 else chosen.choices(
                vocabulary, range(len(vocabulary), 0, -1))[0])
            parts.append(chosen.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", "! ", ";x:"]))
        text = "".join(parts)
        out.append(text.upper() if chosen.random() < 0.2 else text)
    return out


@pytest.mark.parametrize("least, longest", [(5, 5), (20, 3), (3, 2), (4, 7)])
def test_plain_counting(spark, least, longest):
    rows = [(k, t, chosen) for k, (t, chosen) in enumerate(zip(prose(300, least), ["en", "fr", None] * 100))]
    assert mined(documents(spark, rows), least=least, longest=longest) == plain([r[1:] for r in rows], least, longest)


def test_many_tries_and_a_small_filter(spark, monkeypatch):
    for name, value in (("TRIE", 20), ("FILTER_BITS", 17)):
        monkeypatch.setattr(collocations, name, value)
    rows = [(k, t, "en") for k, t in enumerate(prose(200, 9))]
    want = plain([r[1:] for r in rows], 4)
    assert len(want) > 60 and mined(documents(spark, rows), least=4) == want


def test_first_rows_and_ties(spark):
    rows = [(k, "p q. r s. t u. a b c. a b d", "en") for k in range(10)]
    for first in (1, 2, 5):
        assert mined(documents(spark, rows), least=2, first=first) == plain([r[1:] for r in rows], 2, first=first)


def test_edge_values(spark):
    rows = [(i, t, *(lang or [None])) for i, t, *lang in edge_rows()] + [
        (60, "same same same same " * 30, "de"), (61, "w" * 5000 + " x " + "w" * 5000 + " x", "de"), (62, ".,;:!?", "")]
    assert mined(documents(spark, rows), least=2) == plain([r[1:] for r in rows], 2)


def test_empty_and_rare(spark):
    assert mined(spark.createDataFrame([], SCHEMA)) == []
    assert mined(documents(spark, [(1, None), (2, "a b c"), (3, "")])) == []


@pytest.mark.parametrize("seed", range(4))
def test_double_array(seed):
    chosen = random.Random(seed)
    symbols = [chosen.getrandbits(64) - (1 << 63) for _ in range((3, 40, 400, 2_000)[seed])]
    phrases = list({tuple(chosen.choices(symbols, k=chosen.randint(1, 5))) for _ in range(3_000)})
    flat = np.array([w for p in phrases for w in p], np.int64).view(np.uint64)
    trie = collocations.DoubleArray.build(flat, np.array([len(p) for p in phrases]))
    text = [w for p in chosen.choices(phrases, k=500) for w in p] + chosen.choices(symbols, k=500) + [12345]
    joined = np.array([chosen.random() < 0.9 for _ in text])
    codes = trie.codes(np.array(text, np.int64).view(np.uint64))
    got = Counter()
    for found in trie.accepted(codes, joined):
        got.update(tuple(trie.symbols(c[c > 0]).view(np.int64).tolist()) for c in trie.phrases[found])
    want, known = Counter(), set(phrases)
    for i in range(len(text)):
        for k in range(1, 6):
            if i + k <= len(text) and joined[i + 1:i + k].all() and tuple(text[i:i + k]) in known:
                want[tuple(text[i:i + k])] += 1
    assert got == want and len(trie.check) < 3 * (trie.check >= 0).sum() + 2 * len(symbols) + 2000
    again = collocations.DoubleArray.unpack(*trie.pack(), trie.phrases.shape[1])
    assert all((a == b).all() for a, b in zip(vars(again).values(), vars(trie).values()))


def test_double_array_of_many_words_stays_small():
    """Children that lie far apart: 60,000 symbols, 100,000 phrases of three."""
    chosen = np.random.default_rng(2)
    symbols = chosen.integers(0, 1 << 63, 60_000, dtype=np.uint64)
    heads = chosen.integers(0, 2_000, 100_000)
    rows = np.unique(np.stack([heads, chosen.integers(0, 60_000, 100_000), chosen.integers(0, 60_000, 100_000)], 1), axis=0)
    trie = collocations.DoubleArray.build(symbols[rows].ravel(), np.full(len(rows), 3))
    assert len(trie.check) < 4_000_000
    met = list(trie.accepted(trie.codes(symbols[rows].ravel()), np.tile([False, True, True], len(rows))))
    assert [len(m) for m in met] == [0, 0, len(rows)] and len(set(met[2].tolist())) == len(rows)


def test_combiner(monkeypatch):
    monkeypatch.setattr(counting, "WAITING", 40)
    chosen, waiting, got, want, most = random.Random(1), counting.Combiner(["k", "word", "n"]), Counter(), Counter(), 0
    for _ in range(50):
        keys = np.array([chosen.choice([*range(5), *range(5, 200)]) % 60 for _ in range(7)], np.uint64)
        for k in keys.tolist():
            want[k, f"w{k}"] += 2
        for batch in waiting.add(keys, np.full(7, 2), [keys, [f"w{k}" for k in keys]]):
            got.update({(r["k"], r["word"]): r["n"] for r in batch.to_pylist()})
        most = max(most, waiting.rows)
    for batch in waiting.flush():
        got.update({(r["k"], r["word"]): r["n"] for r in batch.to_pylist()})
    assert got == want and most < 47 and list(waiting.flush()) == []


def test_scores_pass_64_bits(spark):
    row = spark.createDataFrame([(10 ** 14, 10 ** 15, 10 ** 14, 3 * 10 ** 14)], "a long, n long, l long, r long")
    exact = collocations._exact
    got = row.selectExpr(f"(1000 * {exact('a')} * {exact('n')}) div ({exact('l')} * {exact('r')})").first()[0]
    assert got == 1000 * 10 ** 29 // (3 * 10 ** 28)


def test_query(spark):
    rows = duck("/root/testdata/sf0.001").execute("select text, lang from documents").fetchall()
    got = QUERIES["op11_collocations"](spark, "/root/testdata/sf0.001")
    assert [t for _, t in got.dtypes] == ["string", "bigint", "string", *["bigint"] * 5]
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, 100)
