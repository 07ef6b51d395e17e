"""SentencePiece coding against the library, and benchmark decontamination against a plain version."""

import random
import re

import numpy as np
import pytest
import sentencepiece

from opinion_engine.llm import decontamination, sentencepiece_bpe
from opinion_engine.llm.queries import tokenizer_path

from .cases import SCHEMA, documents, edge_rows, words


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())


@pytest.fixture(scope="module")
def vocabulary():
    return sentencepiece_bpe.read_vocabulary(tokenizer_path())


def test_documents(spark, library, vocabulary):
    rows = edge_rows()
    got = sentencepiece_bpe.encode_decode(documents(spark, rows), vocabulary).collect()
    want = []
    for i, text in rows:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        want.append((i, ids, len(ids), library.decode(ids)))
    key = lambda r: (str(r[0]), r[2], r[3])
    assert sorted(((r[0], np.frombuffer(r[1], "<u4").tolist(), r[2], r[3]) for r in got), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("alphabet", ["ab e\n\t▁é日本 tinhe=-_'01", "etaoinshrdlu", "= -", " ▁a", "é́﻿​ 😀ﬁ"])
def test_random_texts(library, vocabulary, alphabet):
    chosen = random.Random(alphabet)
    texts = ["".join(chosen.choice(alphabet) for _ in range(chosen.randint(0, 200))) for _ in range(150)]
    texts += [" " * 5000, "a" * 3000, "=" * 1001, "ab" * 1500, " " * 11 + "a" + " " * 27 + "\n"]
    tokenizer = sentencepiece_bpe.Tokenizer(vocabulary)
    got = [np.frombuffer(p, "<u4").tolist() for p in tokenizer.encode_all(texts)]
    assert got == library.encode(texts, add_bos=True, add_eos=True)


def test_decode_any_ids(library, vocabulary):
    chosen, tokenizer = random.Random(1), sentencepiece_bpe.Tokenizer(vocabulary)
    for _ in range(2000):
        ids = [chosen.choice([chosen.randint(3, 258), chosen.randint(259, 31_999), 0, 1, 2]) for _ in range(10)]
        assert tokenizer.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids)


def test_full_cache_changes_nothing(vocabulary, monkeypatch):
    monkeypatch.setattr(sentencepiece_bpe, "CACHED_SEGMENTS", 3)
    small, large = sentencepiece_bpe.Tokenizer(vocabulary), sentencepiece_bpe.Tokenizer(vocabulary)
    texts = [" ".join(words(30, k)) for k in range(6)]
    assert [small.encode_all([t])[0] for t in texts] == large.encode_all(texts)


# --- decontamination -----------------------------------------------------------------------

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return _WORD.findall(bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()))


def plain_hits(rows, items, size=10):
    windows = {}
    for name, text in items:
        found = plain_words(text)
        for k in range(max(1, len(found) - size + 1)) if found else ():
            windows.setdefault(tuple(found[k:k + size]), set()).add("" if name is None else str(name))
    out = []
    for i, text in rows:
        found, hit, names = plain_words(text), set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(found) - n + 1):
                if (w := tuple(found[k:k + n])) in windows:
                    names |= windows[w]
                    hit |= set(range(k, k + n))
        out.append((i, len(found), len(hit), sorted(names)))
    return out


def contaminated():
    passage, short = words(25, 50), words(4, 51)
    items = [(1, " ".join(passage)), (2, " ".join(passage[3:18])), (2, "Short: " + " ".join(short)), (3, None), (4, " . "),
             (None, " ".join(words(12, 52))), (10, " ".join(["same"] * 12)), (5, " ".join(passage[5:9]))]
    rows = [*edge_rows(), (30, "pre, " + "; ".join(passage).upper() + ". post"), (31, "a " + " ".join(passage[:14])),
            (32, "x short " + " ".join(short) + " y " + " ".join(words(12, 52))), (33, " ".join(passage[:9])),
            (34, " ".join(words(50, 53)) + " " + " ".join(passage[2:14]) + "\nend")]
    return rows, items


@pytest.mark.parametrize("block", [2 << 20, 100])
def test_hits(spark, monkeypatch, block):
    """The same hits whether the items are matched at once or in blocks."""
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", block)
    rows, items = contaminated()
    got = decontamination.match_items(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    found = [(r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got.collect()]
    assert sorted(found, key=repr) == sorted(plain_hits(rows, items), key=repr)


def test_spans_are_cut(spark):
    rows, items = contaminated()
    df = documents(spark, rows)
    out = decontamination.remove_spans(df, spark.createDataFrame(items, "item_id long, text string"))
    assert out.columns == df.columns
    got = {r["doc_id"]: r["text"] for r in out.filter("doc_id >= 16").collect()}
    start = " ".join(words(50, 53))
    assert got == {16: "one", 33: " ".join(words(25, 50)[:5]) + " ", 34: start + " \nend"}
    clean = {i for i, n, h, _ in plain_hits(rows, items) if not h}
    assert clean <= {r["doc_id"] for r in out.select("doc_id").collect()}


def test_kept_columns_may_clash(spark):
    """Results win over kept columns of the same names; the others pass unchanged."""
    rows, items = contaminated()
    df = documents(spark, rows)
    got = decontamination.match_items(df, spark.createDataFrame(items, "item_id long, text string"),
                                      keep=("doc_id", "spans", "n_words", "score", "text"))
    assert got.columns == ["doc_id", "score", "text", "n_words", "n_hit", "items", "longest", "spans"]
    want = sorted(plain_hits(rows, items), key=repr)
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got.collect()), key=repr) == want
    assert all((r["longest"] > 0) == (r["n_hit"] > 0) and r["score"] == 0.5 for r in got.collect())


def test_nothing_to_match(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r["n_hit"] for r in decontamination.match_items(documents(spark, edge_rows()), none).collect()} == {0}
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontamination.match_items(spark.createDataFrame([], SCHEMA), items).count() == 0
    assert decontamination.remove_spans(spark.createDataFrame([], SCHEMA), items).count() == 0
