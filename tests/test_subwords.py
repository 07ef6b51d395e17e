"""Subword numbers against plain cutting."""

import json

import pytest
import regex

from opinion_engine.operators import subwords
from tests.compare import duck

PIECES = {"a": 0, "b": 1, "a</w>": 2, "b</w>": 3, "ab": 4, "abc</w>": 5, "ba</w>": 6, ",</w>": 7, "1</w>": 8, "é</w>": 9}
SMALL = subwords.Vocabulary(PIECES, 20, 21, 22)


def plain(text, vocabulary, length):
    out = []
    for word in regex.findall(subwords.WORD, (text or "").lower()):
        at, found = 0, []
        while at < len(word):
            for stop in range(len(word), at, -1):
                number = vocabulary.pieces.get(word[at:stop] + (vocabulary.end if stop == len(word) else ""))
                if number is not None:
                    break
            else:
                found = [vocabulary.unknown]
                break
            found.append(number)
            at = stop
        out += found
    kept = [vocabulary.first, *out[:length - 2], vocabulary.last]
    return len(out), kept + [vocabulary.pad] * (length - len(kept)), [1] * len(kept) + [0] * (length - len(kept))


@pytest.mark.parametrize("length", [2, 5, 12])
def test_plain_cutting(spark, length):
    texts = ["ab abc", "AB, ba1", "", None, "abca é ,, x", "aaab" * 20, "b\tb\x0bb", "été 11 a!"]
    df = spark.createDataFrame([(i, t, "w") for i, t in enumerate(texts)], "id long, text string, _word string").repartition(3)
    got = subwords.encode(df, "text", SMALL, length)
    assert got.columns == ["id", "text", "_word", "n_tokens", "input_ids", "attention_mask"]
    assert {r["id"]: (r["n_tokens"], r["input_ids"], r["attention_mask"]) for r in got.collect()} == {
        i: plain(t, SMALL, length) for i, t in enumerate(texts)}
    assert subwords.encode(df.limit(0), "text", SMALL, length).count() == 0


def test_the_longest_piece_wins_and_may_not_work_out():
    assert SMALL.cut("abab") == [4, 0, 3] and SMALL.cut("abc") == [5] and SMALL.cut("abca") == [22]


def test_whole_documents(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    vocabulary = subwords.read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    rows = duck("/root/testdata/sf0.001").execute("select doc_id, text from documents").fetchall()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = subwords.encode(df, "text", vocabulary).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["input_ids"], r["attention_mask"]) for r in got} == {
        i: plain(t, vocabulary, 512) for i, t in rows}


def test_limits(tmp_path, monkeypatch, spark):
    monkeypatch.setattr(subwords, "MAX_PIECES", 3)
    path = tmp_path / "v.json"
    path.write_text(json.dumps({"added_tokens": [{"id": 8}, {"id": 9}], "model": {"vocab": PIECES}}))
    with pytest.raises(ValueError, match="10 pieces"):
        subwords.read_vocabulary(str(path))
    with pytest.raises(ValueError, match="two places"):
        subwords.encode(spark.range(1), "id", SMALL, 1)
