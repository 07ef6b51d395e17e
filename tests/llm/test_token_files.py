"""Packed token files: the packing, the file format, and whole tables against the tokenizers library."""

import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from opinion_engine.llm import token_files
from opinion_engine.llm.queries import QUERIES, word_tokenizer
from opinion_engine.session import scratch_path
from tests.compare import duck

from .cases import SCHEMA, documents, edge_rows, words

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_str(word_tokenizer())


def whole(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [2]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50_000), st.integers(0, (1 << 64) - 1)), max_size=300))
def test_packing_round_trips(ids):
    packed, escapes = token_files.pack(np.array(ids, np.uint64))
    assert token_files.unpack(packed, escapes).tolist() == ids
    assert len(escapes) == sum(i >= 1 << 60 for i in ids)


def test_packing_is_dense():
    for count, bits in token_files.WIDTHS:
        ids = np.full(count * 10, (1 << bits) - 1, np.uint64)
        assert len(token_files.pack(ids)[0]) == 10
    ids = np.random.default_rng(1).integers(0, 1 << 15, 100_000)
    assert len(token_files.pack(ids)[0]) <= 25_001


def test_a_block_is_read_alone_and_damage_is_found():
    sink = io.BytesIO()
    sink.close = lambda: None
    writer = token_files.FileWriter(sink)
    rows = [(k, np.random.default_rng(k).integers(0, 60_000, n)) for k, n in enumerate((0, 3, 200_000, 1, 65_536, 70_000))]
    for doc_id, ids in [(None, np.array([7])), *rows]:
        writer.add(doc_id, ids)
    writer.close()
    data = sink.getvalue()
    got = list(token_files.read_file(pa.BufferReader(data)))
    assert [(i, ids.tolist()) for i, ids in got] == [(None, [7])] + [(i, ids.tolist()) for i, ids in rows]
    stream = np.concatenate([[7], *(ids for _, ids in rows)])
    last = np.array([writer.blocks[-1]], token_files.BLOCK)[0]
    alone = token_files._read_block(pa.BufferReader(data), last)
    assert alone.tolist() == stream[-len(alone):].tolist() and len(writer.blocks) == -(-len(stream) // token_files.BLOCK_IDS)
    broken = bytearray(data)
    broken[int(last["offset"]) + 5] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        list(token_files.read_file(pa.BufferReader(bytes(broken))))
    with pytest.raises(ValueError, match="not a file"):
        list(token_files.read_file(pa.BufferReader(b"0" * 100)))


@settings(max_examples=150, deadline=None)
@given(st.text(st.one_of(st.sampled_from("abzAZÀÖ×Øöøÿßéµªºæñ.,;:<=>0123 '"), st.sampled_from(" \t\n\r\x0b\x0c\x85\xa0 '’sStTé́Σσςİß<|>endoftxar1٣日本\U0001f600​‍"),
                         st.characters(codec="utf-8")), max_size=60))
def test_words_are_encoded_like_whole_texts(library, text):
    encoder = token_files.WordEncoder(word_tokenizer())
    texts = [text + "<|endoftext|> x", text, None, "", text[::-1]]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder(texts)] == [whole(library, t)[:-1] for t in texts]


def test_simple_texts_are_encoded_by_parts(library):
    """Every character of a simple text next to letters, digits and signs, and random texts of them."""
    encoder = token_files.WordEncoder(word_tokenizer())
    simple = [chr(c) for c in range(256) if token_files.SIMPLE.fullmatch(chr(c))]
    assert len(simple) == 127 + 62 and "'" not in simple and "ß" in simple and "µ" not in simple
    texts = [f"{a}{c}{b}{c}{c} {b}" for c in simple for a, b in (("a", "B"), ("é", "ß"), ("1", "x"), (",", "Ö"), ("<", "|"))]
    chosen = random.Random(3)
    texts += ["".join(chosen.choices("aBéßÖ1,.<>|=_- \n\x1c\x00", k=30)) for _ in range(500)]
    texts += ["a<|endoftext|>b", "x<|STARTOFTEXT|>y", "<|endoftext|", "it's", "x'tis", "e\u0301,", "<\u0338a", "İß"]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder(texts)] == [whole(library, t)[:-1] for t in texts]


def test_long_texts_and_full_caches(library, monkeypatch):
    monkeypatch.setattr(token_files, "PIECE", 100)
    monkeypatch.setattr(token_files, "CACHED_WORDS", 20)
    monkeypatch.setattr(token_files, "CACHED_LETTERS", 5)
    text = " ".join(words(3_000, 5)) + " " + "w" * 500 + "\n" + "é" * 70 + " " + " ".join(words(300, 5))
    encoder = token_files.WordEncoder(word_tokenizer(), "<u2")
    for _ in range(2):
        assert np.frombuffer(encoder([text])[0], "<u2").tolist() == whole(library, text)[:-1]
    assert len(encoder.known) + len(encoder.older) < 100 and all(len(w) <= 5 for w in encoder.older)


def compare(got, rows, library):
    coded = [(i, np.array(whole(library, t), "<u4")) for i, t in rows]
    short = lambda ids: ids.astype("<u2").tobytes()
    coded.sort(key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32(short(r[1])), short(r[1])))
    at, want = 0, []
    for i, ids in coded:
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    found = [(r[0], r[1], r[2], zlib.crc32(r[3]) if isinstance(r[3], (bytes, bytearray)) else r[3]) for r in got]
    assert sorted(found, key=lambda r: (r[1], r[2])) == want


@pytest.mark.parametrize("file_ids, part_bytes", [(token_files.FILE_IDS, token_files.PART_BYTES), (50, 2000)])
def test_tables(spark, library, file_ids, part_bytes):
    rows = [r[:2] for r in edge_rows()] + [(50, "same words")] * 300 + [(50, f"one id {k}") for k in range(300)]
    folder = scratch_path(spark, "test-token-files")
    token_files.write(documents(spark, rows), word_tokenizer(), 2, folder, file_ids, part_bytes)
    got = token_files.read(spark, folder)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids"]
    compare(got.collect(), rows, library)
    named = spark.read.parquet(f"{folder}/manifest")
    assert named.agg({"documents": "sum"}).first()[0] == len(rows) and (file_ids > 50 or named.count() > 20)
    hot = token_files.part_bounds(documents(spark, rows), 2000).tolist().count(50)
    assert file_ids > 50 or hot > 5  # rows of one id lie in several parts


def test_files_that_no_manifest_names_are_not_read(spark, library):
    folder = scratch_path(spark, "test-token-files")
    token_files.write(documents(spark, [(1, "a b"), (2, "c")]), word_tokenizer(), 2, folder)
    before = token_files.read(spark, folder).collect()
    system, root = token_files._filesystem(folder)
    with system.open_output_stream(f"{root}/part-000000-0000-lost-attempt.s8b") as stream:
        stream.write(b"half a file")
    assert sorted(token_files.read(spark, folder).collect()) == sorted(before)


def test_empty_table(spark):
    folder = scratch_path(spark, "test-token-files")
    token_files.write(spark.createDataFrame([], SCHEMA), word_tokenizer(), 2, folder)
    assert token_files.read(spark, folder).collect() == []


def test_query(spark, library):
    rows = duck(FOLDER).execute("select doc_id, text from documents").fetchall()
    got = QUERIES["op12_token_files"](spark, FOLDER)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert [t for _, t in got.dtypes] == ["bigint"] * 4
    compare(got.collect(), rows, library)
