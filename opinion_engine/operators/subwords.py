"""Texts as subword numbers of one length, with a mask: what a neural classifier takes.

Words are found in the JVM. Each distinct word of a batch is cut once, by the longest piece of a given vocabulary from
the left; a word that cannot be cut to its end is one unknown number. Numbers are cut to a length and filled up.
The vocabulary is a parameter, of at most ``MAX_PIECES`` pieces, so what goes to the tasks has a bounded size.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_PIECES = 1 << 20
MAX_LENGTH = 512
# Runs of letters, single digits, and runs of other characters.
WORD = r"[\p{L}]+|[\p{N}]|[^ \t-\r\p{L}\p{N}]+"


@dataclass
class Vocabulary:
    """Pieces with their numbers. A piece that ends a word carries ``end``."""

    pieces: Mapping[str, int]
    first: int
    last: int
    unknown: int
    pad: int = 0
    end: str = "</w>"
    trie: dict = field(init=False, repr=False)

    def __post_init__(self) -> None:
        if len(self.pieces) > MAX_PIECES:
            raise ValueError(f"{len(self.pieces)} pieces; at most {MAX_PIECES}")
        self.trie = {}
        for piece, number in self.pieces.items():
            closed = piece.endswith(self.end)
            node = self.trie
            for c in piece[:-len(self.end)] if closed else piece:
                node = node.setdefault(c, {})
            node["closed" if closed else "open"] = number

    def cut(self, word: str) -> list[int]:
        """Numbers of a word's pieces, the longest first from the left; one unknown number if it does not work out."""
        out, at = [], 0
        while at < len(word):
            node, best, k = self.trie, None, at
            while k < len(word) and word[k] in node:
                node = node[word[k]]
                k += 1
                number = node.get("closed" if k == len(word) else "open")
                if number is not None:
                    best = (number, k)
            if best is None:
                return [self.unknown]
            out.append(best[0])
            at = best[1]
        return out


def read_vocabulary(path: str) -> Vocabulary:
    """From a tokenizer file with pieces that end in ``</w>`` and two marks for the ends of a text.

    An unknown word has the mark of a text's end.
    """
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    first, last = (t["id"] for t in content["added_tokens"][:2])
    return Vocabulary(content["model"]["vocab"], first, last, last)


def _numbers(words: pa.Array, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all words one after another, and how many each text has. A missing text has none."""
    sizes = np.nan_to_num(words.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    coded = words.flatten().dictionary_encode()
    cuts = [vocabulary.cut(w) for w in coded.dictionary.to_pylist()]
    lengths = np.array([len(c) for c in cuts], np.int64)
    flat = np.array([n for c in cuts for n in c], np.int64)
    begins = np.cumsum(lengths) - lengths
    which = coded.indices.to_numpy(zero_copy_only=False)
    each = lengths[which]
    inner = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each)
    owner = np.repeat(np.arange(len(words)), sizes)
    return flat[np.repeat(begins[which], each) + inner], np.bincount(owner, each, minlength=len(words)).astype(np.int64)


def _padded(numbers: np.ndarray, counts: np.ndarray, vocabulary: Vocabulary, length: int) -> tuple[np.ndarray, np.ndarray]:
    """A row of ``length`` numbers per text with both marks, and which of them are used."""
    used = np.minimum(counts, length - 2)
    begins = np.cumsum(counts) - counts
    ids = np.full((len(counts), length), vocabulary.pad, np.int32)
    ids[:, 0] = vocabulary.first
    row = np.repeat(np.arange(len(counts)), used)
    place = np.arange(int(used.sum())) - np.repeat(np.cumsum(used) - used, used)
    ids[row, place + 1] = numbers[begins[row] + place]
    ids[np.arange(len(counts)), used + 1] = vocabulary.last
    return ids, (np.arange(length) < used[:, None] + 2).astype(np.int32)


def encode(df: DataFrame, text: str, vocabulary: Vocabulary, length: int = MAX_LENGTH) -> DataFrame:
    """Each row with ``n_tokens`` (before cutting), ``input_ids`` and ``attention_mask``, arrays of ``length``."""
    if length < 2:
        raise ValueError("a text's two marks need two places")
    sent = df.sparkSession.sparkContext.broadcast(vocabulary)
    out = T.StructType([*df.schema.fields, T.StructField("n_tokens", T.LongType()),
                        T.StructField("input_ids", T.ArrayType(T.IntegerType())),
                        T.StructField("attention_mask", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 1024):  # so many padded rows at a time
                rows = batch.slice(k, 1024)
                numbers, counts = _numbers(rows.column("_words"), sent.value)
                ids, mask = _padded(numbers, counts, sent.value, length)
                offsets = pa.array(np.arange(0, (len(counts) + 1) * length, length, dtype=np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x.ravel())) for x in (ids, mask)]
                yield pa.RecordBatch.from_arrays([*rows.columns[:-1], pa.array(counts), *lists], names=out.names)

    words = F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
    return df.withColumn("_words", words).mapInArrow(run, out)
