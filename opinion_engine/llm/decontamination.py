"""Benchmark decontamination with a generalised suffix automaton of the test items.

The normalised words of all items form one automaton. Each document's words are streamed through it once;
the state carries the longest match that ends at the word. Where the match reaches the window length, the
last words are a window of some item; shorter items count as whole windows.

Documents are not shuffled. The items are read in blocks of at most ``BLOCK_BYTES`` of text, each of which
is sent to the tasks and matched in one pass. Where there are several blocks, a first pass over all documents looks up
the hashes of their windows in a bit table of fixed size over the windows of all items, and the passes of the blocks read
only the documents that it cannot rule out, so the corpus is not read once per block. The automaton alone decides.

Edge values: a null or empty text has no words and no hit. Rows with null or equal ids are matched each for
itself. Items with a null text are no window; an item without an id is named by the empty string, and items
that share an id count once. No items, or no documents, give no hits. Other columns are dropped unless
``keep`` names them. Very long texts are matched whole, in a slice of their own.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .counting import Filter
from .wordhash import Block, blocks, mix, slices, window_hashes, word_hashes

BLOCK_BYTES = 2 << 20
FILTER_BITS = 27
WINDOW = 10
_KEPT = frozenset([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
#: Lower-case A-Z; every other byte that is no digit, letter or part of a longer character becomes a space.
_NORMAL = bytes(b + 0x20 if 0x41 <= b <= 0x5A else b if b in _KEPT else 0x20 for b in range(256))
_WORD = re.compile(rb"[^ ]+")
#: Bytes that separate words once A-Z are lower-cased.
_APART = np.array([b not in _KEPT for b in range(256)])


class SuffixAutomaton:
    """All runs of words of a set of items; state 0 is the empty run."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW) -> None:
        self.window = window
        self.word_id: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [(name, [self.word_id.setdefault(w, len(self.word_id)) for w in words])
                 for name, words in items if words]
        for _, words in coded:
            last = 0
            for word in words:
                last = self._extend(last, word)
        self._name_windows(coded)

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._clone(last, word, known)
        state = self._state(self.length[last] + 1, {})
        while last != -1 and word not in self.next[last]:
            self.next[last][word] = state
            last = self.link[last]
        if last == -1:
            self.link[state] = 0
            return state
        known = self.next[last][word]
        exact = self.length[known] == self.length[last] + 1
        self.link[state] = known if exact else self._clone(last, word, known)
        return state

    def _state(self, length: int, arcs: dict[int, int]) -> int:
        self.next.append(arcs)
        self.length.append(length)
        self.link.append(0)
        return len(self.next) - 1

    def _clone(self, last: int, word: int, known: int) -> int:
        copy = self._state(self.length[last] + 1, dict(self.next[known]))
        self.link[copy] = self.link[known]
        self.link[known] = copy
        while last != -1 and self.next[last].get(word) == known:
            self.next[last][word] = copy
            last = self.link[last]
        return copy

    def _name_windows(self, coded: list[tuple[str, list[int]]]) -> None:
        """For each state: its suffix of one window, the items with that window, and short items that end there."""
        by_length = sorted(range(len(self.next)), key=self.length.__getitem__)
        self.top = [0] * len(self.next)
        for s in by_length[1:]:
            self.top[s] = self.top[self.link[s]] if self.length[self.link[s]] >= self.window else s
        self.items: dict[int, set[str]] = {}
        short: dict[int, list[tuple[int, str]]] = {}
        for name, words in coded:
            state = 0
            for n, word in enumerate(words, 1):
                state = self.next[state][word]
                if n >= self.window:
                    self.items.setdefault(self.top[state], set()).add(name)
            if len(words) < self.window:
                short.setdefault(state, []).append((len(words), name))
        self.short: dict[int, list[tuple[int, str]]] = {}
        for s in by_length[1:]:
            found = short.get(s, []) + self.short.get(self.link[s], [])
            if found:
                self.short[s] = found

    def match(self, words: list[bytes]) -> tuple[bytearray | None, set[str], int]:
        """Which words are hit (None for none), by which items, and the longest match."""
        arcs, link, length, top, items, short = self.next, self.link, self.length, self.top, self.items, self.short
        window, longest, state, matched = self.window, 0, 0, 0
        hit: bytearray | None = None
        names: set[str] = set()
        for at, word in enumerate(map(self.word_id.get, words)):
            if word is None:
                state = matched = 0
                continue
            to = arcs[state].get(word)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = arcs[state].get(word)
            state = to if to is not None else 0
            matched = matched + 1 if to is not None else 0
            if matched > longest:
                longest = matched
            if matched >= window:
                hit = hit or bytearray(len(words))
                hit[at - window + 1:at + 1] = b"\1" * window
                names |= items[top[state]]
            if short and state in short:
                for size, name in short[state]:
                    if size <= matched:
                        hit = hit or bytearray(len(words))
                        hit[at - size + 1:at + 1] = b"\1" * size
                        names.add(name)
        return hit, names, longest


_AUTOMATA: dict[tuple, SuffixAutomaton] = {}


def _automaton(key: tuple, items: list[tuple[str, bytes]], window: int) -> SuffixAutomaton:
    """The automaton of a block of items, built once in each worker and dropped for the next block's."""
    if key not in _AUTOMATA:
        _AUTOMATA.clear()
        _AUTOMATA[key] = SuffixAutomaton([(n, t.translate(_NORMAL).split()) for n, t in items], window)
    return _AUTOMATA[key]


def _spans(hit: bytes) -> list[tuple[int, int]]:
    """Maximal runs of hit words as (first, last)."""
    flags = np.frombuffer(hit, np.uint8)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags, [0]])))
    return list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist()))


def _named(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text").filter(
        F.col("text").isNotNull())


def _number_of_blocks(benchmark: DataFrame) -> int:
    size = _named(benchmark).agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return -(-size // BLOCK_BYTES) or 1


def item_blocks(benchmark: DataFrame, blocks: int) -> Iterator[list[tuple[str, bytes]]]:
    """The items in blocks of a bounded size, one at a time on the driver."""
    for k in range(blocks):
        rows = _named(benchmark).filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        yield sorted((r["item_id"], r["text"].encode()) for r in rows)


def _window_keys(block: Block, size: int, starts: np.ndarray) -> np.ndarray:
    return mix(window_hashes(word_hashes(block), starts, size) + np.uint64(size))


def _item_windows(items: DataFrame, window: int) -> DataFrame:
    """``key`` and ``size`` of every window of the items; a shorter item is one window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(0), _APART, lower=True):
                counts = np.diff(block.first)
                left = np.repeat(counts, counts) - block.place_of_word()
                for size in sorted({window, *counts[(counts > 0) & (counts < window)].tolist()}):
                    short = np.repeat(counts, counts) == size
                    starts = np.flatnonzero((left >= size) & ((size == window) | short))
                    keys = _window_keys(block, size, starts)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys.view(np.int64)), pa.array(np.full(len(keys), size, np.int32))], ["key", "size"])

    return items.select("text").mapInArrow(run, "key long, size int").distinct()


def _ruled_out(docs: DataFrame, benchmark: DataFrame, window: int, text: int) -> DataFrame:
    """``docs`` with ``n_words``, and ``maybe`` where a window's hash is in the bit table of the items' windows."""
    windows = materialize(_item_windows(_named(benchmark), window), "item-windows")
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())  # at most ``window``
    sent = docs.sparkSession.sparkContext.broadcast(Filter.of(windows.select("key"), FILTER_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(text), _APART, lower=True):
                counts = np.diff(block.first)
                left = np.repeat(counts, counts) - block.place_of_word()
                owner, maybe = block.document_of_word(), np.zeros(block.documents, bool)
                for size in sizes:
                    starts = np.flatnonzero(left >= size)
                    maybe[owner[starts[sent.value.has(_window_keys(block, size, starts))]]] = True
                columns = dict(zip(batch.schema.names, batch.slice(block.row, block.documents).columns))
                columns |= {"n_words": pa.array(counts), "maybe": pa.array(maybe)}
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return docs.withColumn("maybe", F.lit(True)).mapInArrow(run, docs.withColumn("maybe", F.lit(True)).schema)


def _matched(docs: DataFrame, benchmark: DataFrame, window: int, carried: list[str]) -> DataFrame:
    """The columns ``carried`` as ``in_0``.. and the results, so that no names can clash."""
    out = docs.select(*[F.col(f"`{c}`").alias(f"in_{i}") for i, c in enumerate(carried)]).withColumns({
        "n_words": F.lit(0).cast("long"), "items": F.array().cast("array<string>"), "longest": F.lit(0),
        "spans": F.array().cast("array<struct<first:int,last:int>>")})
    schema, text = out.schema, carried.index("text")
    number, clean = _number_of_blocks(benchmark), None
    if number > 1:
        judged = materialize(_ruled_out(out, benchmark, window, text), "items-ruled-out")
        clean, out = judged.filter("not maybe").drop("maybe"), judged.filter("maybe").drop("maybe")
    for block, items in enumerate(item_blocks(benchmark, number)):
        out = materialize(out, "items-matched") if block else out
        sent = docs.sparkSession.sparkContext.broadcast(items)
        out = out.mapInArrow(_matcher(sent, (uuid.uuid4().hex, window), text), schema)
    out = out if clean is None else out.unionByName(clean)
    # Shorter matches are no hits, and documents that were ruled out have not been looked at for them.
    out = out.withColumn("longest", F.when(F.size("spans") > 0, F.col("longest")).otherwise(0))
    return out.withColumn("n_hit", F.aggregate(
        "spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1))


def match_items(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per document the columns ``keep``, and ``n_words``, ``n_hit``, ``items``, ``longest`` and ``spans``.

    ``items`` are the sorted ids of the items found, ``longest`` is the longest match in words (0 without a hit), and ``spans``
    holds the runs of hit words, by number within the document. These names win over kept columns.
    """
    carried = list(dict.fromkeys([*keep, "text"]))
    results = ["n_words", "n_hit", "items", "longest", "spans"]
    return _matched(docs, benchmark, window, carried).select(
        *[F.col(f"in_{i}").alias(c) for i, c in enumerate(carried) if c in keep and c not in results], *results)


def _matcher(sent, key: tuple, text: int):
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(key, sent.value, key[1])
        for batch in batches:
            for part in slices(batch, text):
                columns = dict(zip(part.schema.names, part.columns))
                rows = [[], [], [], []]
                before = zip(*(columns[c].to_pylist() for c in ("items", "longest", "spans")))
                for raw, (names, longest, spans) in zip(part.column(text).to_pylist(), before):
                    words = (raw or "").encode().translate(_NORMAL).split()
                    hit, found, run = automaton.match(words)
                    if hit is not None:
                        for s in spans:
                            hit[s["first"]:s["last"] + 1] = b"\1" * (s["last"] + 1 - s["first"])
                        spans = [{"first": a, "last": b} for a, b in _spans(hit)]
                        names = sorted(found.union(names))
                    for column, value in zip(rows, (len(words), names, max(longest, run), spans)):
                        column.append(value)
                for name, values in zip(("n_words", "items", "longest", "spans"), rows):
                    columns[name] = pa.array(values, part.schema.field(name).type)
                yield pa.RecordBatch.from_arrays(list(columns.values()), schema=part.schema)

    return match


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, coverage: float = 0.5) -> DataFrame:
    """Cut hit spans out of the texts, and drop documents with at least ``coverage`` of their words hit.

    Returns the columns of ``docs``. A document without a hit comes out as it was; of others, each hit span is
    cut from its first word's first character to its last word's last one.
    """
    columns = [f"in_{i}" for i in range(len(docs.columns))]
    matched = _matched(docs, benchmark, window, docs.columns)
    kept = matched.filter(F.col("n_hit") < F.greatest(F.lit(coverage) * F.col("n_words"), F.lit(1e-9)))
    inner = kept.select(*columns, "spans")
    cut = inner.mapInArrow(_cutter(docs.columns.index("text")), inner.drop("spans").schema)
    return cut.select(*[F.col(c).alias(name) for c, name in zip(columns, docs.columns)])


def _cutter(text: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                values = part.column(text).to_pylist()
                for row, spans in enumerate(part.column(part.num_columns - 1).to_pylist()):
                    if spans:
                        values[row] = _without(values[row], spans)
                columns = part.columns[:-1]
                columns[text] = pa.array(values, columns[text].type)
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names[:-1])

    return cut


def _without(text: str, spans: list[dict]) -> str:
    raw = text.encode()
    at = [m.span() for m in _WORD.finditer(raw.translate(_NORMAL))]
    out, last = [], 0
    for s in spans:
        out.append(raw[last:at[s["first"]][0]])
        last = at[s["last"]][1]
    return b"".join([*out, raw[last:]]).decode()
