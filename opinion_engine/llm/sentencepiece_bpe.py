"""SentencePiece BPE encoding and decoding in vectorised merge rounds.

A block's distinct segments (a run of spaces and the characters up to the next space) lie in flat symbol
arrays. Each round looks up the rank of every adjacent pair, takes the smallest rank of each segment, merges
its leftmost occurrences in all segments at once and compacts the arrays, until no pair is left. Nothing is
shuffled: a document is encoded where it is read, and a task holds about one megabyte of text at a time.

Edge values: a null or empty text has only the begin and end ids and decodes to an empty text. Every row
comes out once, whatever its id; other columns are dropped, whatever their names. Very long texts are encoded whole, and
an empty table gives an empty one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .wordhash import slices

SPACE = "▁"
NO_PAIR = np.iinfo(np.int32).max
CACHED_SEGMENTS = 120_000  # per task; a full cache starts anew
CACHED_CHARS = 64


@dataclass
class Vocabulary:
    """What a model file holds: pieces and scores by id, and what each special id is."""

    pieces: list[str]
    scores: list[float]
    first_byte: int
    unknown: int
    begin: int
    end: int
    control: frozenset[int]


def read_vocabulary(path: str) -> Vocabulary:
    """Read a BPE model with byte fallback, identity normalisation and a dummy prefix.

    The file is read where this runs (the driver); tasks get its pieces.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    return Vocabulary(
        pieces=[model.id_to_piece(i) for i in range(size)], scores=[model.get_score(i) for i in range(size)],
        first_byte=model.piece_to_id("<0x00>"), unknown=model.unk_id(), begin=model.bos_id(), end=model.eos_id(),
        control=frozenset(i for i in range(size) if model.is_control(i) or model.is_unknown(i)))


class PairTable:
    """Open addressing over pairs of pieces, probed for many pairs at once."""

    def __init__(self, keys: np.ndarray, merged: np.ndarray, rank: np.ndarray) -> None:
        self.bits = max(4, int(2 * len(keys)).bit_length() + 1)
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.zeros((1 << self.bits, 2), np.int32)
        self.values[:, 0] = NO_PAIR
        at = self._slot(keys)
        left = np.arange(len(keys))
        while len(left):
            free = self.keys[at] == -1
            self.keys[at[free]] = keys[left[free]]  # the last of those that meet in a slot stays
            stays = self.keys[at] == keys[left]
            self.values[at[stays]] = np.stack([rank[left[stays]], merged[left[stays]]], 1)
            left, at = left[~stays], (at[~stays] + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged piece of each pair; ``NO_PAIR`` where there is none."""
        at = self._slot(keys)
        there = self.keys[at]
        open_ = np.flatnonzero((there != keys) & (there != -1))
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self.keys) - 1)
            there = self.keys[at[open_]]
            open_ = open_[(there != keys[open_]) & (there != -1)]
        found = self.values[at]
        return found[:, 0], found[:, 1]


@dataclass
class Tokenizer:
    """Lookup tables of a vocabulary."""

    vocabulary: Vocabulary
    cache: dict[str, bytes] = field(default_factory=dict)

    def __post_init__(self) -> None:
        v = self.vocabulary
        special = v.control | set(range(v.first_byte, v.first_byte + 256))
        normal = {p: i for i, p in enumerate(v.pieces) if i not in special}
        order = np.unique(-np.array(v.scores))  # equal scores share a rank
        rank = np.searchsorted(order, -np.array(v.scores)).astype(np.int32)
        self.size = len(v.pieces)

        self.char_id = np.arange(self.size, self.size + 0x110000, dtype=np.int32)  # characters that are no piece
        inner = set()
        for piece, i in normal.items():
            if len(piece) == 1:
                self.char_id[ord(piece)] = i
            else:
                inner.update(piece)
        keys, merged = [], []
        for piece, i in normal.items():
            for cut in range(1, len(piece)):
                left, right = normal.get(piece[:cut]), normal.get(piece[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    merged.append(i)
        keys, merged = np.array(keys, np.int64), np.array(merged, np.int32)
        # A piece is calm if no pair with it comes before or beside the piece itself: then all its
        # occurrences can be merged at once. Others are merged where they cannot reach one another.
        best = np.full(self.size, NO_PAIR, np.int32)
        np.minimum.at(best, keys >> 32, rank[merged])
        np.minimum.at(best, keys & 0xFFFFFFFF, rank[merged])
        self.calm = best > rank
        self.table = PairTable(keys, merged, rank[merged])
        self.reach = 2 * max((len(p) for p in normal), default=1)

        # Where pieces of several spaces are the worst of all and hold nothing else, a run of spaces merges
        # from the left, after the word behind it has taken the last one or not.
        self.runs = {len(p): i for p, i in normal.items() if set(p) == {SPACE}}
        last = rank.max() if len(rank) else 0
        self.plain_runs = 1 in self.runs and all(
            rank[i] == last if set(p) == {SPACE} else rank[i] < last and SPACE not in p[1:]
            for p, i in normal.items() if p != SPACE)
        # Characters inside no longer piece cut a text without changing it.
        cuts = "".join(c for c in "\n\t\r" if c not in inner)
        self.segment = re.compile(f"[{cuts}]|{SPACE}*[^{SPACE}{cuts}]+|{SPACE}+" if cuts else f"{SPACE}*[^{SPACE}]+|{SPACE}+")

        surface = [p.replace(SPACE, " ").encode() for p in v.pieces]
        for i in v.control:
            surface[i] = b""
        surface[v.unknown] = " ⁇ ".encode()
        self.control = np.array(sorted(v.control - {v.unknown}), np.int64)
        for i in range(256):
            surface[v.first_byte + i] = bytes([i])
        lengths = np.array([len(s) for s in surface], np.int64)
        self.surface, self.surface_length = np.frombuffer(b"".join(surface), np.uint8), lengths
        self.surface_start = np.cumsum(lengths) - lengths

    # --- encoding -------------------------------------------------------------------------

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, begin and end included, as packed little-endian 32-bit numbers."""
        marked = [self.segment.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        known = self.cache
        new = list({s for segments in marked for s in segments if s not in known})
        known.update(zip(new, self._encode_segments(new)))
        first = np.array([self.vocabulary.begin], "<u4").tobytes()
        last = np.array([self.vocabulary.end], "<u4").tobytes()
        out = [b"".join([first, *[known[s] for s in segments], last]) for segments in marked]
        if len(known) > CACHED_SEGMENTS:
            known.clear()
        for s in new:
            if len(s) > CACHED_CHARS:
                known.pop(s, None)
        return out

    def _encode_segments(self, segments: list[str]) -> list[bytes]:
        if not self.plain_runs:
            ids, bounds = self._merge(segments)
            return [self._packed(ids[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
        words = [s.lstrip(SPACE) for s in segments]
        spaces = [len(s) - len(w) for s, w in zip(segments, words)]
        ids, bounds = self._merge([SPACE + w if n and w else w for n, w in zip(spaces, words)])
        packed, bounds = self._packed_all(ids, bounds)
        space = np.array([self.runs[1]], "<u4").tobytes()
        out = []
        for n, w, a, b in zip(spaces, words, bounds[:-1], bounds[1:]):
            one = packed[a:b]
            if n > 1 or not w:
                if n and w and one[:4] == space:
                    one = one[4:]  # the space stayed alone, so it belongs to the run
                elif w:
                    n -= 1
                one = self._run(n) + one
            out.append(one)
        return out

    def _run(self, n: int) -> bytes:
        sizes = []
        for _ in range(n):
            sizes.append(1)
            while len(sizes) > 1 and sizes[-2] + sizes[-1] in self.runs:
                sizes[-2:] = [sizes[-2] + sizes[-1]]
        return np.array([self.runs[k] for k in sizes], "<u4").tobytes()

    def _packed(self, ids: np.ndarray) -> bytes:
        return self._packed_all(ids, np.array([0, len(ids)]))[0]

    def _packed_all(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[bytes, list[int]]:
        """Pack ids; characters without a piece become their UTF-8 bytes."""
        odd = np.flatnonzero(ids >= self.size)
        if len(odd):
            raw = [chr(c).encode("utf-8", "surrogatepass") for c in (ids[odd] - self.size).tolist()]
            lengths = np.ones(len(ids), np.int64)
            lengths[odd] = [len(r) for r in raw]
            starts = np.concatenate([[0], np.cumsum(lengths)])
            wide = np.repeat(ids, lengths)
            values = np.frombuffer(b"".join(raw), np.uint8).astype(np.int32) + self.vocabulary.first_byte
            wide[np.repeat(np.isin(np.arange(len(ids)), odd, assume_unique=True), lengths)] = values
            ids, bounds = wide, starts[bounds]
        return ids.astype("<u4").tobytes(), (np.asarray(bounds) * 4).tolist()

    def _merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Merge rounds over all words; returns the symbols and where each word's symbols begin."""
        lengths = np.array([len(w) for w in words], np.int64)
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        symbols = self.char_id[chars]
        word = np.repeat(np.arange(len(words), dtype=np.int64), lengths)
        place = np.arange(len(symbols), dtype=np.int64)
        done_symbols, done_words, done_places = [], [], []
        while len(symbols):
            rank, merged = self._pairs(symbols, word)
            begins = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            best = np.minimum.reduceat(rank, begins)
            sizes = np.diff(np.concatenate([begins, [len(symbols)]]))
            active = np.repeat(best != NO_PAIR, sizes)
            if not active.all():  # words without a pair are finished
                done_symbols.append(symbols[~active])
                done_words.append(word[~active])
                done_places.append(place[~active])
                symbols, word, place, rank, merged = (x[active] for x in (symbols, word, place, rank, merged))
                if not len(symbols):
                    break
                keep = best != NO_PAIR
                best, sizes = best[keep], sizes[keep]
            at = self._leftmost(np.flatnonzero(rank == np.repeat(best, sizes)), word, place, merged)
            symbols[at] = merged[at]
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            symbols, word, place = symbols[stay], word[stay], place[stay]
        if done_symbols:
            place = np.concatenate(done_places)
            order = np.argsort(place, kind="stable")
            symbols, word = np.concatenate(done_symbols)[order], np.concatenate(done_words)[order]
        return symbols, np.searchsorted(word, np.arange(len(words) + 1))

    def _pairs(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged piece of each symbol with its right neighbour."""
        rank = np.full(len(symbols), NO_PAIR, np.int32)
        merged = np.zeros(len(symbols), np.int32)
        if len(symbols) > 1:
            at = np.flatnonzero((word[1:] == word[:-1]) & (symbols[1:] < self.size) & (symbols[:-1] < self.size))
            key = symbols[at].astype(np.int64) << 32 | symbols[at + 1]
            rank[at], merged[at] = self.table.find(key)
        return rank, merged

    def _leftmost(self, at: np.ndarray, word: np.ndarray, place: np.ndarray, merged: np.ndarray) -> np.ndarray:
        """Of the best pairs of each word, those that merging from left to right would take now.

        A merge can only change what lies within a piece's length, so of a piece that is not calm the
        occurrences with another one close on their left wait for a later round.
        """
        same = np.zeros(len(at), bool)
        same[1:] = word[at[1:]] == word[at[:-1]]
        near = same.copy()
        near[1:] &= place[at[1:]] - place[at[:-1]] < self.reach
        wait = near & ~self.calm[merged[at]]
        # Equal scores of different pieces are merged one by one as well.
        wait[1:] |= near[1:] & (merged[at[1:]] != merged[at[:-1]])
        if wait.any():
            # whatever is close behind one that waits must wait too, in the order of the text
            group = np.cumsum(~near)
            blocked = np.zeros(group[-1] + 1, bool)
            blocked[group[wait]] = True
            wait = near & blocked[group]
        # Of overlapping pairs (a a a) every second one is taken.
        touch = np.zeros(len(at), bool)
        touch[1:] = same[1:] & (at[1:] == at[:-1] + 1)
        run = np.cumsum(~touch)
        first = np.flatnonzero(~touch)
        odd = (np.arange(len(at)) - first[run - 1]) % 2 == 1
        return at[~wait & ~(odd & touch)]

    # --- decoding -------------------------------------------------------------------------

    def decode(self, packed: bytes) -> str:
        """The text of packed ids."""
        ids = np.frombuffer(packed, "<u4").astype(np.int64)
        control = np.flatnonzero(np.isin(ids, self.control))
        parts = [p[1:] if i else p for i, p in enumerate(np.split(ids, control))] if len(control) else [ids]
        parts = [p for p in parts if len(p)]  # bytes on both sides of a control id make no character
        space = bool(parts) and self.vocabulary.pieces[parts[0][0]].startswith(SPACE)
        return "".join(map(self._decode_part, parts))[1 if space else 0:]

    def _decode_part(self, ids: np.ndarray) -> str:
        lengths = self.surface_length[ids]
        ends = np.cumsum(lengths)
        at = np.arange(int(ends[-1])) + np.repeat(self.surface_start[ids] - (ends - lengths), lengths)
        raw = self.surface[at].tobytes()
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return _decode_bytewise(raw)


def _decode_bytewise(raw: bytes) -> str:
    """Decode UTF-8; each byte outside a whole character becomes one replacement character."""
    out, i = [], 0
    while i < len(raw):
        for size in (1, 2, 3, 4):
            try:
                out.append(raw[i:i + size].decode())
                i += size
                break
            except UnicodeDecodeError:
                pass
        else:
            out.append("�")
            i += 1
    return "".join(out)


@lru_cache(maxsize=2)
def _tokenizer(key: tuple) -> Tokenizer:
    pieces, scores, *rest = key
    return Tokenizer(Vocabulary(list(pieces), list(scores), *rest))


def encode_decode(docs: DataFrame, vocabulary: Vocabulary, id_column: str = "doc_id",
                  text_column: str = "text") -> DataFrame:
    """Encode every text and decode the ids.

    Returns the id column, ``ids`` (packed little-endian unsigned 32-bit numbers, begin and end included),
    ``n_tokens`` and ``decoded``.
    """
    v = vocabulary
    key = (tuple(v.pieces), tuple(v.scores), v.first_byte, v.unknown, v.begin, v.end, v.control)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(key)
        for batch in batches:
            for part in slices(batch, 1):
                ids = tokenizer.encode_all([t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.binary()), pa.array([len(i) // 4 for i in ids], pa.int64()),
                     pa.array([tokenizer.decode(i) for i in ids], pa.string())], names)

    names = [id_column, "ids", "n_tokens", "decoded"]
    narrow = docs.select(id_column, text_column)
    kind = narrow.schema[0].dataType.simpleString()
    return narrow.mapInArrow(encode, f"`{id_column}` {kind}, ids binary, n_tokens long, decoded string")
