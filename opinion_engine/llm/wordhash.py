"""Words of Arrow text columns as numpy arrays: where they start, and 64-bit hashes of them.

Texts stay UTF-8 bytes. A block is a run of documents of about ``BLOCK_BYTES`` bytes, so memory in a
task does not follow the size of an Arrow batch; one longer document is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

#: Bytes that separate words: space, and tab to carriage return.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True

_RANDOM = np.random.default_rng(20_240_601)
_BYTE_VALUES = [_RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2)]
_FACTORS = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)]
#: Odd multipliers of the words of a window, by place.
_PLACES = [_RANDOM.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2)]

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


@dataclass
class Block:
    """Words of consecutive documents: ``first[i]:first[i + 1]`` are the words of document ``i``."""

    data: np.ndarray  # bytes of the texts
    row: int  # the first document's row in its batch
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def documents(self) -> int:
        return len(self.first) - 1

    def document_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.documents), np.diff(self.first))

    def place_of_word(self) -> np.ndarray:
        """A word's number within its document."""
        return np.arange(len(self.starts)) - np.repeat(self.first[:-1], np.diff(self.first))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null texts are empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offsets


def blocks(column: pa.Array, separators: np.ndarray = SPACES, lower: bool = False) -> Iterator[Block]:
    """Split a text column into blocks of whole documents and find their words."""
    if not len(column):
        return
    data, offsets = text_bytes(column)
    row = 0
    while row < len(column):
        stop = int(np.searchsorted(offsets, offsets[row] + BLOCK_BYTES, side="right")) - 1
        stop = min(max(stop, row + 1), len(column))
        piece = data[offsets[row]:offsets[stop]]
        yield _words(LOWER[piece] if lower else piece, offsets[row:stop + 1] - offsets[row], row, separators)
        row = stop


def _words(data: np.ndarray, offsets: np.ndarray, row: int, separators: np.ndarray) -> Block:
    inside = np.empty(len(data) + 1, bool)
    inside[:-1] = ~separators[data]
    inside[-1] = False
    begins = np.empty(len(data), bool)
    if len(data):
        begins[0] = inside[0]
        begins[1:] = inside[1:-1] & ~inside[:-2]
        edges = offsets[1:-1]
        edges = edges[edges < len(data)]
        begins[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    # a word ends at the next separator, or where the next document begins
    stops = inside.copy()
    stops[:-1] &= ~begins
    gaps = np.flatnonzero(~stops)  # separators and word starts
    ends = gaps[np.searchsorted(gaps, starts, side="right")] if len(starts) else starts
    return Block(data, row, starts, ends, np.searchsorted(starts, offsets))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(block: Block, seed: int = 0) -> np.ndarray:
    """64-bit hashes of a block's words; ``seed`` 0 or 1 picks one of two independent functions."""
    lengths = block.ends - block.starts
    if not len(lengths):
        return np.zeros(0, np.uint64)
    first = np.cumsum(lengths) - lengths
    inner = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    powers = np.full(int(lengths.max()), _FACTORS[seed], np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    values = _BYTE_VALUES[seed][block.data[inner + np.repeat(block.starts, lengths)]]
    values *= powers[inner]
    return mix(np.add.reduceat(values, first) + lengths.astype(np.uint64))


def window_hashes(words: np.ndarray, at: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hashes of the windows of ``size`` words that start at the words ``at``."""
    total = np.zeros(len(at), np.uint64)
    for k in range(size):
        total += words[at + k] * _PLACES[seed][k]
    return mix(total)


def slices(batch: pa.RecordBatch, text: int, rows: int = 1024, size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of at most ``rows`` rows with about ``size`` bytes in the column ``text``."""
    if not batch.num_rows:
        return
    _, offsets = text_bytes(batch.column(text))
    row = 0
    while row < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1
        stop = min(max(stop, row + 1), row + rows, batch.num_rows)
        yield batch.slice(row, stop - row)
        row = stop
