"""Counting in tasks before anything moves: sums of equal keys, bit tables, and rows packed by bucket."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import trim
from .wordhash import mix

WAITING = 1 << 19
BUCKET_KEYS = 1 << 21  # keys to be counted, with their repeats, that make a bucket

_ODD = np.uint64(0x9E3779B97F4A7C15)
_CHUNK_BITS = 16  # of a filter's slots in one row


class Combiner:
    """Adds up the counts of equal keys; about ``WAITING`` rows wait in a task."""

    def __init__(self, names: list[str]) -> None:
        self.names = names
        self.parts: list[tuple] = []  # keys, counts, columns
        self.rows = 0

    def add(self, keys: np.ndarray, counts: np.ndarray, columns: list) -> Iterator[pa.RecordBatch]:
        self.parts.append((keys, counts, columns))
        self.rows += len(keys)
        if self.rows >= WAITING:
            yield from self.flush(WAITING // 2)

    def flush(self, more_than: int = 0) -> Iterator[pa.RecordBatch]:
        """Combine what waits; send it on if more rows than that are left."""
        if not self.parts:
            return
        _, first, which = np.unique(np.concatenate([p[0] for p in self.parts]), return_index=True, return_inverse=True)
        counts = np.bincount(which, np.concatenate([p[1] for p in self.parts])).astype(np.int64)
        columns = [pa.concat_arrays([pa.array(c) for c in column]).take(pa.array(first))
                   for column in zip(*(p[2] for p in self.parts))]
        keys = np.concatenate([p[0] for p in self.parts])[first]
        self.parts, self.rows = [(keys, counts, columns)], len(keys)
        if self.rows > more_than:
            self.parts, self.rows = [], 0
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts)], self.names)


class Filter:
    """A Bloom filter of a fixed number of bits over 64-bit keys, whatever their number."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits  # bytes

    @staticmethod
    def slots(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        shift = np.uint64(64 - size)
        return (keys >> shift).astype(np.int64), ((keys * _ODD) >> shift).astype(np.int64)

    def has(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for slot in self.slots(keys, len(self.bits).bit_length() + 2):
            out &= (self.bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)
        return out

    @classmethod
    def of(cls, keys: DataFrame, size: int) -> Filter:
        """Of a one-column frame, with 2 ** ``size`` bits: tasks set those of their keys, and rows of 8 KB are united."""
        width = 1 << _CHUNK_BITS - 3

        def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bits = np.zeros(1 << size - 3, np.uint8)
            for batch in batches:
                for slot in cls.slots(batch.column(0).to_numpy().view(np.uint64), size):
                    np.bitwise_or.at(bits, slot >> 3, np.uint8(1) << (slot & 7).astype(np.uint8))
            rows = bits.reshape(-1, width)
            used = np.flatnonzero(rows.any(1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(used), pa.array([rows[k].tobytes() for k in used], pa.binary())], ["chunk", "bits"])

        def unite(table: pa.Table) -> pa.Table:
            rows = np.stack([np.frombuffer(b.as_py(), np.uint8) for b in table.column("bits")])
            return pa.table({"chunk": table.column("chunk").slice(0, 1),
                             "bits": pa.array([np.bitwise_or.reduce(rows).tobytes()], pa.binary())})

        bits = np.zeros((1 << size - _CHUNK_BITS, width), np.uint8)
        # At most 2 ** (size - 3) bytes in all.
        for row in keys.mapInArrow(mark, "chunk long, bits binary").groupBy("chunk").applyInArrow(
                unite, "chunk long, bits binary").collect():
            bits[row["chunk"]] = np.frombuffer(row["bits"], np.uint8)
        return cls(bits.ravel())


def packed(bucket: np.ndarray, columns: Sequence[np.ndarray]) -> tuple[np.ndarray, list[pa.Array]]:
    """The buckets that occur, and for each of them the entries of each column in one binary value."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, np.int64)
    bounds = np.append(first, len(bucket))
    values = []
    for column in columns:
        offsets = pa.array((bounds * column.itemsize).astype(np.int32))
        values.append(pa.Array.from_buffers(pa.binary(), len(first), [None, offsets.buffers()[1],
                                                                      pa.py_buffer(column[order].tobytes())]))
    return bucket[first], values


def unpacked(column: pa.ChunkedArray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All entries of packed values one after another, and how many each value has."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):  # no chunk at all
        return np.zeros(0, kind), np.zeros(0, np.int64)
    _, offsets, data = column.buffers()
    wide = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(offsets, wide)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, wide)
    size = np.dtype(kind).itemsize
    flat = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return np.frombuffer(flat.tobytes(), kind), np.diff(offsets) // size


def count_keys(frame: DataFrame, tell: Callable[[], Callable], key_of: Callable, names: Sequence[str], least: float,
               total: int) -> DataFrame:
    """``names`` (64-bit numbers) and ``n`` of the keys that occur ``least`` times.

    ``tell`` runs in each task and returns a function from a batch to the columns of the keys in it, run by run, and
    ``key_of`` makes keys of columns. A task adds up its keys over many runs and sends them packed, one row per bucket;
    a bucket's keys are added up in one task. ``total`` keys in all say how many buckets there are.
    """
    buckets = max(1, -(-total // BUCKET_KEYS))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, waiting = tell(), Combiner([*names, "n"])

        def send(combined: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in combined:
                columns = [c.to_numpy() for c in batch.columns]
                bucket, values = packed(bucket_of(key_of(*(c.view(np.uint64) for c in columns[:-1])), buckets), columns)
                yield pa.RecordBatch.from_arrays([pa.array(bucket), *values], ["bucket", *names, "n"])

        for batch in batches:
            for columns in found(batch):
                yield from send(waiting.add(key_of(*columns), np.ones(len(columns[0]), np.int64),
                                            [c.view(np.int64) for c in columns]))
        yield from send(waiting.flush())
        trim()

    def add_up(table: pa.Table) -> pa.Table:
        *columns, n = (unpacked(table.column(c), "<i8")[0] for c in (*names, "n"))
        _, at, which = np.unique(key_of(*(c.view(np.uint64) for c in columns)), return_index=True, return_inverse=True)
        total = np.bincount(which, n).astype(np.int64)
        keep = total >= least
        return pa.table([*[pa.array(c[at][keep]) for c in columns], pa.array(total[keep])], names=[*names, "n"])

    sent = ", ".join(f"{c} binary" for c in (*names, "n"))
    return frame.mapInArrow(count, f"bucket int, {sent}").groupBy("bucket").applyInArrow(
        add_up, ", ".join(f"{c} long" for c in (*names, "n")))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(keys) % np.uint64(buckets)).astype(np.int32)
