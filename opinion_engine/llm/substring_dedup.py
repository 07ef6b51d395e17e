"""Substring dedup: word windows that occur earlier are removed, found by difference-cover anchors.

1. Anchors. With a cover ``D`` modulo ``v``, any two positions have a shift below ``v`` that takes both into
   ``D``. So two equal windows of ``window`` words share an anchor of ``window - v + 1`` words that lies at a
   cover position in both documents. Only anchors at cover positions are hashed and sent, 4 of 13.
2. Repeated anchors. Anchor hashes are dealt to buckets; a bucket returns, per document, the hashes that occur
   more than once.
3. Extension. A document's windows around repeated anchors are hashed whole and dealt to buckets, which return
   all but the first occurrence (by id, then start) of each window.
4. Each document drops the words of its returned windows.

Hashes travel packed, one row per bucket and batch of documents. Within a batch equal anchors are known to be
repeated and equal windows known to be later, so a hash goes to its bucket once per batch, and what is known
already takes a bucket dealt by document: a passage in a third of all documents makes no bucket large. A copy
of a whole text that has a smaller id elsewhere is known from one aggregate over digests, and its windows are
all later ones. Texts are shuffled once, by id; the number of buckets follows the bytes of text.

Hashes of words and windows have 64 bits; a window counts as equal if its anchors and its own hash are.

Edge values: a null or empty text has no words. A null id counts as the greatest id. Rows that share an id
are one document written twice: windows at equal (id, start) do not remove each other. Other columns are
dropped unless ``keep`` names them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .wordhash import blocks, mix, slices, window_hashes, word_hashes

WINDOW = 20
PERIOD = 13
COVER = (0, 1, 3, 9)  # every difference modulo 13 occurs between two of them
ANCHOR = WINDOW - PERIOD + 1
BUCKET_BYTES = 16 << 20  # text per bucket
BATCH_BYTES, BATCH_ROWS = 8 << 20, 1 << 16  # text that is packed together
_LAST_ID = (1 << 63) - 1
_PACKED = "bucket long, hashes binary, owners binary, places binary, ids binary, known boolean"


def _planes(numbers: np.ndarray) -> bytes:
    """Small numbers byte by byte, all low bytes first, so that the empty high bytes compress to nothing."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4")[:, 0]


def _pack(hashes: np.ndarray, owners: np.ndarray, places: np.ndarray, ids: np.ndarray, bucket: np.ndarray,
          known: bool) -> Iterator[tuple]:
    """Rows of the packed form, one per bucket; ``owners`` index ``ids``."""
    order = np.lexsort([places, owners, bucket])
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for at in np.split(order, cuts) if len(order) else ():
        used, owner = np.unique(owners[at], return_inverse=True)
        yield (int(bucket[at[0]]), hashes[at].tobytes(), _planes(owner), _planes(places[at]), ids[used].tobytes(), known)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.bool_()]
    columns = list(zip(*rows)) if rows else [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                      ["bucket", "hashes", "owners", "places", "ids", "known"])


def _unpack(table: pa.Table, known: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, ids and places of a bucket's rows."""
    out = [[np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]]
    columns = [table.column(c).to_pylist() for c in ("hashes", "owners", "places", "ids", "known")]
    for hashes, owners, places, ids, is_known in zip(*columns):
        if is_known == known:
            out[0].append(np.frombuffer(hashes, np.uint64))
            out[1].append(np.frombuffer(ids, np.int64)[_numbers(owners)])
            out[2].append(_numbers(places))
    return tuple(np.concatenate(o) for o in out)


def _dealt(ids: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of what is sent to a document."""
    return (mix(ids.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _to_documents(hashes: np.ndarray, ids: np.ndarray, places: np.ndarray, buckets: int) -> pa.Table:
    """Packed rows for the documents, one per bucket of documents."""
    documents, owner = np.unique(ids, return_inverse=True)
    rows = list(_pack(hashes, owner, places, documents, _dealt(documents, buckets)[owner], False))
    return pa.Table.from_batches([_batch(rows)])


def _by_document(key: tuple, table: pa.Table) -> pa.Table:
    """One row per document with its packed hashes and places."""
    hashes, ids, places = _unpack(table, False)
    order = np.argsort(ids, kind="stable")
    hashes, ids, places = hashes[order], ids[order], places[order].astype("<u4")
    first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])) if len(ids) else np.zeros(0, np.int64)
    bounds = np.concatenate([first, [len(ids)]])

    def binary(values: np.ndarray) -> pa.Array:
        offsets = (bounds * values.itemsize).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets.tobytes()),
                                                               pa.py_buffer(values.tobytes())])

    return pa.table({"key": pa.array(ids[first], pa.int64()), "hashes": binary(hashes), "places": binary(places)})


def _packed_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from slices(batch, 1, BATCH_ROWS, BATCH_BYTES)


def _documents(texts: pa.Array) -> list[np.ndarray]:
    """Per word of all texts: its hash, its text, its place there, and how many words the text has."""
    parts = [[np.zeros(0, np.uint64)], *[[np.zeros(0, np.int64)] for _ in range(3)]]
    for block in blocks(texts):
        counts = np.diff(block.first)
        for part, values in zip(parts, (word_hashes(block), block.row + block.document_of_word(),
                                        block.place_of_word(), np.repeat(counts, counts))):
            part.append(values)
    return [np.concatenate(p) for p in parts]


def _anchors(words: np.ndarray, place: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where anchors start, and their hashes. Documents shorter than a window have none."""
    cover = np.zeros(PERIOD, bool)
    cover[list(COVER)] = True
    at = np.flatnonzero(cover[place % PERIOD] & (place + ANCHOR <= size) & (size >= WINDOW))
    return at, window_hashes(words, at, ANCHOR)


def _send_anchors(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _packed_together(batches):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            words, row, place, size = _documents(batch.column(1))
            at, hashes = _anchors(words, place, size)
            owner = row[at]
            # one entry per document and hash
            order = np.lexsort([owner, hashes])
            hashes, owner = hashes[order], owner[order]
            same = np.zeros(len(hashes), bool)
            same[1:] = hashes[1:] == hashes[:-1]
            again = np.zeros(len(hashes), bool)
            again[:-1] = same[1:]
            repeated = same | again
            one = np.ones(len(hashes), bool)
            one[1:] = ~(same[1:] & (owner[1:] == owner[:-1]))
            known = repeated & one
            none = np.zeros(len(hashes), np.uint32)
            dealt = _dealt(ids, buckets)
            # A hash is sent to its bucket once; place 1 says that the sender knows it as repeated.
            sent = ~same
            rows = list(_pack(hashes[sent], owner[sent], repeated[sent].astype(np.uint32), ids,
                              (hashes[sent] % np.uint64(buckets)).astype(np.int64), False))
            rows += _pack(hashes[known], owner[known], none[known], ids, dealt[owner[known]], True)
            yield _batch(rows)

    return run


def _return_anchors(table: pa.Table, buckets: int) -> pa.Table:
    """The documents' hashes that occur more than once."""
    hashes, ids, sure = _unpack(table, False)
    order = np.argsort(hashes, kind="stable")
    hashes, ids, sure = hashes[order], ids[order], sure[order]
    same = np.zeros(len(hashes), bool)
    same[1:] = hashes[1:] == hashes[:-1]
    same[:-1] |= same[1:]
    ask = same & (sure == 0)  # the sender has told its own documents of the others
    more = _unpack(table, True)
    hashes, ids = np.concatenate([hashes[ask], more[0]]), np.concatenate([ids[ask], more[1]])
    return _to_documents(hashes, ids, np.zeros(len(ids), np.uint32), buckets)


def _windows(words: np.ndarray, row: np.ndarray, place: np.ndarray, size: np.ndarray,
             marks: list) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the windows that hold a repeated anchor."""
    at, hashes = _anchors(words, place, size)
    if not len(at):
        return at, hashes
    # a document's own repeated hashes, looked up as (row, hash) mixed into one number
    counts = [len(m) for m in marks]
    salt = mix(np.arange(len(marks), dtype=np.uint64))
    wanted = np.sort(np.concatenate(marks) ^ np.repeat(salt, counts)) if sum(counts) else np.zeros(0, np.uint64)
    mine = hashes ^ salt[row[at]]
    found = np.searchsorted(wanted, mine)
    hit = np.zeros(len(at), bool)
    inside = found < len(wanted)
    hit[inside] = wanted[found[inside]] == mine[inside]
    near = np.zeros(len(words) + 1, np.int64)
    begin = at[hit]
    np.add.at(near, np.maximum(begin - (PERIOD - 1), begin - place[begin]), 1)
    np.add.at(near, begin + 1, -1)
    starts = np.flatnonzero((np.cumsum(near)[:-1] > 0) & (place + WINDOW <= size))
    return starts, window_hashes(words, starts, WINDOW, 1)


def _send_windows(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _packed_together(batches):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            words, row, place, size = _documents(batch.column(1))
            marks = [np.frombuffer(m, np.uint64) for m in batch.column(2).to_pylist()]
            starts, hashes = _windows(words, row, place, size, marks)
            owner, begin = row[starts], place[starts]
            order = np.lexsort([begin, ids[owner], hashes])
            hashes, owner, begin = hashes[order], owner[order], begin[order]
            place_id = ids[owner]
            head = np.ones(len(hashes), bool)
            head[1:] = hashes[1:] != hashes[:-1]
            # later than the first one of this batch, by id and start
            first = np.flatnonzero(head)[np.cumsum(head) - 1] if len(head) else np.zeros(0, np.int64)
            later = (place_id != place_id[first]) | (begin != begin[first])
            dealt = _dealt(ids, buckets)
            rows = list(_pack(hashes[head], owner[head], begin[head], ids,
                              (hashes[head] % np.uint64(buckets)).astype(np.int64), False))
            rows += _pack(hashes[later], owner[later], begin[later], ids, dealt[owner[later]], True)
            yield _batch(rows)

    return run


def _return_windows(table: pa.Table, buckets: int) -> pa.Table:
    """The documents' windows that are not the first of their hash."""
    hashes, ids, places = _unpack(table, False)
    order = np.lexsort([places, ids, hashes])
    hashes, ids, places = hashes[order], ids[order], places[order]
    head = np.ones(len(hashes), bool)
    head[1:] = hashes[1:] != hashes[:-1]
    first = np.flatnonzero(head)[np.cumsum(head) - 1] if len(head) else np.zeros(0, np.int64)
    later = (ids != ids[first]) | (places != places[first])
    more = _unpack(table, True)
    return _to_documents(*[np.concatenate([a[later], b]) for a, b in zip((hashes, ids, places), more)], buckets)


def _covered(n: int, starts: np.ndarray) -> np.ndarray:
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + WINDOW, n), -1)
    return np.cumsum(edge)[:-1] > 0


def _cut(kept: list[int], text: int):
    """Remove covered words; the last three columns are packed hashes and places, and whether the text is a copy."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                hashes, places, copy = (part.column(part.num_columns - k).to_pylist() for k in (3, 2, 1))
                flagged = [i for i, (h, c) in enumerate(zip(hashes, copy)) if h and not c]
                own = _own_windows(part.column(text).take(pa.array(flagged, pa.int64()))) if flagged else {}
                row_of = dict(zip(flagged, range(len(flagged))))
                out = [[], [], []]
                for i, raw in enumerate(part.column(text).to_pylist()):
                    words = (raw or "").encode().split()
                    n = len(words)
                    if copy[i] and n >= WINDOW:
                        left = []
                    elif i in row_of:
                        mine = own.get(row_of[i], np.zeros(0, np.uint64))
                        start = np.frombuffer(places[i], "<u4").astype(np.int64)
                        fits = start < len(mine)
                        start, want = start[fits], np.frombuffer(hashes[i], np.uint64)[fits]
                        gone = _covered(n, start[mine[start] == want])
                        left = [w for w, g in zip(words, gone.tolist()) if not g]
                    else:
                        left = words
                    for column, value in zip(out, (n, n - len(left), b" ".join(left).decode())):
                        column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(i) for i in kept], pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                     pa.array(out[2], pa.string())],
                    names=[*[f"in_{i}" for i in kept], "n_words", "n_removed", "kept"])

    return run


def _own_windows(texts: pa.Array) -> dict[int, np.ndarray]:
    """Hashes of all windows of each text."""
    out = {}
    for block in blocks(texts):
        words = word_hashes(block)
        for i in range(block.documents):
            a, b = int(block.first[i]), int(block.first[i + 1])
            out[block.row + i] = window_hashes(words[a:b], np.arange(max(0, b - a - WINDOW + 1)), WINDOW, 1)
    return out


def dedup_substrings(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep``, and ``n_words``, ``n_removed`` and ``kept`` (the words left, joined by single spaces).

    These names win over kept columns.
    """
    carried = list(dict.fromkeys([*keep, "text"]))
    inner = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST_ID)).alias("key"),
                        *[F.col(f"`{c}`").alias(f"in_{i}") for i, c in enumerate(carried)])
    text = f"in_{carried.index('text')}"
    size = inner.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = max(16, -(-size // BUCKET_BYTES))

    def returned(sent: DataFrame, answer) -> DataFrame:
        """What buckets return to documents, gathered per document."""
        def run(key: tuple, table: pa.Table) -> pa.Table:
            return answer(table, buckets)

        return sent.groupBy("bucket").applyInArrow(run, _PACKED).groupBy("bucket").applyInArrow(
            _by_document, "key long, hashes binary, places binary")

    digest = [F.xxhash64(F.lit(s), text) for s in ("a", "b")]
    originals = inner.filter(F.col(text).isNotNull()).groupBy(digest[0].alias("d1"), digest[1].alias("d2")).agg(
        F.min("key").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("d1", "d2", "least")
    keys = inner.filter(F.col(text).isNotNull()).select("key", digest[0].alias("d1"), digest[1].alias("d2"))
    # A copy is told from other rows with its id by the digest.
    copies = keys.join(originals, ["d1", "d2"]).filter("key > least").groupBy("key").agg(
        F.collect_set("d1").alias("copied"))

    anchors = returned(inner.select("key", text).mapInArrow(_send_anchors(buckets), _PACKED), _return_anchors)
    # Read by both passes over the texts, so it is stored; it holds repeated hashes only.
    marks = materialize(anchors.select("key", "hashes").join(copies, "key", "full"), "repeated-anchors")
    marked = inner.join(marks.hint("shuffle_hash"), "key", "left").withColumn(
        "copy", F.coalesce(F.array_contains("copied", digest[0]), F.lit(False)))
    # All columns are named, so that both passes share one shuffle of the texts.
    columns = [f"in_{i}" for i in range(len(carried))]
    windows = returned(marked.filter("not copy and hashes is not null")
                       .select("key", text, "hashes", *[c for c in columns if c != text])
                       .mapInArrow(_send_windows(buckets), _PACKED), _return_windows)
    later = windows.select("key", F.col("hashes").alias("later"), "places")
    ready = marked.drop("hashes", "copied").join(later.hint("shuffle_hash"), "key", "left").select(
        *columns, "later", "places", "copy")
    results = ("n_words", "n_removed", "kept")
    kept = [i for i, c in enumerate(carried) if c in keep and c not in results]
    schema = inner.select(*[f"in_{i}" for i in kept]).withColumns(
        {"n_words": F.lit(0).cast("long"), "n_removed": F.lit(0).cast("long"), "kept": F.lit("")}).schema
    return ready.mapInArrow(_cut(kept, carried.index("text")), schema).select(
        *[F.col(f"in_{i}").alias(carried[i]) for i in kept], *results)
