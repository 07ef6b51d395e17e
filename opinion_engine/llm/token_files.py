"""Token ids of texts in binary files, packed by Simple-8b.

Encoding. Texts are encoded where they lie, with the tokenizers library. The tokenizers this is meant for ignore case and
never join words over ASCII white space (``SPLITTING``), nor, in texts of ASCII and Latin-1 letters without apostrophes
(``SIMPLE``), letters and other characters. So the library encodes each distinct word, or part of one, on its own and
the ids are put together; a bounded cache in the worker holds the ids of short words. A text goes through in pieces of
``PIECE`` characters that end at white space. The tests compare with the library's ids of whole texts.

Order. Ids, not texts, are shuffled and sorted by document: approximate quantiles of the documents' ids cut the table
into parts of about ``PART_BYTES`` bytes of text, each one task, which writes its part into files of about ``FILE_IDS``
ids. A part's first position is the sum of the parts before it, from one count per part. A written file is named in the
manifest, a Parquet table that Spark commits. A task that runs again writes files of its own, and files that no manifest
names are never read.

Packing (``pack``). A 64-bit word holds a selector in its top four bits, which says how many ids of which width fill
the other 60, the first id lowest. ``WIDTHS`` lists them: one id of 60 bits up to 60 of one bit, and 120 zeros.
Selector 15 is the escape: the other bits are the place of a full 64-bit id among the escapes after the block's words.
Words never reach over a block of ``BLOCK_IDS`` ids, and each block's offset, ids, words and escapes are listed at the
file's end, so a reader unpacks any block alone, all words of a selector at once.

A file: ``MAGIC``; blocks (words, then escapes); one ``BLOCK`` per block; one ``DOCUMENT`` per document; ``TRAILER``.
All numbers are little-endian. Files lie below one folder that all executors share, and are opened through pyarrow.

Edge values: a null or empty text has the end id only. Rows without an id come first; rows that share an id follow
each other in the order of the checksums of their tokens, and each comes out. Other columns are dropped, whatever their names.
An empty table makes no file and reads back empty. A very long text fills many blocks, and its file ends with it.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .wordhash import slices

BLOCK_IDS = 1 << 16
FILE_IDS = 1 << 25
PART_BYTES = 1 << 26
PIECE = 1 << 20
CACHED_WORDS = 1 << 18
CACHED_LETTERS = 40
MAGIC = b"s8btok01"

#: (ids, bits) of the selectors 0 to 14; selector 15 is the escape.
WIDTHS = ((120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15),
          (3, 20), (2, 30), (1, 60))
ESCAPE = 15
_COUNTS = np.array([n for n, _ in WIDTHS] + [1])
_BITS = np.array([bits for _, bits in WIDTHS] + [0])
_PLACE = np.uint64((1 << 60) - 1)
_POWERS = np.array([1 << k for k in range(64)], np.uint64)
_SHORT_LENGTHS = np.searchsorted(_POWERS, np.arange(1 << 16), side="right").astype(np.uint8)

BLOCK = np.dtype([("offset", "<u8"), ("ids", "<u4"), ("words", "<u4"), ("escapes", "<u4"), ("crc", "<u4")])
DOCUMENT = np.dtype([("doc_id", "<i8"), ("named", "<u8"), ("tokens", "<u8")])
TRAILER = np.dtype([("blocks", "<u8"), ("documents", "<u8"), ("index", "<u8"), ("magic", "S8")])

_FIRST = -(1 << 63)  # the place of rows without an id
_MANIFEST = "part int, file int, path string, documents long, tokens long"


# --- Simple-8b -----------------------------------------------------------------------------


def _bit_lengths(ids: np.ndarray) -> np.ndarray:
    if len(ids) and ids.max() < 1 << 16:
        return _SHORT_LENGTHS[ids]
    return np.searchsorted(_POWERS, ids, side="right").astype(np.uint8)


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``ids`` (unsigned, up to 64 bits) as packed words and escapes. Each word takes as many ids as any selector can."""
    n = len(ids)
    lengths = _bit_lengths(ids)
    chosen = np.full(n, ESCAPE, np.uint8)
    widest, reach = lengths, 1  # the widest of the ``reach`` ids from each place on
    for selector in range(len(WIDTHS) - 1, -1, -1):  # a later one takes more ids
        count, bits = WIDTHS[selector]
        if count > n:
            break
        while reach < count:
            more = min(reach, count - reach)
            widest, reach = np.maximum(widest[:len(widest) - more], widest[more:]), reach + more
        chosen[:n - count + 1][widest <= bits] = selector
    step = _COUNTS[chosen].astype(np.uint8).tobytes()
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at += step[at]
    starts = np.array(starts, np.int64)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    selectors = chosen[starts]
    ids = ids.astype(np.uint64)
    escaped = selectors == ESCAPE
    escapes = ids[starts[escaped]]
    ids[starts[escaped]] = np.arange(len(escapes))
    place = np.arange(n) - np.repeat(starts, _COUNTS[selectors])
    ids <<= (place * np.repeat(_BITS[selectors], _COUNTS[selectors])).astype(np.uint64)
    return np.bitwise_or.reduceat(ids, starts) | selectors.astype(np.uint64) << np.uint64(60), escapes


def unpack(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """The ids of packed words, all words of a selector at once."""
    selectors = (words >> np.uint64(60)).astype(np.int64)
    counts = _COUNTS[selectors]
    first = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    for selector, (count, bits) in enumerate(WIDTHS):
        rows = np.flatnonzero(selectors == selector)
        if bits and len(rows):
            values = words[rows][:, None] >> (np.arange(count) * bits).astype(np.uint64)
            out[first[rows][:, None] + np.arange(count)] = values & np.uint64((1 << bits) - 1)
    rows = np.flatnonzero(selectors == ESCAPE)
    out[first[rows]] = escapes[(words[rows] & _PLACE).astype(np.int64)]
    return out


# --- files ---------------------------------------------------------------------------------


class FileWriter:
    """Writes documents to one stream, a block of ids at a time."""

    def __init__(self, stream) -> None:
        self.stream = stream
        self.offset = stream.write(MAGIC)
        self.blocks: list[tuple] = []
        self.documents: list[tuple] = []
        self.waiting: list[np.ndarray] = []
        self.waiting_ids = 0
        self.tokens = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.documents.append((doc_id or 0, doc_id is not None, len(ids)))
        self.tokens += len(ids)
        self.waiting.append(ids)
        self.waiting_ids += len(ids)
        if self.waiting_ids >= BLOCK_IDS:
            self._flush(BLOCK_IDS)

    def _flush(self, least: int) -> None:
        """Write the waiting ids in whole blocks, and what is left as well if it has ``least`` ids."""
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint64)
        at = 0
        while at < len(ids) and len(ids) - at >= least:
            part = ids[at:at + BLOCK_IDS]
            words, escapes = pack(part)
            data = words.astype("<u8").tobytes() + escapes.astype("<u8").tobytes()
            self.blocks.append((self.offset, len(part), len(words), len(escapes), zlib.crc32(data)))
            self.offset += self.stream.write(data)
            at += len(part)
        self.waiting, self.waiting_ids = [ids[at:]], len(ids) - at

    def close(self) -> None:
        self._flush(1)
        self.stream.write(np.array(self.blocks, BLOCK).tobytes() + np.array(self.documents, DOCUMENT).tobytes())
        self.stream.write(np.array([(len(self.blocks), len(self.documents), self.offset, MAGIC)], TRAILER).tobytes())
        self.stream.close()


def read_file(file) -> Iterator[tuple[int | None, np.ndarray]]:
    """``doc_id`` and ids of the documents of one file, in order; a block is read when its ids are due."""
    size = file.size()
    (trailer,) = np.frombuffer(file.read_at(TRAILER.itemsize, size - TRAILER.itemsize), TRAILER)
    if trailer["magic"] != MAGIC or file.read_at(len(MAGIC), 0) != MAGIC:
        raise ValueError("not a file of packed token ids")
    at = int(trailer["index"])
    index = np.frombuffer(file.read_at(int(trailer["blocks"]) * BLOCK.itemsize, at), BLOCK)
    documents = np.frombuffer(
        file.read_at(int(trailer["documents"]) * DOCUMENT.itemsize, at + index.nbytes), DOCUMENT)
    block, have, left = 0, [np.zeros(0, np.uint64)], 0
    for doc_id, named, tokens in documents.tolist():
        while left < tokens:
            ids = _read_block(file, index[block])
            have.append(ids)
            left += len(ids)
            block += 1
        flat = have[0] if len(have) == 1 else np.concatenate(have)
        yield (doc_id if named else None), flat[:tokens]
        have, left = [flat[tokens:]], left - tokens


def _read_block(file, block: np.void) -> np.ndarray:
    words, escapes = int(block["words"]), int(block["escapes"])
    data = file.read_at(8 * (words + escapes), int(block["offset"]))
    if zlib.crc32(data) != block["crc"]:
        raise ValueError("a block of token ids is damaged")
    numbers = np.frombuffer(data, "<u8")
    return unpack(numbers[:words], numbers[words:])


# --- encoding ------------------------------------------------------------------------------

SPLITTING = re.compile(r"[ \t-\r]")
#: Texts whose words may be cut between letters and other characters, and the parts they are cut into.
SIMPLE = re.compile(r"[\x00-\x26\x28-\x7fÀ-ÖØ-öø-ÿ]*")
LETTERS = re.compile(r"[a-zß-öø-ÿ]+")
SMALL = "".join(c for c in map(chr, range(0x61, 0x100)) if LETTERS.fullmatch(c))
PARTS = re.compile(r"[a-zß-öø-ÿ]+|[^a-zß-öø-ÿ \t-\r]+")


class WordEncoder:
    """Ids of texts as bytes: the library encodes distinct words, of which the short ones are kept for later texts.

    Two generations of words are kept. When the younger is full the older goes, and words that are met again move up.
    """

    def __init__(self, tokenizer_json: str, width: str = "<u4") -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        added = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added)) or "(?!)")
        self.width = width
        # Whether a run of small letters is one word as it stands, which the library's model then cuts directly; letters
        # beyond ASCII are spelled as the library's model spells them.
        first, second = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        spelled = lambda text: [word for word, _ in second.pre_tokenize_str(text)]
        self.spelling = {ord(c): spelled(c)[0] for c in SMALL if not c.isascii()} if second else {}
        self.direct = bool(first and second) and first.normalize_str(SMALL) == SMALL and spelled(SMALL) == [
            SMALL.translate(self.spelling)]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """The packed ids of each text; many texts that are short, or one that is long."""
        if len(texts) != 1 or len(texts[0] or "") <= PIECE:
            return self._encode([self.words(text or "") for text in texts])
        at, pieces, text = 0, [], texts[0]
        while at < len(text):
            cut = SPLITTING.search(text, at + PIECE)
            stop = cut.start() if cut else len(text)
            pieces += self._encode([self.words(text[at:stop])])
            at = stop
        return [b"".join(pieces)]

    def words(self, text: str) -> list[str]:
        """What the library encodes on its own: the parts of words in a simple text, else the words."""
        if SIMPLE.fullmatch(text):
            lower = text.lower()
            if not self.added.search(lower):
                return PARTS.findall(lower)
        return [w for w in SPLITTING.split(text) if w]

    def _encode(self, texts: list[list[str]]) -> list[bytes]:
        known = self.known
        missing = set().union(*texts).difference(known)
        if missing:
            self._learn(missing)
        out = [b"".join([known[w] for w in words]) for words in texts]
        for word in missing:
            if len(word) > CACHED_LETTERS:
                del known[word]
        if len(known) > CACHED_WORDS:
            self.known, self.older = {}, known
        return out

    def _learn(self, words: set[str]) -> None:
        """Have the library encode what is not known, all at once."""
        new, known, older = [], self.known, self.older
        cut, kind = self.tokenizer.model.tokenize, "H" if self.width == "<u2" else "I"
        for word in words:
            if word in older:
                known[word] = older[word]
            elif self.direct and LETTERS.fullmatch(word):
                known[word] = array(kind, [t.id for t in cut(word.translate(self.spelling))]).tobytes()
            else:
                new.append(word)
        if not new:
            return
        coded = self.tokenizer.encode(new, is_pretokenized=True, add_special_tokens=False)
        ids = np.array(coded.ids, self.width)
        counts = np.bincount(np.array(coded.word_ids, np.int64), minlength=len(new))
        packed, start = ids.tobytes(), 0
        for word, size in zip(new, (counts * ids.itemsize).tolist()):
            known[word] = packed[start:start + size]
            start += size


#: The encoder that a worker made last, with the words it knows.
_last: list[tuple[int, WordEncoder]] = []


def _encoder(tokenizer_json: str, width: str) -> WordEncoder:
    key = hash((tokenizer_json, width))
    if not _last or _last[0][0] != key:
        _last[:] = [(key, WordEncoder(tokenizer_json, width))]
    return _last[0][1]


def id_width(tokenizer_json: str, end_id: int) -> str:
    """The unsigned type that holds every id of a vocabulary."""
    from tokenizers import Tokenizer

    return "<u2" if max(Tokenizer.from_str(tokenizer_json).get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"


def _encode(docs: DataFrame, tokenizer_json: str, end_id: int, width: str, bounds: np.ndarray) -> DataFrame:
    """``part``, ``doc_id``, ``crc`` (of the ids) and ``ids`` with the end id.

    A part holds the ids between two ``bounds``. An id that is several bounds has several parts, which its rows share
    by checksum, so that order by id and checksum is kept.
    """
    sent = docs.sparkSession.sparkContext.broadcast(tokenizer_json)  # one vocabulary, whatever the table's size
    end = np.array([end_id], width).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(sent.value, width)
        for batch in batches:
            for rows in slices(batch, 1):
                ids = [coded + end for coded in encoder(rows.column(1).to_pylist())]
                crc = np.array([zlib.crc32(x) for x in ids], np.int64)
                keys = rows.column(0).fill_null(_FIRST).to_numpy()
                low, high = (np.searchsorted(bounds, keys, side) for side in ("left", "right"))
                part = low + (crc * (high - low + 1) >> 32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part.astype(np.int32)), rows.column(0), pa.array(crc), pa.array(ids, pa.binary())],
                    ["part", "doc_id", "crc", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "part int, doc_id long, crc long, ids binary")


# --- the table -----------------------------------------------------------------------------


def _filesystem(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def _write_parts(folder: str, file_ids: int, width: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _filesystem(folder)
        writer, written, current = None, [], None

        def finish() -> None:
            writer.close()
            written.append((current, len(written), name, len(writer.documents), writer.tokens))

        for batch in batches:
            for part, doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if writer is not None and (part != current or writer.tokens >= file_ids):
                    finish()
                    writer = None
                if writer is None:
                    current, name = part, f"part-{part:06d}-{len(written):04d}-{uuid.uuid4().hex}.s8b"
                    writer = FileWriter(system.open_output_stream(f"{root}/{name}"))
                writer.add(doc_id, np.frombuffer(ids.as_buffer(), width))
        if writer is not None:
            finish()
        yield pa.RecordBatch.from_pylist(
            [dict(zip(("part", "file", "path", "documents", "tokens"), row)) for row in written],
            pa.schema([("part", pa.int32()), ("file", pa.int32()), ("path", pa.string()),
                       ("documents", pa.int64()), ("tokens", pa.int64())]))

    return run


def part_bounds(docs: DataFrame, part_bytes: int) -> np.ndarray:
    """Ids that cut a table into parts with about ``part_bytes`` bytes of text, one for each core at least."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(_FIRST))
    size, rows = docs.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    parts = max(docs.sparkSession.sparkContext.defaultParallelism, -(-(size or 0) // part_bytes))
    if not rows or parts == 1:
        return np.zeros(0, np.int64)
    shares = [k / parts for k in range(1, parts)]
    return np.array(docs.agg(F.percentile_approx(key, shares, max(10_000, 10 * parts))).first()[0], np.int64)


def write(docs: DataFrame, tokenizer_json: str, end_id: int, folder: str, file_ids: int = FILE_IDS,
          part_bytes: int = PART_BYTES) -> None:
    """Encode all rows and write their ids, in ascending order of ``doc_id``, to files and a manifest in ``folder``."""
    system, root = _filesystem(folder)
    system.create_dir(root, recursive=True)
    docs = docs.select("doc_id", "text")
    bounds, width = part_bounds(docs, part_bytes), id_width(tokenizer_json, end_id)
    coded = _encode(docs, tokenizer_json, end_id, width, bounds)
    ordered = coded.repartitionById(len(bounds) + 1, "part").sortWithinPartitions(
        "part", F.col("doc_id").asc_nulls_first(), "crc", "ids")
    ordered.select("part", "doc_id", "ids").mapInArrow(
        _write_parts(folder, file_ids, width), _MANIFEST).write.parquet(f"{folder}/manifest")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids`` (little-endian, 32 bits)."""
    manifest = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    parts = manifest.groupBy("part").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("files")).orderBy(
        "part").collect()  # one row per task that wrote
    starts, at = [], 0
    for row in parts:
        starts.append((row["part"], at))
        at += row["tokens"]
    before = Window.partitionBy("part").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    placed = (manifest.join(F.broadcast(spark.createDataFrame(starts, "part int, first long")), "part")
              .select("path", (F.col("first") + F.coalesce(F.sum("tokens").over(before), F.lit(0))).alias("first")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _filesystem(folder)
        for batch in batches:
            for name, first in zip(*(c.to_pylist() for c in batch.columns)):
                with system.open_input_file(f"{root}/{name}") as file:
                    yield from _batches(read_file(file), first)

    files = sum(row["files"] for row in parts)
    return placed.repartition(max(1, min(files, 10_000))).mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids binary")


def _batches(documents: Iterable[tuple[int | None, np.ndarray]], start: int) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    names = ["doc_id", "start", "n_tokens", "ids"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    for doc_id, ids in documents:
        rows.append((doc_id, start, len(ids), ids.astype("<u4").tobytes()))
        start += len(ids)
        size += 4 * len(ids)
        if size > PIECE:
            yield batch()
            rows, size = [], 0
    if rows:
        yield batch()
