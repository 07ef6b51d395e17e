"""LM scoring with a weighted backoff automaton.

Learning. Word counts over all learning texts give p(w) = (c - d) / N with an absolute discount d; the mass it
frees belongs to words not seen. All pairs of neighbouring words are counted as well, and each that occurs
``LEAST`` times or more, whatever the size of the table, is an arc: p(w | h) = (c(h, w) - d) / c(h). A word with
arcs is a state; its failure arc leads to the root and weighs what is left of its probability over what the root
gives to words without an arc. ``fit`` can be asked for a pruned model, by shares of all tokens.

Scoring. The state after a word is that word, so the steps of a text are looked up together: every step weighs
its failure arc and its word at the root, and a step with an arc weighs the arc instead. Words with at least
``HEAD`` of all tokens (heads, at most 1 / HEAD) and arcs with at least ``ARC`` (at most 1 / ARC) go to every task.
That is a cache: the weights of all other words and arcs are tables. A task asks them for its texts' other words, and
for the pairs that a bit table of fixed size does not rule out as arcs. Requests travel packed by bucket of their
hash, a bucket adds up what it gives to each row, and its answers travel packed by the part of the texts that asked.
No text is shuffled.

Words and pairs are 64-bit hashes; a pair of heads is exact. What is gathered from the corpus, the counts of all
words and pairs, grows with it. Pairs are added up in each task over many texts before they are sent, packed by
bucket, so a pair that makes up a third of all sends one entry per task and time. Buckets hold the pairs of
about ``BUCKET_KEYS`` tokens, whatever the corpus. Weights of heads reach the pairs by broadcast, so no head, which
may have very many pairs, is a key of a shuffled join. A table goes as soon as the next one is written.

Edge values: a null or empty text has the end token only. Rows without an id are scored but not learned from.
Rows that share an id are scored each for itself. If nothing is learned, scores are those of an empty model:
every token is unknown with probability 1. An empty table gives an empty one. Other columns are dropped, whatever
their names. A very long text is a block of its own, and is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialize
from .common import trim, type_of
from .counting import BUCKET_KEYS, WAITING, Combiner, Filter, bucket_of, count_keys, packed, unpacked
from .wordhash import Block, blocks, mix, word_hashes

HEAD = 1e-6
ARC = 1e-6
FILTER_BITS = 27
LEAST = 2
ADD = 0.1
END = np.uint64(0xE0D0E0D0E0D0E0D1)  # the end token; no word hashes to it but by accident
_REST = np.uint64(1 << 63)  # set in the number of a word that is no head


def _tokens(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a block's tokens with the ends, and where each document's tokens begin."""
    words = word_hashes(block)
    places = np.arange(block.documents)
    out = np.insert(words, block.first[1:], END)
    return out, block.first + np.concatenate([places, [block.documents]])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting = Combiner(["word", "n"])
    for batch in batches:
        for block in blocks(batch.column(0), lower=True):
            found, counts = np.unique(_tokens(block)[0], return_counts=True)
            yield from waiting.add(found, counts, [found.view(np.int64)])
    yield from waiting.flush()
    trim()


def count_words(texts: DataFrame) -> DataFrame:
    """``word`` (hash) and ``n`` of all tokens of a one-column frame of texts."""
    return texts.mapInArrow(_count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Numbering:
    """Numbers of the head words: 1.. in the order of their hashes; 0 for all others."""

    def __init__(self, heads: np.ndarray) -> None:
        self.heads = heads  # sorted unsigned hashes
        # An index over the top bits leaves few steps of search.
        self.bits = max(1, min(22, int(len(heads)).bit_length() + 2))
        top = (heads >> np.uint64(64 - self.bits)).astype(np.int64)
        self.begin = np.searchsorted(top, np.arange((1 << self.bits) + 1))
        self.steps = int(np.diff(self.begin).max(initial=0))

    def __call__(self, words: np.ndarray) -> np.ndarray:
        out = np.zeros(len(words), np.int32)
        if not len(self.heads):
            return out
        top = (words >> np.uint64(64 - self.bits)).astype(np.int64)
        at, stop = self.begin[top], self.begin[top + 1]
        for step in range(self.steps):
            here = at + step
            inside = here < stop
            hit = inside & (self.heads[np.minimum(here, len(self.heads) - 1)] == words)
            out[hit] = here[hit] + 1
            if not inside.any():
                break
        return out


@dataclass
class Model:
    """What goes to every task; bounded by the shares of ``fit``."""

    tokens: int  # N
    words: int  # V
    discount: float
    unknown: float  # log10 of the probability of a word not seen
    heads: np.ndarray
    head_counts: np.ndarray
    fail: np.ndarray  # log10 weight of each head's failure arc, 0 without arcs
    arcs: dict[str, np.ndarray]  # sorted "key", and "gain", log10 of an arc over the failure arc and the root; or empty
    some: Filter | None = None  # a bit table of all arcs: what it does not have is no arc


@dataclass
class Stored:
    """Tables of all words (``word``, ``n``, ``fail``) and all arcs (``key``, ``gain``)."""

    words: DataFrame
    arcs: DataFrame


def _numbers(tokens: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Heads by their number, other words by their hash, mixed once more for ``END``, with the top bit set."""
    return np.where(heads > 0, heads.astype(np.uint64), mix(tokens) | _REST)


def _keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return (before << np.uint64(32) | before >> np.uint64(32)) ^ word


def _before(words: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The word before each; a text begins after an end token."""
    out = np.concatenate([end, words[:-1]])
    out[first[:-1]] = end
    return out


def _pair_counts(texts: DataFrame, heads: np.ndarray, least: float, total: int) -> DataFrame:
    """``h``, ``w`` (numbers of words) and ``n`` of neighbouring words that occur ``least`` times."""
    sent = texts.sparkSession.sparkContext.broadcast(heads)

    def tell():
        number = Numbering(sent.value)
        end = _numbers(np.array([END]), number(np.array([END])))

        def pairs(batch: pa.RecordBatch) -> Iterator[list[np.ndarray]]:
            for block in blocks(batch.column(0), lower=True):
                tokens, first = _tokens(block)
                words = _numbers(tokens, number(tokens))
                yield [_before(words, first, end), words]

        return pairs

    return count_keys(texts, tell, _keys, ("h", "w"), least, total)


def _numbered(counts: DataFrame, heads: np.ndarray) -> DataFrame:
    """``counts`` with ``id``, the number of each word."""
    sent = counts.sparkSession.sparkContext.broadcast(heads)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = Numbering(sent.value)
        for batch in batches:
            words = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            ids = _numbers(words, number(words)).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids)], ["word", "n", "id"])

    return counts.select("word", "n").mapInArrow(run, "word long, n long, id long")


def _looked_up(pairs: DataFrame, column: str, words: DataFrame) -> DataFrame:
    """Stored ``pairs`` with the columns of ``words`` for the word ``column``: heads by broadcast, others by shuffle."""
    heads, rest = (words.withColumnRenamed("id", column).filter(F.col(column) > 0),
                   words.withColumnRenamed("id", column).filter(F.col(column) < 0))
    return (pairs.filter(F.col(column) > 0).join(F.broadcast(heads), column)
            .unionByName(pairs.filter(F.col(column) < 0).join(rest, column)))


def fit(texts: DataFrame, head: float = 0.0, arc: float = 0.0, cached_head: float = HEAD,
        cached_arc: float = ARC) -> tuple[Model, Stored]:
    """Learn from a one-column frame of texts; returns what tasks get and the tables of everything.

    ``head`` and ``arc`` prune the model: arcs join words with at least ``head`` of all tokens, and have at least
    ``arc`` themselves. Nothing is pruned by default. What is cached changes no score.
    """
    counts = materialize(count_words(texts), "word-counts")
    total = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"), F.count_if(F.col("n") == 1).alias("n1"),
                       F.count_if(F.col("n") == 2).alias("n2")).first()
    n, v = total["n"] or 0, total["v"]
    if not n:
        none = np.zeros(0, np.uint64)
        nothing = counts.select("word", "n", F.lit(0.0).alias("fail"))
        return (Model(0, 0, 0.0, 0.0, none, none.astype(np.int64), np.zeros(0), {}),
                Stored(nothing, counts.select(F.col("word").alias("key"), F.lit(0.0).alias("gain"))))
    discount = min(0.95, max(0.05, total["n1"] / max(1, total["n1"] + 2 * total["n2"])))
    # At most 1 / cached_head rows.
    rows = counts.filter(F.col("n") >= cached_head * n).select("word").toPandas()
    heads = np.sort(rows["word"].to_numpy(np.int64).view(np.uint64))
    pairs = materialize(_pair_counts(texts, heads, max(float(LEAST), arc * n), n), "pair-counts")
    words = _numbered(counts, heads)
    root = lambda c: (F.col(c) - discount) / F.lit(float(n))
    after = materialize(_looked_up(pairs, "w", words.filter(F.col("n") >= head * n).select(
        "id", root("n").alias("root"))), "pair-roots")
    discard(pairs)
    sums = after.groupBy(F.col("h").alias("id")).agg(
        F.sum(F.col("n") - discount).alias("kept"), F.sum("root").alias("lower"))
    weight = F.log10((1 - F.col("kept") / F.col("n")) / (1 - F.col("lower")))
    words = materialize(words.join(sums, "id", "left").select(
        "id", "word", "n", F.when(F.col("n") >= head * n, weight).alias("fail")), "word-weights")
    discard(counts)
    enough = words.filter(F.col("n") >= head * n)
    arcs = materialize(_looked_up(after, "h", enough.select("id", F.col("n").alias("c"), "fail")).select(
        F.shiftleft("h", 32).bitwiseOR(F.shiftrightunsigned("h", 32)).bitwiseXOR(F.col("w")).alias("key"), "n",
        (F.log10((F.col("n") - discount) / F.col("c")) - F.col("fail") - F.log10("root")).alias("gain"),
        ((F.col("h") > 0) & (F.col("w") > 0)).alias("heads")), "pair-weights")
    discard(after)
    rows = words.filter("id > 0").select("id", "n", "fail").toPandas().sort_values("id")
    # At most 1 / cached_arc rows.
    cached = arcs.filter(F.col("heads") & (F.col("n") >= cached_arc * n)).select("key", "gain").toPandas().sort_values("key")
    return (Model(n, v, discount, float(np.log10(discount * v / n)), heads, rows["n"].to_numpy(np.int64),
                  rows["fail"].fillna(0.0).to_numpy(np.float64),
                  {"key": cached["key"].to_numpy(np.int64).view(np.uint64), "gain": cached["gain"].to_numpy(np.float64)},
                  Filter.of(arcs.select("key"), FILTER_BITS)),
            Stored(words.select("word", "n", F.coalesce("fail", F.lit(0.0)).alias("fail")), arcs.select("key", "gain")))


class Automaton:
    """The steps of texts over heads and cached arcs, and what is left to be looked up in the tables."""

    def __init__(self, model: Model) -> None:
        self.number = Numbering(model.heads)
        # A word's weight at the root and, as the word before another, that of its failure arc; 0 for no head.
        self.word = np.append(0.0, np.log10((model.head_counts - model.discount) / max(model.tokens, 1)) + model.fail)
        self.key, self.gain = (model.arcs or {"key": np.zeros(0, np.uint64), "gain": np.zeros(0)}).values()
        self.end = _numbers(np.array([END]), self.number(np.array([END])))
        self.some = model.some

    def weights(self, tokens: np.ndarray, first: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Weight of each step as far as it is known here, keys of the steps, and which may be arcs that are not cached.

        A text's words are also the words before: its end token stands for the one it begins after.
        """
        words = _numbers(tokens, heads)
        keys = _keys(_before(words, first, self.end), words)
        weight = self.word[heads]
        open_ = self.some.has(keys) if self.some is not None else np.ones(len(keys), bool)
        if not len(self.key):
            return weight, keys, open_
        at = np.minimum(np.searchsorted(self.key, keys), len(self.key) - 1)
        hit = self.key[at] == keys
        return weight + np.where(hit, self.gain[at], 0.0), keys, open_ & ~hit


class Requests:
    """Hashes that rows of a task ask the tables for, packed by bucket once about ``WAITING`` of them wait.

    ``kind`` 0 are words and 1 are arcs, each with buckets of its own.
    """

    def __init__(self, part: int, buckets: int) -> None:
        self.part, self.buckets = part, buckets
        self.waiting: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, kind: int, hashes: np.ndarray, rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Rows ask for hashes; equal requests of a row become one with their number."""
        order = np.lexsort([hashes, rows])
        hashes, rows = hashes[order], rows[order]
        head = np.ones(len(hashes), bool)
        head[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
        at = np.flatnonzero(head)
        times = np.diff(np.append(at, len(hashes))).astype(np.int32)
        bucket = bucket_of(hashes[at], self.buckets) + np.int32(kind * self.buckets)
        self.waiting.append((bucket, hashes[at], rows[at].astype(np.int32), times))
        self.size += len(at)
        if self.size >= WAITING:
            yield self.flush()

    def flush(self) -> pa.RecordBatch:
        if not self.waiting:
            self.waiting.append((np.zeros(0, np.int32), np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32)))
        bucket, *columns = (np.concatenate(c) for c in zip(*self.waiting))
        self.waiting, self.size = [], 0
        bucket, values = packed(bucket, columns)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(bucket), self.part, np.int32)), pa.array(bucket), *values],
            ["part", "bucket", "hashes", "rows", "times"])


def _answers(keys: pa.Table, requests: pa.Table, weigh) -> pa.Table:
    """What a bucket's table gives to the rows that ask it, added up per row and packed by part.

    ``weigh`` maps the places of hashes in the sorted table (-1 for none) to the columns that are added up.
    """
    known = keys.column("hash").to_numpy().view(np.uint64)
    order = np.argsort(known)
    known = known[order]
    hashes, sizes = unpacked(requests.column("hashes"), "<u8")
    rows, times = (unpacked(requests.column(c), "<i4")[0] for c in ("rows", "times"))
    part = np.repeat(requests.column("part").to_numpy(), sizes)
    if len(known):
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        place = np.where(known[at] == hashes, order[at], -1)
    else:
        place = np.full(len(hashes), -1)
    # A row of the table with a part and a row in it stands for each that asks.
    owner = part.astype(np.int64) << np.int64(32) | rows
    owners, which = np.unique(owner, return_inverse=True)
    sums = [np.bincount(which, times * v, minlength=len(owners)) for v in weigh(place)]
    parts, values = packed((owners >> 32).astype(np.int32), [(owners & 0xFFFFFFFF).astype(np.int32), *sums])
    return pa.table([pa.array(parts), *values], names=["part", "rows", "known", "base", "more"])


def score(docs: DataFrame, model: Model, stored: Stored, id_column: str = "doc_id",
          text_column: str = "text") -> DataFrame:
    """Per row: id, ``n_tokens``, ``n_known``, ``base_score`` (add-0.1 unigrams) and ``score``."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)
    base_of = model.tokens + ADD * (model.words + 1)
    buckets = max(1, -(-model.tokens // BUCKET_KEYS))
    asks = ["part", "bucket", "hashes", "rows", "times"]
    own = ["id", "n_tokens", "n_known", "base_score", "score"]
    id_type = type_of(docs, id_column)
    schema = (f"part int, bucket int, hashes binary, rows binary, times binary, id {id_type}, n_tokens long, "
              "n_known long, base_score double, score double, row int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        automaton = Automaton(model)
        part = TaskContext.get().partitionId()
        requests, before, kind = Requests(part, buckets), 0, None
        base = np.append(0.0, np.log10((model.head_counts + ADD) / base_of)) if model.tokens else np.zeros(1)

        def asked(batch: pa.RecordBatch) -> pa.RecordBatch:
            none = [pa.nulls(batch.num_rows, t) for t in (kind, pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int32())]
            return pa.RecordBatch.from_arrays([*batch.columns, *none], [*asks, *own, "row"])

        for batch in batches:
            kind = batch.schema.field(0).type
            for block in blocks(batch.column(1), lower=True):
                ids = batch.column(0).slice(block.row, block.documents)
                n = block.documents
                tokens, first = _tokens(block)
                heads = automaton.number(tokens)
                owner = np.repeat(np.arange(n), np.diff(first))
                known = np.bincount(owner, heads > 0, minlength=n)
                base_sum = np.bincount(owner, base[heads], minlength=n)
                weight, keys, other = automaton.weights(tokens, first, heads)
                sums = np.bincount(owner, weight, minlength=n)
                rows = np.arange(before, before + n, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, -1, np.int32)),
                     *[pa.nulls(n, pa.binary())] * 3, ids, pa.array(np.diff(first)), pa.array(known.astype(np.int64)),
                     pa.array(base_sum), pa.array(sums, pa.float64()), pa.array(rows)], [*asks, *own, "row"])
                if model.tokens:
                    rare = heads == 0
                    for batch_of_requests in requests.add(0, tokens[rare], before + owner[rare]):
                        yield asked(batch_of_requests)
                    for batch_of_requests in requests.add(1, keys[other], before + owner[other]):
                        yield asked(batch_of_requests)
                before += n
        if kind is not None:
            yield asked(requests.flush())
        trim()

    # Stored, because the requests go to their tables and back while the rows' own sums wait.
    scored = materialize(docs.select(F.col(id_column).alias("id"), text_column).mapInArrow(run, schema), "scored")
    rows = scored.filter("bucket = -1").select("part", "row", *own)
    if not model.tokens:
        return rows.select(F.col("id").alias(id_column), *own[1:])
    of_words, of_arcs = _word_answers(model, base_of), _arc_answers
    answers = []
    for number, table, answer in ((0, stored.words.select(F.col("word").alias("hash"), "n", "fail"), of_words),
                                  (1, stored.arcs.select(F.col("key").alias("hash"), "gain"), of_arcs)):
        asking = scored.filter((F.col("bucket") >= number * buckets) & (F.col("bucket") < (number + 1) * buckets)).select(*asks)
        dealt = _inbucket_of(table, buckets, number)
        found = dealt.groupBy("bucket").cogroup(asking.groupBy("bucket")).applyInArrow(
            answer, "part int, rows binary, known binary, base binary, more binary")
        answers.append(materialize(found, "answers"))  # frees what it has shuffled before the next table is asked

    def finish(rows: pa.Table, found: pa.Table) -> pa.Table:
        """The rows of a part with all that the tables add to them."""
        if not rows.num_rows:
            return rows.select(own)
        row = rows.column("row").to_numpy()
        at = np.zeros(int(row.max()) + 1, np.int64)
        at[row] = np.arange(len(row))
        which = at[unpacked(found.column("rows"), "<i4")[0]]
        more = [np.bincount(which, unpacked(found.column(c), "<f8")[0], minlength=len(row)) for c in ("known", "base", "more")]
        sums = [rows.column(c).to_numpy() + m for c, m in zip(own[2:], more)]
        return pa.table([rows.column("id"), rows.column("n_tokens"), pa.array(sums[0].astype(np.int64)),
                         pa.array(sums[1]), pa.array(sums[2])], names=own)

    out = rows.groupBy("part").cogroup(answers[0].unionByName(answers[1]).groupBy("part")).applyInArrow(
        finish, f"id {id_type}, n_tokens long, n_known long, base_score double, score double")
    return out.select(F.col("id").alias(id_column), *own[1:])


def _inbucket_of(table: DataFrame, buckets: int, number: int) -> DataFrame:
    """A table's rows with the bucket of their hash, numbered like the requests of that kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket = bucket_of(batch.column(0).to_numpy().view(np.uint64), buckets) + np.int32(number * buckets)
            yield pa.RecordBatch.from_arrays([pa.array(bucket), *batch.columns], ["bucket", *batch.schema.names])

    names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema)
    return table.mapInArrow(run, f"bucket int, {names}")


def _word_answers(model: Model, base_of: float):
    tokens, discount, unknown = model.tokens, model.discount, model.unknown

    def answer(words: pa.Table, requests: pa.Table) -> pa.Table:
        n = np.append(words.column("n").to_numpy(), 0)  # place -1: a word that was not seen
        with np.errstate(divide="ignore", invalid="ignore"):
            root = np.where(n > 0, np.log10((n - discount) / tokens) + np.append(words.column("fail").to_numpy(), 0.0), unknown)
        base = np.log10((n + ADD) / base_of)
        return _answers(words, requests, lambda place: ((n[place] > 0).astype(float), base[place], root[place]))

    return answer


def _arc_answers(arcs: pa.Table, requests: pa.Table) -> pa.Table:
    gain = np.append(arcs.column("gain").to_numpy(), 0.0)
    return _answers(arcs, requests, lambda place: (np.zeros(len(place)), np.zeros(len(place)), gain[place]))
