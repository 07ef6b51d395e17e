"""Phrase collocations by counting Apriori-safe candidates with double-array tries.

A text falls into pieces, and those into words. A word in a language is a symbol, a 64-bit hash. Everything is counted
per language.

1. One pass counts words. A bit table of fixed size (``Filter``) of those that occur ``least`` times goes to all tasks.
2. One pass counts neighbouring pairs of such words, packed by bucket. Those with ``least`` occurrences are the
   candidates of two words, and a second bit table holds them.
3. One pass keeps of each text the runs of words whose neighbours all are such pairs, as codes into an alphabet per
   block. All that follows reads these runs, not the texts.
4. Triples in runs are counted like pairs, and give the candidates of three words. A longer candidate joins two phrases
   that overlap in all but a word each (Apriori: no phrase is more frequent than its parts).
5. Candidates are dealt into tries of about ``TRIE`` phrases, each built into a double array by one task and broadcast
   by itself (``DoubleArray``). A task advances all positions of a block at once, level by level, counts the accepting
   states that it meets, and sends its counts in slices, which are added up over lots of tasks and then over the lots.
   Candidates of two to four words are counted together, longer ones once the shorter are known.

A false hit of a bit table only adds candidates; the tries count whole symbols. The number of passes over the runs is
the number of tries, which follows the number of frequent phrases. Hot words and pairs are combined in each task, over
``WAITING`` rows at a time, before they move.

Scores are exact: products are decimals of 38 digits, enough for tables of 10^17 words.

Edge values: null and empty texts have no words; a null language is ``und``. Repeated rows count each time. Ids are not
looked at, and other columns are dropped, whatever their names. Very long texts are blocks of their own, and very long
words are words. An empty table, or one without frequent phrases, gives no rows. Ties of all sort keys cannot be: the
last is the phrase.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import first_rows
from ..session import discard, materialize
from .common import trim
from .counting import WAITING, Combiner, Filter, count_keys, unpacked
from .wordhash import Block, blocks, mix, word_hashes

TRIE = 1 << 18
FILTER_BITS = 26
SEARCHED = 33
SLICE = 1 << 12  # phrases whose counts travel together
LOTS = 256
NO_LANGUAGE = "und"

#: Bytes that end a piece, and those that separate words.
BREAKS = np.zeros(256, bool)
BREAKS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
SEPARATORS = BREAKS.copy()
SEPARATORS[[0x20, 0x09]] = True

_ODD = np.uint64(0x9E3779B97F4A7C15)


# --- words ---------------------------------------------------------------------------------


def _symbols(block: Block, languages: list[str]) -> np.ndarray:
    """A 64-bit number per word, for the word in the language of its document."""
    from xxhash import xxh64_intdigest

    of = {name: xxh64_intdigest(name) for name in set(languages)}
    seeds = np.array([of[name] for name in languages], np.uint64)
    return mix(word_hashes(block) + np.repeat(seeds, np.diff(block.first)) * _ODD)


def _joined(block: Block) -> np.ndarray:
    """Whether a word continues the piece of the word before it."""
    breaks = np.concatenate([[0], np.cumsum(BREAKS[block.data], dtype=np.int64)])
    out = np.zeros(len(block.starts), bool)
    out[1:] = breaks[block.starts[1:]] == breaks[block.ends[:-1]]
    begins = block.first[:-1]
    out[begins[begins < len(out)]] = False
    return out


def _languages(batch: pa.RecordBatch, block: Block) -> list[str]:
    return batch.column(1).slice(block.row, block.documents).fill_null(NO_LANGUAGE).to_pylist()


def _texts_of(block: Block, at: np.ndarray) -> pa.Array:
    """The bytes of some of a block's words, as texts."""
    lengths = (block.ends - block.starts)[at]
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    inner = np.arange(offsets[-1]) - np.repeat(offsets[:-1], lengths)
    data = block.data[inner + np.repeat(block.starts[at], lengths)]
    return pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data.tobytes()))


def count_words(texts: DataFrame) -> DataFrame:
    """``symbol``, ``lang``, ``word`` and ``n`` of all words of a frame of ``text`` and ``lang``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = Combiner(["symbol", "lang", "word", "n"])
        for batch in batches:
            for block in blocks(batch.column(0), SEPARATORS, lower=True):
                languages = _languages(batch, block)
                found, at, counts = np.unique(_symbols(block, languages), return_index=True, return_counts=True)
                owner = np.searchsorted(block.first, at, side="right") - 1
                names = pa.array(languages, pa.string()).take(pa.array(owner))
                yield from waiting.add(found, counts, [found.view(np.int64), names, _texts_of(block, at)])
        yield from waiting.flush()
        trim()

    return texts.mapInArrow(run, "symbol long, lang string, word string, n long").groupBy("symbol", "lang", "word").agg(
        F.sum("n").alias("n"))


# --- pairs and runs ------------------------------------------------------------------------


def _key(*symbols: np.ndarray) -> np.ndarray:
    key = symbols[0]
    for symbol in symbols[1:]:
        key = mix(key * _ODD + symbol)
    return key


def _key_column(words: list[str]):
    """``_key`` is for tasks; candidates carry it so that a filter can be made of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = _key(*(c.to_numpy().view(np.uint64) for c in batch.columns))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64))], ["key"])

    return lambda frame: frame.select(*words).mapInArrow(run, "key long")


def count_pairs(texts: DataFrame, frequent: Filter, least: int, total: int) -> DataFrame:
    """``w0``, ``w1`` and ``n`` of neighbouring words that are both frequent and occur together ``least`` times."""
    sent = texts.sparkSession.sparkContext.broadcast(frequent.bits)

    def tell():
        known = Filter(sent.value)

        def pairs(batch: pa.RecordBatch) -> Iterator[list[np.ndarray]]:
            for block in blocks(batch.column(0), SEPARATORS, lower=True):
                symbols = _symbols(block, _languages(batch, block))
                good = known.has(symbols)
                at = np.flatnonzero(_joined(block)[1:] & good[1:] & good[:-1])
                yield [symbols[at], symbols[at + 1]]

        return pairs

    return count_keys(texts, tell, _key, ("w0", "w1"), least, total)


def frequent_runs(texts: DataFrame, pairs: Filter) -> DataFrame:
    """Per block ``alphabet`` (symbols), ``codes`` and ``joined`` of the words in runs of frequent pairs."""
    sent = texts.sparkSession.sparkContext.broadcast(pairs.bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Filter(sent.value)
        for batch in batches:
            for block in blocks(batch.column(0), SEPARATORS, lower=True):
                symbols = _symbols(block, _languages(batch, block))
                joined = _joined(block)
                at = np.flatnonzero(joined)
                joined[at] = known.has(_key(symbols[at - 1], symbols[at]))
                keep = joined.copy()
                keep[:-1] |= joined[1:]
                if keep.any():
                    alphabet, codes = np.unique(symbols[keep], return_inverse=True)
                    codes = codes.astype("<u2" if len(alphabet) <= 1 << 16 else "<u4")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x.tobytes()], pa.binary()) for x in (alphabet, codes, np.packbits(joined[keep]))],
                        ["alphabet", "codes", "joined"])
        trim()

    return texts.mapInArrow(run, "alphabet binary, codes binary, joined binary")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for alphabet, codes, joined in zip(*batch.columns):
            alphabet = np.frombuffer(alphabet.as_buffer(), np.uint64)
            codes = np.frombuffer(codes.as_buffer(), "<u2" if len(alphabet) <= 1 << 16 else "<u4")
            yield alphabet, codes, np.unpackbits(np.frombuffer(joined.as_buffer(), np.uint8), count=len(codes)).astype(bool)


def count_triples(runs: DataFrame, least: int, total: int) -> DataFrame:
    """``w0``, ``w1``, ``w2`` and ``n`` of three neighbouring words of a run that occur ``least`` times."""

    def tell():
        def triples(batch: pa.RecordBatch) -> Iterator[list[np.ndarray]]:
            for alphabet, codes, joined in _runs([batch]):
                at = np.flatnonzero(joined[2:] & joined[1:-1])
                yield [alphabet[codes[at + k]] for k in range(3)]

        return triples

    return count_keys(runs, tell, _key, ("w0", "w1", "w2"), least, total)


# --- tries ---------------------------------------------------------------------------------


@dataclass
class DoubleArray:
    """A trie of phrases: the child of state s by the code c is base[s] + c, if its check is s. State 0 is the root."""

    alphabet: np.ndarray  # sorted symbols
    code: np.ndarray  # of each symbol, from 1 for the commonest, so that children lie close
    base: np.ndarray
    check: np.ndarray
    accept: np.ndarray  # a phrase's number in its state, else -1
    phrases: np.ndarray  # codes, filled up with 0

    @classmethod
    def build(cls, symbols: np.ndarray, lengths: np.ndarray) -> DoubleArray:
        """Of distinct phrases: their symbols one after another, and how many each has."""
        alphabet, which, counts = np.unique(symbols, return_inverse=True, return_counts=True)
        code = np.empty(len(alphabet), np.int32)
        code[np.argsort(-counts, kind="stable")] = np.arange(1, len(alphabet) + 1)
        table = np.zeros((len(lengths), int(lengths.max())), np.int32)
        table[np.arange(table.shape[1]) < lengths[:, None]] = code[which]
        table = table[np.lexsort(table.T[::-1])]
        # Nodes, numbered level by level from the root 0: in sorted rows a new prefix is a new node.
        node = np.zeros(len(table), np.int64)
        fresh = np.zeros(len(table), bool)
        fresh[0] = True
        parents, steps, total = [], [], 1
        for level in table.T:
            fresh[1:] |= level[1:] != level[:-1]
            new = fresh & (level > 0)
            parents.append(node[new])
            steps.append(level[new])
            node = np.where(level > 0, total - 1 + np.cumsum(new), node)
            total += int(new.sum())
        parent = np.concatenate(parents)
        base, slot = _place(parent, np.concatenate(steps).astype(np.int64), total)
        size = int(slot.max()) + 1
        at = {k: np.full(size, v, np.int32) for k, v in (("base", 0), ("check", -1), ("accept", -1))}
        at["base"][slot] = base
        at["check"][slot[1:]] = slot[parent]
        at["accept"][slot[node]] = np.arange(len(table))  # the last node of each row
        return cls(alphabet, code, at["base"], at["check"], at["accept"], table)

    def codes(self, symbols: np.ndarray) -> np.ndarray:
        """Codes of symbols, 0 for those in no phrase."""
        at = np.minimum(np.searchsorted(self.alphabet, symbols), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == symbols, self.code[at], 0)

    def symbols(self, codes: np.ndarray) -> np.ndarray:
        """The symbols of codes from 1."""
        of_code = np.empty(len(self.alphabet), np.uint64)
        of_code[self.code - 1] = self.alphabet
        return of_code[codes - 1]

    def accepted(self, codes: np.ndarray, joined: np.ndarray) -> Iterator[np.ndarray]:
        """Numbers of the phrases that occur, level by level; all positions advance at once."""
        at = np.flatnonzero(codes)
        state = np.zeros(len(at), np.int64)
        for level in range(self.phrases.shape[1]):
            if level:
                inside = at + level < len(codes)
                at, state = at[inside], state[inside]
                inside = joined[at + level]
                at, state = at[inside], state[inside]
            step = self.base[state] + codes[at + level]
            inside = (step >= 0) & (step < len(self.check))
            inside &= self.check[np.where(inside, step, 0)] == state
            at, state = at[inside], step[inside]
            found = self.accept[state]
            yield found[found >= 0]

    def pack(self) -> list[bytes]:
        return [x.tobytes() for x in (self.alphabet, self.code, self.base, self.check, self.accept, self.phrases)]

    @classmethod
    def unpack(cls, alphabet: bytes, *rest: bytes | int) -> DoubleArray:
        *packed, width = rest
        *arrays, phrases = (np.frombuffer(x, np.int32) for x in packed)
        return cls(np.frombuffer(alphabet, np.uint64), *arrays, phrases.reshape(-1, width))


def _place(parent: np.ndarray, code: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Base and slot of every node. ``parent`` and ``code`` are those of the nodes 1, 2, ...

    Nodes with several children take a place where all of them fit, the largest first. The search looks at
    ``SEARCHED`` places from where free slots begin to the end of what is used; towards the end few slots are, so the
    array grows by little. Only children fill the gaps, all at once.
    """
    order = np.lexsort([code, parent])
    owner, kids = parent[order], order + 1
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(first, len(owner)))
    base, slot = np.zeros(total, np.int64), np.zeros(total, np.int64)
    used = np.zeros(total + int(code.max(initial=0)) + 1024, bool)
    used[0] = True
    low = top = 1
    for k in np.argsort(-sizes, kind="stable"):
        if sizes[k] == 1:
            break
        mine = kids[first[k]:first[k] + sizes[k]]
        apart = code[mine - 1] - code[mine[0] - 1]
        while used[low:low + 256].all():
            low += 256
        place = -1
        for start in np.linspace(low, top, SEARCHED, dtype=np.int64).tolist():
            if len(used) <= start + 512 + apart[-1]:
                used = np.concatenate([used, np.zeros(len(used) // 2 + int(apart[-1]) + 512, bool)])
            free = np.flatnonzero(~used[start:start + 256]) + start
            fits = ~used[free[:, None] + apart].any(1)
            if fits.any():
                place = int(free[fits.argmax()])
                break  # from ``top`` on everything is free
        used[place + apart] = True
        top = max(top, place + int(apart[-1]) + 1)
        slot[mine] = place + apart
        base[owner[first[k]]] = place - code[mine[0] - 1]
    single = first[sizes == 1]
    free = np.flatnonzero(~used)[:len(single)]
    if len(free) < len(single):
        free = np.concatenate([free, len(used) + np.arange(len(single) - len(free))])
    slot[kids[single]] = free
    base[owner[single]] = free - code[kids[single] - 1]
    return base, slot


def count_phrases(runs: DataFrame, candidates: DataFrame, name: str) -> DataFrame:
    """``words`` and ``n`` of the candidates (``words``, arrays of symbols) that occur in the stored runs."""
    spark = runs.sparkSession
    candidates = materialize(candidates.select("words"), f"{name}-candidates")
    width, total = candidates.agg(F.max(F.size("words")), F.count(F.lit(1))).first()
    shards = math.ceil(total / TRIE)

    def build(table: pa.Table) -> pa.Table:
        words = table.column("words").combine_chunks()
        trie = DoubleArray.build(words.flatten().to_numpy().view(np.uint64), words.value_lengths().to_numpy())
        packed = [*trie.pack(), trie.phrases.shape[1]]
        return pa.table({"shard": table.column("shard").slice(0, 1)} | {
            f"t{k}": pa.array([x]) for k, x in enumerate(packed)})

    schema = "shard int, t0 binary, t1 binary, t2 binary, t3 binary, t4 binary, t5 binary, t6 long"
    dealt = candidates.withColumn("shard", F.pmod(F.xxhash64("words"), F.lit(max(shards, 1))).cast("int"))
    tries = materialize(dealt.groupBy("shard").applyInArrow(build, schema), f"{name}-tries")
    counts = []
    for shard in range(shards):
        rows = tries.filter(F.col("shard") == shard).drop("shard").collect()  # one trie of about TRIE phrases
        for row in rows:
            counts.append(materialize(_counted(runs, DoubleArray.unpack(*row)), f"{name}-counts"))
    if not counts:
        return candidates.select("words", F.lit(0).cast("long").alias("n"))
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out


def _counted(runs: DataFrame, trie: DoubleArray) -> DataFrame:
    """``words`` and ``n`` of a trie's phrases. Tasks send slices of their counts, which are added up in two rounds."""
    sent = runs.sparkSession.sparkContext.broadcast(trie)
    schema = "slice int, lot int, counts binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = sent.value
        counts = np.zeros(len(trie.phrases), np.int64)
        waiting: list[np.ndarray] = []
        for alphabet, codes, joined in _runs(batches):
            waiting += trie.accepted(trie.codes(alphabet)[codes], joined)
            if sum(map(len, waiting)) > WAITING:
                counts += np.bincount(np.concatenate(waiting), minlength=len(counts))
                waiting = []
        if waiting:
            counts += np.bincount(np.concatenate(waiting), minlength=len(counts))
        lot = TaskContext.get().partitionId() % LOTS
        slices = [(k, counts[k * SLICE:(k + 1) * SLICE]) for k in range(-(-len(counts) // SLICE))]
        slices = [(k, part.tobytes()) for k, part in slices if part.any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in slices], pa.int32()), pa.array([lot] * len(slices), pa.int32()),
             pa.array([part for _, part in slices], pa.binary())], ["slice", "lot", "counts"])
        trim()

    def total(table: pa.Table) -> np.ndarray:
        counts, sizes = unpacked(table.column("counts"), "<i8")
        return counts.reshape(len(sizes), -1).sum(0)

    def add(table: pa.Table) -> pa.Table:
        return pa.table({"slice": table.column("slice").slice(0, 1), "lot": table.column("lot").slice(0, 1),
                         "counts": pa.array([total(table).tobytes()], pa.binary())})

    def spell(table: pa.Table) -> pa.Table:
        counts = total(table)
        met = np.flatnonzero(counts)
        codes = sent.value.phrases[table.column("slice")[0].as_py() * SLICE + met]
        offsets = np.concatenate([[0], np.cumsum((codes > 0).sum(1))]).astype(np.int32)
        words = sent.value.symbols(codes[codes > 0]).view(np.int64)
        return pa.table({"words": pa.ListArray.from_arrays(pa.array(offsets), pa.array(words)), "n": pa.array(counts[met])})

    added = runs.mapInArrow(run, schema).groupBy("slice", "lot").applyInArrow(add, schema)
    return added.groupBy("slice").applyInArrow(spell, "words array<long>, n long")


def _extended(phrases: DataFrame, size: int) -> DataFrame:
    """Apriori: candidates of ``size`` words from stored phrases of one less, whose last words are another's first."""
    some = phrases.filter(F.size("words") == size - 1).select("words")
    left = some.select(F.col("words").alias("head"), F.slice("words", 2, size - 2).alias("shared"))
    right = some.select(F.element_at("words", -1).alias("last"), F.slice("words", 1, size - 2).alias("shared"))
    return left.join(right, "shared").select(F.concat("head", F.array("last")).alias("words"))


def frequent_phrases(texts: DataFrame, words: DataFrame, least: int, longest: int, total: int) -> DataFrame:
    """``words`` (symbols) and ``a`` of all phrases of 2 to ``longest`` words that occur ``least`` times.

    ``words`` are the stored frequent words, and ``total`` is the number of all word occurrences.
    """
    enough = F.col("n") >= least
    known = Filter.of(words.select("symbol"), FILTER_BITS)
    pairs = materialize(count_pairs(texts, known, least, total), "frequent-pairs")
    runs = materialize(frequent_runs(texts, Filter.of(_key_column(["w0", "w1"])(pairs), FILTER_BITS)), "frequent-runs")
    candidates = pairs.select(F.array("w0", "w1").alias("words"))
    if longest > 2:
        triples = materialize(count_triples(runs, least, total).select(F.array("w0", "w1", "w2").alias("words")),
                              "frequent-triples")
        candidates = candidates.unionByName(triples)
        if longest > 3:
            candidates = candidates.unionByName(_extended(triples, 4))
    found = materialize(count_phrases(runs, candidates, "phrases").filter(enough), "frequent-phrases")
    for size in range(5, longest + 1):
        more = count_phrases(runs, _extended(found, size), "phrases").filter(enough)
        found = materialize(found.unionByName(more), "frequent-phrases")
    return found.withColumnRenamed("n", "a")


# --- scores --------------------------------------------------------------------------------


def _exact(name: str) -> str:
    return f"cast({name} as decimal(18, 0))"


def mine(docs: DataFrame, least: int = 100, longest: int = 5, first: int = 2000, contained: int = 100,
         text_column: str = "text", language_column: str = "lang") -> DataFrame:
    """The ``first`` phrases per language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score``.

    ``contained`` is the percentage of a phrase's occurrences from which on a longer phrase takes its place.
    """
    texts = docs.select(F.col(text_column).alias("text"), F.col(language_column).alias("lang"))
    counted = materialize(count_words(texts), "word-counts")
    totals = materialize(counted.groupBy("lang").agg(F.sum("n").alias("n")), "word-totals")
    total = totals.agg(F.sum("n")).first()[0] or 0
    words = materialize(counted.filter(F.col("n") >= least), "frequent-words")
    discard(counted)
    phrases = frequent_phrases(texts, words, least, longest, total)
    known = materialize(phrases.unionByName(words.select(F.array("symbol").alias("words"), F.col("n").alias("a"))),
                        "known-phrases")
    # A longer phrase that holds one has parts of one word more that are no rarer, so those tell.
    longer = phrases.filter(F.size("words") > 2).select(
        F.explode(F.array(F.expr("slice(words, 1, size(words) - 1)"), F.expr("slice(words, 2, size(words) - 1)"))).alias(
            "words"), F.col("a").alias("more")).groupBy("words").agg(F.max("more").alias("more"))
    kept = phrases.join(longer, "words", "left").filter(
        F.col("more").isNull() | (100 * F.col("more") < contained * F.col("a"))).drop("more")
    language = words.select(F.col("symbol").alias("head"), "lang").join(totals, "lang")
    kept = kept.withColumn("head", F.element_at("words", 1)).join(language, "head").drop("head")
    cuts = kept.withColumn("k", F.explode(F.expr("sequence(1, size(words) - 1)"))).withColumns({
        "left": F.expr("slice(words, 1, k)"), "right": F.expr("slice(words, k + 1, size(words) - k)")})
    judged = (cuts.join(known.select(F.col("words").alias("left"), F.col("a").alias("l")), "left")
              .join(known.select(F.col("words").alias("right"), F.col("a").alias("r")), "right")
              .withColumn("score", F.expr(f"(1000 * {_exact('a')} * {_exact('n')}) div ({_exact('l')} * {_exact('r')})")))
    best = judged.groupBy("words", "lang", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    spelled = (best.select("words", F.posexplode("words").alias("place", "symbol"))
               .join(words.select("symbol", "word"), "symbol").groupBy("words")
               .agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("spelled"))  # ``longest`` at most
               .select("words", F.array_join(F.col("spelled.word"), " ").alias("phrase")))
    rows = best.join(spelled, "words").select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    ranked = first_rows(rows, first, [F.desc("score"), F.desc("a"), F.asc("phrase")], ["lang"])
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
