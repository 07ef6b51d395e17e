"""Toxicity by a weighted finite-state grammar of clauses.

Texts are cut into clauses, and each word of a clause becomes a class: insult, hint (a weak one), threat, target, negation,
report or other. A cascade of transducers rewrites the classes: negation turns an insult or threat within three words into one
that is denied; a threat and a target within three words become a menace; reported speech turns insults and menaces into
quoted ones up to the end of the clause; after a target an insult is aimed and a hint is an insult; and the last one keeps the
strongest of what a clause holds. The cascade is composed into one machine. A clause counts only if the machine ends in
an accepting state, as a denied or quoted insult, a hint, a bare or an aimed insult, or a menace. An insult alone decides nothing: the same word weighs
what its clause weighs.

A document's features are the numbers of its clauses of each kind, and a logistic model over their logarithms, learned
from the labels, turns them into a score. A kind that the labels do not show keeps about its ``PRIOR``.

The lexicon of insults is learned: words, and stems (first letters that several words share), which occur in toxic
documents and nearly never in others, do so in both halves of the sample, and so often that no such term is to be expected
by chance among all the words there are. Threats, targets, negations and reports
are small closed lists. Learning uses at most ``SAMPLE_ROWS`` labelled rows per class, which bounds the lexicon's
counts; every document is scored whole, where it is read, without a shuffle.

Edge values: a null or empty text has no clause. Rows without an id are scored but not learned from. Of
labels with the same id the greatest counts, and null ones are ignored. Rows of the documents that share an id are each
learned from. Without labels of both classes the score is 0 (no toxic label) or 1 (only toxic ones). An empty table
gives an empty one. Very long texts are scored whole. Other columns are dropped, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import sampling
from ..session import discard, materialize
from .common import type_of
from .wordhash import slices

SAMPLE_ROWS = 10_000  # per class
LEXICON_ROWS = 20_000  # more than terms that MIN_DOCUMENTS of the sample's toxic documents can hold for certain
MIN_DOCUMENTS = 5
MIN_IN_HALF = 2
STRONG = 5.5  # from this weight on a term is an insult, below it is a hint
MIN_WEIGHT = 4.0  # log of how much likelier a term is in toxic documents
STEM_LENGTHS = (4, 5, 6)
STEM_WORDS = 3

# Classes of words, and what the cascade makes of them.
OTHER, INSULT, HINT, THREAT, TARGET, NEGATION, REPORT = range(7)
DENIED, QUOTED, AIMED, MENACE = range(7, 11)
_SEEDS = {
    THREAT: "kill hurt destroy crush burn beat punish töten schlagen vernichten matar golpear tuer frapper",
    TARGET: "you your yours he she they him her them du ihr euch dich sie er tu vous il elle ils usted ustedes tú él ella",
    NEGATION: "not no never nobody nicht kein keine nie ne pas jamais nunca jamás",
    REPORT: "said says called wrote quoted claimed sagte schrieb nannte dijo escribió llamó dit écrit appelé",
}
#: Kinds of clauses, by the machine's accepting states, and what a clause of each is thought to weigh at first.
KINDS = ("denied", "quoted", "hint", "bare", "aimed", "menace")
PRIOR = np.array([0.5, 1.0, 1.5, 3.0, 4.0, 4.0])
PRIOR_BASE = -3.0
CLASS_OF = {word: kind for kind, words in _SEEDS.items() for word in words.split()}
_CLAUSE = re.compile(r"[.!?;:\n]+")
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


# --- the grammar ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Transducer:
    """State 0 starts. ``step`` maps (state, class) to (state, class); what it lacks is taken as ``OTHER``, unchanged."""

    step: dict[tuple[int, int], tuple[int, int]]

    def take(self, state: int, kind: int) -> tuple[int, int]:
        found = self.step.get((state, kind))
        return found or (self.step.get((state, OTHER), (state, OTHER))[0], kind)


def _counting(restart: int, reach: int = 3) -> dict[tuple[int, int], tuple[int, int]]:
    """States that count down the words since the last ``restart``."""
    return {**{(s, OTHER): (s - 1, OTHER) for s in range(1, reach + 1)},
            **{(s, restart): (reach, restart) for s in range(reach + 1)}}


NEGATING = Transducer({**_counting(NEGATION), **{(s, kind): (0, DENIED) for s in (1, 2, 3) for kind in (INSULT, HINT)},
                       **{(s, THREAT): (0, OTHER) for s in (1, 2, 3)}})
THREATENING = Transducer({**_counting(THREAT), **{(s, TARGET): (0, MENACE) for s in (1, 2, 3)}})
REPORTING = Transducer({(0, REPORT): (1, REPORT), (1, REPORT): (1, REPORT),
                        **{(1, kind): (1, QUOTED) for kind in (INSULT, HINT, MENACE)}})
#: After a target an insult is aimed, and a hint is an insult.
AIMING = Transducer({**_counting(TARGET, 5), **{(s, INSULT): (s - 1, AIMED) for s in range(1, 6)},
                     **{(s, HINT): (s - 1, INSULT) for s in range(1, 6)}})
#: The state is the strongest kind so far, as its place in ``KINDS`` from 1; a target right after an insult aims it.
_RANK = {DENIED: 1, QUOTED: 2, HINT: 3, INSULT: 4, AIMED: 5, MENACE: 6}
_FRESH = 7  # a bare insult was the last word
KEEPING = Transducer({
    **{(s, kind): (max(4 if s == _FRESH else s, rank), kind) for s in range(_FRESH + 1) for kind, rank in _RANK.items()},
    **{(s, INSULT): (_FRESH, INSULT) for s in (0, 1, 2, 3, 4, _FRESH)},
    (_FRESH, OTHER): (4, OTHER), (_FRESH, TARGET): (5, TARGET)})
ACCEPTING = {**{s: s - 1 for s in range(1, 7)}, _FRESH: 3}


def compose(*parts: Transducer) -> tuple[dict[tuple[int, int], int], dict[int, int]]:
    """One machine for the cascade: its steps over classes of words, and the kind of each accepting state."""
    start = (0,) * len(parts)
    number, todo, step = {start: 0}, [start], {}
    while todo:
        states = todo.pop()
        for kind in range(REPORT + 1):
            symbol, to = kind, []
            for part, state in zip(parts, states):
                state, symbol = part.take(state, symbol)
                to.append(state)
            if tuple(to) not in number:
                number[tuple(to)] = len(number)
                todo.append(tuple(to))
            step[number[states], kind] = number[tuple(to)]
    return step, {n: ACCEPTING[states[-1]] for states, n in number.items() if states[-1] in ACCEPTING}


STEP, ACCEPTED = compose(NEGATING, THREATENING, REPORTING, AIMING, KEEPING)


@dataclass
class Lexicon:
    words: dict[str, float]
    stems: dict[str, float]
    known: dict[str, float] = field(default_factory=dict)

    def weight(self, word: str) -> float:
        """An insult's weight, 0 for other words; remembered for up to 200,000 words."""
        found = self.known.get(word)
        if found is None:
            found = max([self.words.get(word, 0.0), *[self.stems.get(word[:n], 0.0) for n in STEM_LENGTHS]])
            if len(self.known) >= 200_000:
                self.known.clear()
            self.known[word] = found
        return found


def clause_kind(classes: list[int]) -> int | None:
    """The place in ``KINDS`` of a clause, None where the grammar does not match it."""
    state = 0
    for kind in classes:
        state = STEP[state, kind]
    return ACCEPTED.get(state)


def matched(text: str | None, lexicon: Lexicon) -> np.ndarray:
    """How many clauses of a text are of each kind."""
    found = np.zeros(len(KINDS), np.int64)
    words = set(words_of(text)) if text else ()
    marked = {w: INSULT if x >= STRONG else HINT for w in words if (x := lexicon.weight(w))}
    marked |= {w: THREAT for w in words if CLASS_OF.get(w) == THREAT}
    if marked:
        for clause in _CLAUSE.split(text):
            clause = words_of(clause)
            if not marked.keys().isdisjoint(clause):
                kind = clause_kind([marked.get(w) or CLASS_OF.get(w, OTHER) for w in clause])
                if kind is not None:
                    found[kind] += 1
    return found


# --- learning ------------------------------------------------------------------------------


def labelled_sample(docs: DataFrame, labels: DataFrame, learn: F.Column, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``text``, ``toxic`` and ``half`` of at most ``rows`` learning documents per class, chosen by a hash of the id.

    Stored, because it is read several times.
    """
    one = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter(
        F.col("toxic").isin(0, 1) & learn).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = sampling.per_class_sample(one, "doc_id", "toxic", rows)
    # At most two short rows per unit of ``rows``.
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int")
    return materialize(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(
        "text", "toxic", half.alias("half")), "toxic-sample")


def _word_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with each word: clean ones, and toxic ones of either half; one row per word and part."""
    for batch in batches:
        for part in slices(batch, 0):
            found: dict[str, list[int]] = {}
            for text, toxic, half in zip(*(c.to_pylist() for c in part.columns)):
                for word in set(words_of(text or "")):
                    found.setdefault(word, [0, 0, 0])[toxic and 1 + half] += 1
            counts = np.array(list(found.values()), np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), *[pa.array(c) for c in counts.T]], ["word", "clean", "toxic_0", "toxic_1"])


def learn_lexicon(sample: DataFrame, clean: int, toxic: int) -> Lexicon:
    """Words and stems that mark toxic documents, at most ``LEXICON_ROWS`` of each."""
    counts = ("clean", "toxic_0", "toxic_1")
    words = materialize(sample.select("text", "toxic", "half").mapInArrow(
        _word_documents, "word string, clean long, toxic_0 long, toxic_1 long").groupBy("word").agg(
        *[F.sum(c).alias(c) for c in counts]), "toxic-words")
    both = F.col("toxic_0") + F.col("toxic_1")
    weight = F.log((both + 0.5) / (toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (clean + 1.0))
    # What one half shows by chance the other does not.
    marked = (weight >= MIN_WEIGHT) & (both >= MIN_DOCUMENTS) & (F.least("toxic_0", "toxic_1") >= MIN_IN_HALF)
    # Chernoff: how unlikely it is that so many of a term's documents are toxic by chance, as minus a logarithm.
    share, usual, total = both / (both + F.col("clean")), toxic / (toxic + clean), both + F.col("clean")
    rest = F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - usual))).otherwise(0.0)
    surprise = total * (share * F.log(share / usual) + rest)
    stems = (words.select(F.explode(F.array(*[F.substring("word", 1, n) for n in STEM_LENGTHS])).alias("term"),
                          "word", *counts)
             .filter(F.char_length("term") < F.char_length("word")).groupBy("term")
             .agg(*[F.sum(c).alias(c) for c in counts], F.count_if(both > 0).alias("n_words"))
             .filter(F.col("n_words") >= STEM_WORDS))
    out = []
    for terms in (words.withColumnRenamed("word", "term"), stems):
        # So unlikely that less than one such term is expected among all that could be taken.
        least = math.log(max(1, terms.filter(both > 0).count()))
        rows = (terms.filter(marked & (surprise >= least)).withColumn("weight", weight)
                .orderBy(F.desc(F.col("weight") * both), "term").limit(LEXICON_ROWS).select("term", "weight").collect())
        out.append({r["term"]: r["weight"] for r in rows})
    discard(words)
    return Lexicon(*out)


def fit_weights(rows: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of the kinds and the base of a logistic model, drawn to ``PRIOR``, by Newton's method."""
    x = np.column_stack([np.log1p(rows), np.ones(len(rows))])
    prior, hold = np.append(PRIOR, PRIOR_BASE), np.append(np.ones(len(KINDS)), 0.01)
    w = prior.copy()
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (toxic - p)) - hold * (w - prior)
        move = np.linalg.solve((x.T * (weight * p * (1 - p))) @ x + np.diag(hold), gradient)
        w = w + np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-9:
            break
    return w


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray  # of the kinds, and the base

    def score(self, text: str | None) -> float:
        x = np.log1p(matched(text, self.lexicon)) @ self.weights[:-1] + self.weights[-1]
        return float(1 / (1 + np.exp(-np.clip(x, -30, 30))))


def fit(docs: DataFrame, labels: DataFrame, learn: F.Column) -> Model:
    """Learn lexicon and weights from labels of the documents where ``learn`` (over ``doc_id``) holds."""
    sample = labelled_sample(docs, labels, learn)
    counts = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    clean, toxic = counts.get(0, 0), counts.get(1, 0)
    if not clean or not toxic:
        return Model(Lexicon({}, {}), np.append(np.zeros(len(KINDS)), 30.0 if toxic else -30.0))
    lexicon = learn_lexicon(sample, clean, toxic)
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                found = np.array([matched(t, sent.value) for t in part.column(0).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(1), *[pa.array(c) for c in found.T]], ["toxic", *KINDS])

    # At most two rows per unit of SAMPLE_ROWS, as many as there are different ones.
    rows = sample.select("text", "toxic").mapInArrow(features, "toxic int, " + ", ".join(f"{k} long" for k in KINDS)).groupBy(
        "toxic", *KINDS).count().toPandas()
    discard(sample)
    label = rows["toxic"].to_numpy(float)
    # The classes weigh the same, so that rare labels are not lost.
    weight = rows["count"].to_numpy(float) * np.where(label > 0, 1 / toxic, 1 / clean) * (clean + toxic) / 2
    return Model(lexicon, fit_weights(rows[list(KINDS)].to_numpy(float), label, weight))


def score(docs: DataFrame, model: Model, id_column: str = "doc_id") -> DataFrame:
    """The id column and ``score``, 0 to 1."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # at most 2 * LEXICON_ROWS terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            for part in slices(batch, 1):
                scores = [model.score(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores, pa.float64())], [id_column, "score"])

    return docs.select(id_column, "text").mapInArrow(
        run, f"`{id_column}` {type_of(docs, id_column)}, score double")
