"""Language identification by nearest centroid.

A text's vector holds 1 + log counts of hashed byte trigrams of its lower-cased letters, weighted by inverse
document frequency and normalised. Each language has up to ``CENTROIDS`` centroids, found by spherical k-means
over a bounded sample of its documents (a language of a few documents, or of equal ones, has fewer), and a text belongs to the language of the centroid with the greatest
cosine. It is rejected if it has no letter, or is far from every centroid. Short texts lie farther off than long ones, so
the limit depends on the size, the number of different trigrams: each sampled document is also cut to 1, 2, 4, 8, ...
bytes, and for each octave of sizes a language knows the cosine that all but ``TRIMMED`` of its pieces reach. A text under
``REJECT`` times that of its own size is rejected.

Document frequencies cover all learning documents; ``SAMPLE_ROWS`` per language bounds only what is clustered.
Scoring runs where a document is read, without a shuffle.

Edge values: a null text, or one without a letter, is ``und`` with score 0 and rejected; so is every text if
nothing could be learned. Rows without an id are predicted but not learned from; equal ids are separate rows.
Ties go to the language that sorts first. Other columns pass only if ``keep`` names them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import keys
from .wordhash import slices

UNKNOWN = "und"
FEATURE_BITS = 14
FEATURES = 1 << FEATURE_BITS
SAMPLE_ROWS = 300
CENTROIDS = 4
ROUNDS = 10
SMALLEST_SHARE = 0.05
REJECT = 0.7
TRIMMED = 0.01
FEW = 20  # pieces that a limit is taken from
SIZES = 15  # limits for vectors with up to 1, 3, 7, ... entries
SEED = 42
_SLICE_ROWS = 128
_LETTERS = np.full(256, 0x20, np.uint8)
_LETTERS[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTERS[0x80:] = np.arange(0x80, 0x100)


@dataclass
class Features:
    """Sparse counts of a run of texts: entry ``i`` is feature ``feature[i]`` of text ``text[i]``."""

    text: np.ndarray
    feature: np.ndarray
    count: np.ndarray


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def count_features(texts: list[str | None]) -> Features:
    raw = [f" {t.lower()} ".encode() if t else b"" for t in texts]
    owner = np.repeat(np.arange(len(raw), dtype=np.int64), [len(r) for r in raw])
    data = _LETTERS[np.frombuffer(b"".join(raw), np.uint8)].astype(np.uint32)
    if len(data) < 3:
        none = np.zeros(0, np.int64)
        return Features(none, none, none)
    gram = data[:-2] << np.uint32(16) | data[1:-1] << np.uint32(8) | data[2:]
    inside = (owner[:-2] == owner[2:]) & (data[1:-1] != 0x20)
    hashed = (gram[inside] * np.uint32(2654435761)) >> np.uint32(32 - FEATURE_BITS)
    counts = np.bincount((owner[:-2][inside] << FEATURE_BITS) | hashed, minlength=1)
    at = np.flatnonzero(counts)
    return Features(at >> FEATURE_BITS, at & (FEATURES - 1), counts[at])


def _weights(features: Features, idf: np.ndarray, texts: int) -> np.ndarray:
    """Entries of the normalised vectors."""
    values = (1 + np.log(features.count)) * idf[features.feature]
    norm = np.sqrt(np.bincount(features.text, values * values, minlength=texts))
    return values / norm[features.text]


@dataclass
class Model:
    languages: list[str]  # of each centroid
    centroids: np.ndarray  # centroid x feature
    limits: np.ndarray  # centroid x size: the cosine that nearly all pieces of its language reach
    idf: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        """Language, cosine and rejection of each text."""
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
        features = count_features(texts)
        values = _weights(features, self.idf, len(texts))
        cosine = np.stack([np.bincount(features.text, values * c[features.feature], minlength=len(texts))
                           for c in self.centroids])
        best = cosine.argmax(0)
        score = np.clip(cosine[best, np.arange(len(texts))], 0, 1)
        far = score < REJECT * self.limits[best, sizes_of(features, len(texts))]
        letters = [has_letter(t) for t in texts]
        return ([self.languages[b] if ok else UNKNOWN for b, ok in zip(best, letters)],
                [float(s) if ok else 0.0 for s, ok in zip(score, letters)],
                [bool(f) or not ok for f, ok in zip(far, letters)])


def _document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each feature occurs, and the number of documents; one row per feature is collected."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, documents = np.zeros(FEATURES + 1, np.int64), 0
        for batch in batches:
            for part in slices(batch, 0, _SLICE_ROWS):
                found[:FEATURES] += np.bincount(count_features(part.column(0).to_pylist()).feature, minlength=FEATURES)
                documents += part.num_rows
        found[FEATURES] = documents
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(found[at], pa.int64())], ["feature", "n"])

    rows = texts.mapInArrow(count, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(FEATURES + 1, np.int64)
    for row in rows:
        out[row["feature"]] = row["n"]
    return out[:FEATURES], int(out[FEATURES])


def sizes_of(features: Features, texts: int) -> np.ndarray:
    """The bit length of each vector's number of entries, at most the last of ``SIZES``."""
    entries = np.bincount(features.text, minlength=texts)
    return np.minimum(np.searchsorted(1 << np.arange(SIZES), entries, side="right"), SIZES - 1)


def size_limits(texts: list[str], centroids: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """For each size the cosine to the nearest centroid that all but ``TRIMMED`` of the texts' pieces reach.

    A size that few pieces have takes the limit of the next smaller one, as larger texts lie nearer.
    """
    raw, sizes, cosines = [t.encode() for t in texts], [], []
    for cut in range(max([0, *(len(r).bit_length() for r in raw)]) + 1):
        pieces = [r[:1 << cut].decode(errors="ignore") for r in raw if not cut or len(r) > 1 << (cut - 1)]
        for k in range(0, len(pieces), _SLICE_ROWS):
            part = pieces[k:k + _SLICE_ROWS]
            features = count_features(part)
            values = _weights(features, idf, len(part))
            sizes.append(sizes_of(features, len(part)))
            cosines.append(np.stack([np.bincount(features.text, values * c[features.feature], minlength=len(part))
                                     for c in centroids]).max(0))
    size, cosine = np.concatenate(sizes), np.concatenate(cosines)
    limits = np.zeros(SIZES)
    for k in range(1, SIZES):
        found = cosine[size == k]
        limits[k] = max(np.quantile(found, TRIMMED), limits[k - 1]) if len(found) >= FEW else limits[k - 1]
    return limits


def _halves(vectors: np.ndarray) -> np.ndarray | None:
    """Two unit centroids of a cluster cut at the median of its widest direction; None if its rows are equal."""
    apart = vectors - vectors.mean(0)
    widest = apart[np.square(apart).sum(1).argmax()]
    for _ in range(ROUNDS):
        if not np.linalg.norm(widest) > 1e-6:
            return None
        widest = (apart @ (widest / np.linalg.norm(widest))) @ apart
    order = np.argsort(apart @ widest, kind="stable")
    sums = np.stack([vectors[half].sum(0) for half in np.array_split(order, 2)])
    return sums / np.linalg.norm(sums, axis=1, keepdims=True)


def cluster(vectors: np.ndarray, k: int = CENTROIDS, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means: unit centroids.

    It starts with k-means++. A cluster of a few rows is no kind of text but an error in the labels: its centroid
    goes to a half of the largest cluster.
    """
    random = np.random.default_rng(SEED)
    chosen = [0]
    while len(chosen) < min(k, len(vectors)):
        far = np.maximum(0, 1 - (vectors @ vectors[chosen].T).max(1).astype(np.float64))
        far[far <= 1e-6] = 0
        if not far.any():
            break
        chosen.append(int(random.choice(len(vectors), p=far / far.sum())))
    centroids = vectors[chosen]
    least = max(1, SMALLEST_SHARE * len(vectors))
    for turn in range(2 * rounds):
        own = (vectors @ centroids.T).argmax(1)
        sizes = np.bincount(own, minlength=len(centroids))
        small = int(sizes.argmin())
        if sizes[small] < least:
            halves = _halves(vectors[own == sizes.argmax()]) if sizes.max() >= 2 * least else None
            if halves is None:
                centroids = np.delete(centroids, small, 0)
            else:
                centroids[[sizes.argmax(), small]] = halves
        elif turn < rounds:
            sums = np.stack([vectors[own == c].sum(0) for c in range(len(centroids))])
            centroids = sums / np.linalg.norm(sums, axis=1, keepdims=True)
        else:
            break
    sizes = np.bincount((vectors @ centroids.T).argmax(1), minlength=len(centroids))
    return centroids[sizes >= least]


def _clusters(idf: np.ndarray, lang_column: str):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("_order")
        vectors = np.zeros((table.num_rows, FEATURES), np.float32)
        for batch in table.combine_chunks().to_batches():
            row = 0
            for part in slices(batch, batch.schema.get_field_index("text"), _SLICE_ROWS):
                features = count_features(part.column("text").to_pylist())
                vectors[row + features.text, features.feature] = _weights(features, idf, part.num_rows)
                row += part.num_rows
        centroids = cluster(vectors)
        limits = size_limits(table.column("text").to_pylist(), centroids, idf).tolist()
        return pa.table({"lang": pa.array([key[0].as_py()] * len(centroids), pa.string()),
                         "centroid": pa.array([c.astype("<f4").tobytes() for c in centroids], pa.binary()),
                         "limits": pa.array([limits] * len(centroids), pa.list_(pa.float64()))})

    return run


def _sampled_ids(ids: DataFrame, n: int) -> DataFrame:
    """The ``n`` ids of each language with the smallest hashes, with ``_order``.

    Counts per size of the hash, at most 961 per language, tell which few ids can be among them. Only those, about
    a sixteenth more than ``n``, are ranked, however many tasks read the table.
    """
    sized = ids.withColumn("_order", keys.order_key(F.col("doc_id"))).withColumn(
        "_size", keys.size_bucket(F.col("_order")))
    before = Window.partitionBy("lang").orderBy("_size").rowsBetween(Window.unboundedPreceding, -1)
    counts = sized.groupBy("lang", "_size").agg(F.count(F.lit(1)).alias("_n"))
    wanted = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).filter(F.col("_before") < n)
    order = Window.partitionBy("lang").orderBy("_order", "doc_id")
    return (sized.join(wanted.select("lang", "_size"), ["lang", "_size"], "left_semi")
            .withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= n)
            .select("lang", "doc_id", "_order").distinct())


def fit(docs: DataFrame, learn: F.Column, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from ``text`` and ``lang`` of the rows where ``learn`` holds and ``lang`` is not null."""
    rows = docs.select("doc_id", F.col("text"), F.col("lang").cast("string").alias("lang")).filter(
        learn & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    found, documents = _document_frequencies(rows.select("text"))
    idf = np.log((1 + documents) / (1 + found)) + 1
    # The sample has at most sample_rows short rows per language.
    sample = rows.join(F.broadcast(_sampled_ids(rows.select("lang", "doc_id"), sample_rows)), ["lang", "doc_id"])
    learned = sample.groupBy("lang").applyInArrow(
        _clusters(idf, "lang"), "lang string, centroid binary, limits array<double>").collect()
    learned.sort(key=lambda r: (r["lang"], r["centroid"]))
    return Model([r["lang"] for r in learned],
                 np.array([np.frombuffer(r["centroid"], "<f4") for r in learned]).reshape(len(learned), FEATURES),
                 np.array([r["limits"] for r in learned]).reshape(len(learned), SIZES), idf)


def _predicted(docs: DataFrame, model: Model, carried: list[str]) -> DataFrame:
    """The columns ``carried`` as ``in_0``.. and the results, so that no names can clash."""
    inner = docs.select(*[F.col(f"`{c}`").alias(f"in_{i}") for i, c in enumerate(carried)])
    schema = inner.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0), "rejected": F.lit(True)}).schema
    # A model has a few hundred kilobytes per language, whatever the number of documents.
    sent = docs.sparkSession.sparkContext.broadcast(model)
    text = carried.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, _SLICE_ROWS):
                languages, scores, rejected = sent.value.predict(part.column(text).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(languages, pa.string()), pa.array(scores, pa.float64()),
                     pa.array(rejected, pa.bool_())], names=schema.names)

    return inner.mapInArrow(run, schema)


def predict(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep``, and ``lang_pred``, ``score`` (cosine, 0 to 1) and ``rejected``, which win over kept ones."""
    carried = list(dict.fromkeys([*keep, "text"]))
    results = ["lang_pred", "score", "rejected"]
    return _predicted(docs, model, carried).select(
        *[F.col(f"in_{i}").alias(c) for i, c in enumerate(carried) if c in keep and c not in results], *results)


def recognised(docs: DataFrame, model: Model, fill: str | None = None) -> DataFrame:
    """The rows of ``docs`` that are not rejected, unchanged but for the column ``fill``: null becomes the language."""
    kept = _predicted(docs, model, docs.columns).filter(~F.col("rejected"))
    columns = [F.coalesce(f"in_{i}", "lang_pred") if c == fill else F.col(f"in_{i}") for i, c in enumerate(docs.columns)]
    return kept.select(*[column.alias(c) for column, c in zip(columns, docs.columns)])
