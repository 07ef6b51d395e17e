"""Prepare a corpus: five stages, each over all that the one before has kept.

Each stage takes (spark, docs, sf_dir) and returns a frame with the columns of ``documents``, the last one the
tokens. ``run`` writes every stage's rows to the shared folder and rereads them as the next stage's input.

Edge values. Texts that are null, empty or without a letter are rejected by the first stage. Rows that share an id are
judged each for itself until near-duplicates are linked, where they are one document, of which one row stays; rows
without an id pass, but the tokens of such a row have no id. Equal texts leave the one with the least id. A document that
loses all its lines, or half of its words to benchmark items, goes; very long texts are worked on whole. An empty table
comes out empty, as does one from which no language can be learned. Extra columns pass every stage but the last,
whatever their names; ``n_chars`` follows the text where a stage cuts it, and ``lang`` is filled where it was null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinion_engine.llm import decontamination, language_id, line_dedup, sentencepiece_bpe, simhash
from opinion_engine.llm.common import is_held_out
from opinion_engine.llm.queries import tokenizer_path
from opinion_engine.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; texts without letters, or far from every language, go.

    A document without a language gets the one that it is recognised as.
    """
    model = language_id.fit(docs, ~is_held_out("doc_id", 4, 2))
    return language_id.recognised(docs, model, fill="lang")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines of three-line windows that occur earlier; documents left without text go."""
    cut = line_dedup.dedup_lines(docs)
    kept = cut.filter(~((F.col("n_removed") > 0) & (F.col("n_removed") == F.col("n_lines"))))
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def dedup_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that fingerprints of three-word shingles, at most two bits apart, connect."""
    return simhash.one_per_group(docs, size=3, max_bits=2)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the spans that benchmark items share; documents that are half benchmark go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.remove_spans(docs, benchmark).withColumn(
        "n_chars", F.char_length("text").cast("long")).select(docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of each text's tokens and of the text that they decode to."""
    vocabulary = sentencepiece_bpe.read_vocabulary(tokenizer_path())
    return sentencepiece_bpe.encode_decode(docs, vocabulary).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_near_copies),
    ("benchmark_decontamination", decontaminate),
    ("sentencepiece", tokenize),
]

#: SQL cannot express language identification, fingerprint tries or tokens; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
