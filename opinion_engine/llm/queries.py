"""The registered queries of the operators, and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (ann_search, collocations, decontamination, hard_negatives, language_id, line_dedup, ngram_lm, sentencepiece_bpe, simhash,
               substring_dedup, token_files, toxicity, url_rules)
from .common import is_held_out

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def registered(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _sha256(column: str) -> F.Column:
    return F.sha2(F.col(column).cast("binary"), 256)


def tokenizer_path() -> str:
    """The model file of the registered query; the operator takes any."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@registered
def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.dedup_substrings(_table(spark, folder, "documents")).select(
        "doc_id", "n_words", "n_removed", _sha256("kept").alias("kept_sha256"))


@registered
def op2_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return ann_search.nearest_neighbours(_table(spark, folder, "embeddings"), F.col("id") % 100 == 0)


@registered
def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = line_dedup.dedup_lines(_table(spark, folder, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


ORACLE["op3_line_dedup"] = """
with lines as (
  select doc_id, unnest(range(1, len(l) + 1)) as n, unnest(l) as line, len(l) as n_lines
  from (select doc_id, string_split(text, chr(10)) as l from documents where text is not null)),
windows as (
  select *, lead(line) over w as l2, lead(line, 2) over w as l3 from lines window w as (partition by doc_id order by n)),
judged as (
  select *, n + 2 <= n_lines and row_number() over (partition by line, l2, l3, n + 2 <= n_lines order by doc_id, n) > 1 as later
  from windows),
covered as (
  select *, bool_or(later) over (partition by doc_id order by n rows between 2 preceding and current row) as gone from judged)
select d.doc_id, coalesce(any_value(n_lines), 0) as n_lines, coalesce(count_if(gone), 0) as n_removed,
  case when d.text is not null then sha256(coalesce(string_agg(line, chr(10) order by n) filter (not gone), '')) end as kept_sha256
from documents d left join covered c on d.doc_id = c.doc_id group by d.doc_id, d.text"""


@registered
def op4_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = sentencepiece_bpe.read_vocabulary(tokenizer_path())
    return sentencepiece_bpe.encode_decode(_table(spark, folder, "documents"), vocabulary).select(
        "doc_id", "n_tokens", _sha256("ids").alias("ids_sha256"), _sha256("decoded").alias("decoded_sha256"))


@registered
def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, folder, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@registered
def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    held_out = is_held_out("doc_id", 4, 2)
    model = language_id.fit(documents, ~held_out)
    return language_id.predict(documents, model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


@registered
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    held_out = is_held_out("doc_id", 4, 2)
    model = toxicity.fit(documents, _table(spark, folder, "labels"), ~held_out)
    return toxicity.score(documents, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@registered
def op8_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    matched = decontamination.match_items(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return matched.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
        F.col("longest").cast("long").alias("longest"))


@registered
def op9_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    held_out = is_held_out("doc_id", 10, 0)
    model, counts = ngram_lm.fit(documents.filter(~held_out).select("text"))
    return ngram_lm.score(documents, model, counts).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


#: Listed rules of the registered query.
LISTED_RULES = (
    url_rules.ListedRule("allow", "org", "/"),
    url_rules.ListedRule("block", "example.org", "/es/"),
    url_rules.ListedRule("block", "example.org", "/en/1"),
    url_rules.ListedRule("allow", "com", "/fr/"),
    url_rules.ListedRule("block", "com", "/de/"),
)
#: Pattern rules of the registered query: link farms, pill shops, gambling, tracking and session links.
PATTERN_RULES = (
    url_rules.PatternRule("block", r"://([^/?#]*[.-])?spam-farm\.", ("spam", "farm")),
    url_rules.PatternRule("block", r"://([^/?#]*[.-])?cheap-pills\.", ("cheap", "pills")),
    url_rules.PatternRule("block", r"://([^/?#]*[.-])?casino([.-])", ("casino",)),
    url_rules.PatternRule("block", r"[?&]sessionid=", ("sessionid",)),
    url_rules.PatternRule("block", r"[?&]utm_source=spam(&|#|$)", ("utm", "source", "spam")),
)


@registered
def op10_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return url_rules.judge(_table(spark, folder, "pages"), LISTED_RULES, PATTERN_RULES)


@registered
def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.mine(_table(spark, folder, "documents"))


ORACLE["op11_collocations"] = """
with pieces as (
  select lang, regexp_extract_all(piece, '[^ \\t]+') as w from (
    select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) as piece from documents)),
totals as (select lang, cast(sum(len(w)) as bigint) as n from pieces group by lang),
grams as (
  select lang, size, list_slice(w, i, i + size - 1) as g, count(*) as f
  from (select lang, w, unnest(range(1, len(w) + 1)) as i from pieces), range(1, 6) r(size)
  where i + size - 1 <= len(w) group by all having count(*) >= 100),
longer as (
  select lang, g, max(f) as more from (
    select lang, unnest([list_slice(g, 1, size - 1), list_slice(g, 2, size)]) as g, f from grams where size > 2)
  group by lang, g),
cuts as (
  select p.lang, p.g, p.size, p.f, n, unnest(range(1, p.size)) as k
  from grams p join totals using (lang) left join longer using (lang, g)
  where p.size > 1 and (more is null or 100 * more < 100 * p.f)),
judged as (
  select c.lang, c.g, c.f as a, c.n, k, l.f as l, r.f as r,
    cast(1000::hugeint * c.f * c.n // (l.f::hugeint * r.f) as bigint) as score
  from cuts c join grams l on l.lang = c.lang and l.g = list_slice(c.g, 1, k)
    join grams r on r.lang = c.lang and r.g = list_slice(c.g, k + 1, c.size)),
best as (select *, array_to_string(g, ' ') as phrase from judged
  qualify row_number() over (partition by lang, g order by score, k) = 1)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from best qualify rank <= 2000"""


#: The id after each document's ids in the registered query.
END_ID = 2


def word_tokenizer() -> str:
    """The tokenizer of the registered query, as JSON; the operator takes any."""
    import public_tokenizers

    return Path(public_tokenizers.path("word_bpe_49k.json")).read_text()


@registered
def op12_token_files(spark: SparkSession, folder: str) -> DataFrame:
    files = scratch_path(spark, "token-files")
    token_files.write(_table(spark, folder, "documents"), word_tokenizer(), END_ID, files)
    return token_files.read(spark, files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@registered
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = _table(spark, folder, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0)


ORACLE["op13_hard_negatives"] = """
with vectors as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scores as (
  select a.vec_id as anchor_id, o.vec_id, a.label = o.label as same, list_dot_product(a.v, o.v)::bigint as score
  from vectors a join vectors o on a.vec_id % 100 = 0 and a.vec_id <> o.vec_id),
positives as (
  select * from scores where same qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select anchor_id, p.vec_id as positive_id,
  row_number() over (partition by anchor_id, p.vec_id order by n.score desc, n.vec_id)::int as rank,
  n.vec_id as negative_id, p.score as positive_score, n.score as negative_score
from positives p join scores n using (anchor_id)
where not n.same and 30 * p.score <= 100 * n.score and 100 * n.score <= 90 * p.score qualify rank <= 10"""


_LISTED_SQL = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in LISTED_RULES)
_PATTERN_SQL = " or ".join(f"regexp_matches(u, '{r.pattern}')" for r in PATTERN_RULES)
_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
ORACLE["op10_url_filters"] = f"""
with rules(v, h, p) as (values {_LISTED_SQL}),
parts as (
  select page_id, translate(coalesce(url, ''), {_AZ}) as u,
    case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
split as (
  select row_number() over () as n, page_id, u, translate(regexp_extract(rest, '^[^/?#]*'), {_AZ}) as host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') as path from parts),
fits as (
  select n, max_by(h || p, length(h || p)) as rule, max_by(v, length(h || p)) as verdict
  from split join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p) group by n)
select page_id, host, path, rule, coalesce(verdict, case when {_PATTERN_SQL} then 'block' else 'allow' end) as verdict
from split left join fits using (n)"""
