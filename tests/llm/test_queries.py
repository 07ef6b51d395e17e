"""The registered queries against their SQL or a plain version, and the pipeline stage by stage."""

import os
import re
import zlib

import numpy as np
import pytest
import sentencepiece

import __spark_entry__ as contract
import corpus_pipeline
from opinion_engine.llm.queries import ORACLE, QUERIES, tokenizer_path
from tests.compare import difference, duck

from .cases import SCHEMA, documents, edge_rows, sha, words
from .test_coding import plain_hits
from .test_dedup import plain_fingerprint, plain_groups, plain_substrings

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.fixture(scope="module")
def texts(con):
    return con.execute("select doc_id, text from documents order by doc_id").fetchall()


def result(spark, number):
    (name,) = [n for n in QUERIES if n.startswith(f"op{number}_")]
    return QUERIES[name](spark, FOLDER).collect()


def test_one_query_per_operator_and_the_pipeline():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(ORACLE) == {"op3_line_dedup", "op10_url_filters", "op11_collocations", "op13_hard_negatives"} and corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, con, name):
    assert difference(QUERIES[name](spark, FOLDER), con, ORACLE[name]) is None


def test_substring_dedup(spark, texts):
    want = {(i, n, gone, sha(kept)) for i, n, gone, kept in plain_substrings(texts)}
    assert {tuple(r) for r in result(spark, 1)} == want


def test_nearest_neighbours(spark, con):
    rows = con.execute("select vec_id, embedding from embeddings order by vec_id").fetchall()
    data = np.array([v for _, v in rows])
    ids = np.array([i for i, _ in rows])
    found = {}
    for r in result(spark, 2):
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = total = 0
    for i in np.flatnonzero(ids % 100 == 0):
        dist = np.sqrt(np.square(data - data[i]).sum(1))
        dist[i] = np.inf
        best = np.lexsort([ids, dist])[:10]
        got = sorted(found[ids[i]])
        assert [r for r, _, _ in got] == list(range(1, 11))
        assert all(abs(dist[ids == v][0] - s) < 1e-12 for _, v, s in got)
        hits, total = hits + len({v for _, v, _ in got} & set(ids[best].tolist())), total + 10
    assert hits / total >= 0.9


def test_sentencepiece(spark, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())
    want = set()
    for i, text in texts:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        want.add((i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library.decode(ids))))
    assert {tuple(r) for r in result(spark, 4)} == want


def test_simhash(spark, texts):
    prints = [plain_fingerprint(t, 3) for _, t in texts]
    groups = plain_groups([i for i, _ in texts], prints, lambda a, b: (a ^ b).bit_count() <= 2)
    assert {tuple(r) for r in result(spark, 5)} == {(i, f"{p:016x}", groups[i]) for (i, _), p in zip(texts, prints)}


def test_language_id(spark, con):
    truth = dict(con.execute("select doc_id, lang from documents").fetchall())
    got = result(spark, 6)
    assert {r["doc_id"]: r["held_out"] for r in got} == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in truth}
    assert all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"] and r["lang_pred"] != "und"]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.97


def test_toxicity(spark):
    got = QUERIES["op7_toxicity"](spark, "/root/testdata/sf0.01").collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    truth = duck("/root/testdata/sf0.01").execute("select doc_id, toxic from labels").fetchall()
    score = {r["doc_id"]: r["score"] for r in got if r["held_out"]}
    toxic, clean = ([score[i] for i, t in truth if t == kind and i in score] for kind in (1, 0))
    assert np.mean([a > b for a in toxic for b in clean]) > 0.5  # few labels at this size


def test_decontamination(spark, con, texts):
    items = con.execute("select item_id, text from benchmark").fetchall()
    got = {tuple(r)[:6] for r in result(spark, 8)}
    assert got == {(i, n, hit, len(names), sha(",".join(names)), hit > 0) for i, n, hit, names in plain_hits(texts, items)}


def test_lm_scoring(spark, texts):
    got = result(spark, 9)
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i, _ in texts if zlib.crc32(str(i).encode()) % 10 == 0}
    n = sum(r["n_tokens"] for r in held)
    assert sum(r["score"] for r in held) / n > sum(r["base_score"] for r in held) / n


# --- the pipeline --------------------------------------------------------------------------


def edge_folder(spark, tmp_path):
    """Every edge value that a document with an id of its own can have, beside texts of two languages."""
    seen, rows = set(), []
    for i, text, *rest in edge_rows():
        if i is not None and i not in seen:
            seen.add(i)
            rows.append((i, text, *rest))
    rows += [(100 + k, " ".join(words(40, 100 + k)), "de") for k in range(12)]
    rows += [(300 + k, words(30, 7)[0] + " " + " ".join(words(30, 7)), None) for k in range(3)]
    item = " ".join(words(30_000, 3)[50:80])
    folder = str(tmp_path)
    documents(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None), (3, "a b c")], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet")
    return folder, [r[:2] for r in rows], [(1, item), (2, None), (3, "a b c")]


@pytest.mark.parametrize("case", ["given", "edge"])
def test_stages(spark, con, texts, case, tmp_path):
    """Each stage against a plain version over what the one before has kept."""
    if case == "given":
        folder, items = FOLDER, con.execute("select item_id, text from benchmark").fetchall()
    else:
        folder, texts, items = edge_folder(spark, tmp_path)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = corpus_pipeline.materialize(stage(spark, docs, folder), "stage")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == before.columns
            rows = docs.select("doc_id", "text", "lang", "n_chars").collect()
            kept[name] = {r["doc_id"]: r["text"] for r in rows}
            assert len(rows) == len(kept[name])
            assert all(r["n_chars"] == len(r["text"]) and r["lang"] for r in rows)
    source = dict(texts)
    assert kept["language_id"].items() <= source.items()
    lettered = [i for i, t in texts if t and any(map(str.isalpha, t))]
    assert set(kept["language_id"]) <= set(lettered) and len(kept["language_id"]) >= 0.9 * len(lettered)
    seen, want = set(), {}
    for i in sorted(kept["language_id"]):
        lines = kept["language_id"][i].split("\n")
        gone = set()
        for p in range(len(lines) - 2):
            window = tuple(lines[p:p + 3])
            gone |= {p, p + 1, p + 2} if window in seen else set()
            seen.add(window)
        if len(gone) < len(lines):
            want[i] = "\n".join(x for p, x in enumerate(lines) if p not in gone)
    assert kept["line_dedup"] == want
    near = kept["simhash_near_dedup"]
    assert near.items() <= kept["line_dedup"].items()
    prints = {i: plain_fingerprint(t, 3) for i, t in kept["line_dedup"].items()}
    groups = plain_groups(sorted(prints), [prints[i] for i in sorted(prints)], lambda a, b: (a ^ b).bit_count() <= 2)
    assert set(near) == {i for i, least in groups.items() if i == least}
    clean = kept["benchmark_decontamination"]
    assert not any(h for _, _, h, _ in plain_hits(list(clean.items()), items))
    hits = plain_hits(list(near.items()), items)
    assert {i: near[i] for i, _, h, _ in hits if not h}.items() <= clean.items()
    assert set(clean) == {i for i, n, h, _ in hits if not h or 2 * h < n}
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())
    got = {r["doc_id"]: (r["n_tokens"], r["decoded_sha256"]) for r in docs.collect()}
    ids = {i: library.encode(t, add_bos=True, add_eos=True) for i, t in clean.items()}
    assert got == {i: (len(x), sha(library.decode(x))) for i, x in ids.items()}


def test_stages_take_null_and_repeated_ids(spark, tmp_path):
    rows = edge_rows() + [(100 + k, " ".join(words(40, 100 + k)), "de") for k in range(12)]
    spark.createDataFrame([(1, "a b c d e f g h i j k")], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    for docs in (documents(spark, rows), spark.createDataFrame([], SCHEMA)):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            out.collect()
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == columns
                docs = corpus_pipeline.materialize(out, "edge")
                ids = [r[0] for r in docs.select("doc_id").collect()]
                if name == "simhash_near_dedup":
                    assert len(set(ids) - {None}) == len([i for i in ids if i is not None])
                assert (None in ids) == bool(ids)  # a row without an id passes


def test_run(spark):
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert 0 < got.count() <= spark.read.parquet(f"{FOLDER}/documents.parquet").count()


def test_nothing_else_imports_this_package():
    root = os.path.dirname(os.path.abspath(contract.__file__))
    for folder, _, files in os.walk(f"{root}/opinion_engine"):
        for file in files:
            if file.endswith(".py") and not folder.endswith("/llm"):
                assert "llm" not in open(f"{folder}/{file}").read()


def test_plans_have_no_joins_of_all_pairs(spark):
    for name in ("op3_line_dedup", "op10_url_filters", "op4_sentencepiece", "op8_benchmark_decontamination"):
        plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
