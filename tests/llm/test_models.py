"""Language models, language identification, toxicity: plain versions and held-out accuracy."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinion_engine.llm import language_id, ngram_lm, toxicity
from opinion_engine.llm.common import is_held_out

from .cases import SCHEMA, documents, edge_rows, words


# --- LM scoring ----------------------------------------------------------------------------


def tokens(text):
    raw = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    return [*raw.split(), None]


def plain_model(rows, head, arc):
    """Probability functions of the base and of the interpolation-free backoff model."""
    lists = [tokens(t) for i, t in rows if i is not None and zlib.crc32(str(i).encode()) % 10 != 0]
    count = Counter(w for x in lists for w in x)
    n, v = sum(count.values()), len(count)
    n1, n2 = (sum(c == k for c in count.values()) for k in (1, 2))
    d = min(0.95, max(0.05, n1 / max(1, n1 + 2 * n2)))
    heads = {w for w, c in count.items() if c >= head * n}
    pairs = Counter((a, b) for x in lists for a, b in zip([None, *x], x) if a in heads and b in heads)
    pairs = {p: c for p, c in pairs.items() if c >= max(2.0, arc * n)}
    root = lambda w: (count[w] - d) / n if count[w] else d * v / n

    def probability(h, w):
        if (h, w) in pairs:
            return (pairs[h, w] - d) / count[h]
        after = [b for a, b in pairs if a == h]
        if not after:
            return root(w)
        left = 1 - sum((pairs[h, b] - d) / count[h] for b in after)
        return root(w) * left / (1 - sum(map(root, after)))

    base = lambda w: (count[w] + 0.1) / (n + 0.1 * (v + 1))
    return count, n, base, probability


@pytest.mark.parametrize("head,arc", [(1e-6, 2e-6), (0.01, 0.004)])
def test_scores(spark, head, arc):
    chosen = random.Random(2)
    pool = words(30, 1)
    rows = [(i, " ".join(chosen.choices(pool, weights=range(1, 31), k=chosen.randint(1, 60))) + " A b A b")
            for i in range(80)]
    rows += [r for r in edge_rows() if r[0] != 11]
    count, n, base, probability = plain_model(rows, head, arc)
    df = documents(spark, rows)
    model, counts = ngram_lm.fit(df.filter(~is_held_out("doc_id", 10, 0)).select("text"), head, arc)
    assert model.tokens == n and model.arcs
    want = []
    for i, text in rows:
        found = tokens(text)
        want.append((i, len(found), sum(w in count for w in found), sum(math.log10(base(w)) for w in found),
                     sum(math.log10(probability(h, w)) for h, w in zip([None, *found], found))))
    got = sorted(map(tuple, ngram_lm.score(df, model, counts).collect()), key=repr)
    for a, b in zip(got, sorted(want, key=repr)):
        assert a[:3] == b[:3] and np.allclose(a[3:], b[3:])
    assert len(got) == len(want)
    # what follows a word sums to one, unknown words as one of them
    for h in [None, b"a", b"b"]:
        assert math.isclose(sum(probability(h, w) for w in [*count, b"never seen"]), 1)


@pytest.mark.parametrize("cached_head,cached_arc", [(1e-6, 2e-6), (0.02, 0.01), (2.0, 2.0)])
def test_every_repeated_pair_is_scored(spark, cached_head, cached_arc):
    """Pairs far under any share of the tokens, of frequent and of rare words; what is cached changes nothing."""
    chosen = random.Random(5)
    rows = [(i, " ".join(chosen.choices(["a", "b", "c"], k=60)) + (f" rare{i // 4} word{i // 4} a" if i % 2 else ""))
            for i in range(120)] + [(200, "b rare1 never"), (201, None)]
    count, n, base, probability = plain_model(rows, 0.0, 0.0)
    df = documents(spark, rows)
    model, stored = ngram_lm.fit(df.filter(~is_held_out("doc_id", 10, 0)).select("text"), cached_head=cached_head,
                                 cached_arc=cached_arc)
    want = {i: (sum(math.log10(base(w)) for w in tokens(t)),
                sum(math.log10(probability(h, w)) for h, w in zip([None, *tokens(t)], tokens(t)))) for i, t in rows}
    got = {r["doc_id"]: (r["base_score"], r["score"]) for r in ngram_lm.score(df, model, stored).collect()}
    assert got.keys() == want.keys() and all(np.allclose(got[i], want[i]) for i in want)


def test_large_tables_keep_repeated_pairs(spark):
    """With 2.1 million tokens a share of 2e-6 would need five occurrences; two are enough."""
    rows = [(i, "a " * 70_000) for i in range(30)] + [(100, "left right"), (101, "left right")]
    df = documents(spark, rows)
    model, stored = ngram_lm.fit(df.select("text"))
    got = {r["doc_id"]: r["score"] for r in ngram_lm.score(df, model, stored).collect()}
    _, _, _, probability = plain_model([(1, t) for _, t in rows], 0.0, 0.0)
    found = tokens("left right")
    assert math.isclose(got[100], sum(math.log10(probability(h, w)) for h, w in zip([None, *found], found)))


def test_nothing_to_learn(spark):
    df = documents(spark, edge_rows()[:5])
    model, counts = ngram_lm.fit(df.filter("false").select("text"))
    got = ngram_lm.score(df, model, counts).collect()
    assert {(r["n_known"], r["base_score"], r["score"]) for r in got} == {(0, 0.0, 0.0)}
    assert ngram_lm.score(spark.createDataFrame([], SCHEMA), model, counts).count() == 0


def test_numbering():
    heads = np.sort(np.random.default_rng(0).integers(0, 1 << 63, 1000, dtype=np.uint64) * np.uint64(2))
    number = ngram_lm.Numbering(heads)
    assert number(heads).tolist() == list(range(1, 1001))
    assert not number(heads + np.uint64(1)).any()
    assert number(np.zeros(0, np.uint64)).tolist() == []


# --- language identification ---------------------------------------------------------------

_SOUNDS = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ein", "üng", "er"], "cc": ["ño", "que", "cion", "es"],
           "dd": ["жи", "ко", "во", "да"]}


def languages(n, seed):
    chosen = random.Random(seed)
    out = []
    for i in range(n):
        lang = chosen.choice(list(_SOUNDS))
        text = " ".join("".join(chosen.choices(_SOUNDS[lang], k=chosen.randint(1, 3))) for _ in range(chosen.randint(3, 60)))
        out.append((i, text, lang))
    return out


def test_languages(spark):
    rows = [*languages(300, 1), (1000, None, "aa"), (1001, "", "aa"), (1002, "123 !? ²", "aa"),
            (None, "schein üng", "bb"), (1003, "schein", None), (1003, "schein", None), (1004, "kalo " * 20_000, "aa"),
            (1005, "漢字仮名交文" * 5, None)]
    df = documents(spark, rows)
    model = language_id.fit(df, ~is_held_out("doc_id", 4, 2))
    got = language_id.predict(df, model).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    truth = {i: lang for i, _, lang in rows[:300]}
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in got if r["doc_id"] in truth]) > 0.99
    assert not any(r["rejected"] for r in got if r["doc_id"] in truth)
    by_id = {r["doc_id"]: (r["lang_pred"], r["rejected"]) for r in got}
    assert by_id[1000] == by_id[1001] == by_id[1002] == ("und", True)
    assert by_id[1003] == by_id[None] == ("bb", False) and by_id[1004] == ("aa", False)
    assert by_id[1005][0] in _SOUNDS and by_id[1005][1]  # far from all
    kept = language_id.recognised(df, model)
    assert kept.columns == df.columns
    assert kept.count() == sum(not r["rejected"] for r in got)


def test_languages_without_learning(spark):
    df = documents(spark, languages(5, 1))
    model = language_id.fit(df, F.lit(False))
    assert {tuple(r)[1:] for r in language_id.predict(df, model).collect()} == {("und", 0.0, True)}
    assert language_id.predict(spark.createDataFrame([], SCHEMA), model).count() == 0


def test_clusters():
    chosen = np.random.default_rng(0)
    centers = np.eye(5)[:3]
    rows = np.abs(centers[chosen.integers(0, 3, 90)] + chosen.normal(0, 0.02, (90, 5)))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    found = language_id.cluster(rows, 3)
    assert sorted(found.argmax(1)) == [0, 1, 2] and (rows @ found.T).max(1).min() > 0.98
    assert len(language_id.cluster(rows[:1].repeat(4, 0), 3)) == 1


def test_clusters_of_a_few_rows_are_replaced():
    """Outliers do not use up the centroids of a language."""
    chosen = np.random.default_rng(1)
    rows = np.abs(np.eye(60)[chosen.integers(0, 4, 300)] + 0.2 + chosen.normal(0, 0.05, (300, 60)))
    rows[:5] = np.eye(60)[10:15]
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    found = language_id.cluster(rows)
    assert len(found) == language_id.CENTROIDS
    own = (rows @ found.T).argmax(1)
    assert np.bincount(own, minlength=4).min() >= 15


def test_every_language_has_several_centroids(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.fit(docs, ~is_held_out("doc_id", 4, 2))
    assert Counter(model.languages) == {lang: language_id.CENTROIDS for lang in ("de", "en", "es", "fr")}
    got = language_id.predict(docs, model, ("doc_id", "lang")).filter(is_held_out("doc_id", 4, 2))
    right, rows, far = got.agg(F.count_if(F.expr("lang = lang_pred")), F.count("lang"), F.count_if("rejected")).first()
    print(right, rows, far, flush=True)
    assert right >= 0.97 * rows


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("lang is not null")


@pytest.mark.parametrize("left_out", ["de", "es"])
def test_a_language_that_was_not_learned_is_rejected(given, left_out):
    """Nine of ten texts of 200 bytes or more; of the learned languages nearly none."""
    model = language_id.fit(given.filter(f"lang != '{left_out}'"), ~is_held_out("doc_id", 4, 2))
    got = language_id.predict(given.filter("octet_length(text) >= 200"), model, ("doc_id", "lang")).toPandas()
    strange = got[got["lang"] == left_out]["rejected"].mean()
    held = got[(got["lang"] != left_out) & got["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)]
    print(left_out, strange, held["rejected"].mean(), len(held), flush=True)
    assert strange >= 0.9 and held["rejected"].mean() <= 0.01


def test_cosines_and_rejection_by_hand(given):
    """The query's predictions against a plain computation over dictionaries."""
    model = language_id.fit(given, ~is_held_out("doc_id", 4, 2))
    rows = given.select("doc_id", "text").limit(60).collect() + [(-1, "a"), (-2, "Ünï"), (-3, "xx yy zz")]
    got = model.predict([r[1] for r in rows])
    for (_, text), lang, score, rejected in zip(rows, *got):
        data = bytes(b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in f" {text.lower()} ".encode())
        grams = Counter(data[i:i + 3] for i in range(len(data) - 2) if data[i + 1] != 0x20)
        vector = {}
        hashed = Counter()
        for gram, n in grams.items():
            number = int.from_bytes(gram, "big") * 2654435761 % (1 << 32) >> (32 - language_id.FEATURE_BITS)
            hashed[number] += n
        for f, n in hashed.items():
            vector[f] = (1 + math.log(n)) * model.idf[f]
        norm = math.sqrt(sum(v * v for v in vector.values()))
        cosines = [sum(v * c[f] for f, v in vector.items()) / norm for c in model.centroids]
        best = max(range(len(cosines)), key=lambda k: cosines[k])
        size = min(len(vector).bit_length(), language_id.SIZES - 1)
        assert lang == model.languages[best] and score == pytest.approx(min(max(cosines[best], 0), 1), abs=1e-5)
        assert rejected == (score < language_id.REJECT * model.limits[best, size])


# --- toxicity ------------------------------------------------------------------------------


def plain_kind(classes):
    """What a clause is, by rules over its whole list of classes."""
    T = toxicity
    def used_up(i):
        """The last negation before i within three words that nothing has taken since."""
        for k in range(i - 1, max(-1, i - 4), -1):
            if classes[k] == T.NEGATION:
                return not any(classes[m] in (T.INSULT, T.HINT, T.THREAT) for m in range(k + 1, i))
        return False

    events = []
    reported = False
    threats = None
    for i, c in enumerate(classes):
        reported = reported or c == T.REPORT
        if c == T.THREAT and not used_up(i):
            threats = i
        if c == T.TARGET and threats is not None and i - threats <= 3:
            events.append((2 if reported else 6))
            threats = None
        if c in (T.INSULT, T.HINT):
            before = any(classes[k] == T.TARGET and not taken(classes, k, T) for k in range(max(0, i - 5), i))
            after = i + 1 < len(classes) and classes[i + 1] == T.TARGET and not taken(classes, i + 1, T)
            if used_up(i):
                events.append(1)
            elif reported:
                events.append(2)
            elif c == T.INSULT:
                events.append(5 if before or after else 4)
            else:
                events.append(3 if not before else 5 if after else 4)
    return max(events) - 1 if events else None


def taken(classes, i, T):
    """Whether the target at i completes a threat."""
    threat = None
    for k, c in enumerate(classes[:i + 1]):
        if c == T.THREAT:
            last = [m for m in range(max(0, k - 3), k) if classes[m] == T.NEGATION]
            denied = bool(last) and not any(classes[m] in (T.INSULT, T.HINT, T.THREAT) for m in range(last[-1] + 1, k))
            if not denied:
                threat = k
        if c == T.TARGET:
            done = threat is not None and k - threat <= 3
            if done:
                threat = None
            if k == i:
                return done
    return False


def test_machine_against_rules():
    chosen = random.Random(7)
    for _ in range(20_000):
        classes = chosen.choices(range(7), (5, 1.5, 1.5, 1, 2, 1, 0.4), k=chosen.randint(0, 9))
        assert toxicity.clause_kind(classes) == plain_kind(classes), classes


def test_grammar():
    lexicon = toxicity.Lexicon({"idiot": 6.0, "odd": 4.0}, {"stup": 7.0})
    kinds = lambda text: [k for k, n in zip(toxicity.KINDS, toxicity.matched(text, lexicon)) for _ in range(n)]
    assert kinds("The idiot came.") == ["bare"] and kinds("IDIOT! stupid; STUPIDLY") == ["bare"] * 3
    assert kinds("You idiot") == kinds("idiot, you") == ["aimed"] and kinds("idiot he said") == ["aimed"]
    assert kinds("not an idiot") == ["denied"] and kinds("not that it ever matters, idiot") == ["bare"]
    assert kinds("not nice. idiot") == ["bare"]  # negation ends with its clause
    assert kinds("He said you are no idiot") == ["denied"] and kinds("she called him an idiot") == ["quoted"]
    assert kinds("I will kill you") == ["menace"] and kinds("kill the time") == kinds("never kill you") == []
    assert kinds("he wrote I kill you") == ["quoted"] and kinds("no idiot, you idiot") == ["aimed"]
    assert kinds("how odd") == ["hint"] and kinds("you are odd") == ["bare"] and kinds("not odd") == ["denied"]
    assert not any(map(kinds, [None, "", "12 ...", "stu idiots"]))


def test_the_verdict_needs_the_grammar(spark):
    """The same insults in every text: only denied or quoted in clean ones. No sum over words tells them apart."""
    chosen, pool = random.Random(8), words(150, 11)
    rows, toxic = [], []
    for i in range(600):
        insult = chosen.choice(["grobik", "fiesnar", "dulmo"])
        text = lambda n: " ".join(chosen.choices(pool, k=n))
        bad = i % 2
        around = [f"{text(9)} {insult} {text(4)}", f"you are {insult}"] if bad else [
            f"{text(9)} not {insult} {text(4)}", f"he said that {insult} {text(3)}"]
        rows.append((i, ". ".join(chosen.sample([text(12), text(6), around[i // 2 % 2]], 3))))
        toxic.append((i, bad if i % 3 else None))
        if i % 6 == 3:  # texts without any insult teach what an insult is
            rows.append((1000 + i, text(30)))
            toxic.append((1000 + i, 0))
    df = documents(spark, rows)
    sample = [(text, label) for (i, text), (j, label) in zip(rows, toxic) if label is not None]
    lexicon = toxicity.Lexicon({w: 6.0 for w in ("grobik", "fiesnar", "dulmo")}, {})
    found = np.array([toxicity.matched(t, lexicon) for t, _ in sample], float)
    label = np.array([y for _, y in sample], float)
    model = toxicity.Model(lexicon, toxicity.fit_weights(found, label, np.ones(len(label))))
    got = {r["doc_id"]: r["score"] >= 0.3 for r in toxicity.score(df, model).collect()}
    assert all(got[i] == bool(i % 2) for i in range(600))
    sums = {i: sum(w in lexicon.words for w in toxicity.words_of(t)) for i, t in rows if i < 1000}
    assert {sums[i] for i in range(600)} == {1}  # one insult in each: equal for every sum of word weights


def test_toxicity(spark):
    chosen = random.Random(4)
    insults, pool = ["grobik", "grobiksen", "grobikla", "grobiknu", "fiesnar"], words(200, 6)
    rows, toxic = [], []
    for i in range(400):
        text = chosen.choices(pool, k=chosen.randint(5, 80))
        bad = i % 5 == 0
        if bad:
            for w in chosen.choices(insults, k=2):
                text.insert(chosen.randint(0, len(text)), w)
        rows.append((i, " ".join(text).capitalize()))
        toxic.append((i, int(bad)))
    toxic += [(0, 0), (None, 1), (1, None), (9999, 1)]
    rows += [(1000, None), (1001, ""), (None, "grobik fiesnar"), (1002, "grobikneu " + " ".join(pool)), (1003, pool[0] * 9000)]
    df = documents(spark, rows)
    labels = spark.createDataFrame(toxic, "doc_id long, toxic int")
    model = toxicity.fit(df, labels, ~is_held_out("doc_id", 4, 2))
    assert "grobi" in model.lexicon.stems and "fiesnar" in model.lexicon.words
    got = {r["doc_id"]: r["score"] for r in toxicity.score(df, model).collect()}
    assert all(0 <= s <= 1 for s in got.values()) and len(got) == len(rows)
    assert all((got[i] >= 0.3) == (i % 5 == 0) for i in range(400))
    assert got[None] >= 0.3 and got[1002] >= 0.3
    assert got[1000] == got[1001] == got[1003] < 0.3


def test_toxicity_without_labels(spark):
    df = documents(spark, [(1, "a"), (2, None)])
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(df, labels, F.lit(True))
    assert all(r["score"] < 1e-6 for r in toxicity.score(df, model).collect())
    one = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert all(r["score"] > 0.99 for r in toxicity.score(df, toxicity.fit(df, one, F.lit(True))).collect())
    assert toxicity.score(spark.createDataFrame([], SCHEMA), model).count() == 0
