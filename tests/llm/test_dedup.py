"""Line dedup, substring dedup and SimHash against plain versions."""

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from opinion_engine.llm import components, line_dedup, simhash, substring_dedup
from opinion_engine.llm.wordhash import blocks, word_hashes

from .cases import SCHEMA, documents, edge_rows, later_starts, order_of, words


def plain_lines(rows):
    split = [(order_of(i), t.split("\n") if t is not None else []) for i, t in rows]
    later = later_starts([(k, [(p, tuple(x[p:p + 3])) for p in range(len(x) - 2)]) for k, x in split])
    out = []
    for (_, lines), starts, (i, text) in zip(split, later, rows):
        gone = {p + k for p in starts for k in range(3)}
        kept = "\n".join(x for p, x in enumerate(lines) if p not in gone)
        out.append((i, None if text is None else kept, len(lines), len(gone)))
    return out


def plain_substrings(rows, size=20):
    split = [(order_of(i), (t or "").encode().split()) for i, t in rows]
    later = later_starts([(k, [(p, tuple(x[p:p + size])) for p in range(len(x) - size + 1)]) for k, x in split])
    out = []
    for (_, found), starts, (i, _) in zip(split, later, rows):
        gone = {p + k for p in starts for k in range(size)}
        out.append((i, len(found), len(gone), b" ".join(w for p, w in enumerate(found) if p not in gone).decode()))
    return out


def test_lines(spark):
    rows = edge_rows()
    got = line_dedup.dedup_lines(documents(spark, rows)).select("doc_id", "text", "n_lines", "n_removed")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain_lines(rows), key=repr)


def test_lines_keep_columns_and_run_no_python(spark):
    df = line_dedup.dedup_lines(documents(spark, edge_rows()))
    assert df.columns == [*documents(spark, []).columns, "n_lines", "n_removed"]
    plan = df._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))
    assert {tuple(r) for r in df.select("key", "lines", "kept", "row").collect()} == {(1, 3, "kept", 4)}


def test_substrings(spark):
    rows = edge_rows()
    got = substring_dedup.dedup_substrings(documents(spark, rows))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain_substrings(rows), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_substrings_random(spark, seed):
    """Few words, so that windows share parts at every shift."""
    chosen = np.random.default_rng(seed)
    pool = [words(35, k) for k in range(6)]
    rows = []
    for i in range(60):
        text = []
        for _ in range(chosen.integers(0, 4)):
            piece = pool[chosen.integers(0, 6)]
            a = chosen.integers(0, 12)
            text += [*piece[a:a + chosen.integers(15, 35)], *words(int(chosen.integers(0, 5)), int(1000 + i))]
        rows.append((int(i), " ".join(text)))
    got = substring_dedup.dedup_substrings(documents(spark, rows))
    assert sorted(map(tuple, got.collect())) == sorted(plain_substrings(rows))


def test_cover_holds_every_difference():
    cover = substring_dedup.COVER
    assert {(a - b) % substring_dedup.PERIOD for a in cover for b in cover} == set(range(substring_dedup.PERIOD))
    assert substring_dedup.ANCHOR + substring_dedup.PERIOD - 1 == substring_dedup.WINDOW


def test_words_of_blocks():
    import pyarrow as pa

    texts = ["", " a b", None, "c\x0bdé ", "e", "f", " ", "g"]
    found = list(blocks(pa.array(texts)))
    assert len(found) == 1
    block = found[0]
    got = [bytes(block.data[a:b]).decode() for a, b in zip(block.starts, block.ends)]
    assert got == [w.decode() for t in texts for w in (t or "").encode().split()]
    assert np.diff(block.first).tolist() == [len((t or "").encode().split()) for t in texts]
    assert len(set(word_hashes(block).tolist())) == len(set(got))


# --- SimHash -------------------------------------------------------------------------------


def plain_fingerprint(text, size):
    raw = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()).split()
    found = [b" ".join(raw[k:k + size]) for k in range(max(1, len(raw) - size + 1))] if raw else []
    votes = [sum(xxh64_intdigest(s, 42) >> k & 1 for s in found) for k in range(64)]
    return sum(1 << k for k in range(64) if 2 * votes[k] > len(found))


def plain_groups(ids, prints, near):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            if ids[a] == ids[b] or near(prints[a], prints[b]):
                x, y = find(ids[a]), find(ids[b])
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_simhash(spark):
    rows = [r for r in edge_rows() if r[0] != 11]
    base = words(200, 9)
    rows += [(100 + k, " ".join([*base[:k], "edit", *base[k + 1:]])) for k in range(20)]
    got = {(r["doc_id"], r["fp"] % (1 << 64), r["component_id"])
           for r in simhash.near_duplicates(documents(spark, rows)).collect()}
    named = [(i, plain_fingerprint(t, 3)) for i, t in rows if i is not None]
    groups = plain_groups([i for i, _ in named], [p for _, p in named], lambda a, b: (a ^ b).bit_count() <= 2)
    assert got == {(i, plain_fingerprint(t, 3), groups.get(i)) for i, t in rows}


@pytest.mark.parametrize("seed", range(4))
def test_trie_finds_every_link(seed):
    chosen = np.random.default_rng(seed)
    base = chosen.integers(0, 1 << 63, 20, dtype=np.uint64)
    values = base[chosen.integers(0, 20, 300)]
    for _ in range(3):
        flip = np.uint64(1) << chosen.integers(0, 64, 300).astype(np.uint64)
        values = np.where(chosen.random(300) < 0.5, values ^ flip, values)
    values = np.unique(values)
    groups = plain_groups(list(range(len(values))), values.tolist(), lambda a, b: (a ^ b).bit_count() <= 2)
    parent = np.arange(len(values))
    found = simhash.trie_links(values, None, 2)
    simhash._unite(parent, found[:, 0], found[:, 1])
    assert simhash._root(parent, np.arange(len(values))).tolist() == list(groups.values())


def test_links_over_many_nodes_and_parts(spark):
    """Small parts make a deep cut with split nodes; the groups stay the same."""
    chosen = np.random.default_rng(1)
    base = chosen.integers(0, 1 << 63, 30, dtype=np.int64)
    values = np.unique(base[chosen.integers(0, 30, 400)] ^ (1 << chosen.integers(0, 62, 400)) ^ (
        1 << chosen.integers(0, 62, 400)))
    frame = spark.createDataFrame([(int(v), i) for i, v in enumerate(values)], "fp long, id long")
    groups = plain_groups(list(range(len(values))), [int(v) for v in values],
                          lambda a, b: ((a ^ b) % (1 << 64)).bit_count() <= 2)
    edges = simhash.links(frame, len(values), 2, part=16)
    got = {r["u"]: r["v"] for r in components.components(edges).collect()}
    assert {i: got.get(i, i) for i in groups} == groups


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60) if i % 20 != 19] + [(5, 5), (70, 3), (3, 70)]
    got = {r["u"]: r["v"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: i // 20 * 20 for i in range(60) if i % 20} | {70: 0}


def test_one_of_each_group_stays(spark):
    base = words(900, 4)
    near = [(20 + k, " ".join([*base[:7 * k], "edit", *base[7 * k + 1:]])) for k in range(10)]
    clean = [(50 + k, " ".join(words(120, 100 + k))) for k in range(20)]
    rows = [*near, *clean, (90, " ".join(base)), (90, " ".join(base)), (None, " ".join(base)), (1, None), (2, "")]
    named = [(i, plain_fingerprint(t, 3)) for i, t in rows if i is not None]
    groups = plain_groups([i for i, _ in named], [p for _, p in named], lambda a, b: (a ^ b).bit_count() <= 2)
    df = documents(spark, rows)
    got = simhash.one_per_group(df)
    assert got.columns == df.columns
    ids = sorted(str(r["doc_id"]) for r in got.collect())
    assert ids == sorted([*(str(i) for i in set(groups) if groups[i] == i), "None"])
    assert {str(i) for i, _ in clean} | {"1", "20"} <= set(ids) and "2" not in ids and "90" not in ids


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert line_dedup.dedup_lines(none).count() == 0
    assert substring_dedup.dedup_substrings(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.one_per_group(none).count() == 0
