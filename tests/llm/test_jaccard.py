"""Jaccard join against brute force over all pairs, and odd inputs."""

from collections import Counter, defaultdict

import numpy as np
import pytest

from plain import shingles
from tallyframe.llm import jaccard as J

SF = "/root/testdata/sf0.01"
def brute(docs):
    """doc position -> (set size, component's smallest id); every pair with a common shingle is compared."""
    sets = [shingles(t) for _, t in docs]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    common = Counter((a, b) for h in holders.values() for k, a in enumerate(h) for b in h[k + 1:])
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            parent[root(a)] = root(b)
    least = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return sorted(((doc, len(sets[i]), least.get(root(i)) if sets[i] else doc) for i, (doc, _) in enumerate(docs)), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_whole_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = brute(docs)
    assert got(J.op3_jaccard_prefix_orders(spark, SF)) == want
    assert len({c for _, _, c in want}) < len(docs)


def near_copies(n, seed, words=80, changes=2):
    rng = np.random.default_rng(seed)
    base = [f"w{rng.integers(1 << 30)}" for _ in range(words)]
    out = []
    for _ in range(n):
        mine = list(base)
        for k in rng.integers(0, words, rng.integers(0, changes + 1)):
            mine[k] = f"x{rng.integers(1 << 30)}"
        out.append(" ".join(mine))
    return out


@pytest.mark.parametrize("tile", [8, 1024])
def test_family_across_tiles_and_hot_tokens(spark, monkeypatch, tile):
    monkeypatch.setattr(J, "TILE", tile)
    monkeypatch.setattr(J, "HOT_LEAST", 20)
    texts = near_copies(60, 1) + near_copies(30, 2, changes=6) + ["a b c", "A  b\nC", "a b c d", "", None, "   ", "é è"]
    docs = [(i * 3, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(*d, "k", 1) for d in docs], "doc_id bigint, text string, key string, n int").repartition(4)
    assert got(J.jaccard_components(df)) == brute(docs)


def test_odd_inputs(spark):
    schema = "doc_id bigint, text string, component_id string"
    rows = [(1, "one two three four five six", None), (1, "one two three four five six", None), (None, "one two three four five six", None), (None, None, None),
            (5, "w " * 50000, None), (4, "w " * 60000, None), (9, "", None)]
    df = spark.createDataFrame(rows, schema)
    assert got(J.jaccard_components(df)) == brute([r[:2] for r in rows])
    assert J.jaccard_components(df.limit(0)).collect() == []


def test_many_small_groups_at_once_equal_one_by_one(spark, monkeypatch):
    texts = [t for seed in range(12) for t in near_copies(2 + seed, seed, 60, 6)] + near_copies(40, 99, 60, 8)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    want = brute(list(enumerate(texts)))
    for small, rows in ((16, 2048), (0, 2048), (100, 7)):
        monkeypatch.setattr(J, "SMALL", small)
        monkeypatch.setattr(J, "CALL_ROWS", rows)
        assert got(J.jaccard_components(docs)) == want


@pytest.mark.parametrize("limit", [1 << 20, 10])
def test_common_elements_of_pairs(monkeypatch, limit):
    monkeypatch.setattr(J, "SLICE", limit)
    rng = np.random.default_rng(3)
    sets = [rng.choice(50, n, replace=False).astype(np.uint64) << np.uint64(40) for n in rng.integers(0, 30, 40)]
    group = np.sort(rng.integers(0, 9, 40))
    left, right = J.pairs_within(group)
    assert list(zip(left, right)) == [(i, j) for i in range(40) for j in range(i + 1, 40) if group[i] == group[j]]
    assert J.commons(*J.ragged(sets), left, right).tolist() == [len(set(sets[i]) & set(sets[j])) for i, j in zip(left, right)]
    assert len(J.commons(np.zeros(0, np.uint64), np.zeros(1, np.int64), left[:0], right[:0])) == 0
