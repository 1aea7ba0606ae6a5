"""Packing: capacity, conflicts, every word once, the tightest compatible bin, odd inputs."""

import random
import re
from collections import defaultdict

from tallyframe.llm import packing as P

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def check(rows, docs, capacity):
    bins, parts = defaultdict(list), defaultdict(list)
    for r in rows:
        bins[r["bin_id"]].append(r)
        parts[r["doc_id"]].append(r)
    for b in bins.values():
        assert sum(max(1, r["n_words"]) for r in b) <= capacity
        assert sorted(r["slot"] for r in b) == list(range(len(b)))
        for c in ("source", "cluster"):
            held = [r[c] for r in b if r[c] is not None]
            assert len(held) == len(set(held))
    assert parts.keys() == docs.keys()
    for d, text in docs.items():
        raw = (text or "").encode()
        cut = [WORD.findall(raw[r["start_byte"]:r["end_byte"]].decode()) for r in sorted(parts[d], key=lambda r: r["piece"])]
        assert [len(c) for c in cut] == [r["n_words"] for r in sorted(parts[d], key=lambda r: r["piece"])]
        assert sum(cut, []) == WORD.findall(text or "")


def test_whole_table(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = P.op5_conflict_best_fit(spark, SF).collect()
    check(rows, docs, P.CAPACITY)
    words = sum(max(1, r["n_words"]) for r in rows)
    assert len({r["bin_id"] for r in rows}) < 1.35 * words / P.CAPACITY + 20


def test_tightest_compatible_bin():
    rng = random.Random(1)
    for _ in range(30):
        n = rng.randrange(1, 120)
        sizes = sorted((rng.randrange(1, 40) for _ in range(n)), reverse=True)
        sources = [rng.choice(["a", "b", "c", None]) for _ in range(n)]
        clusters = [rng.choice([1, 2, 3, 4, 5, None]) for _ in range(n)]
        bins, want = [], []
        for size, s, c in zip(sizes, sources, clusters):
            fits = [(50 - sum(x[0] for x in b), k) for k, b in enumerate(bins)
                    if 50 - sum(x[0] for x in b) >= size and not any((s is not None and x[1] == s) or (c is not None and x[2] == c) for x in b)]
            k = min(fits)[1] if fits else len(bins)
            if not fits:
                bins.append([])
            bins[k].append((size, s, c))
            want.append(k)
        assert P.best_fit(sizes, sources, clusters, 50) == want


def test_odd_inputs(spark):
    rows = [(1, "a b c", "s", "x"), (2, "a b c", None, "x"), (3, None, None, "x"), (4, "", "s", "x"), (5, " \n", "s", "x"), (6, "w é " * 3000, "t", "x"), (7, "one", None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, bin_id string").repartition(3)
    check(P.pack(df, 10, 3).collect(), {r[0]: r[1] for r in rows}, 10)
    assert P.pack(df.limit(0)).count() == 0
    same = spark.createDataFrame([(1, "a b", "s")] * 9 + [(None, "a b", "s")], "doc_id bigint, text string, source string")
    out = P.pack(same).collect()
    assert len(out) == 10 and len({r["bin_id"] for r in out}) == 10
