"""Periodic runs against their definition."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tallyframe.llm import periodic as P

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def is_smallest(w, q):
    return not any(all(w[i] == w[i + p] for i in range(len(w) - p)) for p in range(1, q))


def brute(w):
    number = {}
    a, out = np.array([number.setdefault(x, len(number)) for x in w], int), []
    for q in range(1, len(w) // 4 + 1):
        step = np.diff(np.concatenate([[0], (a[:-q] == a[q:]).astype(int), [0]]))
        for s, e in zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist()):
            if e - s + q >= max(6, 4 * q) and is_smallest(w[s:e + q], q):
                out.append((s, e - s + q, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def random_text(rng):
    if rng.random() < 0.15:
        return rng.choice([None, "", " \n"])
    out = []
    for _ in range(rng.randrange(1, 6)):
        if rng.random() < 0.5:
            out += [rng.choice("abcAé") for _ in range(rng.randrange(0, 40))]
        else:
            base = [rng.choice(rng.choice(["ab", "abcdefgh"])) for _ in range(rng.choice([1, 2, 3, 4, 5, 6, 7, 9, 13, 18, 19, 20, 40, 57, 58, 70]))]
            out += (base * 12)[:len(base) * rng.randrange(1, 9) + rng.randrange(0, len(base) + 1)]
    return rng.choice(["", "  ", "\n"]) + "".join(x + rng.choice([" ", "\n", " \t"]) for x in out)


@pytest.mark.parametrize("chunk", [1 << 20, 200])
def test_random_texts(monkeypatch, chunk):
    monkeypatch.setattr(P.W, "CHUNK", chunk)
    monkeypatch.setattr(P.W.chunks, "__defaults__", (chunk,))
    rng, some = random.Random(3), 0
    for _ in range(150):
        texts = [random_text(rng) for _ in range(rng.randrange(0, 6))]
        got = [x for _, _, n, runs, out in P._scan(pa.array(texts, pa.string())) for x in zip(n.tolist(), runs.to_pylist(), out.to_pylist())]
        assert len(got) == len(texts)
        for text, (n, runs, out) in zip(texts, got):
            w = WORD.findall(text or "")
            want = brute(w)
            some += len(want)
            assert (n, [tuple(r.values()) for r in runs], out) == (len(w), want, collapsed(w, want))
    assert some > 200


def test_one_word_and_structured_texts():
    thue = "a"
    for _ in range(13):
        thue = "".join("ab" if c == "a" else "ba" for c in thue)
    fib = ["a", "ab"]
    while len(fib[-1]) < 3000:
        fib.append(fib[-1] + fib[-2])
    texts = [" ".join(thue), " ".join(fib[-1][:1500]), "x " * 50000, " ".join(["y"] * 5), " ".join(["y"] * 6)]
    got = [[tuple(r.values()) for r in runs] for _, _, _, rows, _ in P._scan(pa.array(texts)) for runs in rows.to_pylist()]
    assert got[0] == [] and got[1] == brute(list(fib[-1][:1500])) and got[2] == [(0, 50000, 1)] and got[3] == [] and got[4] == [(0, 6, 1)]


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r["doc_id"]: tuple(r)[1:] for r in P.op11_periodic_runs(spark, SF).collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = {}
    for d in docs:
        w = WORD.findall(d["text"] or "")
        n, h = len(w), zlib.crc32(str(d["doc_id"]).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = brute(w)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
        want[d["doc_id"]] = (len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapsed(w, runs)))
    assert got == want and sum(v[0] > 0 for v in want.values()) > 50


def test_collapse_keeps_columns_and_other_texts(spark):
    rows = [(1, "a  b a b a b a b\nc", "x", 1), (2, " as  it\tis ", None, 2), (None, None, "y", 3), (3, "", "z", 4), (2, " as  it\tis ", None, 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, runs string, n_words int")
    assert sorted(map(tuple, P.collapse(docs).collect()), key=repr) == sorted([(1, "a b c", "x", 1), *rows[1:]], key=repr)
    assert P.collapse(docs.limit(0)).count() == 0 and P.repeated_runs(docs.limit(0)).count() == 0
