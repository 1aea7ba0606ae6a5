"""Cross-tokenizer alignment against a plain version that encodes whole texts and makes every link."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import alignment as L

SF = "/root/testdata/sf0.01"


def plain_tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(L.A_PATH)
    t.encode_special_tokens = True
    return t, sentencepiece.SentencePieceProcessor(model_file=L.B_PATH)


def brute(docs):
    t, sp = plain_tokenizers()
    same = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in same} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in same)}

    def piece(i):
        x = sp.id_to_piece(i)
        return bytes([int(x[3:5], 16)]) if len(x) == 6 and x.startswith("<0x") else x.replace("▁", " ").encode()

    aligned, held = {}, defaultdict(set)
    for k, text in enumerate(docs):
        want = f" {text}".encode()
        a, b = t.encode(f" {text or ''}", add_special_tokens=False).ids, sp.encode(text or "")
        spelled = [[bytes(byte[c] for c in t.id_to_token(i)) for i in a], [piece(i) for i in b]]
        if not text or any(b"".join(x) != want for x in spelled):
            continue
        ends = [np.cumsum([len(x) for x in s]).tolist() for s in spelled]
        groups, i, j = [], 0, 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            x, y = ends[0].index(cut) + 1, ends[1].index(cut) + 1
            groups.append((a[i:x], b[j:y]))
            i, j = x, y
        links = Counter((x, y) for ga, gb in groups for x in ga for y in gb)
        for pair in links:
            held[pair].add(k)
        aligned[k] = (len(a), len(b), groups, links)
    top = defaultdict(int)
    for (a, _), found in held.items():
        top[a] = max(top[a], len(found))
    out = []
    for k in range(len(docs)):
        if k not in aligned:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = aligned[k]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((n_a, n_b, len(groups), sum(links.values()), sum(n for p, n in links.items() if len(held[p]) == top[p[0]]), sum(n * len(held[p]) for p, n in links.items()), text))
    return out


def run(frame):
    return [tuple(r) for r in L.align(frame).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups").orderBy("doc_id").collect()]


PARTS = ["a", "the", " ", "  ", "\n", "   ", "　", "é", "日本", "<s>", "<|endoftext|>", "x" * 30, "\t", "ж", "’ ", "🙂 ", "don't", "1234", " ̈", "=====", " " * 40, "\u0085 y", "Ā b", "   z"]


@pytest.mark.parametrize("entries", [2_000_000, 500])
def test_random_texts(spark, monkeypatch, entries):
    rng = random.Random(4)
    texts = ["".join(rng.choice(PARTS) + rng.choice(["", " "]) for _ in range(rng.randrange(0, 30))) for _ in range(300)]
    texts += [None, "", " ", "=" * 3000 + "a" * 900, "low ▁ line", "▁", *["the same text"] * 40, *["the same text, the same words"] * 20]
    monkeypatch.setattr(L, "BLOCK_ENTRIES", entries)
    monkeypatch.setattr(L, "PART_BLOCKS", 2)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3, "doc_id")
    want = brute(texts)
    assert [r[1:] for r in run(frame)] == want
    assert sum(w[0] == 0 for w in want) < 30


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    got = [tuple(r) for r in L.op13_pair_bitmaps(spark, SF).orderBy("doc_id").collect()]
    want = [(d["doc_id"], *w[:-1], w[-1] and hashlib.sha256(w[-1].encode()).hexdigest()) for d, w in zip(docs, brute([d["text"] for d in docs]))]
    assert got == want


def test_pair_counts(spark):
    texts = ["a cat and a dog", "a dog", "", None, "cats"]
    from tallyframe.session import materialize
    rows = materialize(L.index(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(2)))
    found = L.pair_counts(rows.filter("bucket is not null").withColumn("part", F.lit(0).cast("long"))).collect()
    got = {int(p): (int(d), int(n)) for r in found for p, d, n in zip(*(np.frombuffer(r[c], t) for c, t in (("pairs", "<u4"), ("docs", "<i8"), ("links", "<i8"))))}
    t, sp = plain_tokenizers()
    pair = (t.encode(" a", add_special_tokens=False).ids[0] << 16) + sp.encode("a")[0]
    assert got[pair] == (2, 3)


def test_bitmaps_round_trip():
    rng = np.random.default_rng(1)
    sizes = np.array([1, 40, 3, 64, 64])
    docs = np.concatenate([np.sort(rng.choice(64, n, replace=False)) for n in sizes])
    pairs, planes = np.array([7, 7, 9, 1 << 31, 3]), np.array([0, 1, 0, 2, 0])
    back = L.unpacked(*L.packed(pairs, planes, sizes, docs, 64), 64)
    assert all((x == y).all() for x, y in zip(back, (pairs, planes, sizes, docs)))


def test_odd_tables(spark):
    schema = "doc_id bigint, text string, block string, slot int, bucket int"
    rows = [(None, "one row", "b", 1, 2), (None, "one row", "b", 1, 2), (5, None, None, None, None)]
    got = run(spark.createDataFrame(rows, schema))
    assert [r[0] for r in got] == [None, None, 5] and got[0] == got[1] and got[0][5] == got[0][4] and got[2][1:] == (0, 0, 0, 0, 0, 0, "")
    assert run(spark.createDataFrame([], schema)) == []
