"""Learned operators: held-out results, plain versions of the vectorised parts, odd inputs."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plain import auc
from tallyframe.llm import langid as L
from tallyframe.llm import quality as Q
from tallyframe.llm import toxicity as X

SF = "/root/testdata/sf0.1"


def outcome(spark, query, label):
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = query(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    y = np.array([labels[r["doc_id"]] for r in held])
    return y, np.array([r["score"] for r in held]), np.array([r["predicted"] for r in held])


def test_toxicity_held_out(spark):
    y, s, p = outcome(spark, X.op2_factorization_machine, "toxic")
    assert auc(y, s) > 0.95 and (p == y).mean() > 0.97 and p[y == 0].mean() < 0.02
    assert (p == (s >= 0.5)).all()


def test_quality_held_out(spark):
    y, s, p = outcome(spark, Q.op4_byte_convnet, "quality")
    assert auc(y, s) > 0.98 and (p == y).mean() > 0.97 and p[y == 1].mean() > 0.99
    assert (p == (s >= Q.THRESHOLD)).all()


def test_langid_held_out(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = L.op1_viterbi_langid(spark, SF).collect()
    assert len(rows) == len(docs) and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"] and docs[r["doc_id"]]["lang"] is not None]
    assert np.mean([r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held]) > 0.99


def test_machine_learns_a_pair_that_no_sum_of_weights_can(spark):
    """Label 1 exactly when both or neither of two words occur."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(600):
        a, b = rng.integers(0, 2, 2)
        rows.append((i, " ".join(["insultword"] * a + ["groupword"] * b + [f"fill{rng.integers(50)}" for _ in range(5)]), int(a and b or not a and not b)))
    x = np.array([["insultword" in t, "groupword" in t] for _, t, _ in rows], np.float32)
    y = np.array([v for *_, v in rows], np.float32)
    import pandas as pd
    part = pd.DataFrame({"ids": [list(range(600))], "ys": [y.astype(int).tolist()], "active": [[np.flatnonzero(v).tolist() for v in x]], "shard": [0]})
    start = {"w0": np.zeros(1, np.float32), "w": np.zeros(2, np.float32), "v": rng.normal(0, 0.3, (2, X.FACTORS)).astype(np.float32)}
    p = X._epochs(part, start, 0)
    assert ((X.machine(x, p) > 0) == y).mean() > 0.99


def test_machine_score_is_its_formula(spark):
    rng = np.random.default_rng(0)
    texts = pa.array(["some words insult group", None, "", "insult insult", "é ünder words " * 3000])
    found = np.unique(np.concatenate([t for _, _, _, t in X.terms(texts)]))
    buckets = found[::3].astype(np.int64)
    p = {"w0": np.array([0.3]), "w": rng.normal(size=len(buckets)), "v": rng.normal(size=(len(buckets), X.FACTORS)) * 0.2}
    dense = np.zeros((5, len(buckets)))
    for i, _, row, term in X.terms(texts, X._numbers(buckets)):
        dense[i + row, term] = 1
    want = 1 / (1 + np.exp(-X.machine(dense, p)))
    assert np.allclose(X.Model(buckets, p).score(texts, X._numbers(buckets)), want)


def direct(text, p):
    """The network written out for one text."""
    raw = (text or "").encode()
    sym = [b + (256 if any(k >= lag and (raw[k:k + 4] + b"\0" * 4)[:4] == (raw[k - lag:k - lag + 4] + b"\0" * 4)[:4] for lag in Q.LAGS) else 0) for k, b in enumerate(raw)] + [Q.PAD] * (Q.WIDTH + Q.STRIDE)
    n = max(1, -(-len(raw) // Q.STRIDE))
    r = np.array([np.maximum(p["bias"] + sum(p["filters"][i][sym[k * Q.STRIDE + i]] for i in range(Q.WIDTH)), 0) for k in range(n)])
    blocks = -(-n // Q.BLOCK)
    chunks = max(1, -(-(blocks - Q.CHUNK_BLOCKS) // Q.HOP_BLOCKS) + 1)
    pooled = np.array([r[c * Q.HOP_BLOCKS * Q.BLOCK:(c * Q.HOP_BLOCKS + Q.CHUNK_BLOCKS) * Q.BLOCK].max(0) for c in range(chunks)])
    return 1 / (1 + np.exp(-(pooled.mean(0) @ p["mean"] + pooled.max(0) @ p["top"] + p["b"][0])))


def test_network_is_its_definition_whatever_the_batch():
    rng = np.random.default_rng(1)
    p = Q.initial()
    p["top"] = rng.normal(size=Q.FILTERS).astype(np.float32)
    texts = ["", None, "a", "abcd abcd abcd", "This This This is é", "".join(chr(97 + x) for x in rng.integers(0, 26, 3001)), "x y z " * 900]
    alone = np.concatenate([Q.probability(pa.array([t], pa.string()), p) for t in texts])
    assert np.allclose(alone, [direct(t, p) for t in texts], atol=1e-5)
    assert np.allclose(alone, Q.probability(pa.array(texts, pa.string()), p), atol=1e-6)


def test_gradients_by_differences():
    rng = np.random.default_rng(2)
    p = {k: v.astype(np.float64) for k, v in Q.initial().items()}
    p["top"] = rng.normal(size=Q.FILTERS)
    raw = np.frombuffer(b"some text of no meaning " * 30, np.uint8)
    sym, first, windows = Q.symbols(raw, np.array([0, len(raw)]))
    text = sym[first[0] * Q.STRIDE:(first[0] + windows[0]) * Q.STRIDE + Q.WIDTH - Q.STRIDE]
    g = Q._gradients([text], np.array([1.0]), p)

    def loss(q):
        mean, top = Q.pooled(Q.responses(text, q), np.array([0]), np.array([len(Q.responses(text, q))]))
        return float(np.log1p(np.exp(-(mean @ q["mean"] + top @ q["top"] + q["b"][0])))[0])

    for name, at in [("filters", (2, text[6], 3)), ("filters", (0, text[0], 1)), ("bias", (5,)), ("mean", (2,)), ("top", (1,)), ("b", (0,))]:
        up, down = {k: v.copy() for k, v in p.items()}, {k: v.copy() for k, v in p.items()}
        up[name][at] += 1e-5
        down[name][at] -= 1e-5
        assert abs((loss(up) - loss(down)) / 2e-5 - g[name][at]) < 1e-3


def test_viterbi_is_the_best_labelling():
    rng = np.random.default_rng(0)
    sizes = [0, 1, 7, 3, 0, 12, 130]
    per_text = np.concatenate([[0], np.cumsum(sizes)])
    scores = rng.normal(0, 3, (per_text[-1], 3)).astype(np.float32)
    label = L.viterbi(scores, per_text, 4.0)
    for a, b in zip(per_text[:-1], per_text[1:]):
        if a == b:
            continue
        best = scores[a].astype(float)
        for t in range(a + 1, b):
            best = np.maximum(best, best.max() - 4.0) + scores[t]
        mine = scores[np.arange(a, b), label[a:b]].sum() - 4.0 * (np.diff(label[a:b].astype(int)) != 0).sum()
        assert abs(mine - best.max()) < 1e-3


def test_mixed_text_is_cut_into_spans(spark):
    words = {"xx": ["alpha", "beta", "gamma", "delta"], "yy": ["üben", "über", "ützen", "ündig"], "zz": ["жизнь", "слово", "город", "вода"]}
    rng = np.random.default_rng(0)
    text = lambda lang, n: " ".join(rng.choice(words[lang], n))
    train = spark.createDataFrame([(i, text(k, 30), k) for i, k in enumerate(list(words) * 20)] + [(99, None, "xx"), (98, "x", None)], "doc_id bigint, text string, lang string")
    model = L.learn(train)
    docs = [(1, text("xx", 20) + ". " + text("yy", 9)), (2, text("zz", 5)), (3, None), (4, ""), (5, "123 !!"), (6, "漢字"), (7, text("yy", 1)), (7, text("yy", 1))]
    got = {}
    for r in L.identify(spark.createDataFrame([(*d, "u", 0.5) for d in docs], "doc_id bigint, text string, lang_pred string, score double"), model).collect():
        got[r["doc_id"]] = r
    assert [s["lang"] for s in got[1]["spans"]] == ["xx", "yy"] and got[1]["lang_pred"] == "xx" and 0.5 < got[1]["score"] < 1
    first, second = got[1]["spans"]
    assert docs[0][1][second["start"]:second["end"]].split() == docs[0][1].split()[20:]
    assert got[2]["lang_pred"] == "zz" and got[7]["lang_pred"] == "yy" and got[6]["lang_pred"] in words
    assert all(got[k]["lang_pred"] == "und" and got[k]["score"] == 0 for k in (3, 4, 5))
    assert L.identify(train.limit(0), model).count() == 0


@pytest.mark.parametrize("n", [0, 6])
def test_classifiers_take_odd_rows(spark, n):
    rows = [(1, None, 1), (1, None, 1), (None, "x", 0), (3, "", 2), (4, "long " * 30000, 3), (5, "é\x00ß", 3)][:n]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score int")
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, None), (4, 0), (None, 1), (77, 1)], "doc_id bigint, quality int")
    for module in (Q, X):
        scored = module.score(docs, module.learn(docs, labels, "quality")).collect()
        assert len(scored) == n and all(0 <= r["score"] <= 1 for r in scored)
    assert Q.filter_documents(docs, Q.initial(), 0.0).count() == n
    assert docs.filter(F.lit(True)).count() == n
