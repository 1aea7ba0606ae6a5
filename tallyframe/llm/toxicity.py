"""Toxicity by a factorization machine over hashed terms (operator 2).

Terms are the lower-cased words of a text and the byte 5-grams and 7-grams inside its words, hashed to BUCKETS values per kind.
From a bounded labelled sample, the terms whose presence depends most on the label are chosen (G statistic).  The machine

    f(x) = w0 + sum_j w_j x_j + 1/2 sum_f ((sum_j v_jf x_j)^2 - sum_j v_jf^2 x_j^2)

learns a weight per term and, through the factors v, every pairwise interaction of terms, such as an insult next to the mention of a
group; a sum of weights alone would miss it.  x_j is 1 if the text has the term, else 0.

The sample is bounded (TRAIN_ROWS), and only the chosen terms of its texts are brought together: one task trains on them, because averaging
the machines of several tasks weakens terms that few of them see.  Scoring is vectorised and reads whole texts.

Defined cases: null and empty texts have no terms and get the score of w0; rows without a label are not learnt from; without any label the
score is 0.5; equal rows get equal results; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import training as T
from tallyframe.llm import words as W

TRAIN_ROWS = 12000
BUCKETS = 1 << 20
GRAMS = (5, 7)
TERMS = 2048
FACTORS = 4
#: Passes over the sample, and updates at least (for small samples).
EPOCHS, LEAST_UPDATES = 30, 3000
LEAST_G = 12.0


def _grams(raw: np.ndarray, offsets: np.ndarray):
    """(bucket, text) of every word and in-word n-gram of consecutive texts; repeated pairs included."""
    base = offsets[0]
    h, start, end, per_text = W.words(raw, offsets, W.LETTER_DIGIT)
    yield (h >> np.uint64(44)).astype(np.int32), np.repeat(np.arange(len(offsets) - 1), np.diff(per_text))
    data = W._LOWER[raw[base:offsets[-1]]]
    inside = W.LETTER_DIGIT[data].copy()
    text_of_word = np.repeat(np.arange(len(offsets) - 1), np.diff(per_text))
    for kind, n in enumerate(GRAMS, 1):
        length = end - start - n + 1
        some = length > 0
        if not some.any():
            continue
        packed = np.zeros(len(data) - n + 1, np.uint64)
        for i in range(n):
            packed |= data[i:len(data) - n + 1 + i].astype(np.uint64) << np.uint64(8 * i)
        count = length[some]
        first = np.cumsum(count) - count
        at = np.arange(int(count.sum())) + np.repeat(start[some] - first, count)
        packed = packed[at] * np.uint64(0x9E3779B97F4A7C15)
        packed ^= packed >> np.uint64(29)
        packed *= np.uint64(0xBF58476D1CE4E5B9)
        yield (packed >> np.uint64(44)).astype(np.int32) + kind * BUCKETS, np.repeat(text_of_word[some], count)
    del inside


def terms(column: pa.Array, chosen: np.ndarray | None = None):
    """(row, term) pairs, distinct, per chunk; with ``chosen`` (bucket -> number or -1) only those."""
    raw, off = W.buffers(column)
    for i, j in W.chunks(off, 2 << 20):
        rows, buckets = [], []
        for bucket, text in _grams(raw, off[i:j + 1]):
            if chosen is not None:
                bucket = chosen[bucket]
                hit = bucket >= 0
                bucket, text = bucket[hit], text[hit]
            rows.append(text)
            buckets.append(bucket)
        span = (len(GRAMS) + 1) * BUCKETS
        pairs = np.unique(np.concatenate(rows).astype(np.int64) * span + np.concatenate(buckets))
        yield i, j, pairs // span, (pairs % span).astype(np.int32)


def choose_terms(sample: DataFrame, most: int = TERMS) -> np.ndarray:
    """Buckets whose presence depends most on the label, by the G statistic of the sample's 2x2 tables."""
    def count(batches):
        n = np.zeros((2, (len(GRAMS) + 1) * BUCKETS), np.int32)
        for b in batches:
            y = b.column("y").to_numpy()
            for i, _, row, bucket in terms(b.column("text")):
                for label in (0, 1):
                    np.add.at(n[label], bucket[y[i + row] == label], 1)
        used = np.flatnonzero(n.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(n[0, used], pa.int64()), pa.array(n[1, used], pa.int64())], ["bucket", "clean", "toxic"])

    totals = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n0, n1 = totals.get(0, 0), totals.get(1, 0)
    if not n0 or not n1:
        return np.zeros(0, np.int64)
    sums = sample.select("text", "y").mapInArrow(count, "bucket int, clean bigint, toxic bigint").groupBy("bucket").agg(F.sum("clean").alias("a"), F.sum("toxic").alias("b"))

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    n = float(n0 + n1)
    g = 2 * (part(a, (a + b) * (n0 / n)) + part(b, (a + b) * (n1 / n)) + part(n0 - a, (n - a - b) * (n0 / n)) + part(n1 - b, (n - a - b) * (n1 / n)))
    best = sums.withColumn("g", g).filter((F.col("a") + F.col("b") >= 3) & (F.col("g") >= LEAST_G)).orderBy(F.desc("g"), "bucket").limit(most)
    return np.array(sorted(r["bucket"] for r in best.collect()), np.int64)


def _numbers(buckets: np.ndarray) -> np.ndarray:
    table = np.full((len(GRAMS) + 1) * BUCKETS, -1, np.int16)
    table[buckets] = np.arange(len(buckets))
    return table


def machine(x: np.ndarray, p: dict[str, np.ndarray]) -> np.ndarray:
    """f(x) of the rows of a 0/1 matrix."""
    return p["w0"][0] + x @ p["w"] + 0.5 * ((x @ p["v"]) ** 2 - x @ (p["v"] ** 2)).sum(1)


def _epochs(part: pd.DataFrame, p: dict, r: int) -> dict:
    rows = sorted((i, y, tuple(a)) for ids, ys, lists in zip(part["ids"], part["ys"], part["active"]) for i, y, a in zip(ids, ys, lists))
    x = np.zeros((len(rows), len(p["w"])), np.float32)
    for row, (_, _, active) in enumerate(rows):
        x[row, np.asarray(active, np.int64)] = 1
    y = np.array([y for _, y, _ in rows], np.float32)
    rng, adam = np.random.default_rng(7), T.Adam(p, 0.01)
    batches = max(1, len(y) // 32)
    for _ in range(max(EPOCHS, -(-LEAST_UPDATES // batches))):
        for rows in np.array_split(rng.permutation(len(y)), batches):
            q, xs = adam.params, x[rows]
            inner = xs @ q["v"]
            d = (T.sigmoid(machine(xs, q)) - y[rows]).astype(np.float32) / len(rows)
            adam.update({"w0": np.array([d.sum()], np.float32), "w": xs.T @ d + 1e-4 * q["w"],
                         "v": xs.T @ (d[:, None] * inner) - q["v"] * (xs.T @ d)[:, None] + 1e-4 * q["v"]})
    return adam.params


class Model:
    def __init__(self, buckets: np.ndarray, params: dict[str, np.ndarray]):
        self.buckets, self.params = buckets, params

    def score(self, column: pa.Array, table: np.ndarray) -> np.ndarray:
        p, out = self.params, np.zeros(len(column))
        for i, j, row, term in terms(column, table):
            n = j - i
            first = np.zeros((n, 1 + 2 * FACTORS))
            both = np.concatenate([p["w"][term, None], p["v"][term], p["v"][term] ** 2], axis=1)
            np.add.at(first, row, both)
            out[i:j] = p["w0"][0] + first[:, 0] + 0.5 * (first[:, 1:1 + FACTORS] ** 2 - first[:, 1 + FACTORS:]).sum(1)
        return T.sigmoid(out)


def learn(docs: DataFrame, labels: DataFrame, label: str, keep=None, rows: int = TRAIN_ROWS) -> Model:
    """Fit on a bounded labelled sample; ``keep`` filters the label rows that may be learnt from."""
    sample = T.labelled_sample(docs, labels, label, rows, keep)
    buckets = choose_terms(sample)
    table = _numbers(buckets)
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def activate(batches):
        for b in batches:
            if not b.num_rows:
                continue
            active: list = [[] for _ in range(b.num_rows)]
            for i, _, row, term in terms(b.column("text"), shared.value):
                for r, t in zip((i + row).tolist(), term.tolist()):
                    active[r].append(t)
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([b.column("doc_id").to_pylist()]), pa.array([b.column("y").to_pylist()], pa.list_(pa.int32())), pa.array([active], pa.list_(pa.list_(pa.int32())))],
                                             ["shard", "ids", "ys", "active"])

    rng, prior = np.random.default_rng(1), sample.agg(F.coalesce(F.avg("y"), F.lit(0.5))).first()[0]
    params = {"w0": np.array([np.log(max(prior, 1e-3) / max(1 - prior, 1e-3))], np.float32), "w": np.zeros(len(buckets), np.float32), "v": rng.normal(0, 0.02, (len(buckets), FACTORS)).astype(np.float32)}
    kind = sample.schema["doc_id"].dataType.simpleString()
    active = sample.select("doc_id", "y", "text").mapInArrow(activate, f"shard int, ids array<{kind}>, ys array<int>, active array<array<int>>")
    return Model(buckets, T.average(active, params, _epochs, 1))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and the probability of label 1 for each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # TERMS x (FACTORS + 2) numbers
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        table = _numbers(shared.value.buckets)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(shared.value.score(b.column("text"), table), pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def op2_factorization_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = T.held_out(5, 0)
    model = learn(docs, labels, "toxic", keep=~out)
    return score(docs, model).select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
