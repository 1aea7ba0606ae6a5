"""Quality by a byte-level convolutional network in numpy (operator 4).

A text is a string of symbols: its UTF-8 bytes, each marked if the four bytes from there also began within the last LAGS
bytes (so that filters can see repetition).  FILTERS learned filters of WIDTH symbols move over the text in strides of
STRIDE.  Overlapping chunks of CHUNK windows (every HOP windows, to the end of the text) are max-pooled per filter after a
ReLU; the mean and the maximum of the chunks' pooled values are combined by a logistic unit into one probability.
Everything is learnt together by backpropagation through the pools, on a bounded labelled sample, averaging the parameters of pieces of it.

A filter over one-hot symbols is a table lookup per position, so scoring is WIDTH gathers and sums per window.

Defined cases: null and empty texts are one window of padding; rows without a label are not learnt from; without
labels the score is that of the untrained network; equal rows get equal results, whatever stands beside them in a batch; an
empty table gives no rows; extra columns are ignored (``filter_documents`` keeps them).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import training as T
from tallyframe.llm import words as W

TRAIN_ROWS = 4000
WIDTH, STRIDE, FILTERS = 8, 4, 16
BLOCK, CHUNK_BLOCKS, HOP_BLOCKS = 64, 4, 2
LAGS = range(3, 21)
PAD = 512
GAP = 28
ROUNDS, BATCH, RATE = 8, 16, 0.01
#: Updates of a shard between two averages at least (for small samples).
LEAST_UPDATES = 24
THRESHOLD = 0.3


def symbols(raw: np.ndarray, offsets: np.ndarray):
    """Symbols of consecutive texts with padding between them, and each text's first window and windows."""
    n = np.diff(offsets)
    windows = np.maximum(1, -(-n // STRIDE))
    room = windows * STRIDE + GAP
    begin = GAP + np.cumsum(room) - room
    total = int(GAP + room.sum() + WIDTH)
    data = np.zeros(total, np.uint8)
    owner_shift = np.repeat(begin - (offsets[:-1] - offsets[0]), n)
    at = np.arange(int(n.sum())) + owner_shift
    data[at] = raw[offsets[0]:offsets[-1]]
    padded = np.concatenate([data, np.zeros(4, np.uint8)]).astype(np.uint32)
    four = padded[:total] | (padded[1:total + 1] << np.uint32(8)) | (padded[2:total + 2] << np.uint32(16)) | (padded[3:total + 3] << np.uint32(24))
    seen = np.zeros(total, bool)
    for lag in LAGS:
        seen[lag:] |= four[lag:] == four[:-lag]
    out = np.full(total, PAD, np.int16)
    out[at] = data[at] + np.int16(256) * seen[at]
    return out, begin // STRIDE, windows


def responses(sym: np.ndarray, p: dict[str, np.ndarray]) -> np.ndarray:
    """ReLU of the filters at every window [windows, FILTERS]."""
    n = (len(sym) - WIDTH) // STRIDE + 1
    out = np.repeat(p["bias"][None, :], n, 0)
    for i in range(WIDTH):
        out += p["filters"][i][sym[i:i + (n - 1) * STRIDE + 1:STRIDE]]
    return np.maximum(out, 0, out=out)


def pooled(r: np.ndarray, first: np.ndarray, windows: np.ndarray):
    """Per text the mean and the maximum over its chunks of the chunks' maxima."""
    blocks = -(-windows // BLOCK)
    start = np.cumsum(blocks) - blocks
    place = np.arange(int(blocks.sum())) - np.repeat(start, blocks)
    lo = np.repeat(first, blocks) + place * BLOCK
    hi = np.minimum(lo + BLOCK, np.repeat(first + windows, blocks))
    edges = np.stack([lo, hi], 1).ravel()
    edges[-1] = min(edges[-1], len(r))
    guarded = np.concatenate([r, np.zeros((1, r.shape[1]), r.dtype)])
    block_max = np.maximum.reduceat(guarded, edges, axis=0)[::2]
    chunks = np.maximum(1, -(-(blocks - CHUNK_BLOCKS) // HOP_BLOCKS) + 1)
    c_start = np.cumsum(chunks) - chunks
    c_place = np.arange(int(chunks.sum())) - np.repeat(c_start, chunks)
    c_first, c_last = np.repeat(start, chunks), np.repeat(start + blocks - 1, chunks)
    chunk_max = block_max[np.minimum(c_first + c_place * HOP_BLOCKS, c_last)]
    for k in range(1, CHUNK_BLOCKS):
        chunk_max = np.maximum(chunk_max, block_max[np.minimum(c_first + c_place * HOP_BLOCKS + k, c_last)])
    mean = np.add.reduceat(chunk_max, c_start, axis=0) / chunks[:, None]
    return mean, np.maximum.reduceat(chunk_max, c_start, axis=0)


def probability(column: pa.Array, p: dict[str, np.ndarray]) -> np.ndarray:
    """Probability of label 1 of each whole text."""
    raw, off = W.buffers(column)
    out = np.zeros(len(column))
    for i, j in W.chunks(off, 1 << 20):
        sym, first, windows = symbols(raw, off[i:j + 1])
        mean, top = pooled(responses(sym, p), first, windows)
        out[i:j] = T.sigmoid(mean @ p["mean"] + top @ p["top"] + p["b"][0])
    return out


def initial(seed: int = 2) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    filters = rng.normal(0, 0.1, (WIDTH, PAD + 1, FILTERS)).astype(np.float32)
    filters[:, PAD] = 0
    return {"filters": filters, "bias": np.zeros(FILTERS, np.float32), "mean": rng.normal(0, 0.3, FILTERS).astype(np.float32),
            "top": np.zeros(FILTERS, np.float32), "b": np.zeros(1, np.float32)}


def _gradients(texts: list[np.ndarray], y: np.ndarray, p: dict) -> dict:
    """Backpropagation through logistic unit, pools, ReLU and filters for a few texts (as symbol strings)."""
    g = {k: np.zeros_like(v) for k, v in p.items()}
    for sym, label in zip(texts, y):
        r = responses(sym, p)
        blocks = -(-len(r) // BLOCK)
        chunks = max(1, -(-(blocks - CHUNK_BLOCKS) // HOP_BLOCKS) + 1)
        where = np.stack([c * HOP_BLOCKS * BLOCK + r[c * HOP_BLOCKS * BLOCK:(c * HOP_BLOCKS + CHUNK_BLOCKS) * BLOCK].argmax(0) for c in range(chunks)])
        value = r[where, np.arange(FILTERS)]
        best = value.argmax(0)
        mean, top = value.mean(0), value.max(0)
        d = np.float32((T.sigmoid(mean @ p["mean"] + top @ p["top"] + p["b"][0]) - label) / len(y))
        g["mean"] += d * mean
        g["top"] += d * top
        g["b"] += d
        back = np.repeat((d * p["mean"] / chunks)[None, :], chunks, 0)
        back[best, np.arange(FILTERS)] += d * p["top"]
        back = np.where(value > 0, back, 0).astype(np.float32)
        g["bias"] += back.sum(0)
        column = np.broadcast_to(np.arange(FILTERS), where.shape)
        for i in range(WIDTH):
            np.add.at(g["filters"][i], (sym[where * STRIDE + i], column), back)
    return g


def _epoch(part: pd.DataFrame, p: dict, r: int) -> dict:
    texts = []
    for text in part["text"]:
        raw = np.frombuffer(text.encode(), np.uint8)
        sym, first, windows = symbols(raw, np.array([0, len(raw)]))
        texts.append(sym[first[0] * STRIDE:(first[0] + windows[0]) * STRIDE + WIDTH - STRIDE])
    y = part["y"].to_numpy(np.float32)
    rng, adam = np.random.default_rng(100 * r + int(part["shard"].iloc[0])), T.Adam(p, RATE)
    batches = max(1, len(y) // BATCH)
    for _ in range(-(-LEAST_UPDATES // batches)):
        for rows in np.array_split(rng.permutation(len(y)), batches):
            adam.update(_gradients([texts[i] for i in rows], y[rows], adam.params))
    return adam.params


def learn(docs: DataFrame, labels: DataFrame, label: str, keep=None, rows: int = TRAIN_ROWS) -> dict[str, np.ndarray]:
    """Fit on a bounded labelled sample; ``keep`` filters the label rows that may be learnt from."""
    return T.average(T.labelled_sample(docs, labels, label, rows, keep), initial(), _epoch, ROUNDS)


def score(docs: DataFrame, params: dict[str, np.ndarray]) -> DataFrame:
    """doc_id and the probability of label 1 for each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(params)  # WIDTH x 513 x FILTERS numbers
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(probability(b.column("text"), shared.value), pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def filter_documents(docs: DataFrame, params: dict[str, np.ndarray], threshold: float = THRESHOLD) -> DataFrame:
    """All rows and columns of the documents whose score reaches the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(params)

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(probability(b.column("text"), shared.value) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def op4_byte_convnet(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = T.held_out(5, 0)
    params = learn(docs, labels, "quality", keep=~out)
    return score(docs, params).select("doc_id", out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
