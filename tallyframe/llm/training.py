"""Bounded labelled samples and data-parallel training by iterative parameter averaging."""

from __future__ import annotations

import pickle
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.session import materialize

#: Pieces of a training sample that are trained on side by side between two averages.
SHARDS = 8


def held_out(modulus: int, remainder: int):
    """Whether crc32 of doc_id as text leaves this remainder (false for a null id)."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus)) == remainder, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, keep=None) -> DataFrame:
    """(doc_id, shard, y, text) of about ``rows`` labelled documents at most, chosen by a hash of doc_id.

    Only the bounded list of chosen ids is broadcast; the texts are not shuffled.
    """
    marked = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    if keep is not None:
        marked = marked.filter(keep)
    marked = marked.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y"))
    total = marked.count()
    share = min(1 << 30, (rows << 30) // max(1, total))
    chosen = marked.filter(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 30)) < share)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(SHARDS)).cast("int").alias("shard"), "y", "text")


def average(sample: DataFrame, params: dict[str, np.ndarray], step: Callable[[pd.DataFrame, dict, int], dict], rounds: int) -> dict[str, np.ndarray]:
    """``rounds`` times: train on every shard from the current parameters, then average by row counts.

    The driver sees one set of parameters per shard, never rows.  ``sample`` (column ``shard``) is written once and reread.
    """
    rows = materialize(sample, "sample")
    for r in range(rounds):
        blob = pickle.dumps(params)

        def train(part: pd.DataFrame) -> pd.DataFrame:
            new = step(part, pickle.loads(blob), r)
            return pd.DataFrame({"shard": [int(part["shard"].iloc[0])], "n": [len(part)], "params": [pickle.dumps(new)]})

        parts = rows.groupBy("shard").applyInPandas(train, "shard int, n bigint, params binary").orderBy("shard").collect()
        if not parts:
            return params
        weight = sum(p["n"] for p in parts)
        trained = [(p["n"] / weight, pickle.loads(bytes(p["params"]))) for p in parts]
        params = {k: sum(w * t[k] for w, t in trained).astype(v.dtype) for k, v in params.items()}
    return params


class Adam:
    """Plain Adam updates on a dict of arrays."""

    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.params, self.rate, self.t = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def update(self, grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        scale = self.rate * np.sqrt(1 - 0.999 ** self.t) / (1 - 0.9 ** self.t)
        for k, g in grads.items():
            self.m[k] = (0.9 * self.m[k] + 0.1 * g).astype(g.dtype)
            self.v[k] = (0.999 * self.v[k] + 0.001 * g * g).astype(g.dtype)
            self.params[k] = (self.params[k] - scale * self.m[k] / (np.sqrt(self.v[k]) + 1e-8)).astype(g.dtype)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))
