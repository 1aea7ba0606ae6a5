"""Approximate nearest neighbours by an adaptive dimension scan inside inverted lists (operator 10).

Vectors are dealt to the lists of k-means centroids, which are fitted on a bounded sample of about ``SAMPLE`` vectors; every vector is
indexed.  A query probes its nearest lists; how many is calibrated on the sample against brute force.  Inside a
probed list the vectors, turned by a random rotation, are scanned in column blocks: after each block a hypothesis test
compares the partial distance, scaled up to all dimensions, with the current k-th distance, and abandons
candidates that are very unlikely to come closer (bound 1 + EPSILON / sqrt(dimensions seen)).  Survivors get
their exact distance on the original vectors in double precision.

Work is dealt by (list, candidate block, query block): a list with a third of all vectors is scanned by many tasks,
and no task holds more than about CANDIDATES vectors and QUERIES queries.

Defined cases: vectors that are null, zero, of another than the commonest dimension, or hold null, NaN or infinite
components take no part, nor do rows with a null id; rows that repeat an id count once (the smallest vector); ties go to the
smaller id; fewer candidates than k give fewer rows; an empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyframe.session import materialize

SAMPLE = 8192
MAX_LISTS = 1024
TARGET = 0.98
EPSILON = 2.1
COLUMNS = 16
CANDIDATES = 4096
QUERIES = 2048


def valid(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (array of double) of the rows that take part."""
    v = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).filter(
        "vec_id is not null and embedding is not null and size(embedding) > 0 and exists(embedding, x -> x <> 0)"
        " and not exists(embedding, x -> x is null or isnan(x) or abs(x) = double('infinity'))")
    v = v.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    return v


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * a @ b.T, 0)


def fit(sample: np.ndarray, lists: int, k: int, seed: int = 11) -> tuple[np.ndarray, int]:
    """Centroids and the number of lists to probe (smallest with mean recall >= TARGET on the sample)."""
    rng = np.random.default_rng(seed)
    lists = min(lists, len(sample))
    centroids = sample[rng.choice(len(sample), lists, replace=False)].copy()
    for _ in range(10):
        near = _distances(sample, centroids).argmin(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, sample)
        n = np.bincount(near, minlength=lists)
        centroids[n > 0] = sums[n > 0] / n[n > 0, None]
    near = _distances(sample, centroids).argmin(1)
    asked = rng.choice(len(sample), min(256, len(sample)), replace=False)
    d = _distances(sample[asked], sample)
    d[np.arange(len(asked)), asked] = np.inf
    top = np.argsort(d, 1)[:, :min(k, len(sample) - 1)]
    if not top.size:
        return centroids, lists
    place = np.argsort(np.argsort(_distances(sample[asked], centroids), 1), 1)
    needed = np.sort(place[np.arange(len(asked))[:, None], near[top]].ravel()) + 1
    return centroids, int(needed[min(len(needed) - 1, math.ceil(TARGET * len(needed)) - 1)])


def scan(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, rotation: np.ndarray, k: int):
    """Per query its k nearest of ``vectors`` by (distance, id): rows (query position, id, distance)."""
    dims = vectors.shape[1]
    turned, asked = vectors @ rotation, queries @ rotation
    edges = list(range(0, dims, COLUMNS)) + [dims]
    blocks = [np.ascontiguousarray(turned[:, a:b]) for a, b in zip(edges, edges[1:])]
    out_q, out_id, out_d = [], [], []
    for q in range(len(queries)):
        best_d, best_id, radius = np.zeros(0), np.zeros(0, ids.dtype), np.inf
        for lo in range(0, len(ids), 512):
            alive = lo + np.flatnonzero(ids[lo:lo + 512] != query_ids[q])
            partial = np.zeros(len(alive))
            for block, a, b in zip(blocks, edges, edges[1:]):
                x = block[alive] - asked[q, a:b]
                partial += np.einsum("ij,ij->i", x, x)
                if np.isfinite(radius):
                    bound = radius * radius * (b / dims) * ((1 + EPSILON / math.sqrt(b)) ** 2 if b < dims else 1 + 1e-9)
                    keep = partial <= bound
                    alive, partial = alive[keep], partial[keep]
                if not len(alive):
                    break
            if not len(alive):
                continue
            x = vectors[alive] - queries[q]
            best_d = np.concatenate([best_d, np.sqrt((x * x).sum(1))])
            best_id = np.concatenate([best_id, ids[alive]])
            order = np.lexsort((best_id, best_d))[:k]
            best_d, best_id = best_d[order], best_id[order]
            if len(best_d) == k:
                radius = best_d[-1]
        out_q.append(np.full(len(best_d), q))
        out_id.append(best_id)
        out_d.append(best_d)
    return np.concatenate(out_q), np.concatenate(out_id), np.concatenate(out_d)


def search(vectors: DataFrame, is_query, k: int = 10, seed: int = 11) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for every row that satisfies ``is_query``."""
    spark = vectors.sparkSession
    rows = materialize(valid(vectors), "vectors")
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    sizes = rows.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    if sizes is None:
        return empty
    dims, total = sizes["d"], sizes["n"]
    rows = rows.filter(F.size("embedding") == dims)
    draw = F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(1 << 30))
    share = min(1 << 30, (SAMPLE << 30) // total)
    sample = rows.filter(draw < share).select("vec_id", "embedding").orderBy("vec_id").toArrow()
    lists = min(MAX_LISTS, max(1, 1 << round(math.log2(max(1.0, math.sqrt(total) / 4)))))
    points = _matrix(sample.column("embedding").combine_chunks(), dims) if sample.num_rows else np.zeros((1, dims))
    centroids, probes = fit(points, lists, k, seed)
    rotation = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))[0]
    shared = spark.sparkContext.broadcast((centroids, rotation))  # MAX_LISTS x dims and dims x dims numbers

    def deal(batches):
        for b in batches:
            near = _distances(_matrix(b.column("embedding"), dims), shared.value[0]).argmin(1)
            yield pa.RecordBatch.from_arrays([pa.array(near, pa.int32()), b.column("vec_id"), b.column("embedding")], ["list", "vec_id", "embedding"])

    dealt = materialize(rows.mapInArrow(deal, "list int, vec_id bigint, embedding array<double>"), "lists")
    count = np.zeros(len(centroids), np.int64)
    for r in dealt.groupBy("list").agg(F.count("*").alias("n")).collect():  # one row per list
        count[r["list"]] = r["n"]
    blocks = np.maximum(1, -(-count // CANDIDATES))
    asked = dealt.filter(is_query).select("vec_id", "embedding")
    q_blocks = max(1, -(-asked.count() // QUERIES))

    def probe(batches):
        for b in batches:
            order = np.argsort(_distances(_matrix(b.column("embedding"), dims), shared.value[0]), 1, kind="stable")
            reach = np.cumsum(count[order], 1)
            n = np.maximum(probes, (reach <= 4 * k).sum(1) + 1)
            row, lst = [], []
            for i in range(len(order)):
                chosen = order[i, :n[i]]
                row.append(np.full(len(chosen), i))
                lst.append(chosen[count[chosen] > 0])
                row[-1] = row[-1][:len(lst[-1])]
            row, lst = (np.concatenate(row), np.concatenate(lst)) if row else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            times = blocks[lst]
            at = np.repeat(row, times)
            block = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(lst, times), pa.int32()), pa.array(block, pa.int32()), b.column("vec_id").take(pa.array(at)), b.column("embedding").take(pa.array(at))],
                                             ["list", "block", "query_id", "embedding"])

    n_blocks = F.element_at(F.array(*[F.lit(int(x)) for x in blocks]), F.col("list") + 1)
    candidates = (dealt.withColumn("block", F.pmod(F.xxhash64("vec_id"), n_blocks).cast("int"))
                  .withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1)))))
    probing = asked.mapInArrow(probe, "list int, block int, query_id bigint, embedding array<double>").withColumn("q_block", F.pmod(F.xxhash64("query_id"), F.lit(q_blocks)).cast("int"))

    def scan_group(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        left = left.sort_values("vec_id")
        asked_ids = right["query_id"].to_numpy()
        q, ids, d = scan(np.stack(right["embedding"].to_numpy()), asked_ids, np.stack(left["embedding"].to_numpy()), left["vec_id"].to_numpy(), shared.value[1], k)
        return pd.DataFrame({"query_id": asked_ids[q], "vec_id": ids, "score": d})

    key = ["list", "block", "q_block"]
    found = candidates.groupBy(*key).cogroup(probing.groupBy(*key)).applyInPandas(scan_group, "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)
