"""Conflict-constrained best-fit packing (operator 5).

Documents are cut into pieces of at most ``capacity`` words and packed into bins of that capacity.  Two pieces conflict, and never share
a bin, when they have the same source or belong to the same duplicate cluster (equal texts; a null source or text conflicts with nothing).

Bins are ordered by residual capacity and carry two bitmaps, of the sources and of the duplicate clusters they hold.  Pieces come largest
first; the search starts at the tightest bin that is large enough and walks to successors until a compatible one is found, else a new bin is opened.

Packing runs in independent groups of about GROUP pieces, dealt by a salted hash, so that hot sources and clusters are spread over all
groups, a group is bounded, and the loss is a few bins per group.

Defined cases: a text without words (null, empty, blank) is one piece of size 1; pieces of one document have the same source, so they
are in different bins; ties go by doc_id and place; repeated rows are packed each; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import words as W
from tallyframe.session import materialize

CAPACITY = 1024
GROUP = 4000


def pieces(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, source, cluster, piece, start_byte, end_byte, n_words, salt: every text cut into pieces of ``capacity`` words."""
    kind, source = docs.schema["doc_id"].dataType.simpleString(), docs.schema["source"].dataType.simpleString()
    names = ["doc_id", "source", "cluster", "piece", "start_byte", "end_byte", "n_words", "salt"]

    def cut(batches):
        for b in batches:
            raw, off = W.buffers(b.column("text"))
            for i, j in W.chunks(off):
                _, start, end, per_text = W.words(raw, off[i:j + 1], W.BLANK_SEPARATED)
                n = np.diff(per_text)
                count = np.maximum(1, -(-n // capacity))
                text = np.repeat(np.arange(j - i), count)
                piece = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
                size = np.minimum(capacity, n[text] - piece * capacity)
                base = (off[i:j] - off[i])[text]
                lo = np.zeros(len(text), np.int64)
                hi = np.zeros(len(text), np.int64)
                some = size > 0
                lo[some] = start[per_text[:-1][text[some]] + piece[some] * capacity] - base[some]
                hi[some] = end[per_text[:-1][text[some]] + piece[some] * capacity + size[some] - 1] - base[some]
                where = pa.array(text + i)
                yield pa.RecordBatch.from_arrays([b.column(c).take(where) for c in ("doc_id", "source", "cluster")]
                                                 + [pa.array(piece, pa.int32()), pa.array(lo), pa.array(hi), pa.array(size, pa.int64()), pa.array(text + i, pa.int64())], names)

    cluster = F.when(F.col("text").isNotNull() & (F.length("text") > 0), F.xxhash64("text"))
    return docs.select("doc_id", "source", cluster.alias("cluster"), "text").mapInArrow(
        cut, f"doc_id {kind}, source {source}, cluster bigint, piece int, start_byte bigint, end_byte bigint, n_words bigint, salt bigint")


def best_fit(sizes: list[int], sources: list, clusters: list, capacity: int) -> list[int]:
    """Bin of each piece, pieces taken in the given order."""
    source_bit = {s: 1 << k for k, s in enumerate(dict.fromkeys(s for s in sources if s is not None))}
    several = pd.Series(clusters, dtype="object").value_counts()
    cluster_bit = {c: 1 << k for k, c in enumerate(several.index[several > 1])}
    open_bins: list[tuple[int, int]] = []  # (residual, bin), ascending
    in_bin_sources: list[int] = []
    in_bin_clusters: list[int] = []
    out = []
    for size, source, cluster in zip(sizes, sources, clusters):
        s, c = source_bit.get(source, 0), cluster_bit.get(cluster, 0)
        at = bisect_left(open_bins, (size, -1))
        while at < len(open_bins) and (in_bin_sources[open_bins[at][1]] & s or in_bin_clusters[open_bins[at][1]] & c):
            at += 1
        if at < len(open_bins):
            residual, k = open_bins.pop(at)
        else:
            residual, k = capacity, len(in_bin_sources)
            in_bin_sources.append(0)
            in_bin_clusters.append(0)
        in_bin_sources[k] |= s
        in_bin_clusters[k] |= c
        if residual > size:
            insort(open_bins, (residual - size, k))
        out.append(k)
    return out


def pack(docs: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """bin_id, slot, doc_id, piece, start_byte, end_byte, n_words, source, cluster of every piece of (doc_id, text, source)."""
    cut = materialize(pieces(docs, capacity), "pieces")
    groups = max(1, -(-cut.count() // group))
    dealt = cut.withColumn("grp", F.pmod(F.xxhash64("doc_id", "cluster", "piece", "salt"), F.lit(groups)).cast("int"))
    kind, source = cut.schema["doc_id"].dataType.simpleString(), cut.schema["source"].dataType.simpleString()

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.assign(size=rows["n_words"].clip(lower=1)).sort_values(["size", "doc_id", "piece", "cluster", "salt"], ascending=[False, True, True, True, True], ignore_index=True)
        sources = [None if pd.isna(s) else s for s in rows["source"]]
        clusters = [None if pd.isna(c) else c for c in rows["cluster"]]
        bins = np.array(best_fit(rows["size"].tolist(), sources, clusters, capacity), np.int64)
        rows["bin_id"] = bins + (int(rows["grp"].iloc[0]) << 32)
        rows["slot"] = rows.groupby("bin_id").cumcount()
        return rows[["bin_id", "slot", "doc_id", "piece", "start_byte", "end_byte", "n_words", "source", "cluster"]]

    # clusters are hashes of 64 bits: kept as text in pandas, where a null would turn them into floats
    return (dealt.withColumn("cluster", F.col("cluster").cast("string")).groupBy("grp").applyInPandas(
        fill, f"bin_id bigint, slot int, doc_id {kind}, piece int, start_byte bigint, end_byte bigint, n_words bigint, source {source}, cluster string")
        .withColumn("cluster", F.col("cluster").cast("bigint")))


def op5_conflict_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source"))
