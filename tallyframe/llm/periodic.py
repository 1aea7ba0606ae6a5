"""Periodic run detection by seed-and-extend on diagonals (operator 11).

A run is a stretch of consecutive words with smallest period q and at least max(LEAST, 4 q) words that cannot be extended.
On the diagonal of lag q (words q apart) such a run is a stretch of at least max(LEAST - q, 3 q) equal words: its guaranteed overlap.

1. Lags are taken in classes: 1 to 5, 6 to 18, 19 to 57 and so on.  The k-grams of a class have the minimum
   guaranteed overlap of its lags (k = 5, 18, 57, ...), which is also its greatest lag.  They are indexed per document; only words whose shorter grams repeat reach the
   next class.
2. Occurrence pairs of one k-gram are enumerated between neighbouring occurrences: as k is no less than the lag, the next occurrence
   of a gram within a run lies exactly one period on, so no other pair is needed and a word that fills a document makes as many pairs as it has words.
3. Pairs (seeds) are taken per lag from left to right, with the furthest place that the lag's diagonal is
   covered to; a seed within it only moves that place on, any other starts an extension.  What is covered, and one period more, is a run if it is long enough.

Words are compared by 64-bit hashes.  Everything is vectorised over a chunk of whole texts; a document never leaves its task.

Defined cases: null and empty texts have no words and no runs, and collapse to an empty text; repeated rows are treated alike; ties
between runs go to the smaller start, then the smaller period; an empty table gives no rows; ``collapse`` keeps extra columns and leaves texts
without a run (null too) as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import words as W

LEAST, EXPONENT = 6, 4
_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _seeds(key: np.ndarray, at: np.ndarray, low: int, high: int):
    """Neighbouring occurrences of equal keys at the ascending places ``at``: (place, lag) with low <= lag <= high, and which entries repeat."""
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    again = np.zeros(len(key), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    first = at[order[:-1][same]]
    lag = at[order[1:][same]] - first
    near = (lag >= low) & (lag <= high)
    return first[near], lag[near], again


def _extended(place: np.ndarray, lag: np.ndarray, k: int):
    """(start, length, period) of the stretches that seeds of k-grams cover, long enough for a run."""
    order = np.lexsort((place, lag))
    place, lag = place[order], lag[order]
    # a seed before the furthest covered place of its lag starts no extension of its own
    new = np.ones(len(place), bool)
    new[1:] = (lag[1:] != lag[:-1]) | (place[1:] >= place[:-1] + k)
    head = np.flatnonzero(new)
    furthest = place[np.concatenate([head[1:], [len(place)]]) - 1] + k if len(head) else place
    start, period = place[head], lag[head]
    length = furthest - start + period
    long = length >= np.maximum(LEAST, EXPONENT * period)
    return start[long], length[long], period[long]


def find_runs(h: np.ndarray, per_text: np.ndarray):
    """(text, start word, length, period) of all runs of consecutive texts, by text, start, period."""
    n = np.diff(per_text)
    stop = np.repeat(per_text[1:], n)
    owner = W.mix(np.repeat(np.arange(1, len(n) + 1, dtype=np.uint64), n))
    place = np.arange(len(h))
    longest = int(n.max()) if len(n) else 0
    found = [(np.zeros(0, np.int64),) * 3]
    low, k = 1, LEAST - 1
    gram, fits = owner.copy(), stop - place >= k
    for i in range(k):
        rest = max(len(h) - i, 0)
        gram[:rest] = W.mix(gram[:rest] * W._BASE + h[len(h) - rest:])
    while max(LEAST, EXPONENT * low) <= longest:
        at = np.flatnonzero(fits)
        first, lag, again = _seeds(gram[at], at, low, k)
        found.append(_extended(first, lag, k))
        low, wide = k + 1, 3 * (k + 1)
        # grams of the next class are made of four of this one, all of which must repeat in the text
        repeats = np.zeros(len(h) + wide, bool)
        repeats[at[again]] = True
        parts = (0, k, 2 * k, wide - k)
        fits = (stop - place >= wide) & np.logical_and.reduce([repeats[p:p + len(h)] for p in parts])
        at = np.flatnonzero(fits)
        if not len(at):
            break
        longer = np.zeros(len(at), np.uint64)
        for p in parts:
            longer = W.mix(longer * W._BASE + gram[at + p])
        gram = gram.copy()
        gram[at] = longer
        k = wide
    start, length, period = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    text = np.searchsorted(per_text, start, "right") - 1
    return text, start - per_text[text], length, period


def _collapsed(raw: np.ndarray, here: np.ndarray, start: np.ndarray, end: np.ndarray, per_text: np.ndarray, keep: np.ndarray) -> pa.Array:
    """Kept words of each text, joined by one blank."""
    data = raw[here[0]:here[-1]].copy()
    s, e = start[keep], end[keep]
    owner = np.repeat(np.arange(len(per_text) - 1), np.diff(per_text))[keep]
    follows = np.zeros(len(s), bool)
    follows[:-1] = owner[1:] == owner[:-1]
    data[e[follows]] = 0x20
    step = np.zeros(len(data) + 2, np.int8)
    step[s] += 1
    step[e + follows] -= 1
    kept = np.cumsum(step[:len(data)], dtype=np.int8).view(bool)
    size = np.bincount(owner, weights=e - s + follows, minlength=len(per_text) - 1).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(data[kept])]).cast(pa.string())


def _scan(column: pa.Array):
    """Per chunk of texts: first row, end row, words per text, runs, collapsed texts."""
    raw, off = W.buffers(column)
    for i, j in W.chunks(off):
        here = off[i:j + 1]
        h, start, end, per_text = W.words(raw, here, W.BLANK_SEPARATED, lower=False)
        text, s, length, period = find_runs(h, per_text)
        step = np.zeros(len(h) + 1, np.int64)
        np.add.at(step, per_text[text] + s + period, 1)
        np.add.at(step, per_text[text] + s + length, -1)
        keep = np.cumsum(step)[:-1] == 0
        offsets = np.searchsorted(text, np.arange(j - i + 1))
        runs = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (s, length, period)], ["start", "length", "period"]))
        yield i, j, np.diff(per_text), runs, _collapsed(raw, here, start, end, per_text, keep)


def repeated_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs [(start, length, period)] by start and period, collapsed (words outside repetitions, joined by one blank)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def scan(batches):
        for b in batches:
            for i, j, n, runs, collapsed in _scan(b.column("text")):
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, j - i), pa.array(n, pa.int64()), runs, collapsed], ["doc_id", "n_words", "runs", "collapsed"])

    return docs.select("doc_id", "text").mapInArrow(scan, f"doc_id {kind}, n_words bigint, runs {_RUNS}, collapsed string")


def collapse(docs: DataFrame) -> DataFrame:
    """All documents; those with a run with only the first period of each run."""
    def clean(batches):
        for b in batches:
            k = b.schema.get_field_index("text")
            for i, j, _, runs, collapsed in _scan(b.column(k)):
                part = b.slice(i, j - i)
                some = pa.compute.greater(pa.compute.list_value_length(runs), 0)
                yield part.set_column(k, b.schema.field(k), pa.compute.if_else(some, collapsed.cast(b.schema.field(k).type), part.column(k)))

    return docs.mapInArrow(clean, docs.schema)


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text) in which every tenth document, by the checksum of its doc_id, repeats a period up to its end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    marked = docs.select("doc_id", "text", h.alias("h"), g.alias("g")).withColumn("w", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))))
    n = F.size("w")
    placed = marked.withColumn("a", F.when(n > 0, F.col("g") % n)).withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))
    again = F.expr("array_join(transform(sequence(0, size(w) - 1), i -> w[int(if(i >= a, a + (i - a) % p, i))]), ' ')")
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), again).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_runs(planted(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","), r.period.cast("string"), F.lit("\n"))), "")
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return found.withColumn("best", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).cast("long").alias("exponent_milli"), digest(lines).alias("runs_sha256"), digest(F.col("collapsed")).alias("collapsed_sha256"))
