"""Benchmark decontamination with a generalised suffix automaton (operator 7).

The automaton of all normalised test items is built once on the driver from the benchmark table, whose size
is checked (``MAX_ITEM_WORDS`` words per automaton; a larger benchmark is cut into blocks of items and the
documents are matched against one automaton after the other).  Executors stream each document's words
through it, tracking the length of the longest suffix that occurs in an item.  A suffix of ``window`` words or
more means that its words lie inside a window of an item; items shorter than a window count as a whole.

Only maximal runs of words that occur in some item at all are streamed: outside such a run the matching
length is 0, and a run shorter than the shortest window cannot hold one.  Finding the runs is vectorised.

Defined cases: null or empty texts have no words and no hits; items without words give no window; equal items all
count; a null item_id is left out of the id list but its windows still hit; an empty benchmark hits nothing; extra columns are kept by
``decontaminate`` (its own columns are prefixed ``_dc_`` while it works).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import words as W

WINDOW = 10
MAX_ITEM_WORDS = 2_000_000


class Automaton:
    """Generalised suffix automaton over word numbers, with the items of each state's strings."""

    def __init__(self, window: int):
        self.window = window
        self.next, self.link, self.length = [{}], [-1], [0]
        self.ends: list[set[int]] = [set()]
        self.shortest = window
        self.short: dict[int, list[tuple[int, int]]] = {}

    def _state(self, length, nxt, link):
        self.next.append(nxt)
        self.link.append(link)
        self.length.append(length)
        self.ends.append(set())
        return len(self.length) - 1

    def _split(self, p, c, q):
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last, c):
        q = self.next[last].get(c)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
        cur = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p != -1 and c not in self.next[p]:
            self.next[p][c] = cur
            p = self.link[p]
        if p != -1:
            q = self.next[p][c]
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return cur

    def add(self, item: int, sequence: list[int]) -> None:
        last = 0
        for c in sequence:
            last = self._extend(last, c)

    def finish(self, items: list[tuple[int, list[int]]]) -> None:
        """Mark each state with the items that hold its strings, and where short items end."""
        for item, sequence in items:
            v = 0
            for c in sequence:
                v = self.next[v][c]
                u = v
                while u > 0 and item not in self.ends[u]:
                    self.ends[u].add(item)
                    u = self.link[u]
            if 0 < len(sequence) < self.window:
                self.shortest = min(self.shortest, len(sequence))
                while self.length[self.link[v]] >= len(sequence):
                    v = self.link[v]
                self.short.setdefault(v, []).append((len(sequence), item))

    def scan(self, sequence: list[int]) -> tuple[list[tuple[int, int]], set[int]]:
        """Hit spans [start, end) over ``sequence`` (merged) and the items with an occurring window."""
        nxt, link, length, window = self.next, self.link, self.length, self.window
        spans: list[list[int]] = []
        found: set[int] = set()
        v = matched = 0
        for i, c in enumerate(sequence):
            while v and c not in nxt[v]:
                v = link[v]
                matched = length[v]
            if c in nxt[v]:
                v = nxt[v][c]
                matched += 1
            hit = 0
            if matched >= window:
                hit = matched
                u = v
                while length[link[u]] >= window:
                    u = link[u]
                found |= self.ends[u]
            if self.short and matched:
                u = v
                while u > 0:
                    for n, item in self.short.get(u, ()):
                        if n <= matched:
                            found.add(item)
                            hit = max(hit, n)
                    u = link[u]
            if hit:
                lo = i + 1 - hit
                while spans and spans[-1][1] >= lo:
                    lo = min(lo, spans.pop()[0])
                spans.append([lo, i + 1])
        return [tuple(s) for s in spans], found


def build(benchmark: DataFrame, window: int = WINDOW, limit: int = MAX_ITEM_WORDS) -> list[tuple]:
    """Automata of the benchmark, in blocks of at most ``limit`` words: (sorted word hashes, automaton, item ids)."""
    blocks, items, ids, size = [], [], [], 0
    rows = benchmark.select(F.col("item_id").cast("string").alias("i"), "text").toLocalIterator(prefetchPartitions=False)
    for row in rows:
        raw, off = W.buffers(pa.array([row["text"]], pa.string()))
        h = W.words(raw, off, W.LETTER_DIGIT)[0]
        if not len(h):
            continue
        if size and size + len(h) > limit:
            blocks.append(_automaton(items, ids, window))
            items, ids, size = [], [], 0
        items.append(h)
        ids.append(row["i"])
        size += len(h)
    if items:
        blocks.append(_automaton(items, ids, window))
    return blocks


def _automaton(items, ids, window):
    vocabulary = np.unique(np.concatenate(items))
    a = Automaton(window)
    numbered = [(k, np.searchsorted(vocabulary, h).tolist()) for k, h in enumerate(items)]
    for k, sequence in numbered:
        a.add(k, sequence)
    a.finish(numbered)
    return vocabulary, a, ids


def _runs(known: np.ndarray, per_text: np.ndarray, shortest: int):
    """(text, start, end) of the runs of known words of at least ``shortest`` words, per text."""
    n = len(known)
    if not n:
        return []
    begins = known.copy()
    begins[1:] &= ~known[:-1]
    cut = per_text[:-1][per_text[:-1] < n]
    begins[cut] = known[cut]
    ends = known.copy()
    ends[:-1] &= ~known[1:]
    last = per_text[1:][per_text[1:] > 0] - 1
    ends[last] = known[last]
    s, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    keep = e - s >= shortest
    s, e = s[keep], e[keep]
    return zip((np.searchsorted(per_text, s, "right") - 1).tolist(), s.tolist(), e.tolist())


def scan_texts(column: pa.Array, blocks: list[tuple]):
    """Per text: (words, hit byte spans, hit words, item ids)."""
    raw, off = W.buffers(column)
    for i, j in W.chunks(off):
        h, start, end, per_text = W.words(raw, off[i:j + 1], W.LETTER_DIGIT)
        hits: dict[int, list] = {}
        for vocabulary, automaton, ids in blocks:
            at = np.searchsorted(vocabulary, h)
            at[at == len(vocabulary)] = 0
            known = vocabulary[at] == h
            for text, s, e in _runs(known, per_text, automaton.shortest):
                spans, found = automaton.scan(at[s:e].tolist())
                if spans:
                    mine = hits.setdefault(text, [[], []])
                    mine[0] += [(s + a, s + b) for a, b in spans]
                    mine[1] += [ids[k] for k in found]
        base = off[i:j + 1] - off[i]
        for t in range(j - i):
            n = int(per_text[t + 1] - per_text[t])
            if t not in hits:
                yield n, [], 0, []
                continue
            merged: list[list[int]] = []
            for s, e in sorted(hits[t][0]):
                if merged and s <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], e)
                else:
                    merged.append([s, e])
            spans = [(int(start[s] - base[t]), int(end[e - 1] - base[t])) for s, e in merged]
            # distinct (block, item) occurrences: an item id may repeat in the table
            yield n, spans, sum(e - s for s, e in merged), hits[t][1]


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, item_ids (sorted), spans (byte start, end, ... in the text)."""
    blocks = build(benchmark, window)
    shared = docs.sparkSession.sparkContext.broadcast(blocks)  # bounded by MAX_ITEM_WORDS per block, benchmark only
    kind = docs.schema["doc_id"].dataType.simpleString()

    def scan(batches):
        for b in batches:
            out = list(scan_texts(b.column("text"), shared.value))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([n for n, *_ in out], pa.int64()), pa.array([n for _, _, n, _ in out], pa.int64()),
                 pa.array([sorted(x for x in set(f) if x is not None) for *_, f in out], pa.list_(pa.string())),
                 pa.array([[x for s in sp for x in s] for _, sp, _, _ in out], pa.list_(pa.int64()))],
                ["doc_id", "n_words", "n_hit", "item_ids", "spans"])

    return docs.select("doc_id", "text").mapInArrow(scan, f"doc_id {kind}, n_words bigint, n_hit bigint, item_ids array<string>, spans array<bigint>")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = 0.5) -> DataFrame:
    """Documents without their hit spans; a document with more than ``max_coverage`` of its words hit goes."""
    blocks = build(benchmark, window)
    shared = docs.sparkSession.sparkContext.broadcast(blocks)
    schema = docs.schema

    def clean(batches):
        for b in batches:
            k = b.schema.get_field_index("text")
            texts, keep, out = b.column(k), [], []
            for row, (n, spans, hit, _) in enumerate(scan_texts(texts, shared.value)):
                if not hit:
                    keep.append(row)
                    out.append(texts[row].as_py())
                elif hit <= max_coverage * n:
                    raw, at, parts = texts[row].as_py().encode(), 0, []
                    for s, e in spans:
                        parts.append(raw[at:s])
                        at = e
                    keep.append(row)
                    out.append(b"".join([*parts, raw[at:]]).decode())
            kept = b.take(pa.array(keep, pa.int64()))
            yield kept.set_column(k, b.schema.field(k), pa.array(out, b.schema.field(k).type))

    return docs.mapInArrow(clean, schema)


def op7_suffix_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))
