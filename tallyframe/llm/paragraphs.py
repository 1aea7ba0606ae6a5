"""Substring dedup by paragraph MinHash banding (operator 8).

Paragraphs are compared as sets of 5-word shingles.  Two kinds are cut from every whole text:

* lines of at least LINE_WORDS words.  BANDS bands of ROWS MinHash values are tuned for recall at the similarity of 0.75
  (1 - (1 - 0.75 ** 2) ** 6 = 0.993); lines that collide in a band are joined into candidate groups, verified by their exact
  Jaccard similarity (on 32 bits of each shingle's hash), and the verified links are clustered by components;
* pieces of PIECE_WORDS words at content-chosen places (the smallest hash of each WINDOW consecutive
  places), whatever the line breaks.  Any run of PIECE_WORDS + WINDOW - 1 = 51 words that two
  texts share holds at least one common piece, so a passage of over 50 words is found wherever it was put in.

Equal pieces only show where to look: around each, all PIECE_WORDS-word windows are compared, so that the whole run that texts share
is found and not the pieces alone (no window of a shared run is WINDOW or more places from a common piece).

Of each cluster of lines the first occurrence (smallest doc_id, then place) is kept and the others are removed; then, of each
window, the first occurrence outside these lines is kept and later ones are removed.  So every word removed with a window is still
held in the same window of an earlier document, or where that one lost it, of one before; ``kept_doc_id`` names the holder of a span's first
words.  A line of which three quarters or more are removed goes as a whole, unless the rest is held for others.  Copies are classes of equal sets, counted and joined, never paired.

Defined cases: null and empty texts, and texts with fewer words than a piece and no long line, are left alone; equal rows (same
doc_id and text) count as one document and are treated alike; ties go to the smaller doc_id, null first; an empty
table gives no rows; extra columns are kept by ``remove`` (its own are prefixed ``_pd_``).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import words as W
from tallyframe.llm.components import components
from tallyframe.llm.jaccard import DEN, NUM, SHINGLE, commons, ragged, set_keys, similar, tile_links
from tallyframe.llm.sieve import sieve
from tallyframe.session import materialize, release_work, work_count

LINE_WORDS = 20
PIECE_WORDS, WINDOW = 20, 32
BANDS, ROWS = 6, 2
#: Bytes of text hashed at once; a worker's arrays are some forty times as large.
CHUNK = 1 << 20
WHOLE_LINE = 0.75
_MULTIPLIERS = W.mix(np.arange(1001, 1001 + BANDS * ROWS, dtype=np.uint64)) | np.uint64(1)


def _sliding(x: np.ndarray, best, fill) -> np.ndarray:
    """best over x[i .. i + WINDOW - 1] (WINDOW is a power of two; past the end: fill)."""
    span = 1
    while span < WINDOW:
        moved = np.full_like(x, fill)
        moved[:-span] = x[span:] if span < len(x) else fill
        x = best(x, moved)
        span *= 2
    return x


def anchors(h: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Places whose hash is the smallest of some WINDOW consecutive places of the same text (or of all, if fewer)."""
    if not len(h):
        return np.zeros(0, np.int64)
    n = np.diff(off)
    end = np.repeat(off[1:], n)
    place = np.arange(len(h))
    least = _sliding(h, np.minimum, np.uint64(0xFFFFFFFFFFFFFFFF))
    least[place + WINDOW > end] = 0
    for a, b in zip(off[:-1][(n > 0) & (n < WINDOW)].tolist(), off[1:][(n > 0) & (n < WINDOW)].tolist()):
        least[a] = h[a:b].min()
    # a place is chosen if a window that starts at most WINDOW - 1 places before has it as its minimum
    highest = _sliding(least[::-1].copy(), np.maximum, np.uint64(0))[::-1]
    return np.flatnonzero((highest == h) & (h > 0))


def line_bounds(raw: np.ndarray, offsets: np.ndarray, start: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Word offsets of all lines that have words (a line feed or the end of a text ends a line)."""
    breaks = np.flatnonzero(raw[offsets[0]:offsets[-1]] == 10)
    line = np.searchsorted(breaks, start)
    new = np.ones(len(start), bool)
    new[1:] = line[1:] != line[:-1]
    new[per_text[:-1][per_text[:-1] < len(start)]] = True
    return np.append(np.flatnonzero(new), len(start))


_UNITS = "d bigint, doc_id {}, kind int, start int, stop int, key bigint, n int, bands array<bigint>, shared binary"


def units(docs: DataFrame) -> DataFrame:
    """Lines (kind 0, with bands and tokens) and pieces (kind 1) of (d, doc_id, text), places in words of the text."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        for b in batches:
            raw, off = W.buffers(b.column("text"))
            for i, j in W.chunks(off, CHUNK):
                here = off[i:j + 1]
                h, start, _, per_text = W.words(raw, here, W.BLANK_SEPARATED)
                lines = line_bounds(raw, here, start, per_text)
                long = np.flatnonzero(np.diff(lines) >= LINE_WORDS) if len(h) else np.zeros(0, np.int64)
                size = np.diff(lines)[long] if len(h) else np.zeros(0, np.int64)
                line_off = np.concatenate([[0], np.cumsum(size)])
                at = np.arange(int(line_off[-1])) + np.repeat(lines[:-1][long] - line_off[:-1] if len(h) else size, size)
                tokens, t_off = W.shingles(h[at], line_off, SHINGLE)
                tokens >>= np.uint64(16)
                for x, y in zip(t_off[:-1].tolist(), t_off[1:].tolist()):
                    tokens[x:y].sort()
                new = np.ones(len(tokens), bool)
                new[1:] = tokens[1:] != tokens[:-1]
                new[t_off[:-1]] = True
                tokens, t_off = tokens[new], np.concatenate([[0], np.cumsum(new)])[t_off]
                keys = set_keys(tokens, t_off)
                bands = np.zeros((len(long), BANDS), np.uint64)
                if len(long):
                    for k in range(BANDS):
                        for r in range(ROWS):
                            least = np.minimum.reduceat(W.mix(tokens * _MULTIPLIERS[k * ROWS + r]), t_off[:-1])
                            bands[:, k] = bands[:, k] * np.uint64(0x9E3779B97F4A7C15) + least
                        bands[:, k] = W.mix(bands[:, k] + np.uint64(k))
                text = np.searchsorted(per_text, lines[:-1][long], "right") - 1 if len(long) else np.zeros(0, np.int64)
                short = (tokens >> np.uint64(16)).astype(np.uint32)
                blob = [short[x:y].tobytes() for x, y in zip(t_off[:-1].tolist(), t_off[1:].tolist())]
                where = pa.array(text + i)
                begin = (lines[:-1][long] - per_text[text]) if len(long) else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column("d").take(where), b.column("doc_id").take(where), pa.array(np.zeros(len(long)), pa.int32()), pa.array(begin, pa.int32()), pa.array(begin + size, pa.int32()),
                     pa.array(keys, pa.int64()), pa.array(np.diff(t_off), pa.int32()),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(long) + 1) * BANDS, pa.int32()), pa.array(bands.ravel().view(np.int64))), pa.array(blob, pa.binary())],
                    ["d", "doc_id", "kind", "start", "stop", "key", "n", "bands", "shared"])
                grams, g_off = _long_grams(h, per_text)
                chosen = anchors(grams, g_off)
                text = np.searchsorted(g_off, chosen, "right") - 1
                begin = chosen - g_off[text]
                where = pa.array(text + i)
                none = pa.nulls(len(chosen), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [b.column("d").take(where), b.column("doc_id").take(where), pa.array(np.ones(len(chosen)), pa.int32()), pa.array(begin, pa.int32()), pa.array(begin + PIECE_WORDS, pa.int32()),
                     pa.array(grams[chosen].view(np.int64)), pa.nulls(len(chosen), pa.int32()), pa.nulls(len(chosen), pa.list_(pa.int64())), none],
                    ["d", "doc_id", "kind", "start", "stop", "key", "n", "bands", "shared"])

    return docs.select("d", "doc_id", "text").mapInArrow(cut, _UNITS.format(kind))


def _long_grams(h: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all PIECE_WORDS-word windows; texts with fewer words have none."""
    n = np.diff(per_text)
    keep = n >= PIECE_WORDS
    size = np.where(keep, n, 0)
    grams, off = W.shingles(h[np.repeat(keep, n)], np.concatenate([[0], np.cumsum(size)]), PIECE_WORDS)
    return grams, off


def line_clusters(lines: DataFrame) -> DataFrame:
    """(node, root): line classes joined to a smaller class by verified similarity."""
    bands = lines.select("key", F.explode("bands").alias("band"))
    least = materialize(bands.groupBy("band").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).filter("lo <> hi").select(F.col("band").alias("b"), "lo"), "bands")
    bands = sieve(bands, "band", least, "b")
    near = components(bands.join(least, F.col("band") == F.col("b")).filter("key <> lo").select("key", "lo").distinct(), "key", "lo")
    groups = near.select(F.col("node").alias("k"), F.col("root").alias("group_id")).unionByName(
        near.select(F.col("root").alias("k"), F.col("root").alias("group_id")).distinct())
    members = (sieve(lines, "key", groups, "k").join(groups, F.col("key") == F.col("k")).groupBy("key", "group_id")
               .agg(F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("shared").alias("shared")))

    def verify(group: pd.DataFrame, split: int = 0):
        marks = np.stack(group["bands"].to_numpy())

        def collide(lo, hi, first, last):
            found = np.zeros((hi - lo, last - first), bool)
            for k in range(BANDS):
                found |= marks[lo:hi, k][:, None] == marks[first:last, k]
            return found

        return similar([np.unique(np.frombuffer(x, np.uint32)) for x in group["shared"]], group["n"].to_numpy(np.int64), lambda _: collide, None, split)

    def verify_pairs(rows: pd.DataFrame, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        ok = np.zeros(len(left), bool)
        if not len(left):
            return ok
        marks = np.stack(rows["bands"].to_numpy())
        mine = np.flatnonzero((marks[left] == marks[right]).any(axis=1))
        n = rows["n"].to_numpy(np.int64)
        common = commons(*ragged([np.unique(np.frombuffer(x, np.uint32)) for x in rows["shared"]]), left[mine], right[mine])
        ok[mine] = DEN * common >= NUM * (n[left[mine]] + n[right[mine]] - common)
        return ok

    return components(tile_links(members, "bands", ["n", "bands", "shared"], verify, verify_pairs), "a", "b")


_IN_GONE = "exists(gone, g -> g.start <= x.start and g.stop >= x.start + {})".format(PIECE_WORDS)


def _occurrences(rows: DataFrame, live, stop) -> DataFrame:
    """The first live occurrence of every key that occurs again (held) and all that come after it: d, start, stop, cluster, kept, held."""
    here = F.struct("doc_id", "d", "start")
    first = (rows.groupBy(F.col("key").alias("c")).agg(F.min(F.when(live, here)).alias("first"), F.max(here).alias("last"))
             .filter("last > first").select("c", "first"))
    return (rows.join(first, F.col("key") == F.col("c")).filter(here >= F.col("first")).withColumn("stop", stop)
            # an occurrence that overlaps the first one of its own text leaves that one whole
            .withColumn("start", F.when((F.col("d") == F.col("first.d")) & (here > F.col("first")), F.greatest("start", F.col("first.start") + PIECE_WORDS)).otherwise(F.col("start")))
            .filter("start < stop")
            .select("d", "start", "stop", F.col("c").alias("cluster"), F.col("first.doc_id").alias("kept"), ((F.col("d") == F.col("first.d")) & (F.col("start") == F.col("first.start"))).alias("held")))


def windows(docs: DataFrame, near: DataFrame) -> DataFrame:
    """(d, doc_id, start, key, live) of all PIECE_WORDS-word windows less than WINDOW places from one of ``near`` (d, places, gone).

    Windows within a removed line (gone) are left out; those that it cuts are not live.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        for b in batches:
            raw, off = W.buffers(b.column("text"))
            places, removed = b.column("places").to_pylist(), b.column("gone").to_pylist()
            for i, j in W.chunks(off, CHUNK):
                h, _, _, per_text = W.words(raw, off[i:j + 1], W.BLANK_SEPARATED)
                grams, g_off = _long_grams(h, per_text)
                step, gone = np.zeros(len(grams) + 1, np.int64), np.zeros(len(h) + 1, np.int64)
                for t in range(i, j):
                    lo, hi = g_off[t - i], g_off[t - i + 1]
                    at = np.array(places[t]) + lo
                    np.add.at(step, np.maximum(at - WINDOW + 1, lo), 1)
                    np.add.at(step, np.minimum(at + WINDOW, hi), -1)
                    for g in removed[t] or []:
                        gone[per_text[t - i] + g["start"]] += 1
                        gone[per_text[t - i] + g["stop"]] -= 1
                gone = np.concatenate([[0], np.cumsum(np.cumsum(gone)[:-1] > 0)])
                chosen = np.flatnonzero(np.cumsum(step)[:-1] > 0)
                text = np.searchsorted(g_off, chosen, "right") - 1
                word = chosen - g_off[text] + per_text[text]
                lost = gone[word + PIECE_WORDS] - gone[word]
                chosen, text, lost = (x[lost < PIECE_WORDS] for x in (chosen, text, lost))
                where = pa.array(text + i)
                yield pa.RecordBatch.from_arrays(
                    [b.column("d").take(where), b.column("doc_id").take(where), pa.array(chosen - g_off[text], pa.int32()), pa.array(grams[chosen].view(np.int64)), pa.array(lost == 0)],
                    ["d", "doc_id", "start", "key", "live"])

    hit = sieve(docs, "d", near, "d").join(near.withColumnRenamed("d", "_d"), F.col("d") == F.col("_d")).select("d", "doc_id", "text", "places", "gone")
    return hit.mapInArrow(cut, f"d bigint, doc_id {kind}, start int, key bigint, live boolean")


def runs(found: DataFrame) -> DataFrame:
    """Overlapping or adjoining spans of one kept document, held or not, as one span; its cluster is the first one's."""
    def join(batches):
        for b in batches:
            d, start, stop, held = (b.column(c).to_numpy(zero_copy_only=False) for c in ("d", "start", "stop", "held"))
            kept = b.column("kept").dictionary_encode().indices.fill_null(-1).to_numpy()
            new = np.ones(len(d), bool)
            new[1:] = (d[1:] != d[:-1]) | (held[1:] != held[:-1]) | (start[1:] > stop[:-1]) | (kept[1:] != kept[:-1])
            head = np.flatnonzero(new)
            take = pa.array(head)
            ends = np.maximum.reduceat(stop, head) if len(head) else stop
            yield pa.RecordBatch.from_arrays([b.column("d").take(take), b.column("start").take(take), pa.array(ends, pa.int32()), *(b.column(c).take(take) for c in ("cluster", "kept", "held"))],
                                             ["d", "start", "stop", "cluster", "kept", "held"])

    kind = found.schema["kept"].dataType.simpleString()
    return (found.repartition("d").sortWithinPartitions("d", "held", "start", "stop")
            .mapInArrow(join, f"d bigint, start int, stop int, cluster bigint, kept {kind}, held boolean"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Per document with repeats: d and its spans [(start word, stop word, cluster, kept doc_id, held)].

    Held spans are first occurrences, of which others are removed; the rest is removed.  Lines come first: what they remove can hold nothing.
    """
    spark, made = docs.sparkSession, work_count(docs.sparkSession)
    cut = materialize(units(docs), "units")
    lines, pieces = cut.filter("kind = 0"), cut.filter("kind = 1").select("d", "doc_id", "start", "key")
    root = line_clusters(lines.select("key", "n", "bands", "shared"))
    in_class = (lines.select("d", "doc_id", "start", "stop", "key").join(root, F.col("key") == F.col("node"), "left")
                .select("d", "doc_id", "start", "stop", F.coalesce("root", "key").alias("key")))
    of_lines = materialize(_occurrences(in_class, F.lit(True), F.col("stop")).distinct(), "lines")
    gone = materialize(of_lines.filter("not held").groupBy(F.col("d").alias("_g")).agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("gone")), "gone")
    several = materialize(pieces.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("key").alias("k")), "several")
    # pieces within removed lines are settled
    found = (sieve(pieces, "key", several, "k").join(several, F.col("key") == F.col("k")).groupBy("d", "doc_id").agg(F.collect_list(F.struct("start", "key")).alias("found"))
             .join(gone, F.col("d") == F.col("_g"), "left"))
    matched = materialize(found.select("d", "doc_id", F.inline(F.expr(f"filter(found, x -> gone is null or not {_IN_GONE})"))), "matched")
    here = F.struct("doc_id", "d", "start")
    again = matched.groupBy(F.col("key").alias("k")).agg(F.min(here).alias("first"), F.max(here).alias("last")).filter("first <> last").select("k")
    near = (matched.join(again, F.col("key") == F.col("k")).groupBy("d").agg(F.collect_set("start").alias("places"))
            .join(gone, F.col("d") == F.col("_g"), "left").select("d", "places", "gone"))
    near = materialize(near, "near")
    release_work(spark, made, ("lines", "gone", "matched", "near"))
    grams = materialize(windows(docs, near), "windows")
    often = materialize(grams.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("key").alias("k")), "often")
    spans = of_lines.unionByName(runs(_occurrences(sieve(grams, "key", often, "k"), F.col("live"), F.col("start") + PIECE_WORDS))).distinct()
    found = spans.groupBy("d").agg(F.sort_array(F.collect_list(F.struct("start", "stop", "cluster", "kept", "held"))).alias("spans"))
    found = materialize(found.filter("exists(spans, s -> not s.held)"), "spans")
    release_work(spark, made, ("spans",))
    return found


def with_row_hash(docs: DataFrame) -> DataFrame:
    return docs.withColumn("d", F.xxhash64("doc_id", "text"))


def merged(text: pa.Array, spans: pa.Array):
    """Per text: removed byte ranges [(start, end, words, cluster, kept)], after the whole-line rule; texts with spans are worked on many at once."""
    some = np.flatnonzero(pc.fill_null(pc.list_value_length(spans), 0).to_numpy(zero_copy_only=False) > 0)
    spans = spans.take(pa.array(some))
    raw, off = W.buffers(text.take(pa.array(some)))
    of = np.concatenate([[0], np.cumsum(pc.list_value_length(spans).to_numpy(zero_copy_only=False))]).astype(np.int64)
    flat = spans.flatten()
    begin, stop, held, cluster, kept_id = (flat.field(k) for k in ("start", "stop", "held", "cluster", "kept"))
    begin, stop, held = begin.to_numpy().astype(np.int64), stop.to_numpy().astype(np.int64), held.to_numpy(zero_copy_only=False)
    out: list[list] = [[] for _ in range(len(text))]
    for i, j in W.chunks(off, CHUNK):
        here = off[i:j + 1]
        start, end, per_text = W.places(raw, here, W.BLANK_SEPARATED)
        if not len(start):
            continue
        lo, hi = of[i], of[j]
        base = np.repeat(per_text[:-1], np.diff(of[i:j + 1]))
        marks = np.zeros((2, len(start) + 1), np.int32)
        np.add.at(marks, (held[lo:hi].astype(np.int64), base + begin[lo:hi]), 1)
        np.add.at(marks, (held[lo:hi].astype(np.int64), base + stop[lo:hi]), -1)
        gone, kept = np.cumsum(marks, axis=1)[:, :-1] > 0
        lines = line_bounds(raw, here, start, per_text)
        size = np.diff(lines)
        share = np.add.reduceat(gone.astype(np.int64), lines[:-1]) / size
        # words that are the only copy of what others have lost stay
        needed = np.add.reduceat((kept & ~gone).astype(np.int64), lines[:-1]) > 0
        gone |= np.repeat((share >= WHOLE_LINE) & ~needed, size)
        before, after = np.concatenate([[False], gone[:-1]]), np.concatenate([gone[1:], [False]])
        head = per_text[:-1][np.diff(per_text) > 0]
        before[head] = False
        after[head[1:] - 1] = False
        new, last = np.flatnonzero(gone & ~before), np.flatnonzero(gone & ~after)
        owner = np.searchsorted(per_text, new, "right") - 1
        for t, a, b in zip(owner.tolist(), new.tolist(), last.tolist()):
            x, y = int(of[i + t]), int(of[i + t + 1])
            mine = x + np.flatnonzero(~held[x:y])
            at = int(mine[min(int(np.searchsorted(begin[mine], a - int(per_text[t]))), len(mine) - 1)])
            zero = int(here[t] - here[0])
            out[int(some[i + t])].append((int(start[a]) - zero, int(end[b]) - zero, b + 1 - a, cluster[at].as_py(), kept_id[at].as_py()))
    yield from out


def removals(docs: DataFrame) -> DataFrame:
    """doc_id, start_byte, end_byte, n_words, cluster_id, kept_doc_id of every removed span."""
    marked = with_row_hash(docs.select("doc_id", "text"))
    spans = repeated_spans(marked)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def list_spans(batches):
        for b in batches:
            rows = [(i, *x) for i, found in enumerate(merged(b.column("text"), b.column("spans"))) for x in found]
            at, s, e, n, c, k = zip(*rows) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(at, pa.int64())), pa.array(s, pa.int64()), pa.array(e, pa.int64()), pa.array(n, pa.int64()), pa.array(c, pa.int64()), pa.array(k, b.column("doc_id").type)],
                                             ["doc_id", "start_byte", "end_byte", "n_words", "cluster_id", "kept_doc_id"])

    hit = sieve(marked, "d", spans, "d").join(spans.withColumnRenamed("d", "_d"), F.col("d") == F.col("_d")).select("doc_id", "text", "spans")
    return hit.mapInArrow(list_spans, f"doc_id {kind}, start_byte bigint, end_byte bigint, n_words bigint, cluster_id bigint, kept_doc_id {kind}")


def remove(docs: DataFrame) -> DataFrame:
    """All documents with their repeated spans cut out of the text; a document of which nothing but blanks is left goes."""
    keyed = docs.withColumn("_pd_d", F.xxhash64("doc_id", "text"))
    spans = repeated_spans(docs.select(F.xxhash64("doc_id", "text").alias("d"), "doc_id", "text")).select(F.col("d").alias("_pd_key"), F.col("spans").alias("_pd_spans"))
    joined = keyed.join(spans, F.col("_pd_d") == F.col("_pd_key"), "left").drop("_pd_d", "_pd_key")

    def clean(batches):
        for b in batches:
            k = b.schema.get_field_index("text")
            texts = b.column(k)
            keep, out = [], []
            for i, found in enumerate(merged(texts, b.column("_pd_spans"))):
                text = texts[i].as_py()
                if found:
                    raw, at, parts = text.encode(), 0, []
                    for s, e, *_ in found:
                        parts.append(raw[at:s])
                        at = e
                    text = b"".join([*parts, raw[at:]]).decode().strip()
                    if not text:
                        continue
                keep.append(i)
                out.append(text)
            kept = b.take(pa.array(keep, pa.int64())).drop_columns(["_pd_spans"])
            yield kept.set_column(kept.schema.get_field_index("text"), kept.schema.field("text"), pa.array(out, kept.schema.field("text").type))

    return joined.mapInArrow(clean, docs.schema)


def op8_paragraph_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removals(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
