"""N-gram Jaccard join with prefix filters under several global orders (operator 3).

Two documents link when the Jaccard similarity of their sets of 5-word shingles is at least 75 / 100.

1. ``signatures``: one pass hashes each document's set; equal sets form a class (copies are never paired).
2. ``records``: a second pass deals the distinct sets' tokens to token buckets in packed arrays, where every token's
   document frequency is counted exactly, and the frequencies go back to the sets.  Tokens of more than
   1 / HOT_SHARE of all documents are known from the first pass (a bounded list) and not dealt.
3. Prefix filter: a set of n tokens must share one of the first n - ceil(0.75 n) + 1 tokens with any partner, under ANY order of
   all tokens.  Three orders are used: rarest first; frequency bands, then a hash; a second hash alone.  Tokens of one
   set only come first in each and never match, so most sets drop out here.
4. Near copies first: every set is verified against the smallest set with one of its LEADS first tokens under the third order
   (one pair a set, whatever the size of the family).  Sets that these links join are one cluster from here on.
5. Clusters that share prefix tokens under the first order are joined to candidate groups (components over
   token stars, no pairs are made); a token of one cluster only is settled, and so is a set all of whose prefix tokens are.
   Inside a group, candidates are sets of different clusters that share prefix tokens under all three orders
   (the filters are intersected); these are verified on the whole sets.  A group is cut into tiles of TILE sets;
   only pairs of tiles that share a prefix token are compared, each in its own task, a strip of sets at a time.  Tiles return a
   spanning forest of their links.
6. Components of the links give the classes.

Inside one very large group whose sets step 4 does not join, the tiles still grow with the square of the group's distinct sets / TILE; they
are spread over tasks and send back links in proportion to the sets.  Sets are told apart by 64-bit hashes, tokens by
48 bits of theirs.

Defined cases: documents without words (null, empty, blank) have n_shingles 0 and link with nothing; fewer than five words
make one shingle; copies and ties get the smallest doc_id as component_id; a null doc_id is carried, and named only by its partners;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import words as W
from tallyframe.llm.components import components
from tallyframe.llm.sieve import sieve
from tallyframe.session import materialize

SHINGLE = 5
NUM, DEN = 75, 100
#: A token is hot when it occurs in more than max(HOT_LEAST, documents / HOT_SHARE) documents; there are at most
#: HOT_SHARE x mean set size such tokens, whatever the number of documents.
HOT_SHARE, HOT_LEAST = 2000, 256
BUCKET_TOKENS = 2_000_000
#: Tokens dealt to the buckets at once: the more, the fewer rows (one for each bucket and time).
DEAL_TOKENS = 1_500_000
LEADS = 2
#: Sets of a tile, and of the strip of a tile that is compared at once.
TILE, STRIP = 4096, 512
#: A token that more than one in DENSE sets of a comparison hold is counted by products of 0/1 matrices, another by its pairs of sets.
DENSE = 12
#: Groups of at most SMALL sets are compared many at once, CALL_ROWS sets a call; larger ones one by one.
SMALL, CALL_ROWS = 16, 2048
#: Elements compared at once.
SLICE = 1 << 20
#: Ranks of hot tokens start here.
LATE = 1 << 31
_SALTS = (np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344), np.uint64(0xA4093822299F31D0))


def shingle_sets(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 48-bit shingle hashes of consecutive texts, and offsets per text."""
    h, _, _, per_text = W.words(raw, offsets, W.BLANK_SEPARATED)
    tokens, off = W.shingles(h, per_text, SHINGLE)
    tokens >>= np.uint64(16)
    for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
        tokens[a:b].sort()
    new = np.ones(len(tokens), bool)
    new[1:] = tokens[1:] != tokens[:-1]
    new[off[:-1][off[:-1] < len(tokens)]] = True
    return tokens[new], np.concatenate([[0], np.cumsum(new)])[off]


def set_keys(tokens: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One hash per set (sums of mixed tokens; order plays no part)."""
    n = np.diff(off)
    sums = np.zeros(len(n), np.uint64)
    some = n > 0
    if some.any():
        sums[some] = np.add.reduceat(W.mix(tokens + np.uint64(1)), off[:-1][some])
    return W.mix(sums + n.astype(np.uint64)).view(np.int64)


def signatures(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns ``carry``, n_shingles, key per document; besides, rows with tokens and counts: tokens that repeat within a batch."""
    named = ["doc_id", *carry]
    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in named)

    def sign(batches):
        seen: set[int] = set()
        for b in batches:
            raw, off = W.buffers(b.column("text"))
            sizes, keys, fresh = [], [], []
            for i, j in W.chunks(off):
                tokens, at = shingle_sets(raw, off[i:j + 1])
                k = set_keys(tokens, at)
                new = np.zeros(j - i, bool)
                for x, key in enumerate(k.tolist()):
                    if key not in seen:
                        seen.add(key)
                        new[x] = True
                fresh.append(tokens[np.repeat(new, np.diff(at))])
                sizes.append(np.diff(at))
                keys.append(k)
            n, key = np.concatenate(sizes or [np.zeros(0, np.int64)]), np.concatenate(keys or [np.zeros(0, np.int64)])
            fresh = np.concatenate(fresh) if fresh else np.zeros(0, np.uint64)
            fresh.sort()
            starts = np.flatnonzero(np.concatenate([[True], fresh[1:] != fresh[:-1]])) if len(fresh) else np.zeros(0, np.int64)
            times = np.diff(np.concatenate([starts, [len(fresh)]]))
            often = times >= 2
            ids = [pa.concat_arrays([b.column(c), pa.nulls(1, b.column(c).type)]) for c in named]
            none = [None] * len(n)
            yield pa.RecordBatch.from_arrays(
                [*ids, pa.array([*n.tolist(), 0], pa.int64()), pa.array([*(k if m else None for k, m in zip(key.tolist(), n.tolist())), None], pa.int64()),
                 pa.array([*none, fresh[starts[often]].astype(np.int64)], pa.list_(pa.int64())), pa.array([*none, times[often]], pa.list_(pa.int64()))],
                [*named, "n_shingles", "key", "tokens", "counts"])

    return docs.select(*named, "text").mapInArrow(sign, f"{kinds}, n_shingles bigint, key bigint, tokens array<bigint>, counts array<bigint>")


def _six(tokens: np.ndarray) -> bytes:
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _eight(blob: bytes) -> np.ndarray:
    out = np.zeros((len(blob) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(blob, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


_PACKED = "bucket int, kind int, keys binary, counts binary, tokens binary, numbers binary"


def _pack(bucket: np.ndarray, owner: np.ndarray, tokens: np.ndarray, numbers: np.ndarray | None, keys: np.ndarray):
    """Rows (bucket, 0, keys, tokens per key, tokens, numbers) of tokens sorted by (bucket, owner)."""
    order = np.argsort(bucket.astype(np.uint16) if len(bucket) and bucket.max() < 1 << 16 else bucket, kind="stable")
    bucket, owner, tokens = bucket[order], owner[order], tokens[order]
    numbers = numbers[order].astype(np.uint32) if numbers is not None else None
    if not len(bucket):
        return
    first = np.concatenate([[True], bucket[1:] != bucket[:-1]])
    heads = np.flatnonzero(first | np.concatenate([[True], owner[1:] != owner[:-1]]))
    mine, counts = keys[owner[heads]], np.diff(np.append(heads, len(bucket))).astype(np.uint32)
    six, cut = _six(tokens), np.flatnonzero(first)
    at = np.append(np.searchsorted(heads, cut), len(heads)).tolist()
    for i, (x, a, b) in enumerate(zip(bucket[cut].tolist(), cut.tolist(), [*cut[1:].tolist(), len(bucket)])):
        yield (x, 0, mine[at[i]:at[i + 1]].tobytes(), counts[at[i]:at[i + 1]].tobytes(), six[6 * a:6 * b], None if numbers is None else numbers[a:b].tobytes())


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
    columns = list(zip(*rows)) if rows else [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["bucket", "kind", "keys", "counts", "tokens", "numbers"])


def _unpack(rows: pd.DataFrame):
    """keys per entry, tokens per entry, tokens, numbers of packed rows; later entries of a key are dropped."""
    keys = np.concatenate([np.frombuffer(x, np.int64) for x in rows["keys"]] or [np.zeros(0, np.int64)])
    counts = np.concatenate([np.frombuffer(x, np.uint32) for x in rows["counts"]] or [np.zeros(0, np.uint32)]).astype(np.int64)
    tokens = np.concatenate([_eight(x) for x in rows["tokens"]] or [np.zeros(0, np.uint64)])
    return keys, counts, tokens


def records(docs: DataFrame, hot: tuple[np.ndarray, np.ndarray], buckets: int) -> DataFrame:
    """(key, n, shared, prefix, lead, p1 .. p3) of the sets that can have a partner.

    shared: the set's tokens that other sets have as well; lead: the first LEADS of them under the third order; p1: prefix tokens under the first order, p2 and p3: places in
    ``shared`` of those under the others.
    """
    shared_hot = docs.sparkSession.sparkContext.broadcast(hot)

    def dealt_out(tokens: np.ndarray, n: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
        hot_tokens, _ = shared_hot.value
        owner = np.repeat(np.arange(len(keys)), n)
        is_hot = np.zeros(len(tokens), bool)
        if len(hot_tokens):
            place = np.searchsorted(hot_tokens, tokens)
            place[place == len(hot_tokens)] = 0
            is_hot = hot_tokens[place] == tokens
        rows = list(_pack((W.mix(tokens[~is_hot]) % np.uint64(buckets)).astype(np.int32), owner[~is_hot], tokens[~is_hot], None, keys))
        home = (keys % buckets).astype(np.int32)
        n_hot = np.bincount(owner[is_hot], minlength=len(keys))
        hot_six = _six(tokens[is_hot][np.argsort(home[owner[is_hot]], kind="stable")])
        order = np.argsort(home, kind="stable")
        home, keys, n, n_hot = home[order], keys[order], n[order].astype(np.uint32), n_hot[order]
        hot_off = np.concatenate([[0], np.cumsum(n_hot)]).tolist()
        n_hot = n_hot.astype(np.uint32)
        cut = np.flatnonzero(np.concatenate([[True], home[1:] != home[:-1]])) if len(home) else np.zeros(0, np.int64)
        for h, x, y in zip(home[cut].tolist(), cut.tolist(), [*cut[1:].tolist(), len(home)]):
            rows.append((h, 1, keys[x:y].tobytes(), n_hot[x:y].tobytes(), hot_six[6 * hot_off[x]:6 * hot_off[y]], n[x:y].tobytes()))
        return _batch(rows)

    def deal(batches):
        seen: set[int] = set()
        waits: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for b in batches:
            raw, off = W.buffers(b.column("text"))
            for i, j in W.chunks(off):
                tokens, at = shingle_sets(raw, off[i:j + 1])
                keys, n = set_keys(tokens, at), np.diff(at)
                new = np.zeros(j - i, bool)
                for x, key in enumerate(keys.tolist()):
                    if n[x] and key not in seen:
                        seen.add(key)
                        new[x] = True
                waits.append((tokens[np.repeat(new, n)], n[new], keys[new]))
                if sum(len(x) for x, *_ in waits) >= DEAL_TOKENS:
                    yield dealt_out(*(np.concatenate(x) for x in zip(*waits)))
                    waits = []
        if waits:
            yield dealt_out(*(np.concatenate(x) for x in zip(*waits)))

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        keys, counts, tokens = _unpack(rows[rows["kind"] == 0])
        _, first = np.unique(keys, return_index=True)
        fresh = np.zeros(len(keys), bool)
        fresh[first] = True
        owner = np.repeat(np.arange(len(keys)), counts)
        tokens, owner = tokens[fresh[owner]], owner[fresh[owner]]
        order = np.argsort(tokens)
        tokens, owner = tokens[order], owner[order]
        starts = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]])) if len(tokens) else np.zeros(0, np.int64)
        times = np.diff(np.concatenate([starts, [len(tokens)]]))
        df = np.repeat(times, times)
        often = df >= 2
        owner, tokens, df = owner[often], tokens[often], df[often]
        order = np.argsort(owner)
        owner, tokens, df = owner[order], tokens[order], df[order]
        out = pd.DataFrame(_pack((keys[owner] % buckets).astype(np.int32), owner, tokens, df, keys), columns=["bucket", "kind", "keys", "counts", "tokens", "numbers"])
        return pd.concat([rows.loc[rows["kind"] == 1, out.columns], out], ignore_index=True)

    def assemble(rows: pd.DataFrame) -> pd.DataFrame:
        hot_tokens, hot_counts = shared_hot.value
        heads, bodies = rows[rows["kind"] == 1], rows[rows["kind"] == 0]
        keys, n_hot, hot_here = _unpack(heads)
        sizes = np.concatenate([np.frombuffer(x, np.uint32) for x in heads["numbers"]] or [np.zeros(0, np.uint32)]).astype(np.int64)
        hot_off = np.concatenate([[0], np.cumsum(n_hot)])
        cold_keys, cold_n, cold = _unpack(bodies)
        df = np.concatenate([np.frombuffer(x, np.uint32) for x in bodies["numbers"]] or [np.zeros(0, np.uint32)]).astype(np.int64)
        keys, first = np.unique(keys, return_index=True)
        sizes, n_hot = sizes[first], n_hot[first]
        of_hot = np.arange(int(n_hot.sum())) + np.repeat(hot_off[first] - (np.cumsum(n_hot) - n_hot), n_hot)
        hot_here = hot_here[of_hot]
        owner = np.concatenate([np.repeat(np.searchsorted(keys, cold_keys), cold_n), np.repeat(np.arange(len(keys)), n_hot)])
        tokens = np.concatenate([cold, hot_here])
        # hot tokens come after all others
        rank = np.concatenate([np.minimum(df, LATE - 1), LATE + np.minimum(hot_counts[np.searchsorted(hot_tokens, hot_here)], LATE - 1)]).astype(np.uint64)
        shared = np.bincount(owner, minlength=len(keys))
        take = sizes - (NUM * sizes + DEN - 1) // DEN + 1 - (sizes - shared)
        mine = ((take > 0) & (shared > 0))[owner]
        owner, tokens, rank = owner[mine], tokens[mine], rank[mine]
        # tokens have 48 bits; one key sorts several times as fast as two
        order = np.argsort(owner.astype(np.uint64) << np.uint64(48) | tokens) if len(keys) < 1 << 16 else np.lexsort((tokens, owner))
        owner, tokens, rank = owner[order], tokens[order], rank[order]
        half = np.uint64(32)
        # a rank in the upper half and a hash in the lower; equal ones stand in the order of the tokens
        orders = [rank << half | W.mix(tokens ^ _SALTS[0]) >> half, np.log2(rank.astype(np.float64)).astype(np.uint64) << half | W.mix(tokens ^ _SALTS[1]) >> half,
                  (rank >= LATE).astype(np.uint64) << half | W.mix(tokens ^ _SALTS[2]) >> half]
        out = []
        cut = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, np.int64)
        six = _six(tokens)
        for x, a, b in zip(owner[cut].tolist(), cut.tolist(), [*cut[1:].tolist(), len(owner)]):
            p1, p2, p3 = (np.argsort(o[a:b], kind="stable")[:take[x]].astype(np.uint32) for o in orders)
            own = tokens[a:b]
            out.append((int(keys[x]), int(sizes[x]), six[6 * a:6 * b], own[p1].astype(np.int64), own[p3[:LEADS]].astype(np.int64), p1.tobytes(), p2.tobytes(), p3.tobytes()))
        return pd.DataFrame(out, columns=["key", "n", "shared", "prefix", "lead", "p1", "p2", "p3"])

    dealt = docs.select("text").mapInArrow(deal, _PACKED)
    counted = dealt.groupBy("bucket").applyInPandas(count, _PACKED)
    return counted.groupBy("bucket").applyInPandas(assemble, "key bigint, n bigint, shared binary, prefix array<bigint>, lead array<bigint>, p1 binary, p2 binary, p3 binary")


class Shares:
    """Numbers of common elements of rows with rows: elements that many rows have by products of 0/1 matrices in blocks of columns, others by their pairs of rows."""

    def __init__(self, rows: list[np.ndarray]):
        """rows: column numbers of each row, each once."""
        m = len(rows)
        flat, off = ragged(rows)
        owner = np.repeat(np.arange(m), np.diff(off))
        times = np.bincount(flat) if len(flat) else np.zeros(1, np.int64)
        dense = times * DENSE > m
        dense &= times >= 2
        few = (times >= 2) & ~dense
        is_dense, is_few = dense[flat], few[flat]
        self.width = int(dense.sum())
        self.owner, self.column = owner[is_dense], (np.cumsum(dense) - 1)[flat[is_dense]]
        self.dense_off = np.concatenate([[0], np.cumsum(np.bincount(self.owner, minlength=m))])
        self.few_off = np.concatenate([[0], np.cumsum(np.bincount(owner[is_few], minlength=m))])
        self.few_column = (np.cumsum(few) - 1)[flat[is_few]]
        # rows of each of the other columns, ascending
        order = np.argsort(self.few_column, kind="stable")
        self.holders = owner[is_few][order]
        self.held_off = np.concatenate([[0], np.cumsum(np.bincount(self.few_column))]).astype(np.int64)

    def _ones(self, lo: int, hi: int, column: int) -> np.ndarray:
        a, b = self.dense_off[lo], self.dense_off[hi]
        x = np.zeros((hi - lo, min(2048, self.width - column)), np.float32)
        at = self.column[a:b] - column
        mine = (at >= 0) & (at < x.shape[1])
        x[self.owner[a:b][mine] - lo, at[mine]] = 1
        return x

    def count(self, lo: int, hi: int, first: int, last: int) -> np.ndarray:
        """Of rows lo .. hi with rows first .. last."""
        out = np.zeros((hi - lo, last - first), np.float32)
        for column in range(0, self.width, 2048):
            out += self._ones(lo, hi, column) @ self._ones(first, last, column).T
        a, b = self.few_off[lo], self.few_off[hi]
        mine, held = self.few_column[a:b], self.held_off
        row = np.repeat(np.arange(hi - lo), np.diff(self.few_off[lo:hi + 1]))
        size = held[mine + 1] - held[mine]
        upto = np.cumsum(size)
        x = 0
        while x < len(mine):
            y = max(x + 1, int(np.searchsorted(upto, (upto[x - 1] if x else 0) + SLICE, "right")))
            n = size[x:y]
            other = self.holders[np.arange(int(n.sum())) + np.repeat(held[mine[x:y]] - (np.cumsum(n) - n), n)]
            here = (other >= first) & (other < last)
            np.add.at(out.reshape(-1), (np.repeat(row[x:y], n) * (last - first) + other - first)[here], np.float32(1))
            x = y
        return out


def forest(left: np.ndarray, right: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest (position, smallest position of its component) of links among m positions."""
    label = np.arange(m)
    while True:
        new = label.copy()
        np.minimum.at(new, left, label[right])
        np.minimum.at(new, right, label[left])
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(m))
    return moved, label[moved]


def similar(sets: list[np.ndarray], n: np.ndarray, filters, cluster: np.ndarray | None = None, split: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Verified links (forest) among sets, or if ``split`` is given between the sets before and after it; none within a cluster.

    ``filters(number)`` (number: places of the sets' tokens -> numbers) gives a function that tells which pairs of rows lo .. hi with rows first .. last to verify.
    """
    m = len(sets)
    flat, off = ragged(sets)
    _, number = np.unique(flat, return_inverse=True)
    numbered = [number[off[i]:off[i + 1]] for i in range(m)]
    wanted = filters(numbered)
    whole = None
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for lo in range(0, split or m, STRIP):
        hi = min(lo + STRIP, split or m)
        first = split or lo
        pick = wanted(lo, hi, first, m)
        if not split:
            pick &= np.arange(lo, hi)[:, None] < np.arange(lo, m)
        if cluster is not None:
            pick &= cluster[lo:hi, None] != cluster[first:]
        a, b = np.nonzero(pick)
        if not len(a):
            continue
        if len(a) <= 4 * m:
            common = commons(number, off, a + lo, b + first)
        else:
            whole = whole or Shares(numbered)
            common = whole.count(lo, hi, first, m)[a, b].astype(np.int64)
        a, b = a + lo, b + first
        ok = DEN * common >= NUM * (n[a] + n[b] - common)
        a, b = forest(a[ok], b[ok], m)
        left.append(a)
        right.append(b)
    return forest(np.concatenate(left), np.concatenate(right), m)


def ragged(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Arrays one after the other, and their offsets."""
    return np.concatenate(rows), np.concatenate([[0], np.cumsum([len(r) for r in rows])])


def commons(flat: np.ndarray, off: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Numbers of common elements of pairs of rows of distinct elements, sorted together in slices of bounded size."""
    _, rank = np.unique(flat, return_inverse=True)
    width = int(rank.max()) + 1 if len(rank) else 1
    size = np.diff(off)
    out = np.zeros(len(left), np.int64)
    upto = np.cumsum(size[left] + size[right])
    lo = 0
    while lo < len(left):
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + SLICE, "right")))
        keys = []
        for side in (left[lo:hi], right[lo:hi]):
            n = size[side]
            at = np.arange(int(n.sum())) + np.repeat(off[side] - (np.cumsum(n) - n), n)
            keys.append(np.repeat(np.arange(hi - lo), n) * width + rank[at])
        key = np.concatenate(keys)
        key.sort()
        out[lo:hi] = np.bincount(key[1:][key[1:] == key[:-1]] // width, minlength=hi - lo)
        lo = hi
    return out


def pairs_within(group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rows (left < right) of equal, ascending group numbers; meant for groups of a few rows."""
    stop = np.searchsorted(group, group, "right")
    n = stop - np.arange(len(group)) - 1
    left = np.repeat(np.arange(len(group)), n)
    return left, left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n)


def tile_links(members: DataFrame, items: str, wanted: list[str], verify, verify_pairs) -> DataFrame:
    """Links within every group (column group_id) of keys: of small groups many at once, of others whole or as pairs of tiles that share an element of ``items``.

    ``verify`` takes the sorted rows of a group (columns key and ``wanted``) and returns forest links by position; of two
    tiles it also gets the number of rows of the first, and links one's rows with the other's.
    ``verify_pairs`` takes sorted rows of many groups and pairs of positions and says which are links.
    """
    sizes = members.groupBy("group_id").agg(F.count("*").alias("members")).filter("members > 1")
    members = materialize(members.join(sizes, "group_id").withColumn("tiles", F.ceil(F.col("members") / TILE).cast("int"))
                          .withColumn("tile", F.pmod(F.xxhash64("key"), F.col("tiles")).cast("int")), "groups")

    def run(group: pd.DataFrame, first=None) -> pd.DataFrame:
        group = group.drop_duplicates("key")
        split = 0
        if first is not None:
            group = group.assign(late=group["tile"] != first).sort_values(["late", "key"], ignore_index=True)
            split = int((~group["late"]).sum())
        else:
            group = group.sort_values("key", ignore_index=True)
        if len(group) < 2 or split == len(group):
            return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        left, right = verify(group, split)
        keys = group["key"].to_numpy()
        return pd.DataFrame({"a": keys[left], "b": keys[right]})

    def run_many(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates(["group_id", "key"]).sort_values(["group_id", "key"], ignore_index=True)
        size = rows.groupby("group_id")["key"].transform("size")
        few = rows[(size <= SMALL).to_numpy()].reset_index(drop=True)
        left, right = pairs_within(few["group_id"].to_numpy())
        ok = verify_pairs(few, left, right)
        left, right = forest(left[ok], right[ok], len(few))
        keys = few["key"].to_numpy()
        out = [pd.DataFrame({"a": keys[left], "b": keys[right]})]
        return pd.concat([*out, *(run(g) for _, g in rows[(size > SMALL).to_numpy()].groupby("group_id"))], ignore_index=True)

    def run_tiles(tiles: tuple, group: pd.DataFrame) -> pd.DataFrame:
        return run(group, tiles[1] if tiles[1] != tiles[2] else None)

    whole = members.filter("tiles = 1").select("group_id", "key", *wanted)
    calls = max(1, -(-whole.count() // CALL_ROWS))
    small = (whole.withColumn("call", F.pmod(F.xxhash64("group_id"), F.lit(calls)).cast("int")).repartition(calls, "call")
             .groupBy("call").applyInPandas(run_many, "a bigint, b bigint"))
    large = members.filter("tiles > 1")
    held = large.select("group_id", "tile", F.explode(items).alias("token")).distinct()
    other = held.select(F.col("group_id").alias("g"), F.col("tile").alias("tile2"), F.col("token").alias("t"))
    meets = (held.join(other, (F.col("group_id") == F.col("g")) & (F.col("token") == F.col("t")) & (F.col("tile") <= F.col("tile2")))
             .select("group_id", F.col("tile").alias("t1"), F.col("tile2").alias("t2")).distinct())
    seats = meets.select(F.col("group_id").alias("g"), "t1", "t2", F.explode(F.array_distinct(F.array("t1", "t2"))).alias("seat"))
    tiled = (large.select("group_id", "tile", "key", *wanted).join(seats, (F.col("group_id") == F.col("g")) & (F.col("tile") == F.col("seat")))
             .groupBy("group_id", "t1", "t2").applyInPandas(run_tiles, "a bigint, b bigint"))
    return small.unionByName(tiled)


def verified_links(group: pd.DataFrame, split: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Candidates share prefix tokens under all three orders; links are verified on the whole sets."""
    def filters(numbered):
        orders = [Shares([x[np.frombuffer(p, np.uint32)] for x, p in zip(numbered, group[name])]) for name in ("p1", "p2", "p3")]

        def wanted(lo, hi, first, last):
            found = orders[0].count(lo, hi, first, last) > 0
            for order in orders[1:]:
                found &= order.count(lo, hi, first, last) > 0
            return found

        return wanted

    return similar([_eight(x) for x in group["shared"]], group["n"].to_numpy(np.int64), filters, group["cluster"].to_numpy(), split)


def verified_pairs(rows: pd.DataFrame, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The same for given pairs of rows: a pair that fails one order's filter is not held against the next."""
    ok = np.zeros(len(left), bool)
    if not len(left):
        return ok
    sets = [_eight(x) for x in rows["shared"]]
    cluster = rows["cluster"].to_numpy()
    mine = np.flatnonzero(cluster[left] != cluster[right])
    for name in ("p1", "p2", "p3"):
        flat, off = ragged([s[np.frombuffer(x, np.uint32)] for s, x in zip(sets, rows[name])])
        mine = mine[commons(flat, off, left[mine], right[mine]) > 0]
    n = rows["n"].to_numpy(np.int64)
    common = commons(*ragged(sets), left[mine], right[mine])
    ok[mine] = DEN * common >= NUM * (n[left[mine]] + n[right[mine]] - common)
    return ok


def _tokens_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all sets of a binary column, one after the other, and their offsets."""
    column = column.cast(pa.large_binary())
    _, off, data = column.buffers()
    off = np.frombuffer(off, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return _eight(data[int(off[0]):int(off[-1])] if off[-1] > off[0] else b""), (off - off[0]) // 6


def row_commons(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Numbers of common tokens of the sets of two columns, row by row, sorted together in slices of bounded size."""
    rows = len(one[1]) - 1
    out = np.zeros(rows, np.int64)
    upto = one[1] + other[1]
    lo = 0
    while lo < rows:
        hi = min(max(lo + 1, int(np.searchsorted(upto, upto[lo] + SLICE, "right")) - 1), lo + (1 << 16), rows)
        key = np.concatenate([tokens[off[lo]:off[hi]] | np.repeat(np.arange(hi - lo, dtype=np.uint64) << np.uint64(48), np.diff(off[lo:hi + 1])) for tokens, off in (one, other)])
        key.sort()
        out[lo:hi] = np.bincount((key[1:][key[1:] == key[:-1]] >> np.uint64(48)).astype(np.int64), minlength=hi - lo)
        lo = hi
    return out


def near_links(found: DataFrame) -> DataFrame:
    """Links (a, b) between sets and the smallest set with one of their leading tokens, verified on the whole sets."""
    leads = found.select("key", F.explode("lead").alias("token"))
    least = leads.groupBy("token").agg(F.min("key").alias("least"), F.count("*").alias("n")).filter("n > 1").select(F.col("token").alias("t"), "least")
    pairs = leads.join(least, F.col("token") == F.col("t")).filter("key <> least").select(F.col("key").alias("a"), F.col("least").alias("b")).distinct()
    one = found.select(F.col("key").alias("x"), F.col("n").alias("n1"), F.col("shared").alias("s1"))
    other = found.select(F.col("key").alias("y"), F.col("n").alias("n2"), F.col("shared").alias("s2"))

    def verify(batches):
        for b in batches:
            common = row_commons(_tokens_of(b.column("s1")), _tokens_of(b.column("s2")))
            n = b.column("n1").to_numpy() + b.column("n2").to_numpy()
            ok = pa.array(np.flatnonzero(DEN * common >= NUM * (n - common)))
            yield pa.RecordBatch.from_arrays([b.column("a").take(ok), b.column("b").take(ok)], ["a", "b"])

    # the least set of a family stands in very many pairs: the last join is a plain one, which skew handling splits
    return (pairs.join(one, F.col("a") == F.col("x")).drop("x").join(other, F.col("b") == F.col("y")).select("a", "b", "n1", "s1", "n2", "s2")
            .mapInArrow(verify, "a bigint, b bigint"))


def links(found: DataFrame) -> DataFrame:
    """Links (a, b) between keys of ``records`` output: those of near copies, and a spanning forest of every tile."""
    near = materialize(near_links(found), "near")
    root = components(near, "a", "b")
    index = materialize(found.select("key", "prefix").join(root, F.col("key") == F.col("node"), "left").select("key", F.coalesce("root", "key").alias("cluster"), "prefix"), "index")
    tokens = index.select("key", "cluster", F.explode("prefix").alias("token"))
    several = materialize(tokens.groupBy("token").agg(F.min("cluster").alias("least"), F.max("cluster").alias("most")).filter("least <> most").select(F.col("token").alias("t"), "least"), "several")
    held = materialize(sieve(tokens, "token", several, "t").join(several, F.col("token") == F.col("t")).select("key", "cluster", "least").distinct(), "held")
    group = components(held.select("cluster", "least").distinct(), "cluster", "least")
    of = (held.select(F.col("key").alias("k"), "cluster").distinct().join(group, F.col("cluster") == F.col("node"), "left")
          .select("k", "cluster", F.coalesce("root", "cluster").alias("group_id")))
    of = materialize(of, "open")
    members = sieve(found, "key", of, "k").join(of, F.col("key") == F.col("k"))
    return tile_links(members, "prefix", ["n", "shared", "cluster", "p1", "p2", "p3"], verified_links, verified_pairs).unionByName(near)


def _classes(docs: DataFrame, carry: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, ``carry``, n_shingles, key; no key without words) and the keys that a link joins to a smaller one (node, root)."""
    signed = materialize(signatures(docs, carry), "signatures")
    rows = signed.filter("tokens is null").select("doc_id", *carry, "n_shingles", "key")
    total = rows.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n_shingles"), F.lit(0)).alias("tokens")).first()
    often = (signed.filter("tokens is not null").select(F.explode(F.arrays_zip("tokens", "counts")).alias("x")).groupBy(F.col("x.tokens").alias("token"))
             .agg(F.sum("x.counts").alias("n")).filter(F.col("n") >= max(HOT_LEAST, total["docs"] // HOT_SHARE)))
    hot = often.toArrow()
    tokens, counts = hot.column("token").to_numpy().astype(np.uint64), hot.column("n").to_numpy().astype(np.int64)
    order = np.argsort(tokens)
    buckets = max(16, total["tokens"] // BUCKET_TOKENS)
    found = materialize(records(docs, (tokens[order], counts[order]), int(buckets)), "records")
    return rows, components(links(found), "a", "b")


def first_rows(docs: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    """``carry`` of one row, smallest by (doc_id, ``carry``), of every class of linked documents with words; ids play no other part."""
    rows, root = _classes(docs, carry)
    # copies first, so that a class of very many is not dealt by its root
    least = rows.filter("key is not null").groupBy("key").agg(F.min(F.struct("doc_id", *carry)).alias("least"))
    return (least.join(root, F.col("key") == F.col("node"), "left").groupBy(F.coalesce("root", "key").alias("class")).agg(F.min("least").alias("least"))
            .select(*[F.col(f"least.{c}").alias(c) for c in carry]))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every document (doc_id, text)."""
    rows, root = _classes(docs)
    classes = rows.filter("key is not null").groupBy("key").agg(F.min("doc_id").alias("least"))
    classes = classes.join(root, F.col("key") == F.col("node"), "left").select("key", F.coalesce("root", "key").alias("root"), "least")
    named = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    of_key = classes.select("key", "root").join(named, "root").select(F.col("key").alias("k"), "component_id")
    return rows.join(of_key, F.col("key") == F.col("k"), "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def op3_jaccard_prefix_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
