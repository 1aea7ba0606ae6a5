"""Cross-tokenizer alignment with inverted pair bitmaps (operator 13).

Each text is encoded by a byte-level BPE (A, of a blank and the text) and by a piece BPE with byte fallback (B, which adds the blank).  Byte offsets at
which tokens of both end cut the tokens into groups; a link is a pair of an A and a B token of one group.

1. ``index`` reads the documents once.  Documents are numbered within blocks; for every pair of token ids that is linked in a block there are
   compressed bitmaps of the block's documents, one for each bit of the number of links (a multiplicity plane): a sorted array of numbers if few
   documents have it, else a bitset.  Bitmaps are dealt to BUCKETS by their A id, and their rows are written once.
2. ``pair_counts``: the planes of a pair are merged by OR and popcounted for its documents, the popcounts of single planes weighted for its
   links.  Sums are formed per row, then per part of blocks, then per bucket, so a frequent id is never gathered from all blocks at once.  All
   pairs of an A id lie in one bucket, which therefore knows the highest document count of the id.
3. ``scores``: bitmaps meet the counts of their bucket part by part (PART_BLOCKS blocks), and each posting returns its pair's score to its documents.

A group in which very many different tokens of both sides never end together makes as many pairs as the product says; equal tokens of a group are multiplied, never paired.

Tokenizing is done once per distinct stretch of a chunk: both tokenizers treat a text as the sequence of its stretches that begin with a blank after a
character that is not blank (no token spans such a place).  If the tokens of a stretch do not spell it, the whole text is encoded instead.

Defined cases: texts that are null, empty, or that the tokens of A or B do not spell (B replaces U+2581, say) have no tokens: zeros, and
empty groups; repeated rows are documents of their own; a null doc_id is carried; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import words as W
from tallyframe.session import materialize

A_PATH, B_PATH = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
CHUNK = 1 << 19
BUCKETS = 32
#: A block ends at so many (pair, document) entries or documents.
BLOCK_ENTRIES, BLOCK_DOCS = 2_000_000, 1 << 16
PART_BLOCKS = 32
#: Stretches kept with their tokens by a worker.
KEPT_STRETCHES, KEPT_TOKENS = 1_000_000, 8_000_000
#: Groups of more links than this are taken by distinct ids.
LARGE = 256

_INDEX = "doc_id {}, block bigint, slot int, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, bucket int, docs int, pairs binary, planes binary, sizes binary, few binary, bits binary"
_NAMES = ["doc_id", "block", "slot", "n_a", "n_b", "n_groups", "n_links", "groups", "bucket", "docs", "pairs", "planes", "sizes", "few", "bits"]
_TYPES = [None, pa.int64(), pa.int32(), *[pa.int64()] * 4, pa.string(), pa.int32(), pa.int32(), *[pa.binary()] * 5]


class Side:
    """One tokenizer: ids of texts (bytes that begin with the blank) and the bytes of every id."""

    def __init__(self, encode: Callable[[list[bytes]], list[list[int]]], spelled: list[bytes]):
        self._encode, self.spelled = encode, spelled
        self.bytes, self.offsets = np.frombuffer(b"".join(spelled), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in spelled])])
        self.width = np.diff(self.offsets)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """ids one after the other, their number for each text, and whether they spell the text."""
        ids = self._encode(texts)
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(size.sum()))
        upto = np.concatenate([[0], np.cumsum(self.width[flat])])
        stop = np.cumsum(size)
        ok = upto[stop] - upto[stop - size] == np.fromiter(map(len, texts), np.int64, len(texts))
        if ok.all():
            told, given = _gather(self.bytes, self.offsets, flat)[0], np.frombuffer(b"".join(texts), np.uint8)
            wrong = np.flatnonzero(told != given)
            ok[np.searchsorted(upto[stop], wrong, "right")] = False
        else:
            ok = np.array([b"".join([self.spelled[x] for x in mine]) == text for mine, text in zip(ids, texts)], bool)
        return flat, size, ok


#: How byte-level BPE cuts a text before merging (fixed value).
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bytes of texts that the faster encoder takes: printable ASCII, tab, line feed, Latin letters beyond ASCII.
_LATIN = re.compile(rb"(?:[\x09\x0A\x20-\x7E]|[\xC3-\xC5][\x80-\xBF])*[\x21-\x7E\x80-\xBF]").fullmatch
JOINED = 512


def byte_level(definition: str) -> Side:
    """Byte-level BPE from its JSON definition.

    Stretches of Latin letters, digits and marks are joined and encoded by a second implementation of the same merges, several times as fast; it is used only
    if ids and merges of the definition are in one order, which is what it goes by.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals the work
    from tiktoken import Encoding
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(definition)
    t.encode_special_tokens = True
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}
    spelled = [b""] * t.get_vocab_size()
    for token, i in t.get_vocab().items():
        spelled[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
    model = json.loads(definition)["model"]
    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    vocab = model["vocab"]
    in_order = [vocab.get(m) for m in merged] == list(range(256, 256 + len(merged))) and sorted(i for i in vocab.values() if i < 256) == list(range(256))
    fast = Encoding("bytes", pat_str=_PATTERN, mergeable_ranks={spelled[i]: i for i in range(256 + len(merged))}, special_tokens={}) if in_order else None

    def slow(texts: list[bytes]) -> list[list[int]]:
        return [x.ids for x in t.encode_batch_fast([x.decode() for x in texts], add_special_tokens=False)]

    width = np.array([len(x) for x in spelled])

    def joined(texts: list[bytes]) -> list[list[int]]:
        """Each text begins with a blank and ends with no white space, so no token spans two of them."""
        ids = fast.encode_ordinary(b"".join(texts).decode())
        cut = np.searchsorted(np.cumsum(width[ids]), np.cumsum([len(x) for x in texts])) + 1
        return [ids[a:b] for a, b in zip([0, *cut[:-1].tolist()], cut.tolist())]

    def encode(texts: list[bytes]) -> list[list[int]]:
        latin = [fast is not None and _LATIN(x) is not None for x in texts]
        out: list = [None] * len(texts)
        for some, how, step in ((np.flatnonzero(latin), joined, JOINED), (np.flatnonzero(~np.array(latin, bool)), slow, len(texts))):
            for k in range(0, len(some), max(step, 1)):
                mine = some[k:k + step].tolist()
                for i, ids in zip(mine, how([texts[i] for i in mine])):
                    out[i] = ids
        return out

    return Side(encode, spelled)


def pieces(model: bytes) -> Side:
    """Piece BPE from its model file; it adds the blank that texts begin with."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    spelled = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in range(sp.vocab_size())]
    return Side(lambda texts: sp.encode([x[1:].decode() for x in texts], num_threads=1), spelled)


#: Code points at or after 0x80 after which no stretch begins: white space, its zero-width relatives, and the mark that B writes for a blank.
_SPACES = np.array([0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x2581, 0x3000, 0xFEFF])


def stretches(data: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Starts of the stretches of consecutive texts that begin at ``begin``: a blank after a character that is not white space, and every text's start."""
    at = np.flatnonzero(data == 0x20)
    at = at[at > 0]
    last = data[at - 1]
    solid = (last > 0x20) & (last < 0x7F)
    wide = np.flatnonzero(last >= 0x80)
    if len(wide):
        two, three = (data[np.maximum(at[wide] - k, 0)].astype(np.int64) for k in (2, 3))
        low = last[wide].astype(np.int64) & 0x3F
        # characters of two bytes, of three, and of four (none of which is white space)
        point = np.where(two >= 0xC0, (two & 0x1F) << 6 | low, np.where(three >= 0xE0, (three & 0x0F) << 12 | (two & 0x3F) << 6 | low, 0x10000))
        solid[wide] = ~np.isin(point, _SPACES)
    keep = np.zeros(len(data), bool)
    keep[at[solid]] = True
    keep[begin] = True
    return np.flatnonzero(keep)


def _gather(flat: np.ndarray, offsets: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenated rows ``which`` of a ragged array, and their sizes."""
    size = offsets[which + 1] - offsets[which]
    shift = offsets[which] - (np.cumsum(size) - size)
    return flat[np.arange(int(size.sum())) + np.repeat(shift, size)], size


class Tokens:
    """Tokens of both sides by stretch; distinct stretches are encoded once while they are kept."""

    def __init__(self, a: Side, b: Side):
        self.sides = (a, b)
        self.forget()

    def forget(self):
        self.keys = np.zeros(0, np.uint64)
        self.slot = np.zeros(0, np.int64)
        self.ok = np.zeros(0, bool)
        self.flat = [np.zeros(0, np.int32), np.zeros(0, np.int32)]
        self.off = [np.zeros(1, np.int64), np.zeros(1, np.int64)]

    def encode(self, texts: list[bytes]):
        """Per side ids and sizes; which texts both sides spell."""
        (a, n_a, ok_a), (b, n_b, ok_b) = (side.encode(texts) for side in self.sides)
        return [(a, n_a), (b, n_b)], ok_a & ok_b

    def of(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Slots of the stretches [start, end)."""
        h, first, inverse = np.unique(W.span_hashes(data, start, end), return_index=True, return_inverse=True)
        if len(self.keys) > KEPT_STRETCHES or max(map(len, self.flat)) > KEPT_TOKENS:
            self.forget()
        where = np.searchsorted(self.keys, h)
        where[where == len(self.keys)] = 0
        new = np.flatnonzero(self.keys[where] != h) if len(self.keys) else np.arange(len(h))
        if len(new):
            raw = data.tobytes()
            out, ok = self.encode([raw[s:e] for s, e in zip(start[first[new]].tolist(), end[first[new]].tolist())])
            self.slot = np.concatenate([self.slot, len(self.ok) + np.arange(len(new))])
            self.ok = np.concatenate([self.ok, ok])
            self.keys = np.concatenate([self.keys, h[new]])
            for k, (ids, size) in enumerate(out):
                self.flat[k] = np.concatenate([self.flat[k], ids])
                self.off[k] = np.concatenate([self.off[k], self.off[k][-1] + np.cumsum(size)])
            order = np.argsort(self.keys)
            self.keys, self.slot = self.keys[order], self.slot[order]
            where = np.searchsorted(self.keys, h)
        return self.slot[where][inverse]


def encoded(texts: list[bytes], tokens: Tokens):
    """Per side ids of consecutive texts (with the blank before) and tokens per text; texts that are not spelled have none."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    size = np.array([len(t) for t in texts], np.int64)
    begin = np.cumsum(size) - size
    start = stretches(data, begin)
    slots = tokens.of(data, start, np.append(start[1:], len(data)))
    first = np.searchsorted(start, begin)
    fine = np.logical_and.reduceat(tokens.ok[slots], first)
    owner = np.repeat(np.arange(len(texts)), np.diff(np.append(first, len(start))))
    sides = []
    for k in (0, 1):
        ids, n = _gather(tokens.flat[k], tokens.off[k], slots[fine[owner]])
        sides.append((ids, np.bincount(owner[fine[owner]], weights=n, minlength=len(texts)).astype(np.int64)))
    if fine.all():
        return sides
    # the rest as a whole, in the place of each text
    rest = np.flatnonzero(~fine)
    whole, ok = tokens.encode([texts[i] for i in rest])
    out = []
    for (ids, n), (more, m) in zip(sides, whole):
        more = more[np.repeat(ok, m)]
        m = np.where(ok, m, 0)
        n[rest] = m
        text = np.concatenate([np.repeat(np.arange(len(texts)), np.where(fine, n, 0)), np.repeat(rest, m)])
        out.append((np.concatenate([ids, more])[np.argsort(text, kind="stable")], n))
    return out


def grouped(a: np.ndarray, b: np.ndarray, width_a: np.ndarray, width_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group number of every A and B token of consecutive texts, and the byte ends of the groups."""
    end_a, end_b = np.cumsum(width_a[a]), np.cumsum(width_b[b])
    total = int(end_a[-1]) if len(end_a) else 0
    ends = np.zeros((2, total + 1), bool)
    ends[0, end_a] = True
    ends[1, end_b] = True
    both = ends[0] & ends[1]
    number = np.cumsum(both, dtype=np.int32)
    return number[end_a - 1], number[end_b - 1], np.flatnonzero(both)


def linked(a, b, group_a, group_b, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys (A id << 32 | B id << 16 | slot) with their numbers of links; and links per group.  ``slot``: document of each group."""
    g = len(slot)
    size_a, size_b = np.bincount(group_a, minlength=g), np.bincount(group_b, minlength=g)
    first_a, first_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
    product = size_a * size_b
    use = product[group_a] <= LARGE
    mine = np.flatnonzero(use)
    times = size_b[group_a[mine]]
    left = np.repeat(mine, times)
    right = np.arange(len(left)) + np.repeat(first_b[group_a[mine]] - (np.cumsum(times) - times), times)
    keys = a[left].astype(np.int64) << 32 | b[right].astype(np.int64) << 16 | slot[group_a[left]]
    keys.sort()
    head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    times = np.diff(np.append(head, len(keys)))
    keys = keys[head]
    large = np.flatnonzero(product > LARGE)
    if len(large):
        all_keys, all_times = [keys], [times]
        for k in large.tolist():
            x, nx = np.unique(a[first_a[k]:first_a[k] + size_a[k]], return_counts=True)
            y, ny = np.unique(b[first_b[k]:first_b[k] + size_b[k]], return_counts=True)
            all_keys.append((x.astype(np.int64)[:, None] << 32 | y.astype(np.int64) << 16 | slot[k]).ravel())
            all_times.append((nx[:, None] * ny).ravel())
        keys, times = summed(np.concatenate(all_keys), np.concatenate(all_times))
    return keys, times, product


def summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys with the sums of their values."""
    if not len(keys):
        return keys, *values
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[head], *(np.add.reduceat(v[order], head) for v in values)


def _numbers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Digits of 0 .. n - 1, each followed by a comma, and their offsets."""
    text = [b"%d," % i for i in range(n)]
    return np.frombuffer(b"".join(text), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in text])])


def written(a, b, group_a, group_b, n_a, n_b, numbers) -> pa.Array:
    """Per text its groups as ``a1,a2|b1;a3|b2,b3``."""
    flat, offsets = numbers
    g = int(group_a[-1]) + 1 if len(group_a) else 0
    size_a, size_b = np.bincount(group_a, minlength=g), np.bincount(group_b, minlength=g)
    before_b, upto_a = np.cumsum(size_b) - size_b, np.cumsum(size_a)
    ids = np.empty(len(a) + len(b), np.int64)
    place_a = np.arange(len(a)) + before_b[group_a]
    place_b = np.arange(len(b)) + upto_a[group_b]
    ids[place_a], ids[place_b] = a, b
    out, size = _gather(flat, offsets, ids)
    last = np.cumsum(size) - 1
    out[last[place_a[upto_a - 1]]] = ord("|")
    out[last[place_b[np.cumsum(size_b) - 1]]] = ord(";")
    per_text = n_a + n_b
    stop = np.cumsum(per_text)
    some = per_text > 0
    keep = np.ones(len(out), bool)
    keep[last[stop[some] - 1]] = False
    ends = np.concatenate([[0], np.cumsum(size)])[stop] - np.cumsum(some)
    return pa.Array.from_buffers(pa.large_string(), len(n_a), [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64)), pa.py_buffer(out[keep])]).cast(pa.string())


def packed(pairs: np.ndarray, planes: np.ndarray, sizes: np.ndarray, docs: np.ndarray, n: int) -> tuple[bytes, ...]:
    """Bitmaps over ``n`` documents as bytes: an array of numbers, or a bitset where that is shorter."""
    dense = sizes * 16 > n
    of = np.repeat(dense, sizes)
    bits = np.zeros((int(dense.sum()), n), bool)
    bits[np.repeat(np.arange(len(bits)), sizes[dense]), docs[of]] = True
    return (pairs.astype("<u4").tobytes(), planes.astype(np.uint8).tobytes(), (sizes - 1).astype("<u2").tobytes(),
            docs[~of].astype("<u2").tobytes(), np.packbits(bits, axis=1).tobytes())


def unpacked(pairs: bytes, planes: bytes, sizes: bytes, few: bytes, bits: bytes, n: int):
    """pairs, planes, sizes of the bitmaps and their documents one after the other."""
    size = np.frombuffer(sizes, "<u2").astype(np.int64) + 1
    dense = size * 16 > n
    docs = np.empty(int(size.sum()), np.uint16)
    of = np.repeat(dense, size)
    docs[~of] = np.frombuffer(few, "<u2")
    if dense.any():
        docs[of] = np.nonzero(np.unpackbits(np.frombuffer(bits, np.uint8).reshape(int(dense.sum()), -1), axis=1, count=n))[1]
    return np.frombuffer(pairs, "<u4").astype(np.int64), np.frombuffer(planes, np.uint8).astype(np.int64), size, docs


class Block:
    """Documents numbered 0, 1, ...; their links until they are written as bitmaps."""

    def __init__(self, number: int):
        self.number, self.docs, self.entries = number, 0, 0
        self.keys: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def add(self, keys: np.ndarray, times: np.ndarray):
        self.keys.append(keys)
        self.times.append(times.astype(np.uint32))
        self.entries += len(keys)

    def rows(self):
        """(bucket, docs, packed bitmaps) for each bucket."""
        keys = np.concatenate(self.keys or [np.zeros(0, np.int64)])
        times = np.concatenate(self.times or [np.zeros(0, np.uint32)])
        order = np.argsort(keys)
        keys, times = keys[order], times[order]
        for bucket, mine in split(W.mix(keys >> 32) % np.uint64(BUCKETS)):
            k, t = keys[mine], times[mine]
            parts = []
            for plane in range(int(t.max()).bit_length()):
                here = k[(t >> np.uint32(plane)) & np.uint32(1) == 1]
                head = np.flatnonzero(np.concatenate([[True], here[1:] >> 16 != here[:-1] >> 16])) if len(here) else np.zeros(0, np.int64)
                parts.append((here[head] >> 16, np.full(len(head), plane), np.diff(np.append(head, len(here))), here & 0xFFFF))
            yield bucket, self.docs, *packed(*(np.concatenate(x) for x in zip(*parts)), self.docs)


def split(bucket: np.ndarray):
    """(bucket, places) of every bucket that occurs."""
    order = np.argsort(bucket, kind="stable")
    at = bucket[order]
    head = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else np.zeros(0, np.int64)
    for x, y in zip(head.tolist(), np.append(head[1:], len(at)).tolist()):
        yield int(at[x]), order[x:y]


_TOKENS: dict[int, Tokens] = {}


def index(docs: DataFrame, a_path: str = A_PATH, b_path: str = B_PATH) -> DataFrame:
    """Rows of documents (bucket null) and rows of bitmaps (bucket not null), see the names of ``_NAMES``."""
    with open(a_path, encoding="utf-8") as f, open(b_path, "rb") as g:  # vocabularies: some MB at most, sent to the executors once
        shared = docs.sparkSession.sparkContext.broadcast((f.read(), g.read()))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        key = hash(shared.value)  # one set of tokenizers a worker
        if key not in _TOKENS:
            _TOKENS.clear()
            _TOKENS[key] = Tokens(byte_level(shared.value[0]), pieces(shared.value[1]))
        tokens = _TOKENS[key]
        a_side, b_side = tokens.sides
        most = max(len(a_side.spelled), len(b_side.spelled))
        if most > 1 << 16:
            raise ValueError("token ids must fit into 16 bits")
        numbers = _numbers(most)
        number = TaskContext.get().partitionId() << 32
        block = Block(number)

        def bitmaps(done: Block, doc_id: pa.DataType) -> pa.RecordBatch:
            rows = list(zip(*done.rows())) or [[]] * 7
            n = len(rows[0])
            given = {"block": [done.number] * n, **dict(zip(_NAMES[8:], rows))}
            return pa.RecordBatch.from_arrays([pa.array(given[c], t) if c in given else pa.nulls(n, t or doc_id) for c, t in zip(_NAMES, _TYPES)], _NAMES)

        for batch in batches:
            raw, off = W.buffers(batch.column("text"))
            doc_id = batch.column("doc_id").type
            for i, j in W.chunks(off, CHUNK):
                for lo in range(i, j, BLOCK_DOCS // 4):
                    hi = min(j, lo + BLOCK_DOCS // 4)
                    if block.entries >= BLOCK_ENTRIES or block.docs + hi - lo > BLOCK_DOCS:
                        yield bitmaps(block, doc_id)
                        number += 1
                        block = Block(number)
                    some = np.flatnonzero(np.diff(off[lo:hi + 1]) > 0)
                    n_a, n_b, n_groups, n_links = np.zeros((4, hi - lo), np.int64)
                    groups = pa.array([""] * (hi - lo), pa.string())
                    if len(some):
                        texts = [b" " + raw[x:y].tobytes() for x, y in zip(off[lo + some].tolist(), off[lo + some + 1].tolist())]
                        (a, in_a), (b, in_b) = encoded(texts, tokens)
                        n_a[some], n_b[some] = in_a, in_b
                        group_a, group_b, _ = grouped(a, b, a_side.width, b_side.width)
                        text_of = np.repeat(np.arange(hi - lo), n_a)
                        first = np.flatnonzero(np.concatenate([[True], group_a[1:] != group_a[:-1]])) if len(a) else np.zeros(0, np.int64)
                        slot = text_of[first]
                        keys, times, product = linked(a, b, group_a, group_b, slot + block.docs)
                        n_groups = np.bincount(slot, minlength=hi - lo)
                        n_links = np.bincount(slot, weights=product, minlength=hi - lo).astype(np.int64)
                        groups = written(a, b, group_a, group_b, n_a, n_b, numbers)
                        block.add(keys, times)
                    n = hi - lo
                    given = {"doc_id": batch.column("doc_id").slice(lo, n), "block": pa.array(np.full(n, block.number)), "slot": pa.array(block.docs + np.arange(n), pa.int32()),
                             "n_a": pa.array(n_a), "n_b": pa.array(n_b), "n_groups": pa.array(n_groups), "n_links": pa.array(n_links), "groups": groups}
                    block.docs += n
                    yield pa.RecordBatch.from_arrays([given[c] if c in given else pa.nulls(n, t) for c, t in zip(_NAMES, _TYPES)], _NAMES)
        if block.entries:
            yield bitmaps(block, doc_id)

    return docs.select("doc_id", "text").mapInArrow(run, _INDEX.format(kind))


_COUNTS = "bucket int, part bigint, pairs binary, docs binary, links binary"


def _counts(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    read = lambda c, t: np.concatenate([np.frombuffer(x, t) for x in rows[c]] or [np.zeros(0, t)]).astype(np.int64)
    return summed(read("pairs", "<u4"), read("docs", "<i8"), read("links", "<i8"))


def pair_counts(postings: DataFrame) -> DataFrame:
    """(bucket, pairs, docs, links, best) as packed arrays, one row a bucket; best: the pair has the most documents of its A id."""
    def popcount(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                pairs, planes, sizes, docs = unpacked(row["pairs"], row["planes"], row["sizes"], row["few"], row["bits"], row["docs"])
                # planes of one pair are merged: a document in two of them counts once
                merged = np.unique(np.repeat(pairs, sizes) << 16 | docs) >> 16
                of, count = np.unique(merged, return_counts=True)
                _, links = summed(pairs, sizes << planes)
                out.append((row["bucket"], row["part"], of.astype("<u4").tobytes(), count.astype("<i8").tobytes(), links.astype("<i8").tobytes()))
            columns = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int32(), pa.int64(), *[pa.binary()] * 3])], ["bucket", "part", "pairs", "docs", "links"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(rows["bucket"].iloc[0], rows["part"].iloc[0], *(x.astype(t).tobytes() for x, t in zip(_counts(rows), ("<u4", "<i8", "<i8"))))],
                            columns=["bucket", "part", "pairs", "docs", "links"])

    def rank(rows: pd.DataFrame) -> pd.DataFrame:
        pairs, docs, links = _counts(rows)
        of = pairs >> 16
        head = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        best = docs == np.repeat(np.maximum.reduceat(docs, head), np.diff(np.append(head, len(of))))
        return pd.DataFrame([(rows["bucket"].iloc[0], pairs.astype("<u4").tobytes(), docs.astype("<i8").tobytes(), links.astype("<i8").tobytes(), best.tobytes())],
                            columns=["bucket", "pairs", "docs", "links", "best"])

    rows = postings.select("bucket", "part", "docs", "pairs", "planes", "sizes", "few", "bits").mapInArrow(popcount, _COUNTS)
    parts = rows.groupBy("bucket", "part").applyInPandas(add, _COUNTS)
    return parts.groupBy("bucket").applyInPandas(rank, "bucket int, pairs binary, docs binary, links binary, best binary")


def scores(postings: DataFrame, counts: DataFrame, parts: int) -> DataFrame:
    """block, slot, n_best, count_sum of the documents that have links."""
    seats = counts.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    both = (postings.select("bucket", "part", "block", F.col("docs").alias("n"), "pairs", "planes", "sizes", "few", "bits", F.lit(None).cast("binary").alias("count"))
            .unionByName(seats.select("bucket", "part", F.lit(None).cast("long").alias("block"), F.lit(None).cast("int").alias("n"), "pairs", F.col("best").alias("planes"),
                                      *(F.lit(None).cast("binary").alias(c) for c in ("sizes", "few", "bits")), F.col("docs").alias("count"))))

    def give(rows: pd.DataFrame) -> pd.DataFrame:
        named = rows["block"].isna()
        out = []
        if named.any() and not named.all():
            table = rows[named].iloc[0]
            of, docs, best = np.frombuffer(table["pairs"], "<u4"), np.frombuffer(table["count"], "<i8"), np.frombuffer(table["planes"], bool)
            for r in rows[~named].itertuples(index=False):
                n = int(r.n)
                pairs, planes, sizes, slots = unpacked(r.pairs, r.planes, r.sizes, r.few, r.bits, n)
                at = np.searchsorted(of, pairs)
                sums = [np.bincount(slots, weights=np.repeat(value << planes, sizes), minlength=n).astype("<i8").tobytes() for value in (best[at].astype(np.int64), docs[at])]
                out.append((int(r.block), *sums))
        return pd.DataFrame(out, columns=["block", "n_best", "count_sum"])

    def total(rows: pd.DataFrame) -> pd.DataFrame:
        best, count = (np.sum([np.frombuffer(x, "<i8") for x in rows[c]], axis=0) for c in ("n_best", "count_sum"))
        return pd.DataFrame({"block": rows["block"].iloc[0], "slot": np.arange(len(best)), "n_best": best, "count_sum": count})

    given = both.groupBy("bucket", "part").applyInPandas(give, "block bigint, n_best binary, count_sum binary")
    return given.groupBy("block").applyInPandas(total, "block bigint, slot int, n_best bigint, count_sum bigint")


def align(docs: DataFrame, a_path: str = A_PATH, b_path: str = B_PATH, groups: Callable[[Column], Column] = lambda c: c) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups (``a1,a2|b1;a3|b2,b3``), n_best, count_sum; ``groups``: what is kept of that column."""
    rows = materialize(index(docs, a_path, b_path).withColumn("groups", groups(F.col("groups"))), "alignment")
    postings = rows.filter("bucket is not null")
    parts = max(1, -(-postings.select("block").distinct().count() // PART_BLOCKS))
    postings = postings.withColumn("part", F.pmod(F.xxhash64("block"), F.lit(parts)).cast("long"))
    counts = materialize(pair_counts(postings), "pairs")
    found = scores(postings, counts, parts).select(F.col("block").alias("in_block"), F.col("slot").alias("at"), "n_best", "count_sum")
    heads = rows.filter("bucket is null")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return (heads.join(found, (F.col("block") == F.col("in_block")) & (F.col("slot") == F.col("at")), "left")
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", zero("n_best"), zero("count_sum")))


def op13_pair_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = lambda c: F.when(c == "", c).otherwise(F.sha2(c.cast("binary"), 256))
    found = align(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), groups=digest)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))
