"""Byte-level word and shingle hashing over Arrow string columns (numpy, no per-word Python).

Word classes of the contracts only separate at ASCII bytes, so a UTF-8 buffer can be cut into words
byte by byte: a byte >= 0x80 always belongs to a word.  A string column is used through its Arrow
buffers; nulls count as empty texts.  Work is done in chunks of whole texts of about ``CHUNK`` bytes, so
memory is bounded by some twenty times the chunk, plus some ten times the longest single text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_SHINGLE = _U(0xD6E8FEB86659FD93)


def byte_class(excluded: list[tuple[int, int]]) -> np.ndarray:
    """256 booleans: which bytes belong to a word, all but the given inclusive ranges."""
    table = np.ones(256, bool)
    for lo, hi in excluded:
        table[lo:hi + 1] = False
    return table


#: Words of the shingle contracts: everything but blank, tab, line feed, vertical tab, form feed, return.
BLANK_SEPARATED = byte_class([(0x20, 0x20), (0x09, 0x0D)])
#: Words of the decontamination contract: digits, a-z (after lower-casing) and all non-ASCII bytes.
LETTER_DIGIT = byte_class([(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (a bijection), so that every bit of the hash depends on every input bit."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> _U(33)
    h *= _U(0xFF51AFD7ED558CCD)
    h ^= h >> _U(33)
    h *= _U(0xC4CEB9FE1A85EC53)
    h ^= h >> _U(33)
    return h


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null has an empty span."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offsets


def chunks(offsets: np.ndarray, limit: int = CHUNK):
    """Ranges [i, j) of whole texts of at most ``limit`` bytes together (one text at least)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


#: Powers of the base and of its inverse modulo 2**64, for one slice.
SLICE = 1 << 18
_POWER = np.concatenate([[_U(1)], np.cumprod(np.full(SLICE, _BASE, np.uint64))])
_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
_DOWN = np.concatenate([[_U(1)], np.cumprod(np.full(SLICE, _INVERSE, np.uint64))])


def _prefix_at(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Sums of value * base**position over data[:place], modulo 2**64, at ascending places; slice by slice, so memory is bounded."""
    out = np.zeros(len(places), np.uint64)
    total, scale = _U(0), _U(1)
    with np.errstate(over="ignore"):
        for lo in range(0, len(data), SLICE):
            part = _BYTE_VALUE[data[lo:lo + SLICE]]
            part *= _POWER[:len(part)]
            np.cumsum(part, out=part)
            a, b = np.searchsorted(places, [lo + 1, lo + len(part) + 1])
            out[a:b] = total + part[places[a:b] - lo - 1] * scale
            total += part[-1] * scale
            scale *= _POWER[SLICE]
    return out


def _lowered(places: np.ndarray) -> np.ndarray:
    """base**-place, modulo 2**64."""
    out = _DOWN[places % SLICE]
    blocks = places // SLICE
    if len(blocks) and blocks[-1]:
        out = out * np.concatenate([[_U(1)], np.cumprod(np.full(int(blocks[-1]), _DOWN[SLICE], np.uint64))])[blocks]
    return out


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes of ascending spans that do not overlap: value * base**(place within the span, from 1), summed, modulo 2**64."""
    h = _prefix_at(data, end)
    h -= _prefix_at(data, start)
    h *= _lowered(start)
    h *= _BASE
    h += (end - start).astype(np.uint64)
    return mix(h)


def places(raw: np.ndarray, offsets: np.ndarray, table: np.ndarray):
    """Places of the words of consecutive texts: start and end byte per word relative to the first text, word offsets per text."""
    data = raw[offsets[0]:offsets[-1]]
    at = (offsets - offsets[0]).astype(np.int64)
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(at), np.int64)
    inside = table[data]
    edges = np.empty(len(data), bool)
    edges[0] = inside[0]
    np.greater(inside[1:], inside[:-1], out=edges[1:])
    cut = at[:-1][at[:-1] < len(data)]
    edges[cut] = inside[cut]
    start = np.flatnonzero(edges)
    edges[-1] = inside[-1]
    np.greater(inside[:-1], inside[1:], out=edges[:-1])
    last = at[1:][at[1:] > 0] - 1
    edges[last] = inside[last]
    return start, np.flatnonzero(edges) + 1, np.searchsorted(start, at)


def words(raw: np.ndarray, offsets: np.ndarray, table: np.ndarray, lower: bool = True):
    """Words of consecutive texts.

    Returns (hash per word, start and end byte per word relative to the first text, word offsets per text).
    Letters A-Z are lower-cased before hashing, unless ``lower`` is false.
    """
    data = raw[offsets[0]:offsets[-1]]
    if lower:
        data = _LOWER[data]
    start, end, per_text = places(data, offsets - offsets[0], table)
    if not len(start):
        return np.zeros(0, np.uint64), start, end, per_text
    return span_hashes(data, start, end), start, end, per_text


def shingles(h: np.ndarray, per_text: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word windows of each text (the whole sequence if it has fewer words, but some).

    Returns (hashes, offsets per text); repeated shingles are kept.
    """
    n_words = np.diff(per_text)
    n = np.where(n_words >= k, n_words - k + 1, (n_words > 0).astype(np.int64))
    off = np.concatenate([[0], np.cumsum(n)])
    out = np.empty(off[-1], np.uint64)
    total = len(h)
    if total >= k:
        roll = np.zeros(total - k + 1, np.uint64)
        for i in range(k):
            roll = roll * _SHINGLE + h[i:total - k + 1 + i]
        roll = mix(roll + _U(k))
        full = np.flatnonzero(n_words >= k)
        at = np.repeat(per_text[full] - off[full], n[full])
        place = np.arange(off[-1])
        owner_full = np.repeat(n_words >= k, n)
        out[owner_full] = roll[place[owner_full] + at]
    for t in np.flatnonzero((n_words > 0) & (n_words < k)):
        acc = _U(0)
        with np.errstate(over="ignore"):
            for x in h[per_text[t]:per_text[t + 1]]:
                acc = acc * _SHINGLE + x
            out[off[t]] = mix(np.array([acc + _U(n_words[t])], np.uint64))[0]
    return out, off
