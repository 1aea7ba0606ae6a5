"""Language identification with span labels (operator 1).

Every word gets one log-probability per language from hashed character n-grams (n = 1 to 4, word borders
included).  The script of a word (Unicode ranges) narrows the languages that may claim it to those whose training texts
use that script.  Viterbi over the words of a text, with a fixed penalty for each change of language, labels
spans; short stretches of foreign words thus need enough evidence to break a span.  A text's language is the one whose spans hold
most letters, its score their share of all letters.

Learning counts n-grams on the executors over a bounded sample: at most about ``TRAIN_TEXTS`` texts per language, chosen by a
hash of doc_id.  The model is one table of HASHES x languages floats.

Scoring is vectorised over a whole Arrow batch: n-gram hashes per code point, sums per word, then one Viterbi step per word
position for all texts of the batch at once.

Defined cases: null text, empty text and text without letters give ``und``, score 0 and no spans; a word whose script no
language uses counts as no evidence; without any training text every text with letters is ``und``; ties go to the alphabetically first language; equal rows
get equal results; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TRAIN_TEXTS = 2000
HASHES = 1 << 16
SWITCH = 12.0
FLOOR = 0.5
CHUNK_CHARS = 1 << 20
#: Code points of whole texts that go through one run of Viterbi together (one text at least).
BATCH_CHARS = 12 << 20

#: Script ranges (first code point, script number); fixed values from the Unicode block chart.
SCRIPTS = [(0x0000, 1), (0x0370, 2), (0x0400, 3), (0x0530, 4), (0x0590, 5), (0x0600, 6), (0x0700, 0), (0x0900, 7), (0x0980, 8), (0x0E00, 9),
           (0x0E80, 0), (0x1100, 10), (0x1200, 0), (0x1E00, 1), (0x1F00, 2), (0x2000, 0), (0x3040, 11), (0x3100, 12), (0x3130, 10), (0x3190, 12),
           (0xAC00, 10), (0xD7B0, 0), (0xF900, 12), (0xFB00, 1), (0xFB13, 0), (0x20000, 12), (0x32000, 0)]
N_SCRIPTS = 13

_TABLES: list = []


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: lower case, and whether it is a letter (built once per process)."""
    if not _TABLES:
        points = range(0x110000)
        _TABLES.append(np.fromiter((ord(c) if len(c := chr(p).lower()) == 1 else p for p in points), np.uint32, 0x110000))
        _TABLES.append(np.fromiter((chr(p).isalpha() for p in points), bool, 0x110000))
    return _TABLES[0], _TABLES[1]


def _codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    n = np.array([len(t) if t else 0 for t in texts], np.int64)
    data = np.frombuffer("".join(t for t in texts if t).encode("utf-32-le", "surrogatepass"), "<u4")
    return data, np.concatenate([[0], np.cumsum(n)])


def words_of(texts: list[str | None]):
    """n-gram buckets and words of some texts.

    Returns (bucket matrix [letters, 4], first letter per word, letters per word, script per word,
    start and end code point per word within its text, word offsets per text).
    """
    lower, letter = _tables()
    data, off = _codes(texts)
    is_letter = letter[data] if len(data) else np.zeros(0, bool)
    begins = is_letter.copy()
    if len(begins):
        begins[1:] &= ~is_letter[:-1]
        cut = off[:-1][off[:-1] < len(data)]
        begins[cut] = is_letter[cut]
    start = np.flatnonzero(begins)
    where = np.flatnonzero(is_letter)
    word = np.cumsum(begins)[where] - 1
    length = np.bincount(word, minlength=len(start)) if len(start) else np.zeros(0, np.int64)
    first = np.cumsum(length) - length
    per_text = np.searchsorted(start, off)
    c = lower[data[where]].astype(np.uint32)
    place = np.arange(len(where)) - np.repeat(first, length)
    before = [c]
    for k in (1, 2, 3):
        previous = np.zeros_like(c)
        previous[k:] = c[:-k] if k < len(c) else 0
        previous[place < k] = 1
        before.append(previous)
    grams = np.empty((len(c), 4), np.int32)
    acc = np.zeros(len(c), np.uint32)
    for k in range(4):
        acc = acc * np.uint32(0x01000193) + before[k] * np.uint32(0x9E3779B1)
        mixed = (acc ^ np.uint32(k * 0x7F4A7C15 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
        grams[:, k] = (mixed ^ (mixed >> np.uint32(15))) >> np.uint32(16)
    bounds = np.array([b for b, _ in SCRIPTS], np.uint32)
    numbers = np.array([s for _, s in SCRIPTS], np.int8)
    script = numbers[np.searchsorted(bounds, data[start], "right") - 1] if len(start) else np.zeros(0, np.int8)
    text_of = np.searchsorted(off, start, "right") - 1
    return grams, first, length, script, start - off[text_of], start - off[text_of] + length, per_text


def _pieces(texts: list[str | None], limit: int = CHUNK_CHARS):
    i, size = 0, 0
    for j, t in enumerate(texts):
        n = len(t) if t else 0
        if size and size + n > limit:
            yield i, j
            i, size = j, 0
        size += n
    if i < len(texts):
        yield i, len(texts)


class Model:
    """Log-probabilities [HASHES, languages] and the languages each script admits."""

    def __init__(self, langs: list[str], counts: np.ndarray, scripts: np.ndarray):
        self.langs = langs
        smooth = counts + FLOOR
        self.table = np.log(smooth / smooth.sum(0)).astype(np.float32) if langs else np.zeros((HASHES, 0), np.float32)
        share = scripts / np.maximum(scripts.sum(0), 1)
        self.admits = share >= 0.001

    def word_scores(self, grams, first, script) -> np.ndarray:
        if not len(first):
            return np.zeros((0, len(self.langs)), np.float32)
        per_letter = self.table[grams[:, 0]]
        for k in (1, 2, 3):
            per_letter += self.table[grams[:, k]]
        s = np.add.reduceat(per_letter, first, axis=0)
        s -= s.max(1, keepdims=True)
        ok = self.admits[script]
        s[~ok] -= 50.0
        s[~ok.any(1)] = 0.0
        return s


def learn(train: DataFrame, texts_per_lang: int = TRAIN_TEXTS) -> Model:
    """Count n-grams and scripts per language over a bounded sample of (doc_id, text, lang)."""
    train = train.filter("text is not null and lang is not null").select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    sizes = {r["lang"]: r["n"] for r in train.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], np.zeros((HASHES, 0)), np.zeros((N_SCRIPTS, 0)))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 20))
    rate = F.create_map(*[F.lit(x) for lang in langs for x in (lang, min(1 << 20, max(1, (texts_per_lang << 20) // sizes[lang])))])
    sample = train.filter(draw < F.element_at(rate, F.col("lang")))
    number = {lang: i for i, lang in enumerate(langs)}

    def count(batches):
        grams_n = np.zeros((len(langs), HASHES), np.int64)
        scripts_n = np.zeros((len(langs), N_SCRIPTS), np.int64)
        for b in batches:
            texts, owners = b.column("text").to_pylist(), np.array([number[x] for x in b.column("lang").to_pylist()])
            for i, j in _pieces(texts):
                grams, first, length, script, _, _, per_text = words_of(texts[i:j])
                of_word = np.repeat(owners[i:j], np.diff(per_text))
                of_letter = np.repeat(of_word, length)
                for lang in np.unique(of_word):
                    grams_n[lang] += np.bincount(grams[of_letter == lang].ravel(), minlength=HASHES)
                    scripts_n[lang] += np.bincount(script[of_word == lang], minlength=N_SCRIPTS)
        both = np.concatenate([grams_n, scripts_n], axis=1)
        lang, slot = np.nonzero(both)
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.int32()), pa.array(slot, pa.int32()), pa.array(both[lang, slot], pa.int64())], ["lang", "slot", "n"])

    rows = sample.select("text", "lang").mapInArrow(count, "lang int, slot int, n bigint").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    both = np.zeros((len(langs), HASHES + N_SCRIPTS))
    both[rows.column("lang").to_numpy(), rows.column("slot").to_numpy()] = rows.column("n").to_numpy()
    return Model(langs, both[:, :HASHES].T.copy(), both[:, HASHES:].T.copy())


def viterbi(scores: np.ndarray, per_text: np.ndarray, switch: float) -> np.ndarray:
    """Best language per word for all texts at once, one step per word position."""
    n_words = np.diff(per_text)
    order = np.argsort(-n_words, kind="stable")
    start, n = per_text[:-1][order], n_words[order]
    longest = int(n[0]) if len(n) else 0
    label = np.zeros(len(scores), np.int8)
    if not longest or not scores.shape[1]:
        return label
    back = np.zeros(scores.shape, np.int8)
    active = np.searchsorted(-n, -np.arange(longest), "left")  # texts with more than t words
    v = scores[start[:active[0]]].copy()
    final = np.zeros(len(n), np.int8)
    langs = np.arange(scores.shape[1], dtype=np.int8)
    for t in range(1, longest):
        a = active[t]
        if a < len(v):
            final[a:len(v)] = v[a:].argmax(1)
            v = v[:a]
        top = v.argmax(1)
        best = v[np.arange(a), top] - switch
        stay = v >= best[:, None]
        rows = start[:a] + t
        back[rows] = np.where(stay, langs, top[:, None])
        v = np.where(stay, v, best[:, None]) + scores[rows]
        if t % 64 == 0:
            v -= v.max(1, keepdims=True)
    final[:len(v)] = v.argmax(1)
    current = final.copy()
    for t in range(longest - 1, -1, -1):
        a = active[t]
        rows = start[:a] + t
        label[rows] = current[:a]
        current[:a] = back[rows, current[:a]] if t else current[:a]
    return label


def label_texts(texts: list[str | None], model: Model, switch: float = SWITCH):
    """Per text: (language, score, spans [(start, end, language)])."""
    scores, lengths, starts, ends, offsets, total = [], [], [], [], [np.zeros(1, np.int64)], 0
    for i, j in _pieces(texts):
        grams, first, length, script, s, e, per_text = words_of(texts[i:j])
        scores.append(model.word_scores(grams, first, script))
        lengths.append(length)
        starts.append(s)
        ends.append(e)
        offsets.append(per_text[1:] + total)
        total += len(first)
    if not total or not model.langs:
        return [("und", 0.0, [])] * len(texts)
    per_text = np.concatenate(offsets)
    length, s, e = np.concatenate(lengths), np.concatenate(starts), np.concatenate(ends)
    label = viterbi(np.concatenate(scores), per_text, switch)
    text_of = np.repeat(np.arange(len(texts)), np.diff(per_text))
    n_langs = len(model.langs)
    letters = np.bincount(text_of * n_langs + label, weights=length, minlength=len(texts) * n_langs).reshape(len(texts), n_langs)
    new = np.ones(total, bool)
    new[1:] = (label[1:] != label[:-1]) | (text_of[1:] != text_of[:-1])
    heads = np.flatnonzero(new)
    tails = np.concatenate([heads[1:], [total]]) - 1
    spans: list[list] = [[] for _ in texts]
    for t, a, b, lang in zip(text_of[heads].tolist(), s[heads].tolist(), e[tails].tolist(), label[heads].tolist()):
        spans[t].append((a, b, model.langs[lang]))
    sums, best = letters.sum(1), letters.argmax(1)
    return [("und", 0.0, []) if not sums[t] else (model.langs[best[t]], float(letters[t, best[t]] / sums[t]), spans[t]) for t in range(len(texts))]


def identify(docs: DataFrame, model: Model, switch: float = SWITCH) -> DataFrame:
    """doc_id, lang_pred, score and the language spans (code points) of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # HASHES x languages floats
    kind = docs.schema["doc_id"].dataType.simpleString()
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))

    def label(batches):
        for b in batches:
            texts = b.column("text").to_pylist()
            out = [x for i, j in _pieces(texts, BATCH_CHARS) for x in label_texts(texts[i:j], shared.value, switch)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([x for x, _, _ in out], pa.string()), pa.array([x for _, x, _ in out], pa.float64()),
                 pa.array([[dict(zip(("start", "end", "lang"), x)) for x in spans] for _, _, spans in out], span)],
                ["doc_id", "lang_pred", "score", "spans"])

    return docs.select("doc_id", "text").mapInArrow(label, f"doc_id {kind}, lang_pred string, score double, spans array<struct<start: bigint, end: bigint, lang: string>>")


def op1_viterbi_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
    model = learn(docs.filter(~held_out))
    return identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))
