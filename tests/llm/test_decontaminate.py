"""Suffix-automaton decontamination against a plain window search."""

import hashlib
import random
import re

from tallyframe.llm import decontaminate as D

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = WORD.findall(lower(text))
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i:i + 10]), set()).add(item)
    lengths = sorted({len(k) for k in windows})
    out = {}
    for doc, text in docs:
        w = WORD.findall(lower(text))
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if (got := windows.get(tuple(w[i:i + n]))) is not None:
                    hit |= set(range(i, i + n))
                    found |= got
        ids = sorted(str(x) for x in found if x is not None)
        out[doc] = (len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit))
    return out


def test_whole_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = {r["doc_id"]: tuple(r)[1:] for r in D.op7_suffix_automaton(spark, SF).collect()}
    assert got == brute(docs, items)
    assert any(v[-1] for v in got.values())


def frames(spark, docs, items):
    return (spark.createDataFrame(docs, "doc_id bigint, text string, n_words string, spans int"), spark.createDataFrame(items, "item_id bigint, text string, doc_id int"))


def test_random_small_alphabet(spark):
    rng = random.Random(5)
    items = [(i, " ".join(rng.choice("abc") for _ in range(rng.choice([1, 3, 9, 10, 11, 25]) if i else 4)), 0) for i in range(1, 9)] + [(20, None, 0), (21, "..", 0)]
    items = [x for x in items if x[1] is None or len(x[1]) != 1] + [(30, "a b c a b c a b c a b c", 0), (31, "a b c a b c a b c a b c", 0)]
    docs = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randrange(0, 60))), "x", 1) for i in range(150)] + [(1000, None, "x", 1), (1001, "", "x", 1), (1002, "A B,c a-b C a b c\na b c", None, None)]
    d, b = frames(spark, docs, items)
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], len(r["item_ids"])) for r in D.contamination(d, b).collect()}
    want = {k: v[:3] for k, v in brute([x[:2] for x in docs], [x[:2] for x in items]).items()}
    assert got == want


def test_blocks_of_items_agree(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(200)
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    import pyarrow as pa
    texts = pa.array([r["text"] for r in docs.collect()])
    one, many = D.build(bench), D.build(bench, limit=300)
    assert len(one) == 1 < len(many)
    key = lambda out: [(n, sp, h, sorted(f)) for n, sp, h, f in out]
    assert key(D.scan_texts(texts, one)) == key(D.scan_texts(texts, many))


def test_spans_removed_and_odd_inputs(spark):
    item = "one two three four five six seven eight nine ten eleven"
    docs = [(1, f"Clean start here and there and then. {item}! And a clean end of more words than those.", "k", 1), (2, item, "k", 1), (3, None, "k", 1), (4, "clean é", None, None), (4, "clean é", None, None)]
    d, b = frames(spark, docs, [(1, item, 0)])
    got = [(r["doc_id"], r["text"], r["n_words"]) for r in D.decontaminate(d, b).collect() if r["text"] is not None]
    assert sorted(got, key=lambda r: r[0]) == [(1, "Clean start here and there and then. ! And a clean end of more words than those.", "k"), (4, "clean é", None), (4, "clean é", None)]
    assert D.decontaminate(d, b).count() == 4
    assert D.decontaminate(d, b.limit(0)).count() == 5 and D.contamination(d.limit(0), b).count() == 0
