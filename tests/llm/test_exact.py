"""Two-pass Bloom dedup against plain grouping; no copy missed, one row of each group kept."""

import hashlib
import re
from collections import defaultdict

import pytest

from tallyframe.llm import exact as E

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, h string, part int, again int, row string, length string"


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def brute(docs):
    """doc_id, keep_id, group_size, kept, digest of every row, in no order."""
    groups = defaultdict(list)
    for k, d in enumerate(docs):
        groups[norm(d[1])].append((-len(d[1] or ""), d[0] is None, d[0] or 0, k))
    out = []
    for text, rows in groups.items():
        first = min(rows)
        out += [(docs[k][0], docs[first[3]][0], len(rows), (a, b, c) == first[:3], hashlib.sha256(text.encode()).hexdigest()) for a, b, c, k in rows]
    return sorted(out, key=repr)


def test_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in E.op12_two_pass_bloom(spark, SF).collect()), key=repr) == brute(docs)


def test_no_python_on_the_main_path(spark):
    plan = E.op12_two_pass_bloom(spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def rows(n):
    base = [(1, "a b"), (2, " a\tb\n"), (3, "ab"), (None, "ab  "), (4, None), (5, ""), (6, " \x0b\x0c\r"), (7, "A b"), (8, "é x" * 30000), (9, "éx" * 30000), (None, None), (10, "a b"), (2, " a\tb\n")]
    return [(*base[i % len(base)], "h", 1, 2, "r", "l") for i in range(n)]


@pytest.mark.parametrize("n", [0, 1, 13, 400])
def test_nulls_blanks_ties_repeats_and_clashing_columns(spark, n):
    docs = spark.createDataFrame(rows(n), SCHEMA).repartition(3)
    got = sorted((tuple(r) for r in E.exact_groups(docs).collect()), key=repr)
    want = brute(rows(n))
    # of rows equal in text and id any one may stay, but only one
    assert [g[:3] + g[4:] for g in got] == [w[:3] + w[4:] for w in want]
    assert sum(g[3] for g in got) == len({g[4] for g in got})
    kept = E.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(norm(r["text"]) for r in kept.collect()) == sorted({norm(r[1]) for r in rows(n)})
    assert {(r["doc_id"], r["text"]) for r in kept.collect()} == {(d[0], d[1]) for d, w in zip(rows(n), [min(((-len(x[1] or ""), x[0] is None, x[0] or 0, x) for x in rows(n) if norm(x[1]) == norm(d[1])), key=lambda r: r[:3]) for d in rows(n)]) if d == w[3]}


def test_small_parts_and_hot_groups_agree(spark, monkeypatch):
    docs = [(i, f"text {i // 2}" if i % 3 else "hot") for i in range(3000)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    monkeypatch.setattr(E, "PART_CELLS", 10000)
    monkeypatch.setattr(E, "HOT_SHARE", 10)
    assert sorted((tuple(r) for r in E.exact_groups(frame).collect()), key=repr) == brute(docs)
    assert E.keep_one(frame).count() == len({t for _, t in docs})


def test_rows_without_a_copy_pass_straight_through(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(5000)] + [(9000 + i, "copy") for i in range(2000)], "doc_id bigint, text string")
    from tallyframe.session import materialize
    from pyspark.sql import functions as F
    signed = materialize(docs.select(F.xxhash64("text").alias("h"), "text"))
    marked = E.filtered(signed, "h")
    assert marked.filter("again and text = 'copy'").count() == 2000
    assert marked.filter("again and text <> 'copy'").count() < 5000 * 0.05
