"""Hilbert sharding: the curve, the law of rows, slots, digests and odd inputs."""

import zlib

import pytest
from pyspark.sql import functions as F

from tallyframe.llm import sharding as S

SF = "/root/testdata/sf0.01"


def test_curve_visits_neighbouring_cells(spark):
    side = 1 << S.BITS
    cells = spark.range(S.CELLS).select((F.col("id") % side).alias("x"), (F.floor(F.col("id") / side) % side).alias("y"), F.floor(F.col("id") / side / side).alias("z"))
    at = {r["h"]: (r["x"], r["y"], r["z"]) for r in cells.select("x", "y", "z", S.hilbert_index(F.col("x"), F.col("y"), F.col("z")).alias("h")).collect()}
    assert sorted(at) == list(range(S.CELLS))
    assert all(sum(abs(a - b) for a, b in zip(at[i], at[i + 1])) == 1 for i in range(S.CELLS - 1))


def check(rows, docs, shards=8):
    assert len(rows) == len(docs)
    counts = [0] * shards
    slots = [set() for _ in range(shards)]
    for r in rows:
        counts[r["shard"]] += 1
        slots[r["shard"]].add(r["slot"])
    assert max(counts) - min(counts) <= 1
    assert all(s == set(range(n)) for s, n in zip(slots, counts))
    sizes = sorted((d["doc_id"], len((d["text"] or "").encode()) + 1, zlib.crc32((d["text"] or "").encode())) for d in docs)
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == sizes


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    rows = S.op6_hilbert_sharding(spark, SF).collect()
    check(rows, docs)
    assert {r["law"] for r in rows} == {"rows"} and {r["grown_shard"] for r in rows} == {None}
    order = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    assert [r["cell"] for r in order] == sorted(r["cell"] for r in rows)


@pytest.mark.parametrize("n", [0, 1, 5, 40])
def test_nulls_ties_repeats_and_clashing_columns(spark, n):
    base = [(1, None, None, None, 1, 2), (1, None, None, None, 1, 2), (2, "", "en", "a", 0, 0), (2, "x" * 70000, "en", None, 0, 0), (3, "same", "de", "a", 5, 5)]
    rows = [base[i % 5] for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, size int, shard int")
    check(S.assign(docs).collect(), docs.collect())


def test_write_shards(spark, scratch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    S.write_shards(docs, f"{scratch}/shards")
    back = spark.read.parquet(f"{scratch}/shards")
    assert back.count() == docs.count() and back.select("_shard").distinct().count() == 8


def test_write_shards_keeps_null_and_repeated_ids(spark, scratch):
    rows = [(None, "a", "en", "s"), (None, "b", "en", "s"), (1, "c", "de", None), (1, "d", None, "s"), (1, "c", "de", None)] * 4
    S.write_shards(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string"), f"{scratch}/odd")
    back = spark.read.parquet(f"{scratch}/odd")
    assert sorted(map(str, map(tuple, back.select("doc_id", "text", "lang", "source").collect()))) == sorted(map(str, rows))
    assert {r["_shard"] for r in back.select("_shard").collect()} == set(range(8))


def test_equal_texts_of_a_cell_are_one_stretch(spark, monkeypatch):
    monkeypatch.setattr(S, "RUN_ROWS", 20)
    rows = [(i, "hot text" if i % 3 == 0 else f"text {i % 200:03d}", "en", "s") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").repartition(5)
    assert S.frequent_texts(S.placed(docs, 4)).count() >= 1
    got = S.assign(docs).collect()
    check(got, docs.collect())
    order = sorted(got, key=lambda r: (r["shard"], r["slot"]))
    stretches = [r["text_crc32"] for i, r in enumerate(order) if i == 0 or (order[i - 1]["cell"], order[i - 1]["text_crc32"]) != (r["cell"], r["text_crc32"])]
    assert len(stretches) == len(set(stretches))  # no group is torn but by a cut between shards
    shards = {}
    for r in order:
        shards.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert sum(len(s) > 1 for s in shards.values()) <= 7 and max(shards.values(), key=len) == shards[zlib.crc32(b"hot text")]
