"""The pipeline's stages against plain versions, on the smallest tables."""

import pyarrow as pa

import corpus_pipeline as C
from tallyframe.llm import decontaminate, quality
from tallyframe.session import materialize
from test_decontaminate import brute as leaks
from test_jaccard import brute as groups
from test_packing import check as check_bins
from test_paragraphs import grams

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = materialize(spark.read.parquet(f"{SF}/documents.parquet"), "docs")
    stages, tables = dict(C.STAGES), [docs]
    for name, stage in C.STAGES:
        tables.append(materialize(stage(spark, tables[-1], SF), name))
    good, single, unique, clean, packed = tables[1:]
    columns = docs.columns
    assert list(stages) == ["quality", "near_duplicates", "repeated_passages", "decontamination", "packing"]
    assert all(t.columns == columns for t in tables[:-1])
    text = lambda t: {r["doc_id"]: r["text"] for r in t.collect()}

    # quality: rows are kept whole, and exactly those the network accepts
    params = quality.learn(docs, spark.read.parquet(f"{SF}/labels.parquet"), "quality", keep=C.training.held_out(5, 0) == False)  # noqa: E712
    rows = docs.collect()
    p = quality.probability(pa.array([r["text"] for r in rows]), params)
    assert text(good) == {r["doc_id"]: r["text"] for r, x in zip(rows, p) if x >= quality.THRESHOLD}
    assert 0 < good.count() < docs.count()
    # near duplicates: the smallest document of each group
    want = {c for d, _, c in groups(list(text(good).items())) if d == c}
    assert text(single) == {d: t for d, t in text(good).items() if d in want}
    # repeated passages: no 51 words are left in two documents, other texts untouched
    held = {}
    for d, t in text(unique).items():
        for g in grams(t, 51):
            assert held.setdefault(g, d) == d
    # decontamination: no window is left whole, texts without one are untouched
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = leaks(list(text(unique).items()), items)
    after = text(clean)
    for d, t in text(unique).items():
        if not before[d][1]:
            assert after[d] == t
        elif before[d][1] > 0.5 * before[d][0]:
            assert d not in after
        else:
            assert after[d] != t
    assert any(v[1] for v in before.values())
    assert all(r["n_chars"] == len(r["text"]) for r in clean.collect())
    check_bins(packed.collect(), after, C.packing.CAPACITY)
    assert sorted(map(str, C.run(spark, SF).collect())) == sorted(map(str, packed.collect()))


def test_stages_take_empty_tables(spark):
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in C.STAGES:
        assert stage(spark, empty, SF).count() == 0
    assert decontaminate.WINDOW == 10
