"""Near duplicates of the pipeline: of a family of near copies one row stays, and no tiles are compared for it."""

import numpy as np

import corpus_pipeline as C
from tallyframe.llm import jaccard as J


def test_families_leave_one_row_without_tiles(spark, monkeypatch):
    rng = np.random.default_rng(4)
    bases = [" ".join(f"w{x}" for x in rng.integers(0, 1 << 30, 60)) for _ in range(4)]
    rows = [(12 * i + k, f"{base} copy{k}") for i, base in enumerate(bases) for k in range(12)]
    asked, tiles = [], J.tile_links
    monkeypatch.setattr(J, "tile_links", lambda members, *rest: asked.append(members.count()) or tiles(members, *rest))
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert sorted(r["doc_id"] for r in C.one_of_each_group(spark, docs, "").collect()) == [0, 12, 24, 36]
    assert asked == [0]
