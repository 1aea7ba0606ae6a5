"""Large families of near copies: settled by one pair a set, tiles compared once and in strips, results as by brute force."""

import numpy as np
import pyarrow as pa
import pytest

from tallyframe.llm import jaccard as J
from tallyframe.llm import paragraphs as P
from test_jaccard import brute, got, near_copies


def test_near_copies_need_no_tiles(spark, monkeypatch):
    rng = np.random.default_rng(8)
    texts = [f"{base} copy{k}" for base in (" ".join(f"w{x}" for x in rng.integers(0, 1 << 30, 60)) for _ in range(5)) for k in range(12)]
    docs = list(enumerate(texts))
    asked, tiles = [], J.tile_links
    monkeypatch.setattr(J, "tile_links", lambda members, *rest: asked.append(members.count()) or tiles(members, *rest))
    assert got(J.jaccard_components(spark.createDataFrame(docs, "doc_id bigint, text string"))) == brute(docs)
    assert asked == [0]


@pytest.mark.parametrize("tile, strip, dense", [(16, 5, 12), (40, 512, 2), (4096, 7, 100)])
def test_loose_family_in_tiles_and_strips(spark, monkeypatch, tile, strip, dense):
    for name, value in (("TILE", tile), ("STRIP", strip), ("DENSE", dense), ("LEADS", 1)):
        monkeypatch.setattr(J, name, value)
    docs = list(enumerate(near_copies(90, 5, words=50, changes=7)))
    assert got(J.jaccard_components(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3))) == brute(docs)


@pytest.mark.parametrize("dense, limit", [(12, 1 << 20), (3, 50), (1000, 7)])
def test_counts_of_blocks(monkeypatch, dense, limit):
    monkeypatch.setattr(J, "DENSE", dense)
    monkeypatch.setattr(J, "SLICE", limit)
    rng = np.random.default_rng(2)
    rows = [rng.choice(60, n, replace=False) for n in rng.integers(0, 25, 30)]
    want = np.array([[len(set(a) & set(b)) for b in rows] for a in rows])
    off_diagonal = ~np.eye(30, dtype=bool)
    for lo, hi, first, last in ((0, 30, 0, 30), (4, 9, 9, 30), (29, 30, 0, 3)):
        block = (slice(lo, hi), slice(first, last))
        assert (J.Shares(rows).count(lo, hi, first, last)[off_diagonal[block]] == want[block][off_diagonal[block]]).all()
    assert J.Shares([rows[0][:0]] * 3).count(0, 3, 0, 3).sum() == 0


def test_two_tiles_are_compared_with_each_other_only():
    sets = [np.arange(10, dtype=np.uint64)] * 6
    every = lambda _: lambda lo, hi, first, last: np.ones((hi - lo, last - first), bool)
    n = np.full(6, 10)
    assert len(J.similar(sets, n, every)[0]) == 5
    links = J.similar(sets, n, every, np.array([1, 1, 2, 2, 1, 1]), 4)
    assert sorted(zip(*(x.tolist() for x in links))) == [(4, 2), (5, 2), (3, 2)] or len(links[0]) == 3 and 0 not in np.concatenate(links)


def test_lines_in_tiles_as_whole(spark, monkeypatch):
    texts = [f"start {k} x\n{t}\nend {k} y" for k, t in enumerate(near_copies(50, 6, words=40, changes=4))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    want = sorted(map(tuple, P.removals(docs).collect()))
    assert want
    monkeypatch.setattr(J, "TILE", 8)
    monkeypatch.setattr(J, "STRIP", 3)
    assert sorted(map(tuple, P.removals(docs).collect())) == want


def test_removed_spans_of_many_texts_at_once(monkeypatch):
    calls, places = [], P.W.places
    monkeypatch.setattr(P.W, "places", lambda *a: calls.append(1) or places(*a))
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("cluster", pa.int64()), ("kept", pa.int64()), ("held", pa.bool_())]))
    span = lambda a, b, held=False: {"start": a, "stop": b, "cluster": a, "kept": None, "held": held}
    texts = ["a b c d e\nf g", None, "é b", "a b c d\ne f", "  ", "x y"] * 100
    spans = [[span(0, 2), span(1, 3)], None, [], [span(0, 3), span(3, 4, True)], None, [span(0, 2)]] * 100
    got = list(P.merged(pa.array(texts), pa.array(spans, kind)))
    assert got == [[(0, 5, 3, 0, None)], [], [], [(0, 5, 3, 0, None)], [], [(0, 3, 2, 0, None)]] * 100
    assert len(calls) == 1
