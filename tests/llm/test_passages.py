"""Paragraph dedup: shared passages go whole, and every removed passage is still held by some document."""

import numpy as np

from tallyframe.llm import paragraphs as P


def test_whole_passage_goes_and_nothing_else(spark):
    rng = np.random.default_rng(11)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 1 << 40, n)]
    docs, want = [], {}
    for k, size in enumerate((51, 52, 60, 75, 100, 230)):
        passage = word(size)
        for copy in range(3):
            head, tail = word(400), word(400)
            docs.append((10 * k + copy, " ".join(head + passage + tail)))
            want[10 * k + copy] = head + (tail if copy else passage + tail)
    left = {r["doc_id"]: r["text"].split() for r in P.remove(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert left == want


def test_every_removed_passage_is_still_held(spark):
    rng = np.random.default_rng(12)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 1 << 40, n)]
    join = " ".join
    line, passage, other = word(400), word(60), word(60)
    # 2 is a near copy of 1 and goes, so 3 holds the passage; 4 repeats it
    docs = [(1, join(line)), (2, join(line[:200] + passage + line[200:])), (3, join(word(100) + passage)), (4, join(word(100) + passage))]
    # three quarters of 11 are a repeat of 10; the rest is what 12 repeats, and stays
    docs += [(10, join(word(900) + (most := word(240)))), (11, join(most + other)), (12, join(other + word(900)))]
    # periodic text
    docs += [(20, join(["a"] * 100)), (21, None)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    left = {r["doc_id"]: r["text"] for r in P.remove(df).collect()}
    assert 2 not in left and left[1] == docs[0][1] and left[3] == docs[2][1]
    assert left[4] == docs[3][1].removesuffix(join(passage)).strip()
    assert left[11] == join(other) and left[12] == docs[6][1].removeprefix(join(other)).strip()
    assert left[20] == join(["a"] * 20) and left[21] is None
    kept = {r["doc_id"]: r["kept_doc_id"] for r in P.removals(df).collect()}
    assert kept == {2: 1, 4: 3, 11: 10, 12: 11, 20: 20}
