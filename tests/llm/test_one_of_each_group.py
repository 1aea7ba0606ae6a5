"""Near duplicates: one row of each group stays whatever its doc_id."""

from collections import Counter

import corpus_pipeline as C


def test_null_and_repeated_ids_lose_no_clean_document(spark):
    text = lambda k: " ".join(f"t{k}w{i}" for i in range(40))
    near = text(1).replace("t1w39", "other")
    rows = [(None, text(k)) for k in range(1, 6)] + [(None, text(2)), (None, None), (None, None), (None, " \n"), (8, "")]
    rows += [(7, text(6)), (7, text(7)), (7, near), (7, text(7)), (9, text(6)), (3, text(8)), (4, text(8))]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = Counter((r["doc_id"], r["text"]) for r in C.one_of_each_group(spark, docs, "").collect())
    want = [(None, text(k)) for k in range(1, 6)] + [(None, None), (None, None), (None, " \n"), (8, ""), (7, text(6)), (7, text(7)), (3, text(8))]
    assert got == Counter(want)
