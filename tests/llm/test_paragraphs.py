"""Paragraph dedup: the 51-word guarantee, recall of similar lines, nothing else touched, odd inputs."""

from collections import defaultdict

import numpy as np

from tallyframe.llm import paragraphs as P
from plain import WORD, lower, shingles

SF = "/root/testdata/sf0.01"


def grams(text, n):
    w = WORD.findall(lower(text))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def long_lines(text):
    return [x for x in text.split("\n") if len(WORD.findall(x)) >= P.LINE_WORDS]


def test_no_shared_run_of_51_words_is_left(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    after = {r["doc_id"]: r["text"] for r in P.remove(docs).collect()}
    holders = defaultdict(set)
    for d, t in after.items():
        for g in grams(t, 51):
            holders[g].add(d)
    assert not [h for h in holders.values() if len(h) > 1]
    # texts that share no 20 words and no similar long line with any other are as they were
    held = defaultdict(set)
    for d, t in before.items():
        for g in grams(t, 20):
            held[g].add(d)
    lines = defaultdict(set)
    for d, t in before.items():
        for line in long_lines(t):
            for s in shingles(line):
                lines[s].add(d)
    clean = [d for d, t in before.items() if all(len(held[g]) == 1 for g in grams(t, 20)) and len(grams(t, 20)) == max(0, len(WORD.findall(t)) - 19)
             and all(len(lines[s]) == 1 for line in long_lines(t) for s in shingles(line))]
    assert len(clean) > 100 and all(after[d] == before[d] for d in clean)
    spans = P.op8_paragraph_minhash(spark, SF).collect()
    assert {r["doc_id"] for r in spans} == {d for d in before if after.get(d) != before[d]}
    for r in spans:
        cut = before[r["doc_id"]].encode()[r["start_byte"]:r["end_byte"]].decode()
        assert len(WORD.findall(cut)) == r["n_words"] and r["kept_doc_id"] <= r["doc_id"]


def test_passage_in_the_middle_of_lines_and_similar_lines(spark):
    rng = np.random.default_rng(4)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 1 << 40, n)]
    passage = " ".join(word(51))
    docs = [(i, " ".join(word(30)) + " " + passage + " " + " ".join(word(30))) for i in range(5)]
    line = word(60)
    similar = list(line)
    similar[30] = "other"
    docs += [(10, "\n".join([" ".join(word(25)), " ".join(line)])), (11, "\n".join([" ".join(similar), " ".join(word(25))]))]
    docs += [(20, " ".join(word(80))), (21, "short"), (22, None), (23, ""), (24, " ".join(word(40)) + "\n" + " ".join(line))]
    df = spark.createDataFrame([(d, t, "d", 1) for d, t in docs], "doc_id bigint, text string, spans string, key int")
    found = P.removals(df).collect()
    assert {r["doc_id"] for r in found} == {1, 2, 3, 4, 11, 24}
    assert {r["kept_doc_id"] for r in found if r["doc_id"] < 10} == {0} and {r["kept_doc_id"] for r in found if r["doc_id"] >= 10} == {10}
    left = {r["doc_id"]: r["text"] for r in P.remove(df).collect()}
    assert left[11] == docs[6][1].split("\n")[1] and left[22] is None and left[23] == "" and left[20] == docs[7][1]
    assert P.remove(df).columns == df.columns


def test_recall_of_similar_lines(spark):
    rows = [(r["doc_id"], line) for r in spark.read.parquet(f"{SF}/documents.parquet").collect() for line in r["text"].split("\n") if len(WORD.findall(line)) >= P.LINE_WORDS]
    sets, holders = [shingles(t) for _, t in rows], defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    links = set()
    for h in holders.values():
        for a in h[:50]:
            for b in h:
                if a < b and sets[a] != sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    links.add((a, b))
    docs = P.with_row_hash(spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id bigint, text string"))
    lines = P.units(docs).filter("kind = 0").cache()
    key = {r["doc_id"]: r["key"] for r in lines.collect()}
    root = {r["node"]: r["root"] for r in P.line_clusters(lines.select("key", "n", "bands", "shared")).collect()}
    of = lambda i: root.get(key[i], key[i])
    assert len(links) > 50 and sum(of(a) == of(b) for a, b in links) >= 0.97 * len(links)


def test_repeated_rows_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(1, text), (1, text), (2, text), (None, None)], "doc_id bigint, text string")
    assert sorted(str(r["doc_id"]) for r in P.remove(df).collect()) == ["1", "1", "None"]
    assert P.removals(df.limit(0)).count() == 0 and P.remove(df.limit(0)).count() == 0
