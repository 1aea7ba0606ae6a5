"""Reply-tree formatting: exact round trip, branch choice, digests against plain Python, odd inputs."""

import hashlib
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from tallyframe.llm import chat as C

SF = "/root/testdata/sf0.01"
COLS = "conv_id bigint, msg_id bigint, parent_id bigint, role string, text string, score double, formatted string"

nasty = st.lists(st.sampled_from(["\\", "#", "### ", "</turn>", "<", "/turn>", ":", ": ", "\n", "a", "é", "\U0001f600"]), max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a: b", "x\n### y"]), nasty), max_size=5))
def test_round_trip(turns):
    text, mask = C.render(turns)
    assert C.parse(text) == turns
    assert "".join(C.unescape(text[s:e]) for s, e in zip(mask[::2], mask[1::2])) == "".join(t for r, t in turns if r == "assistant")


def test_query_against_plain_python(spark):
    want = defaultdict(list)
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        want[r["conv_id"]].append((r["turn"], r["role"], r["text"] or ""))
    want[-7] = [(0, "user", C.PROBE), (1, "assistant", C.PROBE)]
    got = {r["conv_id"]: r for r in C.op9_reply_trees(spark, SF).collect()}
    assert got.keys() == want.keys()
    for k, turns in want.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        assert got[k]["n_turns"] == len(turns)
        assert got[k]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest()
        assert (got[k]["loss_chars"], got[k]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[k]["formatted_chars"] == len(C.render([(r, t) for _, r, t in turns])[0])


def test_branches(spark):
    rows = [(1, 1, None, "user", "q", 0.0, "x"), (1, 2, 1, "assistant", "bad", 1.0, "x"), (1, 3, 1, "assistant", "good", 2.0, "x"),
            (1, 4, 3, "user", None, None, "x"), (1, 4, 3, "user", None, None, "x"), (1, 5, 2, "user", "t", 1.0, "x"),
            (2, 1, 99, None, "orphan", 0.0, None), (3, 1, 2, "user", "loop", 0.0, None), (3, 2, 1, "user", "loop", 0.0, None),
            (None, 1, None, "user", "n", 0.0, None)]
    df = spark.createDataFrame(rows, COLS)
    got = {(r["conv_id"], r["branch_rank"]): C.parse(r["formatted"]) for r in C.format_conversations(df, 2).collect()}
    assert got == {(1, 1): [("user", "q"), ("assistant", "good"), ("user", "")], (1, 2): [("user", "q"), ("assistant", "bad"), ("user", "t")],
                   (2, 1): [("", "orphan")], (None, 1): [("user", "n")]}
    assert C.format_conversations(df.limit(0)).count() == 0


def test_long_thread(spark):
    rows = [(7, i, i - 1 if i else None, "user", str(i), 0.0, None) for i in range(300)]
    out = C.format_conversations(spark.createDataFrame(rows, COLS)).collect()
    assert len(out) == 1 and [t for _, t in C.parse(out[0]["formatted"])] == [str(i) for i in range(300)]


def test_messages_without_an_id(spark):
    rows = [(1, 1, None, "user", "q", 0.0, None), (1, 2, 1, "assistant", "a", 1.0, None), (1, None, 2, "user", "late", 5.0, None), (1, None, 2, "user", "later", 4.0, None),
            (1, None, 2, "user", "late", 5.0, None), (2, None, None, "user", "alone", 0.0, None), (None, None, None, "user", "lost", 0.0, None)]
    got = {(r["conv_id"], r["branch_rank"]): [t for _, t in C.parse(r["formatted"])] for r in C.format_conversations(spark.createDataFrame(rows, COLS), 9).collect()}
    assert got == {(1, 1): ["q", "a", "late"], (1, 2): ["q", "a", "later"], (2, 1): ["alone"], (None, 1): ["lost"]}
