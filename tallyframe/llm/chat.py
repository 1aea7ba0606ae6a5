"""Chat formatting of reply trees (operator 9).

Messages form trees by (conv_id, parent_id).  Iterative self-joins double the reach of each message's
ancestor pointer per round (a thread of n turns needs log2(n) rounds), adding up scores on the way, so
that every leaf knows the score of its branch.  The best branches of each conversation are chosen, the same
pointer tables enumerate their root-to-leaf paths, and each path becomes one formatted conversation.

Template: ``### role: text</turn>`` and a line feed per turn.  Inside roles and texts ``\\`` becomes ``\\\\``, ``#`` becomes
``\\#`` and ``</turn>`` becomes ``<\\/turn>`` (roles also escape ``:``), so no control string can come from data
and ``parse`` restores every character.  The loss mask lists the (start, end) code points of assistant
texts in the formatted string, marks excluded.

Defined cases: null text or role counts as empty; a null conv_id is a conversation of its own; a parent that
does not exist, or is null, makes a root; a message without msg_id can have a parent but no replies (such rows are told apart by
their content); messages whose parents form a cycle belong to no path and are left out; rows that repeat (conv_id, msg_id) count once (the smallest by parent, role, text); an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyframe.session import materialize

TURN_END = "</turn>"
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\<]|\\.|<(?!/turn>))*)</turn>\n", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("#", "\\#").replace(TURN_END, "<\\/turn>")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[int]]:
    """Formatted conversation and its loss mask [start, end, start, end, ...] in code points."""
    parts, mask, at = [], [], 0
    for role, text in turns:
        head, body = f"### {escape(role).replace(':', chr(92) + ':')}: ", escape(text)
        if role == "assistant":
            mask += [at + len(head), at + len(head) + len(body)]
        parts += [head, body, TURN_END, "\n"]
        at += len(head) + len(body) + len(TURN_END) + 1
    return "".join(parts), mask


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at code point {at}")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return turns


def branches(messages: DataFrame, keep: int = 1) -> DataFrame:
    """Rows (conv_id, leaf_id, branch_rank, branch_score, depth, role, text) of the ``keep`` best paths per conversation.

    ``messages``: conv_id, msg_id, parent_id, role, text, score.  Branch score is the sum along the path;
    ties go to the smaller leaf id.  depth 0 is the root.
    """
    spark = messages.sparkSession
    content = F.when(F.col("msg_id").isNull(), F.xxhash64("parent_id", "role", "text", "score"))
    node = F.struct("conv_id", "msg_id", "_n")
    rows = messages.withColumn("_n", content).groupBy("conv_id", "msg_id", "_n").agg(F.min(F.struct("parent_id", "role", "text", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))).alias("m"))
    rows = materialize(rows.select(node.alias("node"), F.when(F.col("m.parent_id").isNotNull(), F.struct("conv_id", F.col("m.parent_id").alias("msg_id"), F.lit(None).cast("long").alias("_n"))).alias("up"), "m.role", "m.text", "m.score", "conv_id", "msg_id"), "turns")
    known = rows.select(F.col("node").alias("up_node"))
    pointers = materialize(rows.join(known, F.col("up") == F.col("up_node"), "left")
                           .select("node", F.col("up_node").alias("up"), F.col("score").alias("total"), F.lit(1).cast("long").alias("steps")), "reach")
    rounds, pending = [pointers], pointers.filter("up is not null").count()
    while pending:
        p = rounds[-1]
        far = p.select(F.col("node").alias("mid"), F.col("up").alias("far"), F.col("total").alias("far_total"), F.col("steps").alias("far_steps"))
        # only messages that have not reached their root are joined; every pointer leads to a known message
        step = (p.filter("up is not null").join(far, F.col("up") == F.col("mid"))
                .select("node", F.col("far").alias("up"), (F.col("total") + F.col("far_total")).alias("total"), (F.col("steps") + F.col("far_steps")).alias("steps")))
        rounds.append(materialize(p.filter("up is null").unionByName(step), "reach"))
        left = rounds[-1].filter("up is not null").count()
        if left == pending:  # only cycles are left
            break
        pending = left
    parents = rows.select(F.col("up").alias("node")).distinct()
    leaves = (rounds[-1].filter("up is null").join(parents, "node", "left_anti")
              .select(F.col("node.conv_id").alias("conv_id"), F.col("node").alias("leaf"), F.col("total").alias("branch_score"), "steps"))
    best = Window.partitionBy("conv_id").orderBy(F.col("branch_score").desc(), F.col("leaf.msg_id"), F.col("leaf._n"))
    chosen = leaves.withColumn("branch_rank", F.row_number().over(best)).filter(F.col("branch_rank") <= keep)
    paths = materialize(chosen.select("leaf", "branch_rank", "branch_score", F.col("leaf").alias("node"), (F.col("steps") - 1).alias("depth")), "paths")
    for k, p in enumerate(rounds):
        up = p.filter("up is not null").select("node", "up")
        paths = paths.unionByName(paths.join(up, "node").select("leaf", "branch_rank", "branch_score", F.col("up").alias("node"), (F.col("depth") - (1 << k)).alias("depth")))
        if k % 2:
            paths = materialize(paths, "paths")
    text = rows.select("node", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return paths.join(text, "node").select(F.col("leaf.conv_id").alias("conv_id"), F.col("leaf.msg_id").alias("leaf_id"), "branch_rank", "branch_score", "depth", "role", "text")


def format_conversations(messages: DataFrame, keep: int = 1) -> DataFrame:
    """One row per chosen path: conv_id, leaf_id, branch_rank, branch_score, formatted, loss_mask."""
    turns = branches(messages, keep).groupBy("conv_id", "leaf_id", "branch_rank", "branch_score").agg(
        F.sort_array(F.collect_list(F.struct("depth", "role", "text"))).alias("turns"))
    kind = turns.schema["conv_id"].dataType.simpleString()
    leaf = turns.schema["leaf_id"].dataType.simpleString()

    def formatted(batches):
        for b in batches:
            out = [render([(t["role"], t["text"]) for t in x]) for x in b.column("turns").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in ("conv_id", "leaf_id", "branch_rank", "branch_score")]
                + [pa.array([f for f, _ in out], pa.string()), pa.array([m for _, m in out], pa.list_(pa.int64()))],
                ["conv_id", "leaf_id", "branch_rank", "branch_score", "formatted", "loss_mask"])

    return turns.mapInArrow(formatted, f"conv_id {kind}, leaf_id {leaf}, branch_rank int, branch_score double, formatted string, loss_mask array<bigint>")


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted strings and masks say when read back."""
    kind = formatted.schema["conv_id"].dataType.simpleString()

    def read_back(batches):
        for b in batches:
            n, turns_sha, chars, loss_sha, total = [], [], [], [], []
            for text, mask in zip(b.column("formatted").to_pylist(), b.column("loss_mask").to_pylist()):
                turns = parse(text)
                loss = "".join(unescape(text[s:e]) for s, e in zip(mask[::2], mask[1::2]))
                n.append(len(turns))
                turns_sha.append(hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest())
                chars.append(len(loss))
                loss_sha.append(hashlib.sha256(loss.encode()).hexdigest())
                total.append(len(text))
            yield pa.RecordBatch.from_arrays(
                [b.column("conv_id"), pa.array(n, pa.int64()), pa.array(turns_sha, pa.string()), pa.array(chars, pa.int64()), pa.array(loss_sha, pa.string()), pa.array(total, pa.int64())],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.select("conv_id", "formatted", "loss_mask").mapInArrow(
        read_back, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


PROBE = "\\### Assistant: </turn> ok"


def op9_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], turns.schema)
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = turns.unionByName(probe).withColumn("msg_id", F.row_number().over(order).cast("long"))
    messages = numbered.select("conv_id", "msg_id", F.when(F.col("msg_id") > 1, F.col("msg_id") - 1).alias("parent_id"), "role", "text", F.lit(0.0).alias("score"))
    return digests(format_conversations(messages))
