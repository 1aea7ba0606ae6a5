"""Digest trees: an ordered fingerprint of a table without one task that sees all of it.

Rows are written with a length before each value and a mark for NULL, so no two different rows give one text.  A leaf is a segment of the
order that the caller names (a month, say) and should hold what one task can sort; its digest is the SHA-256 of its rows' digests in order.  Every level above
digests its children in order, up to one root.  Two tables are compared from their trees; only segments whose leaves differ are read for
the differing rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def exact_text(cols: Sequence[str]) -> Column:
    """``length:value`` of each column, ``-`` for NULL: different rows give different texts."""
    text = [F.col(c).cast("string") for c in cols]
    return F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text])


def row_digest(cols: Sequence[str]) -> Column:
    """Hex SHA-256 of ``exact_text``."""
    return F.sha2(exact_text(cols), 256)


def _ordered(value: str, *order: Column) -> Column:
    """Values one after the other in the order given, hashed."""
    rows = F.array_sort(F.collect_list(F.struct(*order, F.col(value).alias("_v"))))
    return F.sha2(F.array_join(F.transform(rows, lambda r: r["_v"]), ""), 256)


def tree(df: DataFrame, segments: Sequence[tuple[str, Column]], order: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    """level, path, row_count, digest of all nodes; ``segments``: (name, expression) from the coarsest to the leaf.

    ``path`` joins the segment values of a node with "/"; the root (level 0) has an empty path.  Rows of a leaf are ordered by ``order``, then by their digest,
    so rows equal in the order need no other rule.
    """
    names = [n for n, _ in segments]
    rows = df.select(*[e.cast("string").alias(n) for n, e in segments], *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], row_digest(cols or df.columns).alias("digest"))
    node = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("row_count"), _ordered("digest", *[F.col(f"_o{i}") for i in range(len(order))]).alias("digest"))
    path = lambda upto: F.concat_ws("/", *[F.coalesce(F.col(n), F.lit("-")) for n in names[:upto]])
    levels = [node.select(F.lit(len(names)).alias("level"), path(len(names)).alias("path"), "row_count", "digest")]
    for upto in range(len(names) - 1, -1, -1):
        node = node.groupBy(*names[:upto]).agg(F.coalesce(F.sum("row_count"), F.lit(0).cast("bigint")).alias("row_count"), _ordered("digest", F.col(names[upto])).alias("digest"))
        levels.append(node.select(F.lit(upto).alias("level"), path(upto).alias("path"), "row_count", "digest"))
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out


def differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """level, path of the nodes of two trees that are not equal (one side may lack a node)."""
    r = right.select(F.col("level").alias("_l"), F.col("path").alias("_p"), F.col("digest").alias("_d"))
    both = left.join(r, (F.col("level") == F.col("_l")) & (F.col("path") == F.col("_p")), "full")
    return both.filter(~F.col("digest").eqNullSafe(F.col("_d"))).select(F.coalesce("level", "_l").alias("level"), F.coalesce("path", "_p").alias("path"))


def located(left: DataFrame, right: DataFrame, segments: Sequence[tuple[str, Column]], order: Sequence[str]) -> DataFrame:
    """Rows of only one side (column ``side``: left or right), as multisets; rows are compared in segments that differ only."""
    leaf = len(segments)
    bad = differing(tree(left, segments, order, left.columns), tree(right, segments, order, left.columns)).filter(F.col("level") == leaf).select(F.col("path").alias("_bad"))
    here = F.concat_ws("/", *[F.coalesce(e.cast("string"), F.lit("-")) for _, e in segments])

    def suspects(df: DataFrame) -> DataFrame:
        return df.withColumn("_path", here).join(bad, F.col("_path") == F.col("_bad"), "left_semi").drop("_path")

    a, b = suspects(left), suspects(right.select(*left.columns))
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))
