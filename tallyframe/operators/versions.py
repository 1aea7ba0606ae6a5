"""Latest-version-wins deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def _cols(order_by: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order_by]


def latest_wins(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str],
                method: str = "aggregate") -> DataFrame:
    """One row per key: the row with the greatest ``order_by`` tuple (all descending).

    ``order_by`` should end with a tie-breaker such as the record hash so the
    winner is deterministic.  NULL order values rank lowest, as in
    ``ORDER BY .. DESC NULLS LAST``.

    method="aggregate" (default): ``max(struct(order.., row))`` per key.  The
    partial aggregate runs before the shuffle, so a key carrying a third of
    all rows sends at most one row per map task; nothing is buffered per key.
    method="window": ``row_number() = 1`` (Spark adds a partial
    WindowGroupLimit); kept as the textbook form and for comparison.
    """
    order = _cols(order_by)
    if method == "window":
        w = Window.partitionBy(*keys).orderBy(*[c.desc() for c in order])
        return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    payload = [c for c in df.columns if c not in keys]
    ranked = F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order)],
                      F.struct(*[F.col(c) for c in payload]).alias("_row"))
    best = df.groupBy(*keys).agg(F.max(ranked).alias("_best"))
    return best.select(*keys, *[F.col(f"_best._row.{c}").alias(c) for c in payload]).select(*df.columns)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts (partial aggregation)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)
