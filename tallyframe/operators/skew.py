"""Heavy-hitter split join: frequent keys are found by a bounded summary, their rows salted, their few partner rows replicated.

For joins whose partner side ends in an aggregate: rows of one key then meet in the task that aggregated it, and AQE cannot
split what no exchange separates.  One pass over the key columns keeps a frequent-items sketch of fixed size (``approx_top_k``: partial sketches merge, so
nothing grows with the keys).  A key that the sketch names wrongly, or misses, costs time and never a row: both sides derive the salt from
the same short list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: A key with at least this share of the rows is heavy, so there are at most 1 / SHARE of them.
SHARE = 0.01
#: Keys the sketch tracks.  Its counts are off by at most some rows / TRACKED, far below SHARE.
TRACKED = 4096
#: Parts that a heavy key's rows are dealt to.
SALTS = 32
#: Parts that the rows without a key are dealt to.
NULL_PARTS = 4096


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def heavy_keys(df: DataFrame, keys: Sequence[str], share: float = SHARE, tracked: int = TRACKED) -> list[int]:
    """Hashes of the keys with at least ``share`` of the rows: at most 1 / share numbers, from one partial aggregation."""
    most = min(tracked, int(2 / share))
    row = df.filter(F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))).select(_hash(keys).alias("h")).agg(
        F.expr(f"approx_top_k(h, {most}, {tracked})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return sorted(x["item"] for x in row["top"] or [] if x["count"] >= share * row["n"])[:int(1 / share) + 1]


def split_join(facts: DataFrame, partner: DataFrame, keys: Sequence[str], how: str = "inner", heavy: list[int] | None = None, salts: int = SALTS) -> DataFrame:
    """``facts`` joined to ``partner`` on ``keys`` (inner or left); heavy keys' facts are dealt over ``salts`` tasks.

    The salt is the number of the fact's input partition, so a recomputed task deals its rows as before.  Partner rows of heavy keys are repeated ``salts`` times.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    heavy = heavy_keys(facts, keys) if heavy is None else heavy
    if not heavy:
        return facts.join(partner, list(keys), how)
    hot = _hash(keys).isin(heavy)
    dealt = facts.withColumn("_salt", F.when(hot, F.pmod(F.spark_partition_id(), F.lit(salts))).otherwise(0))
    if int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions")) < salts:  # else the salts meet again in few tasks
        dealt = dealt.repartition(salts, *keys, "_salt")
    seats = F.when(hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return dealt.join(partner.withColumn("_salt", F.explode(seats)), [*keys, "_salt"], how).drop("_salt")


def left_join(facts: DataFrame, partner: DataFrame, key: str, partner_key: str) -> DataFrame:
    """``facts`` left-joined to ``partner`` on one key each; facts without a key meet no partner, and are dealt by their content.

    In a plain left join all rows whose key is NULL go to one task.  Here the key is a struct with a seat: 0 for every partner row and every fact
    with a key, 1 to ``NULL_PARTS`` by a hash of the row for facts without one.
    """
    seat = F.when(F.col(key).isNull(), 1 + F.pmod(F.xxhash64(*facts.columns), F.lit(NULL_PARTS))).otherwise(F.lit(0)).cast("int")
    dealt = facts.withColumn("_fact_seat", F.struct(F.col(key).alias("k"), seat.alias("seat")))
    seated = partner.withColumn("_partner_seat", F.struct(F.col(partner_key).alias("k"), F.lit(0).alias("seat")))
    return dealt.join(seated, F.col("_fact_seat") == F.col("_partner_seat"), "left").drop("_fact_seat", "_partner_seat")
