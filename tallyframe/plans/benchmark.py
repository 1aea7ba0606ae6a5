"""Two-variant join/write benchmark: shuffle join vs checked broadcast, flat vs day-partitioned files."""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tallyframe import types as TT
from tallyframe.session import path_exists
from tallyframe.sources.layout import write_sized

# A side is broadcast only when its text size is at most this (measured, not assumed).
BROADCAST_MAX_BYTES = 64 * 1024 ** 2

# Fixed values of the two variants.
VARIANTS = {
    "baseline": {"shuffle_partitions": 64, "broadcast": False, "partitioned": False,
                 "target_bytes": 16 * 1024 ** 2},
    "candidate": {"shuffle_partitions": 8, "broadcast": True, "partitioned": True,
                  "target_bytes": 128 * 1024 ** 2},
}


def small_enough(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Whether all values, as text and 16 bytes a field, fit the bound (one partial aggregation)."""
    width = functools.reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + F.lit(16) for c in df.columns])
    return (df.agg(F.sum(width.cast("long"))).first()[0] or 0) <= max_bytes


def join_accounts(tx: DataFrame, accounts: DataFrame, strategy: str = "auto", on: str = "account_id",
                  how: str = "inner") -> DataFrame:
    """Fact -> account join with an explicit physical choice.

    broadcast: only after ``small_enough``; otherwise falls back to a shuffle
    join.  shuffle: sort-merge join hint.  auto: let AQE decide from runtime
    sizes (it converts to a broadcast only under its measured threshold).
    """
    if strategy == "broadcast":
        side = F.broadcast(accounts) if small_enough(accounts) else accounts.hint("merge")
        return tx.join(side, on, how)
    if strategy == "shuffle":
        return tx.join(accounts.hint("merge"), on, how)
    return tx.join(accounts, on, how)


def typed_transactions(raw_json: DataFrame) -> DataFrame:
    """Cast the narrow JSON projection to the fact types (try_cast: bad text becomes NULL)."""
    return raw_json.select(
        "transaction_id", "account_id",
        F.col("event_at").try_cast("timestamp").alias("event_at"),
        F.col("amount").try_cast(TT.MONEY).alias("amount"),
        "currency", "status", "channel")


def write_variant(df: DataFrame, path: str, target_bytes: int, unit: str | None = None) -> None:
    """Write files of about ``target_bytes`` (row size measured), flat or in folders by a ``unit`` of the event time ("day", "month", ...).

    The caller names the unit: a folder should hold at least a file's worth of rows.
    """
    if unit is None:
        write_sized(df, path, target_bytes)
    else:
        write_sized(df.withColumn("event_from", F.to_date(F.date_trunc(unit, "event_at"))), path, target_bytes, ("event_from",))


def day_rows(spark: SparkSession, path: str, schema: StructType, day: dt.date, unit: str | None = None) -> DataFrame:
    """The rows of one day; of a table in folders only the folder that holds the day is listed and read."""
    if unit is None:
        table = spark.read.schema(schema).parquet(path)
    else:
        start = spark.range(1).select(F.to_date(F.date_trunc(unit, F.lit(day)))).first()[0]
        folder = f"{path}/event_from={start.isoformat()}"
        table = spark.read.schema(schema).parquet(folder) if path_exists(spark, folder) else spark.createDataFrame([], schema)
    return table.filter(F.to_date("event_at") == F.lit(day))


def measures(table: DataFrame) -> DataFrame:
    """One row: row_count and total_amount of a written variant (equal for all variants)."""
    return table.agg(F.count(F.lit(1)).alias("row_count"), F.sum("amount").cast(TT.TOTAL).alias("total_amount"))
