"""Marts over the transactions fact, in exact decimals (sums per currency only)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyframe import types as TT
from tallyframe.operators import sequence, temporal
from tallyframe.session import materialize

def _zero() -> Column:
    return F.lit(0).cast(TT.MONEY)


def _posted(tx: DataFrame, status: str = "POSTED") -> DataFrame:
    return tx.filter(F.col("status") == status)


def _total(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(c).cast(TT.TOTAL)


def payments_daily(tx: DataFrame) -> DataFrame:
    """POSTED count and amount by UTC day x currency x channel."""
    return (_posted(tx).groupBy(F.to_date("event_at").alias("payment_date"), "currency", "channel")
            .agg(F.count(F.lit(1)).alias("transaction_count"), _total("amount").alias("total_amount")))


def customer_activity(tx: DataFrame) -> DataFrame:
    """POSTED incoming/outgoing amounts, count and last event by customer x day x currency."""
    return (_posted(tx).groupBy("customer_id", F.to_date("event_at").alias("activity_date"), "currency")
            .agg(F.count(F.lit(1)).alias("transaction_count"),
                 _total(F.when(F.col("direction") == "IN", F.col("amount")).otherwise(_zero())).alias("incoming_amount"),
                 _total(F.when(F.col("direction") == "OUT", F.col("amount")).otherwise(_zero())).alias("outgoing_amount"),
                 F.max("event_at").alias("last_event_at")))


def control_totals(tx: DataFrame) -> DataFrame:
    """Expected POSTED count and amount per currency (the reconciliation control)."""
    return _posted(tx).groupBy("currency").agg(F.count(F.lit(1)).alias("transaction_count"),
                                               _total("amount").alias("total_amount"))


def history_mart(h: DataFrame) -> DataFrame:
    return h.select("customer_version_id", "customer_id", "region", "segment", "valid_from", "valid_to",
                    "is_current", "change_version")


def daily_rollup(tx: DataFrame, day: Column | str, date_col: str = "event_date") -> DataFrame:
    """One day's amount by currency x channel.

    Filters on a physical date column so a day-partitioned table prunes
    its directories instead of scanning every file.
    """
    day = F.lit(day).cast("date") if isinstance(day, str) else day
    return (tx.filter(F.col(date_col) == day).groupBy("currency", "channel")
            .agg(F.count(F.lit(1)).alias("transaction_count"), _total("amount").alias("total_amount")))


def historical_turnover(tx: DataFrame, history: DataFrame, form: str = "asof", method: str = "buckets", unit: str = "month") -> DataFrame:
    """Turnover by customer x day x currency with the segments valid at event time.

    POSTED facts are bound to history (inner, at event time), aggregated
    (sorted distinct segments, sum), then per (customer, currency) in day
    order: running total, delta to the previous active day (two-level scans over months, see ``sequence``), and a dense rank
    of customers per (day, currency) by turnover.  They run on the daily
    aggregate: one row per customer-day, never per fact.
    """
    bound = temporal.bind(_posted(tx), history, "customer_id", "event_at", columns=("segment",), how="inner",
                          form=form, method=method)
    daily = (bound.groupBy("customer_id", F.to_date("event_at").alias("payment_date"), "currency")
             .agg(F.array_sort(F.collect_set("segment")).alias("historical_segments"),
                  _total("amount").alias("turnover")))
    # The daily aggregate (one row per customer-day) feeds two windows and the
    # rank: write it once rather than recompute the binding.
    daily = materialize(daily, "turnover-daily")
    key, bucket = ["customer_id", "currency"], F.date_trunc(unit, "payment_date")
    out = sequence.scan(daily, key, ["payment_date"], sums={"turnover": "cumulative_turnover"}, method=method, bucket=bucket)
    out = sequence.neighbours(out, key, ["payment_date"], lag={"turnover": "_previous"}, method=method, bucket=bucket)
    out = out.select(*daily.columns, F.col("cumulative_turnover").cast(TT.TOTAL).alias("cumulative_turnover"),
                     (F.col("turnover") - F.col("_previous")).cast(TT.TOTAL).alias("previous_active_day_delta"))
    # One (day, currency) group holds every customer active that day: rank it skew-safely when large.
    return sequence.dense_rank(out, ["payment_date", "currency"], "turnover", "customer_rank", method="window" if method == "window" else "range")


def calendar_fill(totals: DataFrame, start: Column | str | None = None, end: Column | str | None = None,
                  date_col: str = "payment_date",
                  dims: Sequence[str] = ("currency",), value: str = "total_amount") -> DataFrame:
    """Every calendar day x dimension value with turnover (0 when absent), day delta and running total.

    The grid is built per distinct dimension value by exploding
    ``sequence(start, end)``: days x domain values rows, no cross join.
    ``start``/``end`` default to the first and last day present (one scalar
    row reaches the driver).
    """
    # the grid's values, its bounds and the sums all come from one aggregate
    sums = materialize(totals.groupBy(date_col, *dims).agg(_total(value).alias("turnover")), "calendar")
    if start is None or end is None:
        bounds = sums.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi")).first()
        start = F.lit(bounds["lo"]) if start is None else start
        end = F.lit(bounds["hi"]) if end is None else end
    start = F.lit(start).cast("date") if isinstance(start, str) else start
    end = F.lit(end).cast("date") if isinstance(end, str) else end
    values = sums.select(*dims).distinct()
    grid = values.select(*dims, F.explode(F.sequence(start, end, F.expr("INTERVAL 1 DAY"))).alias(date_col))
    full = grid.join(sums, [date_col, *dims], "left").withColumn(
        "turnover", F.coalesce(F.col("turnover"), F.lit(0).cast(TT.TOTAL)))
    w = Window.partitionBy(*dims).orderBy(date_col)
    return (full.withColumn("day_delta", (F.col("turnover") - F.lag("turnover").over(w)).cast(TT.TOTAL))
            .withColumn("cumulative_turnover", F.sum("turnover").over(w).cast(TT.TOTAL)))
