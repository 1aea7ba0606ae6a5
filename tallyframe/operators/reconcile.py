"""Reconciliation and data-quality checks.  Each returns a DataFrame of violations (empty = pass)
or a per-group comparison with a mismatch flag; only ``is_clean`` brings a boolean to the driver."""

from __future__ import annotations

from collections.abc import Sequence
import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from tallyframe import types as TT
from tallyframe.operators import skew
from tallyframe.operators.versions import duplicate_keys  # noqa: F401  (re-exported check)


def is_clean(violations: DataFrame) -> bool:
    """True when the check found nothing; stops at the first row."""
    return violations.isEmpty()


def staged_totals(staged_payments: DataFrame) -> DataFrame:
    """Re-aggregation of a staged payments mart per currency."""
    return staged_payments.groupBy("currency").agg(
        F.sum("transaction_count").cast("bigint").alias("actual_count"),
        F.sum("total_amount").cast(TT.TOTAL).alias("actual_amount"))


def control_diff(expected: DataFrame, staged_payments: DataFrame) -> DataFrame:
    """Control rows with actuals from staging (left join: a missing group stays NULL).

    ``expected``: currency, transaction_count, total_amount.  The actuals are
    recomputed from staging every time, so nothing stale survives.
    """
    e = expected.select("currency", F.col("transaction_count").alias("expected_count"),
                        F.col("total_amount").cast(TT.TOTAL).alias("expected_amount"))
    out = e.join(staged_totals(staged_payments), "currency", "left")
    return out.withColumn("mismatch", ~(F.col("expected_count").eqNullSafe(F.col("actual_count"))
                                        & F.col("expected_amount").eqNullSafe(F.col("actual_amount"))))


def unexpected_groups(staged: DataFrame, control: DataFrame, on: Sequence[str] = ("currency",)) -> DataFrame:
    """Staged rows whose group has no control row (anti join)."""
    return staged.join(control.select(*on).distinct(), list(on), "left_anti")


def mart_diff(activity: DataFrame, payments: DataFrame) -> DataFrame:
    """Per-currency count/amount of the activity mart vs the payments mart (full outer join)."""
    a = activity.groupBy("currency").agg(
        F.sum("transaction_count").cast("bigint").alias("activity_count"),
        F.sum(F.col("incoming_amount") + F.col("outgoing_amount")).cast(TT.TOTAL).alias("activity_amount"))
    p = payments.groupBy("currency").agg(
        F.sum("transaction_count").cast("bigint").alias("payments_count"),
        F.sum("total_amount").cast(TT.TOTAL).alias("payments_amount"))
    out = a.join(p, "currency", "full")
    return out.withColumn("mismatch", ~(F.col("activity_count").eqNullSafe(F.col("payments_count"))
                                        & F.col("activity_amount").eqNullSafe(F.col("payments_amount"))))


def orphans(df: DataFrame, reference: DataFrame, on: str | Sequence[str], ref_on: str | Sequence[str] | None = None) -> DataFrame:
    """Rows of ``df`` without a matching ``reference`` row (NOT EXISTS)."""
    on = [on] if isinstance(on, str) else list(on)
    ref_on = on if ref_on is None else ([ref_on] if isinstance(ref_on, str) else list(ref_on))
    ref = reference.select(*[F.col(r).alias(o) for r, o in zip(ref_on, on)]).distinct()
    return df.join(ref, on, "left_anti")


def known(df: DataFrame, reference: DataFrame, on: str, ref_on: str | None = None) -> DataFrame:
    """Rows of ``df`` whose key exists in ``reference`` (IN / semi join)."""
    ref = reference.select(F.col(ref_on or on).alias(on))
    return df.join(ref, on, "left_semi")


def fact_reference_violations(tx: DataFrame, accounts: DataFrame, history: DataFrame) -> DataFrame:
    """Stored facts that disagree with accounts or with the bound history version.

    Facts bound to no version may be most of them: the joins deal rows without a key over all tasks.
    """
    a = accounts.select(F.col("account_id").alias("_a_account"), F.col("customer_id").alias("_a_customer"), F.col("currency").alias("_a_currency"))
    h = history.select(F.col("customer_version_id").alias("_h_version"), F.col("valid_from").alias("_h_from"),
                       F.col("valid_to").alias("_h_to"))
    j = skew.left_join(skew.left_join(tx, a, "account_id", "_a_account"), h, "customer_version_id", "_h_version")
    bad = (F.col("_a_customer").isNull() | (F.col("_a_customer") != F.col("customer_id"))
           | (F.col("_a_currency") != F.col("currency")) | F.col("_h_version").isNull()
           | (F.col("event_at") < F.col("_h_from"))
           | (F.col("_h_to").isNotNull() & (F.col("event_at") >= F.col("_h_to"))))
    return j.filter(F.coalesce(bad, F.lit(True))).select(*tx.columns)


def freshness(published: DataFrame, ts_col: str, now: dt.datetime | Column | str, max_age_seconds: int) -> DataFrame:
    """One row: last publication time, its age at ``now`` and whether an alert is due.

    Stale when nothing was published or the newest publication is older
    than ``max_age_seconds``.
    """
    now_c = F.lit(now).cast("timestamp") if not isinstance(now, Column) else now
    last = published.agg(F.max(F.col(ts_col).cast("timestamp")).alias("last_published_at"))
    age = F.unix_timestamp(now_c) - F.unix_timestamp(F.col("last_published_at"))
    return last.select("last_published_at", age.cast("bigint").alias("age_seconds"),
                       (F.col("last_published_at").isNull() | (age > F.lit(max_age_seconds))).alias("is_stale"))
