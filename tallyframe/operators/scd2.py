"""Slowly-changing-dimension (type 2) history from late and out-of-order changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.functions.hashing import version_key
from tallyframe.operators import sequence
from tallyframe.operators.versions import latest_wins
from tallyframe.session import materialize

#: End of an interval that has none.
FAR = "9999-12-31 00:00:00"


def history(changes: DataFrame, key: str, effective_at: Column | str, order_by: Sequence[Column | str],
            attributes: Sequence[str], received_at: str | None = "received_at",
            version_col: str = "customer_version_id", change_version: str | None = "change_version",
            method: str = "buckets", unit: str = "month") -> DataFrame:
    """Rebuild intervals ``[valid_from, valid_to)`` from the full set of changes.

    1. one winner per (key, effective instant): greatest ``order_by`` (the
       last item should be a record hash, for deterministic ties);
    2. drop a winner whose attributes equal the previous winner's
       (null-safe), so a run of equal values keeps its first row;
    3. ``valid_to`` = next kept ``valid_from`` of the key, NULL when current.

    Output: version id (sha256 of ``key|valid_from``), key, attributes,
    valid_from, valid_to, change_version, received_at, is_current.

    ``effective_at`` must be a timestamp (parse strings first), so two
    spellings of one instant fall into one group.  ``method`` and ``unit`` (the bucket of the time) pick the
    neighbour computation (see ``sequence.neighbours``).
    """
    eff = F.col(effective_at) if isinstance(effective_at, str) else effective_at
    keep = [key, *attributes] + [c for c in (change_version, received_at) if c]
    base = changes.withColumn("valid_from", eff)
    winners = latest_wins(base.select(*keep, "valid_from", *[
        (F.col(c) if isinstance(c, str) else c).alias(f"_w{i}") for i, c in enumerate(order_by)]),
        [key, "valid_from"], [f"_w{i}" for i in range(len(order_by))])
    winners = winners.select(*keep, "valid_from",
                             F.struct(*[F.col(a) for a in attributes]).alias("_attrs"))
    bucket = F.date_trunc(unit, "valid_from")
    if method == "range":  # one segmentation serves both passes
        winners, method = sequence.segments(winners, [key], ["valid_from"]), "segmented"
    elif method == "buckets":  # read by scans and summaries of both passes
        winners = materialize(winners, "winners")
    flagged = sequence.neighbours(winners, [key], ["valid_from"], lag={"_attrs": "_prev_attrs"},
                                  method=method, bucket=bucket)
    kept = flagged.filter(F.col("_prev_attrs").isNull() | ~F.col("_prev_attrs").eqNullSafe(F.col("_attrs")))
    kept = kept.drop("_prev_attrs", "_attrs")
    bounded = sequence.neighbours(kept, [key], ["valid_from"], lead={"valid_from": "valid_to"}, method=method, bucket=bucket)
    cols = [version_key(key, "valid_from").alias(version_col), key, *attributes, "valid_from", "valid_to"]
    cols += [c for c in (change_version, received_at) if c]
    return bounded.select(*cols, F.col("valid_to").isNull().alias("is_current"))


def current(h: DataFrame) -> DataFrame:
    """The current slice: one row per key with an open interval."""
    return h.filter(F.col("is_current"))


def interval_audit(h: DataFrame, key: str = "customer_id", method: str = "buckets", unit: str = "month") -> DataFrame:
    """Every history row with the checks of a valid interval set.

    A row violates when ``valid_to <= valid_from``, when ``is_current`` does
    not equal ``valid_to IS NULL``, or when it is not the key's first row and
    the previous row is open or ends after this row starts.  Two rows of one
    key at the same ``valid_from`` violate through the second rule of the pair.
    """
    marked = h.withColumn("_row", F.lit(True))
    out = sequence.neighbours(marked, [key], ["valid_from", "customer_version_id"] if
                              "customer_version_id" in h.columns else ["valid_from"],
                              lag={"valid_to": "previous_to", "_row": "_has_previous"}, method=method, bucket=F.date_trunc(unit, "valid_from"))
    bad = ((F.col("valid_to").isNotNull() & (F.col("valid_to") <= F.col("valid_from")))
           | (F.col("is_current") != F.col("valid_to").isNull())
           | (F.col("_has_previous").isNotNull()
              & (F.col("previous_to").isNull() | (F.col("previous_to") > F.col("valid_from")))))
    return out.withColumn("is_violation", F.coalesce(bad, F.lit(True))).drop("_row", "_has_previous")


def overlap_audit(h: DataFrame, key: str = "customer_id", version: str = "customer_version_id", method: str = "buckets", unit: str = "month") -> DataFrame:
    """Every history row with ``covered_to``, the greatest end of all earlier intervals of its key, and whether it starts before that.

    ``interval_audit`` looks one row back, so an interval nested in one that began two rows earlier passes it; the running
    maximum of the ends finds it.  An open interval ends at ``FAR``.  Rows are ordered by (valid_from, version); a NULL ``valid_from`` is a violation.
    """
    ends = h.withColumn("_end", F.coalesce("valid_to", F.lit(FAR).cast("timestamp")))
    out = sequence.scan(ends, [key], ["valid_from", version], maxima={"_end": "covered_to"}, frame="before", method=method, bucket=F.date_trunc(unit, "valid_from"))
    late = F.col("covered_to").isNotNull() & (F.col("covered_to") > F.col("valid_from"))
    return out.drop("_end").withColumn("is_overlapping", F.coalesce(late | (F.col("valid_to") <= F.col("valid_from")), F.col("valid_from").isNull()))


def violations(h: DataFrame, key: str = "customer_id") -> DataFrame:
    """Rows of ``interval_audit`` that break an interval rule; empty = pass."""
    return interval_audit(h, key).filter("is_violation").drop("is_violation")


def multiple_current(h: DataFrame, key: str = "customer_id") -> DataFrame:
    """Keys with more than one current row (one open interval per key)."""
    return current(h).groupBy(key).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")
