"""Point-in-time binding of facts to the dimension version valid at event time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.operators import sequence
from tallyframe.session import materialize


def bind(facts: DataFrame, history: DataFrame, fact_key: str, ts: str, history_key: str | None = None,
         columns: Sequence[str] = ("customer_version_id",), how: str = "left", form: str = "asof",
         method: str = "buckets", unit: str = "month") -> DataFrame:
    """Attach ``columns`` of the version whose ``[valid_from, valid_to)`` holds ``ts``.

    form="range": equi join on the key with the interval as residual
    (``ts >= valid_from AND (valid_to IS NULL OR ts < valid_to)``).  Cheap when
    keys have few versions; AQE splits a key that is hot on the fact side.

    form="asof": facts and version starts are unioned, ordered by
    (key, time, version-before-fact) and the latest version start is carried
    forward (``sequence.neighbours`` fill).  Linear in rows; with ``method="buckets"`` (the time's ``unit``) or "range" a hot key is cut; never
    pairs a fact with every version of its key.  The history is written once (it is read by the scan and by the summary).
    The carried version is kept only while ``ts < valid_to``, so both forms
    agree on any set of non-overlapping intervals.

    form="interval": versions are dealt to the time buckets (``unit``) that they cover, up to the last fact (one aggregate), so an open version
    covers no bucket beyond it; facts meet the versions of their key and bucket only, and the interval is tested on those.  One
    shuffle of the facts, which a hot key shares out over its buckets; versions are repeated once a bucket, so ``unit`` should not be far
    shorter than they are.

    A fact with a NULL key or NULL time is bound to nothing in any form.
    """
    hk = history_key or fact_key
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    h = history.select(F.col(hk).alias("_hk"), "valid_from", "valid_to", *columns)
    if form == "range":
        f, v = facts.alias("_f"), h.alias("_h")
        t = F.col(f"_f.{ts}")
        cond = ((F.col(f"_f.{fact_key}") == F.col("_h._hk")) & (t >= F.col("_h.valid_from"))
                & (F.col("_h.valid_to").isNull() | (t < F.col("_h.valid_to"))))
        return f.join(v, cond, how).select(*[F.col(f"_f.{c}") for c in facts.columns],
                                           *[F.col(f"_h.{c}") for c in columns])
    if form == "interval":
        return _bind_by_interval(facts, h, fact_key, ts, columns, how, unit)
    if form != "asof":
        raise ValueError("form must be 'range', 'asof' or 'interval'")
    fact_cols = facts.columns
    if method == "buckets":
        h = materialize(h, "versions")
    f = facts.select(F.col(fact_key).cast(h.schema["_hk"].dataType).alias("_k"), F.col(ts).alias("_t"),
                     F.lit(1).alias("_is_fact"), F.struct(*[F.col(c) for c in fact_cols]).alias("_f"),
                     F.lit(None).cast(_version_type(h, columns)).alias("_v"))
    v = h.select(F.col("_hk").alias("_k"), F.col("valid_from").alias("_t"), F.lit(0).alias("_is_fact"),
                 F.lit(None).cast(facts.select(F.struct(*fact_cols).alias("s")).schema["s"].dataType).alias("_f"),
                 F.struct("valid_to", *columns).alias("_v"))
    seq = sequence.neighbours(f.unionByName(v), ["_k"], ["_t", "_is_fact"], fill={"_v": "_bound"},
                              method=method, bucket=F.date_trunc(unit, "_t"))
    out = seq.filter(F.col("_is_fact") == 1)
    inside = F.col("_k").isNotNull() & F.col("_t").isNotNull() & F.col("_bound").isNotNull() & (F.col("_bound.valid_to").isNull() | (F.col("_t") < F.col("_bound.valid_to")))
    if how == "inner":
        out = out.filter(inside)
    return out.select(*[F.col(f"_f.{c}").alias(c) for c in fact_cols],
                      *[F.when(inside, F.col(f"_bound.{c}")).alias(c) for c in columns])


def _bind_by_interval(facts: DataFrame, h: DataFrame, fact_key: str, ts: str, columns: Sequence[str], how: str, unit: str) -> DataFrame:
    last = facts.agg(F.max(ts)).first()[0]
    until = F.lit(last).cast("timestamp")
    live = h.filter((F.col("valid_from") <= until) & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from"))))
    covered = F.sequence(F.date_trunc(unit, "valid_from"), F.date_trunc(unit, F.least(F.coalesce("valid_to", until), until)), F.expr(f"INTERVAL 1 {unit}"))
    v = live.withColumn("_bucket", F.explode(covered)).alias("_h")
    f = facts.withColumn("_in", F.date_trunc(unit, ts)).alias("_f")
    t = F.col(f"_f.{ts}")
    cond = ((F.col(f"_f.{fact_key}") == F.col("_h._hk")) & (F.col("_f._in") == F.col("_h._bucket")) & (t >= F.col("_h.valid_from"))
            & (F.col("_h.valid_to").isNull() | (t < F.col("_h.valid_to"))))
    return f.join(v, cond, how).select(*[F.col(f"_f.{c}") for c in facts.columns], *[F.col(f"_h.{c}") for c in columns])


def _version_type(h: DataFrame, columns: Sequence[str]):
    return h.select(F.struct("valid_to", *columns).alias("s")).schema["s"].dataType


def classify_fk(account_id: Column | str = "account_id", account_currency: Column | str = "account_currency",
                currency: Column | str = "currency", event_at: Column | str = "event_at",
                opened_at: Column | str = "opened_at", version_id: Column | str = "customer_version_id") -> Column:
    """Ordered referential classification; '' when the fact is bound."""
    c = lambda x: F.col(x) if isinstance(x, str) else x
    return (F.when(c(account_id).isNull(), "account_fk")
            .when(c(account_currency) != c(currency), "account_currency")
            .when(c(event_at).cast("date") < c(opened_at), "before_account_opening")
            .when(c(version_id).isNull(), "customer_interval")
            .otherwise(""))


def bind_to_accounts_and_history(tx: DataFrame, accounts: DataFrame, history: DataFrame, form: str = "asof",
                                 method: str = "buckets") -> DataFrame:
    """Facts -> account (left) -> customer version at event time (left) + ``fk_reason``.

    ``tx`` needs account_id, currency, event_at; ``accounts`` account_id,
    customer_id, currency, opened_at; ``history`` customer_id, valid_from,
    valid_to, customer_version_id.
    """
    a = accounts.select("account_id", F.col("customer_id"), F.col("currency").alias("account_currency"),
                        "opened_at", F.lit(True).alias("_account_found"))
    joined = tx.join(a, "account_id", "left")
    bound = bind(joined, history, "customer_id", "event_at", columns=("customer_version_id",), how="left",
                 form=form, method=method)
    # The USING join keeps the fact's own account_id; a miss shows as a NULL marker.
    return bound.withColumn("fk_reason", classify_fk(account_id="_account_found")).drop(
        "account_currency", "opened_at", "_account_found")
