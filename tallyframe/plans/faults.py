"""Registered queries over deliberately faulty rows.

Faults are derived from whole given tables by key arithmetic, so that every rule and every branch of a check has
rows on both sides; the oracle statements state the same arithmetic in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyframe import types as TT
from tallyframe.functions.hashing import version_key
from tallyframe.operators import marts, reconcile, scd2, temporal, validation
from tallyframe.plans import publish
from tallyframe.plans import tables
from tallyframe.plans import workloads as W
from tallyframe.sources import batch as B
from tallyframe.sources import proxy
from tallyframe.session import materialize, work_dir

#: Faults of transaction records: order key modulo TRANSACTION_MODULUS -> (field, faulty text; None is a missing field).
TRANSACTION_MODULUS = 23
TRANSACTION_FAULTS = {
    0: ("amount", "-5.00"), 1: ("amount", "12.345"), 2: ("event_at", "2024-02-30T00:00:00Z"), 3: ("source_updated_at", "yesterday"),
    4: ("record_version", "0"), 5: ("record_version", "x1"), 6: ("currency", "GBP"), 7: ("status", "VOID"), 8: ("direction", "UP"),
    9: ("channel", "WEB"), 10: ("account_id", "  "), 11: ("transaction_id", None), 12: ("amount", None), 13: ("event_at", None),
    14: ("source_updated_at", ""), 15: ("direction", None), 16: ("status", None), 17: ("currency", None), 18: ("record_version", None)}
#: Faults of account records: customer key modulo ACCOUNT_MODULUS.
ACCOUNT_MODULUS = 11
ACCOUNT_FAULTS = {
    0: ("opened_at", "2024-13-01"), 1: ("opened_at", "01.02.2024"), 2: ("status", "FROZEN"), 3: ("currency", "XXX"), 4: ("record_version", "-1"),
    5: ("customer_id", ""), 6: ("account_id", None), 7: ("opened_at", None), 8: ("status", " ")}


def _faulty(field: str, value: Column, key: Column, modulus: int, faults: dict) -> Column:
    out = value
    for remainder, (name, text) in faults.items():
        if name == field:
            out = F.when(key % modulus == remainder, F.lit(text)).otherwise(out)
    return out


def _reasons(rows: DataFrame, entity: str, key: Column, modulus: int, faults: dict) -> DataFrame:
    payload = F.to_json(F.struct(*[_faulty(c, F.col(c), key, modulus, faults).alias(c) for c in TT.payload_fields(entity)]))
    raw = rows.select(F.lit(entity).alias("entity"), payload.alias("payload"), F.lit("faults").alias("batch_id"), F.concat(F.lit(f"{entity}:"), F.lpad(key.cast("string"), 12, "0")).alias("source_record_id"),
                      F.lit(None).cast("timestamp").alias("ingested_at"))
    return validation.check_entity(raw, entity).select("source_record_id", "reason")


def dq_reason_codes_faults(spark: SparkSession, sf: str) -> DataFrame:
    t = proxy.transactions(spark, sf).withColumn("key", F.col("transaction_id").cast("bigint"))
    text = t.select("key", "account_id", F.col("amount").cast("string").alias("amount"), "channel", "currency", "direction", proxy.iso_utc(F.col("event_at")).alias("event_at"),
                    F.col("record_version").cast("string").alias("record_version"), proxy.iso_utc(F.col("source_updated_at")).alias("source_updated_at"), "status", "transaction_id",
                    F.lit(None).cast("string").alias("memo"))
    return _reasons(text, "transactions", F.col("key"), TRANSACTION_MODULUS, TRANSACTION_FAULTS)


def dq_reason_codes_accounts_faults(spark, sf):
    a = proxy.accounts(spark, sf).withColumn("key", F.col("account_id").cast("bigint"))
    return _reasons(a, "accounts", F.col("key"), ACCOUNT_MODULUS, ACCOUNT_FAULTS)


def _key(tx: DataFrame) -> Column:
    return F.col("transaction_id").cast("bigint")


def reconcile_control_faults(spark, sf):
    """The staged mart has no EUR rows and misses every fifth USD order."""
    tx = proxy.transactions(spark, sf)
    staged = tx.filter(~((F.col("currency") == "EUR") | ((F.col("currency") == "USD") & (_key(tx) % 5 == 0))))
    return reconcile.control_diff(marts.control_totals(tx), marts.payments_daily(staged))


def reconcile_full_join_faults(spark, sf):
    """Neither mart has every currency: the activity mart no USD, the payments mart no EUR."""
    tx = proxy.transactions(spark, sf)
    return reconcile.mart_diff(marts.customer_activity(tx.filter("currency <> 'USD'")), marts.payments_daily(tx.filter("currency <> 'EUR'")))


def unexpected_groups(spark, sf):
    """Payments of a currency that the control totals do not name."""
    tx = proxy.transactions(spark, sf)
    return reconcile.unexpected_groups(marts.payments_daily(tx), marts.control_totals(tx.filter("currency <> 'EUR'")))


def _tampered_history(spark, sf):
    """Every seventh version ends a day late, every eleventh has its flag turned, every thirteenth ends before it starts."""
    h = W._history(spark, sf)
    v = F.col("change_version")
    return (h.withColumn("valid_to", F.when(v % 7 == 0, F.col("valid_to") + F.expr("INTERVAL 1 DAY")).when(v % 13 == 0, F.col("valid_from") - F.expr("INTERVAL 1 HOUR")).otherwise(F.col("valid_to")))
            .withColumn("is_current", (v % 11 == 0) != F.col("is_current")))


def scd2_interval_audit_faults(spark, sf):
    return scd2.interval_audit(_tampered_history(spark, sf)).select("customer_version_id", "customer_id", "valid_from", "valid_to", "previous_to", "is_violation")


def scd2_violations_faults(spark, sf):
    return scd2.violations(_tampered_history(spark, sf)).select("customer_version_id", "customer_id", "valid_from", "valid_to")


def multiple_current(spark, sf):
    """Customers with more than one current version in the tampered history."""
    return scd2.multiple_current(_tampered_history(spark, sf))


def mart_constraint_violations(spark, sf):
    """Payments without a channel, and amounts turned to NULL for every third day of a month."""
    p = marts.payments_daily(proxy.transactions(spark, sf))
    p = p.withColumn("total_amount", F.when(F.dayofmonth("payment_date") % 3 != 0, F.col("total_amount")))
    return publish.constraint_violations(p, "payments")


def version_join(spark, sf):
    """Bound purchases joined to the history on the version id (inner)."""
    h = materialize(W._history(spark, sf), "history")
    bound = temporal.bind(proxy.purchase_facts(spark, sf).select("event_id", "customer_id", "event_at"), h, "customer_id", "event_at", columns=("customer_version_id",))
    return bound.join(h.select("customer_version_id", "segment", "region", "valid_from"), "customer_version_id").select("event_id", "customer_version_id", "segment", "region", "valid_from")


def state_difference(spark, sf):
    """Fact state before and after the corrections, compared both ways as multisets."""
    stored, updates = W._fact_versions(spark, sf)
    after = tables.merge(stored, updates, ["transaction_id"], ["record_hash"]).drop("_action")
    return (stored.exceptAll(after).withColumn("state", F.lit("before"))
            .unionByName(after.exceptAll(stored).withColumn("state", F.lit("after"))))


def fk_classification_faults(spark, sf):
    """Line items as facts in the span of the history: some of unknown accounts, of another currency, or before the account was opened."""
    li = proxy.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    o = proxy.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = proxy.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    key = F.col("l_orderkey")
    at = F.to_timestamp(F.lit("2024-01-01 00:00:00")) + F.make_dt_interval(((key * 7 + F.col("l_linenumber")) % 40).cast("int"), F.lit(12))
    tx = li.join(o, key == F.col("o_orderkey"), "left").join(c, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        F.when(key % 13 == 0, F.concat(F.lit("X"), F.col("o_custkey").cast("string"))).otherwise(F.col("o_custkey").cast("string")).alias("account_id"),
        proxy.currency_of(F.col("c_nationkey") + F.when(F.col("l_linenumber") == 7, 1).otherwise(0)).alias("currency"),
        F.when(key % 17 == 0, F.to_timestamp(F.lit("1990-01-01 00:00:00"))).otherwise(at).alias("event_at"))
    bound = temporal.bind_to_accounts_and_history(tx, W._accounts_typed(spark, sf), W._history(spark, sf))
    return bound.select("l_orderkey", "l_linenumber", "l_suppkey", "account_id", "customer_id", "customer_version_id", "fk_reason")


def fact_reference_faults(spark, sf):
    """Bound purchases of which every ninth names a version that does not exist; all bound purchases, each marked."""
    h = materialize(W._history(spark, sf), "history")
    facts = proxy.purchase_facts(spark, sf).withColumn("account_id", F.col("customer_id"))
    bound = temporal.bind(facts, h, "customer_id", "event_at", columns=("customer_version_id",), how="inner")
    bound = bound.withColumn("customer_version_id", F.when(F.col("event_id") % 9 == 0, version_key("customer_id", "event_at")).otherwise(F.col("customer_version_id")))
    bad = reconcile.fact_reference_violations(bound, W._accounts_typed(spark, sf), h).select("event_id").withColumn("is_violation", F.lit(True))
    return bound.join(bad, "event_id", "left").select("event_id", "customer_id", F.coalesce("is_violation", F.lit(False)).alias("is_violation"))


def raw_provenance(spark, sf):
    """Orders written as a sharded JSON-lines batch and read back with their provenance."""
    root = work_dir(spark, "provenance")
    rows = proxy.transactions(spark, sf).select(F.col("transaction_id").cast("bigint").alias("ordinal"), "transaction_id", "account_id", "currency")
    folder, manifest = B.write_batch(spark, root, "2024-02-01", {"transactions": rows}, "orders-provenance")
    got = B.read_batch(spark, folder, manifest)
    return got.select("entity", "source_record_id", F.regexp_extract("source_file", r"shard=(\d+)/", 1).alias("shard"), "schema_version", F.get_json_object("payload", "$.account_id").alias("account_id"))


REGISTRY = {f.__name__: f for f in (
    dq_reason_codes_faults, dq_reason_codes_accounts_faults, reconcile_control_faults, reconcile_full_join_faults, unexpected_groups,
    scd2_interval_audit_faults, scd2_violations_faults, multiple_current, mart_constraint_violations, version_join, state_difference,
    fk_classification_faults, fact_reference_faults, raw_provenance)}
