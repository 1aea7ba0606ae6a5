"""The registered workloads: each operator applied to the proxy model over whole test tables.

Every function takes (spark, sf_dir) and returns a DataFrame; names and
column aliases match the DuckDB oracle statements in ``__spark_entry__``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyframe import types as TT
from tallyframe.functions.hashing import fingerprint
from tallyframe.operators import marts, reconcile, scd2, temporal, validation, versions
from tallyframe.session import materialize
from tallyframe.sources import proxy

FRESHNESS_NOW = "2024-02-01 00:00:00"
FRESHNESS_MAX_AGE = 86_400


# --- JSON functions -----------------------------------------------------------------------------

def json_extract(spark: SparkSession, sf: str) -> DataFrame:
    e = proxy.table(spark, sf, "events")
    k = F.get_json_object("props", "$.k")
    return e.select("event_id", "user_id", k.alias("k_text"), k.try_cast("bigint").alias("k"))


# --- validation -------------------------------------------------------------------------------

def _checked_transactions(spark, sf):
    return validation.check_entity(proxy.transaction_payloads(spark, sf), "transactions")


def _checked_accounts(spark, sf):
    a = proxy.accounts(spark, sf)
    raw = a.select(F.lit("accounts").alias("entity"),
                   F.to_json(F.struct(*[F.col(c) for c in TT.payload_fields("accounts")])).alias("payload"),
                   F.lit("accounts").alias("batch_id"),
                   F.concat(F.lit("accounts:"), F.lpad("account_id", 12, "0")).alias("source_record_id"),
                   F.lit(None).cast("timestamp").alias("ingested_at"))
    return validation.check_entity(raw, "accounts")


def dq_reason_codes(spark, sf):
    return _checked_transactions(spark, sf).select("source_record_id", "reason")


def dq_reason_codes_accounts(spark, sf):
    return _checked_accounts(spark, sf).select("source_record_id", "reason")


def quarantine_by_reason(spark, sf):
    rejects = [validation.as_rejects(validation.split(c)[1])
               for c in (_checked_transactions(spark, sf), _checked_accounts(spark, sf))]
    return validation.quarantine_by_reason(validation.quarantine(*rejects))


def dq_reject_ratio(spark, sf):
    cols = ["batch_id", "reason"]
    checked = _checked_accounts(spark, sf).select(*cols).unionByName(_checked_transactions(spark, sf).select(*cols))
    return validation.reject_ratio(checked, by="batch_id").select(
        "batch_id", "read_count", "rejected_count", "accepted_count", "breach")


# --- versions and SCD2 -------------------------------------------------------------------------

def latest_version_wins(spark, sf):
    li = proxy.lineitem_versions(spark, sf)
    return versions.latest_wins(li, ["l_orderkey", "l_linenumber"], ["updated_at", "record_hash"])


def duplicate_keys(spark, sf):
    li = proxy.table(spark, sf, "lineitem")
    return versions.duplicate_keys(li, ["l_orderkey", "l_linenumber"])


def _history(spark, sf, method="buckets"):
    ch = proxy.customer_changes(spark, sf)
    return scd2.history(ch, "customer_id", "effective_at", ["change_version", "record_hash"],
                        ["region", "segment"], method=method)


def scd2_history(spark, sf):
    return _history(spark, sf)


def scd2_current(spark, sf):
    return scd2.current(_history(spark, sf))


def scd2_interval_audit(spark, sf):
    return scd2.interval_audit(_history(spark, sf)).select(
        "customer_version_id", "customer_id", "valid_from", "valid_to", "previous_to", "is_violation")


def scd2_violations(spark, sf):
    return scd2.violations(_history(spark, sf)).select("customer_version_id", "customer_id", "valid_from",
                                                      "valid_to")


# --- point-in-time binding --------------------------------------------------------------------

def _bound_purchases(spark, sf, form):
    facts = proxy.purchase_facts(spark, sf).select("event_id", "customer_id", "event_at")
    return temporal.bind(facts, _history(spark, sf), "customer_id", "event_at",
                         columns=("customer_version_id", "segment"), how="left", form=form)


def point_in_time_join(spark, sf):
    return _bound_purchases(spark, sf, "range")


def as_of_bind(spark, sf):
    return _bound_purchases(spark, sf, "asof")


def _accounts_typed(spark, sf):
    a = proxy.accounts(spark, sf)
    return a.select("account_id", "customer_id", "currency", F.col("opened_at").try_cast("date").alias("opened_at"),
                    "status", F.col("record_version").cast("bigint").alias("record_version"))


def fk_classification(spark, sf):
    """Line items as facts on the order's customer account: currency of the supplier's nation,
    event at ship time; bound to the customer history of events."""
    li = proxy.table(spark, sf, "lineitem")
    s = proxy.table(spark, sf, "supplier").select("s_suppkey", proxy.currency_of(F.col("s_nationkey")).alias("currency"))
    o = proxy.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    tx = (li.join(o, li["l_orderkey"] == o["o_orderkey"], "left")
          .join(s, li["l_suppkey"] == s["s_suppkey"], "left")
          .select("l_orderkey", "l_linenumber", "l_suppkey", F.col("o_custkey").cast("string").alias("account_id"),
                  "currency", F.col("l_shipdate").cast("timestamp").alias("event_at")))
    bound = temporal.bind_to_accounts_and_history(tx, _accounts_typed(spark, sf), _history(spark, sf))
    return bound.select("l_orderkey", "l_linenumber", "l_suppkey", "account_id", "customer_id",
                        "customer_version_id", "fk_reason")


def _known_customers(spark, sf):
    """Customers with any history: those with a change (the history itself need not be built to know them)."""
    return proxy.customer_changes(spark, sf).select("customer_id").distinct()


def semi_join_known(spark, sf):
    o = proxy.table(spark, sf, "orders").withColumn("customer_id", F.col("o_custkey").cast("string"))
    return reconcile.known(o, _known_customers(spark, sf), "customer_id").select("o_orderkey", "customer_id")


def anti_join_orphans(spark, sf):
    o = proxy.table(spark, sf, "orders").withColumn("customer_id", F.col("o_custkey").cast("string"))
    return reconcile.orphans(o, _known_customers(spark, sf), "customer_id").select("o_orderkey", "customer_id")


# --- marts ------------------------------------------------------------------------------------

def payments_daily(spark, sf):
    return marts.payments_daily(proxy.transactions(spark, sf))


def customer_activity(spark, sf):
    return marts.customer_activity(proxy.transactions(spark, sf))


def currency_control_totals(spark, sf):
    return marts.control_totals(proxy.transactions(spark, sf))


def reconcile_control(spark, sf):
    tx = proxy.transactions(spark, sf)
    return reconcile.control_diff(marts.control_totals(tx), marts.payments_daily(tx))


def reconcile_full_join(spark, sf):
    tx = proxy.transactions(spark, sf)
    return reconcile.mart_diff(marts.customer_activity(tx), marts.payments_daily(tx))


def missing_history(spark, sf):
    act = marts.customer_activity(proxy.transactions(spark, sf))
    return reconcile.orphans(act.select("customer_id").distinct(), _known_customers(spark, sf), "customer_id")


def historical_turnover(spark, sf):
    return marts.historical_turnover(proxy.purchase_facts(spark, sf), _history(spark, sf))


def calendar_fill(spark, sf):
    return marts.calendar_fill(marts.payments_daily(proxy.transactions(spark, sf)))


def mart_fingerprint(spark, sf):
    p = marts.payments_daily(proxy.transactions(spark, sf))
    return fingerprint(p, ["payment_date", "currency", "channel", "transaction_count", "total_amount"])


# --- join variants, checksum, rollup ----------------------------------------------------------

def _joined(spark, sf, strategy):
    tx = proxy.transactions(spark, sf).drop("customer_id")
    acc = proxy.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("account_id"),
                                                     F.col("c_custkey").cast("string").alias("customer_id"))
    from tallyframe.plans import benchmark
    j = benchmark.join_accounts(tx, acc, strategy)
    return j.select("transaction_id", "customer_id", "event_at", "amount", "currency", "status", "channel")


def join_broadcast(spark, sf):
    return _joined(spark, sf, "broadcast")


def join_shuffle(spark, sf):
    return _joined(spark, sf, "shuffle")


def checksum(spark, sf):
    j = _joined(spark, sf, "auto")
    return j.agg(F.count(F.lit(1)).alias("row_count"), F.sum("amount").cast(TT.TOTAL).alias("total_amount"))


def one_day_rollup(spark, sf):
    tx = proxy.transactions(spark, sf).withColumn("event_date", F.to_date("event_at"))
    last_day = tx.agg(F.max("event_date").alias("d")).first()["d"]
    return marts.daily_rollup(tx, F.lit(last_day))


# --- ordering ---------------------------------------------------------------------------------

def top1_latest(spark, sf):
    e = proxy.table(spark, sf, "events")
    return e.orderBy(F.col("ts").desc()).limit(1).select("event_id", "ts", "user_id", "event_type")


def last_n(spark, sf):
    e = proxy.table(spark, sf, "events")
    return e.orderBy(F.col("event_id").desc()).limit(100).select("event_id", "ts", "event_type")


def freshness(spark, sf):
    return reconcile.freshness(proxy.table(spark, sf, "events"), "ts", FRESHNESS_NOW, FRESHNESS_MAX_AGE)


# --- ingest, upsert, audits -------------------------------------------------------------------

LOADED_BEFORE = "1998-01-01"


def idempotent_append(spark, sf):
    """Raw already holds the batches before LOADED_BEFORE; a replay of every batch arrives.
    Result: the raw table after the append, each row marked kept or inserted."""
    from tallyframe.sources import batch as B
    raw = proxy.transaction_payloads(spark, sf).select("entity", "batch_id", "source_record_id")
    existing = raw.filter(F.col("batch_id") < LOADED_BEFORE)
    appended = B.insert_absent(existing, raw)
    return existing.withColumn("ingest_action", F.lit("kept")).unionByName(
        appended.withColumn("ingest_action", F.lit("inserted")))


def _fact_versions(spark, sf):
    """(stored, updates): stored facts loaded before LOADED_BEFORE; updates = every order with its
    amount corrected to the sum of its line prices (unchanged when it has no lines)."""
    tx = proxy.transactions(spark, sf).select("transaction_id", "amount", "status", "event_at")
    li = proxy.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").cast("string").alias("transaction_id")).agg(
        F.sum(F.col("l_extendedprice").cast(TT.MONEY)).cast(TT.MONEY).alias("line_amount"))

    def hashed(df):
        return df.withColumn("record_hash", F.sha2(F.concat_ws("|", "transaction_id", F.col("amount").cast("string"),
                                                               "status"), 256))
    stored = hashed(tx.filter(F.col("event_at") < F.lit(LOADED_BEFORE).cast("timestamp")).drop("event_at"))
    updates = hashed(tx.join(li, "transaction_id", "left").select(
        "transaction_id", F.coalesce("line_amount", "amount").alias("amount"), "status"))
    return stored, updates


def merge_upsert(spark, sf):
    from tallyframe.plans import tables
    stored, updates = _fact_versions(spark, sf)
    return tables.merge(stored, updates, ["transaction_id"], ["record_hash"]).withColumnRenamed(
        "_action", "merge_action")


def upsert_change_count(spark, sf):
    from tallyframe.plans import tables
    stored, updates = _fact_versions(spark, sf)
    return tables.change_count(stored, updates, ["transaction_id"], ["record_hash"]).withColumnRenamed(
        "_action", "merge_action")


def fact_reference_violations(spark, sf):
    """Order facts bound to the customer version at order time, audited against accounts and history."""
    h = materialize(_history(spark, sf), "history")
    tx = temporal.bind(proxy.transactions(spark, sf), h, "customer_id", "event_at",
                       columns=("customer_version_id",), how="left")
    bad = reconcile.fact_reference_violations(tx, _accounts_typed(spark, sf), h)
    return bad.select("transaction_id", "account_id", "customer_id", "customer_version_id")


# --- full recompute from raw ------------------------------------------------------------------

def _prepared(spark, sf):
    from tallyframe.plans.prepare import prepare
    return prepare(proxy.raw_records(spark, sf), persist=False)


def prepared_transactions(spark, sf):
    return _prepared(spark, sf).transactions


def prepared_quarantine(spark, sf):
    return _prepared(spark, sf).quarantine


def prepared_history(spark, sf):
    return _prepared(spark, sf).history


def prepared_accounts(spark, sf):
    return _prepared(spark, sf).accounts


# --- versioned tables (write under the session's shared work folder) ---------------------------

def _facts_table(spark, sf):
    from tallyframe.plans import tables
    from tallyframe.session import work_dir
    table = work_dir(spark, "facts")
    stored, updates = _fact_versions(spark, sf)
    tables.write_version(stored, table)
    tables.upsert(updates, table, ["transaction_id"], ["record_hash"])
    return table


def time_travel_read(spark, sf):
    """Version 0 (stored facts) next to the latest version (after the corrections upsert)."""
    from tallyframe.plans import tables
    table = _facts_table(spark, sf)
    v0 = tables.read_version(spark, table, 0).select("transaction_id", F.col("amount").alias("amount_v0"))
    latest = tables.read_version(spark, table).select("transaction_id", F.col("amount").alias("amount_latest"))
    return latest.join(v0, "transaction_id", "left")


def schema_evolution_read(spark, sf):
    """All order facts; a nullable column is added by metadata only and reads NULL."""
    from tallyframe.plans import tables
    from tallyframe.session import work_dir
    table = work_dir(spark, "evolve")
    _, every = _fact_versions(spark, sf)
    tables.write_version(every, table)
    tables.add_column(spark, table, "memo", "string")
    return tables.read_version(spark, table)


def compaction(spark, sf):
    """Facts written in folders by month (some sixty rows a day: a day would be less than a file), compacted; contents must stay equal."""
    from tallyframe.plans import tables
    from tallyframe.session import work_dir
    table = work_dir(spark, "compact")
    tx = proxy.transactions(spark, sf).withColumn("event_month", F.to_date(F.trunc("event_at", "month")))
    tables.write_version(tx, table, ["event_month"])
    v = tables.compact(spark, table, ["event_month"])["version"]
    return fingerprint(tables.read_version(spark, table, v),
                       ["transaction_id", "account_id", "amount", "currency", "status", "channel"])


def publish_pointer(spark, sf):
    """Payments mart published under a run folder and read back through the pointer."""
    from tallyframe.plans import tables
    from tallyframe.session import work_dir
    root = work_dir(spark, "publish")
    path = f"{root}/marts/run-1/payments"
    marts.payments_daily(proxy.transactions(spark, sf)).write.parquet(path)
    tables.publish_pointer(spark, f"{root}/published", "run-1", {"payments": path})
    return tables.read_published(spark, f"{root}/published", "payments")


def export_checksum(spark, sf):
    """Payments mart exported to CSV with checksums, staged after the checks, read back from staging."""
    from tallyframe.plans import publish
    from tallyframe.session import work_dir
    root = work_dir(spark, "export")
    tx = proxy.transactions(spark, sf)
    folder = f"{root}/exports/run-1"
    info = publish.export(marts.payments_daily(tx), f"{folder}/payments", "run-1")
    import json
    manifest = {"snapshots": {}, "files": {"payments": info}, "expected": []}
    spark.createDataFrame([(json.dumps(manifest),)], "m string").coalesce(1).write.text(f"{folder}/manifest")
    publish.stage(spark, root, "run-1")
    return publish.staged(spark, root, "payments", "run-1").drop("run_id")


def file_metadata(spark, sf):
    from tallyframe.sources import batch as B
    return B.file_metadata(spark, sf.rstrip("/"), "*.parquet")


def manifest_integrity(spark, sf):
    """Order records written as a sharded JSON-lines batch, then checked file by file (empty = intact)."""
    from tallyframe.sources import batch as B
    from tallyframe.session import work_dir
    root = work_dir(spark, "batch")
    t = proxy.transactions(spark, sf)
    rows = t.select(F.col("transaction_id").cast("bigint").alias("ordinal"), "transaction_id", "account_id",
                    proxy.iso_utc(F.col("event_at")).alias("event_at"), F.col("amount").cast("string").alias("amount"),
                    "currency", "status", "direction", "channel")
    folder, manifest = B.write_batch(spark, root, "2024-02-01", {"transactions": rows}, "orders")
    return B.check_batch(spark, folder, manifest)


def typed_json_scan(spark, sf):
    """Order facts written as a JSON-lines batch, read back with a declared narrow schema
    (undeclared fields pruned), cast to fact types and joined to accounts."""
    from tallyframe.plans import benchmark
    from tallyframe.sources import batch as B
    from tallyframe.session import work_dir
    root = work_dir(spark, "json")
    t = proxy.transactions(spark, sf)
    rows = t.select(F.col("transaction_id").cast("bigint").alias("ordinal"), "transaction_id", "account_id",
                    proxy.iso_utc(F.col("event_at")).alias("event_at"), F.col("amount").cast("string").alias("amount"),
                    "currency", "status", "direction", "channel", F.lit("1").alias("record_version"))
    folder, manifest = B.write_batch(spark, root, "2024-02-01", {"transactions": rows}, "orders-json")
    paths = [f"{folder}/{f['name']}" for f in manifest["files"] if f["entity"] == "transactions"]
    raw = spark.read.schema("transaction_id STRING, account_id STRING, event_at STRING, amount STRING, "
                            "currency STRING, status STRING, channel STRING").json(paths)
    acc = proxy.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("account_id"),
                                                     F.col("c_custkey").cast("string").alias("customer_id"))
    return benchmark.join_accounts(benchmark.typed_transactions(raw), acc, "auto").select(
        "transaction_id", "customer_id", "event_at", "amount", "currency", "status", "channel")


# --- flagship ---------------------------------------------------------------------------------

def segment_payments(spark, sf):
    """Purchases bound to the customer version valid at event time, by day x currency x segment."""
    facts = proxy.purchase_facts(spark, sf)
    bound = temporal.bind(facts, _history(spark, sf), "customer_id", "event_at", columns=("segment",),
                          how="left")
    return (bound.groupBy(F.to_date("event_at").alias("payment_date"), "currency",
                          F.coalesce(F.col("segment"), F.lit("UNBOUND")).alias("segment"))
            .agg(F.count(F.lit(1)).alias("transaction_count"), F.sum("amount").cast(TT.TOTAL).alias("total_amount")))


REGISTRY = {
    "segment_payments": segment_payments,
    "json_extract": json_extract,
    "dq_reason_codes": dq_reason_codes,
    "dq_reason_codes_accounts": dq_reason_codes_accounts,
    "quarantine_by_reason": quarantine_by_reason,
    "dq_reject_ratio": dq_reject_ratio,
    "latest_version_wins": latest_version_wins,
    "duplicate_keys": duplicate_keys,
    "scd2_history": scd2_history,
    "scd2_current": scd2_current,
    "scd2_interval_audit": scd2_interval_audit,
    "scd2_violations": scd2_violations,
    "point_in_time_join": point_in_time_join,
    "as_of_bind": as_of_bind,
    "fk_classification": fk_classification,
    "semi_join_known": semi_join_known,
    "anti_join_orphans": anti_join_orphans,
    "payments_daily": payments_daily,
    "customer_activity": customer_activity,
    "currency_control_totals": currency_control_totals,
    "reconcile_control": reconcile_control,
    "reconcile_full_join": reconcile_full_join,
    "missing_history": missing_history,
    "historical_turnover": historical_turnover,
    "calendar_fill": calendar_fill,
    "mart_fingerprint": mart_fingerprint,
    "join_broadcast": join_broadcast,
    "join_shuffle": join_shuffle,
    "checksum": checksum,
    "one_day_rollup": one_day_rollup,
    "top1_latest": top1_latest,
    "last_n": last_n,
    "freshness": freshness,
    "idempotent_append": idempotent_append,
    "merge_upsert": merge_upsert,
    "upsert_change_count": upsert_change_count,
    "fact_reference_violations": fact_reference_violations,
    "prepared_transactions": prepared_transactions,
    "prepared_quarantine": prepared_quarantine,
    "prepared_history": prepared_history,
    "prepared_accounts": prepared_accounts,
    "time_travel_read": time_travel_read,
    "schema_evolution_read": schema_evolution_read,
    "compaction": compaction,
    "publish_pointer": publish_pointer,
    "export_checksum": export_checksum,
    "file_metadata": file_metadata,
    "manifest_integrity": manifest_integrity,
    "typed_json_scan": typed_json_scan,
}
