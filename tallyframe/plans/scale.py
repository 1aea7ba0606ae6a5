"""Registered queries of the operators for skew, increments, many batches and physical layout, over whole given tables."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyframe import types as TT
from tallyframe.functions import digest
from tallyframe.operators import ordinals, scd2, sequence, skew, temporal, versions
from tallyframe.plans import incremental, tables
from tallyframe.plans import workloads as W
from tallyframe.session import materialize, work_dir
from tallyframe.sources import batch as B
from tallyframe.sources import batches as BS
from tallyframe.sources import layout, proxy

# --- running aggregates -----------------------------------------------------------------------

LINE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "amount", "quantity"]


def running_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Line items by return flag and line status (few keys, each very large): running amount by row, by day with ties, greatest quantity so far."""
    li = proxy.table(spark, sf, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_extendedprice").cast(TT.MONEY).alias("amount"), F.col("l_quantity").cast(TT.MONEY).alias("quantity"))
    keys, month = ["l_returnflag", "l_linestatus"], F.date_trunc("month", "l_shipdate")
    rows = sequence.scan(li, keys, LINE_ORDER, {"amount": "running_amount"}, {"quantity": "greatest_quantity"}, method="buckets", bucket=month)
    both = sequence.scan(rows, keys, ["l_shipdate"], {"amount": "day_amount"}, frame="range", method="buckets", bucket=month)
    return both.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "amount", F.col("running_amount").cast(TT.TOTAL).alias("running_amount"),
                       F.col("day_amount").cast(TT.TOTAL).alias("day_amount"), "greatest_quantity")


def interval_overlaps_faults(spark, sf):
    """History of which every fifth version ends ten days late, so it may hold later versions whole."""
    h = W._history(spark, sf)
    late = F.when(F.col("change_version") % 5 == 0, F.col("valid_to") + F.expr("INTERVAL 10 DAYS")).otherwise(F.col("valid_to"))
    return scd2.overlap_audit(h.withColumn("valid_to", late)).select("customer_version_id", "customer_id", "valid_from", "valid_to", "covered_to", "is_overlapping")


def interval_bind(spark, sf):
    """Purchases bound through time buckets of a day."""
    facts = proxy.purchase_facts(spark, sf).select("event_id", "customer_id", "event_at")
    return temporal.bind(facts, W._history(spark, sf), "customer_id", "event_at", columns=("customer_version_id", "segment"), form="interval", unit="day")


# --- skew -------------------------------------------------------------------------------------

def _skewed_lines(spark, sf):
    """Line items of which a third share one part key."""
    li = proxy.table(spark, sf, "lineitem")
    part = F.when(F.col("l_orderkey") % 3 == 0, 1).otherwise(F.col("l_partkey"))
    return li.select("l_orderkey", "l_linenumber", "l_suppkey", part.cast("bigint").alias("part_key"), F.col("l_quantity").cast(TT.MONEY).alias("quantity"))


def heavy_key_join(spark, sf):
    """Each line with the totals of its part: the partner side ends in an aggregate, and one part has a third of the lines."""
    li = _skewed_lines(spark, sf)
    totals = li.groupBy("part_key").agg(F.count(F.lit(1)).alias("part_lines"), F.sum("quantity").cast(TT.TOTAL).alias("part_quantity"))
    return skew.split_join(li, totals, ["part_key"]).select("l_orderkey", "l_linenumber", "l_suppkey", "part_key", "part_lines", "part_quantity")


# --- increments -------------------------------------------------------------------------------

#: Records whose checksum modulo LOAD_MODULUS is LATE come with the second load; the rest is the first.
LOAD_MODULUS, LATE = 20, 0


def _incremental(spark, sf):
    # read by every load; written by entity, so that each is read in parts of its own size
    derived = proxy.raw_records(spark, sf)
    parts = [materialize(derived.filter(F.col("entity") == e), f"raw-{e}") for e in TT.ENTITIES]
    raw = functools.reduce(DataFrame.unionByName, parts)
    part = F.crc32(F.col("source_record_id").cast("binary")) % LOAD_MODULUS
    state = incremental.create(spark, work_dir(spark, "state"), buckets=16)
    for load in (part != LATE, part == LATE):
        incremental.apply(state, raw.filter(load))
    return state


def incremental_transactions(spark, sf):
    """Facts after two loads, of which the second holds late and out-of-order records of all entities."""
    return incremental.result(_incremental(spark, sf), "transactions")


def incremental_quarantine(spark, sf):
    return incremental.result(_incremental(spark, sf), "quarantine")


# --- many batches -----------------------------------------------------------------------------

def _order_lines(spark, sf):
    t = proxy.transactions(spark, sf)
    return t.select(F.col("transaction_id").cast("bigint").alias("ordinal"), "transaction_id", "account_id", proxy.iso_utc(F.col("event_at")).alias("event_at"),
                    F.col("amount").cast("string").alias("amount"), "currency", "status", F.year("event_at").alias("year"))


#: Order year -> fault of its batch.
BATCH_FAULTS = {1996: "count", 1997: "missing_file", 1998: "unapproved_fields", 1999: "ordinal", 2000: "checksum", 2001: "identity"}
YEARS = tuple(range(1995, 2002))


def _year_batches(spark, sf, faults):
    """One batch folder a year of orders, ordinals dense within the year's shards; faults are put into manifests and lines."""
    root = work_dir(spark, "years")
    lines = _order_lines(spark, sf)
    counts = lines.groupBy("year").agg(F.count(F.lit(1)).alias("n"))
    numbered = materialize(sequence.scan(lines.withColumn("one", F.lit(1)), ["year"], ["ordinal"], {"one": "rank"}, method="buckets", bucket=F.floor(F.col("ordinal") / 4096))
                           .withColumn("ordinal", (F.col("rank") - 1).cast("bigint")).drop("one", "rank"), "numbered")
    present = {r["year"] for r in counts.collect()}  # at most seven
    folders = []
    for year in sorted(present & set(YEARS)):
        fault = faults.get(year)
        rows = numbered.filter(F.col("year") == year).drop("year")
        if fault == "unapproved_fields":
            rows = rows.withColumn("surprise", F.lit("x"))
        if fault == "ordinal":  # the first record comes twice
            rows = rows.unionByName(rows.filter("ordinal = 0"))
        folder, manifest = B.write_batch(spark, root, f"{year}-01-01", {"transactions": rows}, "year")
        if fault in ("count", "missing_file", "checksum", "identity"):
            files = [dict(f) for f in manifest["files"]]
            if fault == "count":
                files[0]["records"] += 1
            elif fault == "checksum":
                files[0]["sha256"] = "0" * 64
            elif fault == "missing_file":
                files.append(dict(files[0], name="transactions/shard=00099/part-lost.txt"))
            told = dict(manifest, files=files)
            told["batch_id"] = f"{year}-01-01-{'0' * 20}" if fault == "identity" else B.batch_identity(told)
            spark.createDataFrame([told], TT.MANIFEST_SCHEMA).coalesce(1).write.mode("overwrite").json(f"{folder}/manifest")
        folders.append(folder)
    return folders


def backfill_integrity_faults(spark, sf):
    """Seven yearly batches checked as one, six of them faulty: day, rule and the shard (NULL for a rule of the manifest)."""
    found = BS.check_batches(spark, _year_batches(spark, sf, BATCH_FAULTS))
    return found.select(F.substring("batch_id", 1, 10).alias("batch_day"), "rule", F.regexp_extract("name", r"shard=(\d+)/", 1).alias("shard"), F.coalesce("detail", F.lit("")).alias("detail"))


def backfill_records(spark, sf):
    """All yearly batches read as one table with their provenance."""
    raw = BS.read_batches(spark, _year_batches(spark, sf, {}))
    return raw.select("entity", F.substring("batch_id", 1, 10).alias("batch_day"), "source_record_id", "schema_version", F.get_json_object("payload", "$.transaction_id").alias("transaction_id"))


# --- ordinals ---------------------------------------------------------------------------------

def idempotent_append_bitmaps(spark, sf):
    """``idempotent_append`` by ordinal bitmaps: raw already holds the batches before W.LOADED_BEFORE, and every batch arrives again."""
    raw = proxy.transaction_payloads(spark, sf).select("entity", "batch_id", "source_record_id", F.regexp_extract("source_record_id", r":(\d+)$", 1).cast("bigint").alias("ordinal"))
    existing = raw.filter(F.col("batch_id") < W.LOADED_BEFORE)
    added = ordinals.insert_absent(existing, raw, ["entity", "batch_id"], "ordinal")
    return existing.withColumn("ingest_action", F.lit("kept")).unionByName(added.withColumn("ingest_action", F.lit("inserted"))).drop("ordinal")


def _faulty_ordinals(spark, sf):
    """Orders as records of batches by priority: every 97th is missing, every 89th comes twice, every 101st has no ordinal."""
    o = proxy.table(spark, sf, "orders").select(F.col("o_orderpriority").alias("batch"), F.col("o_orderkey").alias("ordinal")).filter("ordinal % 97 <> 0")
    numbered = o.withColumn("ordinal", F.when(F.col("ordinal") % 101 != 0, F.col("ordinal")))
    return numbered.unionByName(numbered.filter("ordinal % 89 = 0"))


def ordinal_presence_faults(spark, sf):
    return ordinals.presence(_faulty_ordinals(spark, sf), ["batch"], "ordinal")


def ordinal_gaps_faults(spark, sf):
    return ordinals.gaps(_faulty_ordinals(spark, sf), ["batch"], "ordinal")


# --- counts while writing, digests, layout ----------------------------------------------------

def load_metrics(spark, sf):
    """Order records checked and written, valid and rejected apart; all counts are taken from the rows as they are written."""
    checked = W._checked_transactions(spark, sf).select("source_record_id", "batch_id", "reason", (F.col("reason") != "").alias("rejected"))
    seen = layout.write_observed(checked, work_dir(spark, "checked"), {
        "read_count": F.count(F.lit(1)), "rejected_count": F.count_if("rejected"), "channel_count": F.count_if(F.col("reason").contains("channel")),
        "first_batch": F.min("batch_id"), "last_batch": F.max("batch_id")}, ("rejected",))
    seen["accepted_count"] = seen["read_count"] - seen["rejected_count"]
    return spark.createDataFrame([seen], "read_count bigint, rejected_count bigint, accepted_count bigint, channel_count bigint, first_batch string, last_batch string")


def _line_segments():
    """Year, then month of shipping."""
    return [("year", F.date_format("l_shipdate", "yyyy")), ("month", F.date_format("l_shipdate", "MM"))]


def digest_tree(spark, sf):
    """Digests of the line items by month of shipping, by year and of the whole table."""
    li = proxy.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", F.col("l_quantity").cast(TT.MONEY).alias("quantity"), F.col("l_shipdate").cast("timestamp").alias("l_shipdate"))
    return digest.tree(li, _line_segments(), ["l_orderkey", "l_linenumber"], ["l_orderkey", "l_linenumber", "l_returnflag", "quantity"])


def digest_difference(spark, sf):
    """Fact state before and after the corrections: only key ranges whose digests differ are compared row by row."""
    stored, updates = W._fact_versions(spark, sf)
    after = tables.merge(stored, updates, ["transaction_id"], ["record_hash"]).drop("_action")
    span = [("range", F.floor(F.col("transaction_id").cast("bigint") / 1000))]
    return digest.located(materialize(stored, "before"), materialize(after, "after"), span, ["transaction_id"]).withColumn(
        "state", F.when(F.col("side") == "left", "before").otherwise("after")).drop("side")


def bucketed_join(spark, sf):
    """Facts and accounts written as tables bucketed by account, joined without an exchange."""
    run = uuid.uuid4().hex[:12]
    tx = proxy.transactions(spark, sf).select("transaction_id", "account_id", "event_at", "amount", "currency", "status", "channel")
    acc = proxy.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("account_id"), F.col("c_custkey").cast("string").alias("customer_id"))
    left = layout.write_bucketed(tx, f"facts_{run}", "account_id", 8)
    right = layout.write_bucketed(acc, f"accounts_{run}", "account_id", 8)
    return left.join(right.hint("merge"), "account_id").select("transaction_id", "customer_id", "event_at", "amount", "currency", "status", "channel")


def sized_write(spark, sf):
    """Order facts written in files of a wanted size, read back: rows and amount."""
    path = work_dir(spark, "sized")
    layout.write_sized(proxy.transactions(spark, sf), path, 256 * 1024)
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("row_count"), F.sum("amount").cast(TT.TOTAL).alias("total_amount"))


def account_winners(spark, sf):
    """Accounts of one to four versions each, some of a customer without orders: the winner first, then the filter on known customers."""
    c = proxy.table(spark, sf, "customer")
    version = F.explode(F.sequence(F.lit(1), (F.col("c_custkey") % 4 + 1).cast("int")))
    rows = c.select("c_custkey", "c_nationkey", version.alias("v")).select(
        F.col("c_custkey").cast("string").alias("account_id"),
        F.when((F.col("v") == 3) & (F.col("c_custkey") % 5 == 0), F.lit("nobody")).otherwise(F.col("c_custkey").cast("string")).alias("customer_id"),
        proxy.currency_of(F.col("c_nationkey") + F.col("v")).alias("currency"), F.least(F.col("v"), F.lit(3)).cast("bigint").alias("record_version"))
    rows = rows.withColumn("record_hash", F.sha2(F.concat_ws("|", "account_id", "customer_id", "currency", F.col("record_version").cast("string")), 256))
    known = proxy.table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("customer_id")).distinct()
    winners = versions.latest_wins(rows, ["account_id"], ["record_version", "record_hash"])
    return winners.join(known, "customer_id", "left_semi").select("account_id", "customer_id", "currency", "record_version", "record_hash")


REGISTRY = {f.__name__: f for f in (
    running_totals, interval_overlaps_faults, interval_bind, heavy_key_join, incremental_transactions, incremental_quarantine, backfill_integrity_faults,
    backfill_records, idempotent_append_bitmaps, ordinal_presence_faults, ordinal_gaps_faults, load_metrics, digest_tree, digest_difference, bucketed_join,
    sized_write, account_winners)}
