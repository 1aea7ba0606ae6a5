"""Batch runner: raw -> validate -> load, then the publication steps, with journal rows per stage."""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession, functions as F

from tallyframe import types as TT
from tallyframe.operators import reconcile, scd2, validation
from tallyframe.plans import journal, publish, tables
from tallyframe.plans.prepare import Prepared, prepare
from tallyframe.session import materialize
from tallyframe.sources import batch as B
from tallyframe.sources import batches as BS
from tallyframe.sources.layout import write_observed


class Lake:
    """Folder layout of one deployment (all paths under one shared root)."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")
        self.raw = f"{self.root}/raw"
        self.transactions = f"{self.root}/dds/transactions"
        self.history = f"{self.root}/dds/customer_history"
        self.accounts = f"{self.root}/dds/accounts"
        self.customers = f"{self.root}/dds/customers"
        self.quarantine = f"{self.root}/dds/quarantine"
        self.publish = f"{self.root}/publish"
        self.journal = f"{self.root}/journal"


def require_memo_column(spark: SparkSession, lake: Lake, manifests: Sequence[Mapping]) -> None:
    """Version 2 records carry ``memo``; they are taken only by a fact table that has the column.

    Checked on every path before anything is stored, also for the first load and for each batch of a backfill.
    """
    if all(m["schema_version"] != 2 for m in manifests):
        return
    if tables.latest_version(spark, lake.transactions) is None or "memo" not in tables.read_version(spark, lake.transactions).columns:
        raise ValueError("Schema v2: add the memo column to the fact table first")


def raw_stage(spark: SparkSession, lake: Lake, folder: str, manifest: Mapping) -> dict:
    require_memo_column(spark, lake, [manifest])
    problems = B.check_batch(spark, folder, manifest)
    if not problems.isEmpty():
        raise ValueError(f"{folder} is not an intact batch, e.g. {[tuple(r) for r in problems.limit(5).collect()]}")
    return B.ingest(spark, lake.raw, folder, manifest)


def _prepared(spark: SparkSession, lake: Lake, method: str = "buckets") -> Prepared:
    raw = B.raw_table(spark, lake.raw)
    return prepare(raw, method=method)


def validate_stage(spark: SparkSession, lake: Lake, manifest: Mapping, maximum: float = TT.DEFAULT_MAX_REJECT_RATIO,
                   p: Prepared | None = None) -> dict:
    """Recompute the quarantine (retroactive, all raw) and enforce the batch's reject ratio."""
    own = p is None
    p = p or _prepared(spark, lake)
    try:
        v = tables.write_version(p.quarantine, lake.quarantine, operation="replace")
        # counted on the written version (partition-free filter on a small table), not by recomputing
        rejected = tables.read_version(spark, lake.quarantine, v).filter(
            F.col("batch_id") == manifest["batch_id"]).count()
        read = sum(int(f["records"]) for f in manifest["files"])
        return validation.enforce({"read_count": read, "accepted_count": read - rejected,
                                   "rejected_count": rejected}, maximum)
    finally:
        if own:
            p.release()


def load_stage(spark: SparkSession, lake: Lake, manifest: Mapping, p: Prepared | None = None) -> dict:
    """Write history/accounts/customers versions, upsert the facts, then the fact assertions."""
    own = p is None
    p = p or _prepared(spark, lake)
    try:
        require_memo_column(spark, lake, [manifest])
        current = tables.latest_version(spark, lake.transactions)
        tables.write_version(p.history, lake.history, operation="replace")
        tables.write_version(p.accounts, lake.accounts, operation="replace")
        tables.write_version(scd2.current(p.history), lake.customers, operation="replace")
        # Facts are partitioned by UTC event day; an upsert rewrites only the
        # days it touches (including a day a correction moves a fact out of).
        facts = p.transactions.withColumn("event_date", F.to_date("event_at"))
        if current is None or "memo" not in tables.read_version(spark, lake.transactions).columns:
            # no version 2 record is in raw (require_memo_column): the column holds no value
            facts = facts.drop("memo")
        if current is not None:
            facts = tables.align(facts, tables.read_version(spark, lake.transactions).schema)
        result = tables.upsert(facts, lake.transactions, ["transaction_id"], ["record_hash", "customer_version_id"],
                               partition_by=["event_date"])
        assert_facts(spark, lake)
        n = tables.read_version(spark, lake.transactions).count()
        return {"changed_count": result["changed_count"], "accepted_count": n}
    finally:
        if own:
            p.release()


def assert_facts(spark: SparkSession, lake: Lake) -> None:
    h = tables.read_version(spark, lake.history)
    if not reconcile.is_clean(scd2.violations(h)):
        raise ValueError("Critical DQ: customer intervals overlap, are empty or wrongly flagged")
    tx = tables.read_version(spark, lake.transactions)
    if not reconcile.is_clean(reconcile.duplicate_keys(tx, ["transaction_id"])):
        raise ValueError("Critical DQ: a transaction id occurs twice")
    acc = tables.read_version(spark, lake.accounts)
    if not reconcile.is_clean(reconcile.fact_reference_violations(tx, acc, h)):
        raise ValueError("Critical DQ: a fact points to no account or to no version valid at its time")


def process(spark: SparkSession, lake: Lake, folder: str, manifest: Mapping | None = None,
            run_id: str | None = None, publish_marts: bool = True) -> dict:
    """Run every stage of one batch; each stage writes a journal row (also on failure)."""
    manifest = manifest or B.read_manifest(spark, folder)
    run_id = run_id or uuid.uuid4().hex
    out = {}

    def step(name, fn):
        began = time.monotonic()
        try:
            metrics = fn()
        except Exception as error:
            journal.record(spark, lake.journal, run_id, name, time.monotonic() - began,
                           getattr(error, "metrics", {}), str(error))
            journal.batch_state(spark, lake.journal, manifest["batch_id"], run_id, "failed")
            journal.alert(spark, lake.journal, "task_failure", {"run_id": run_id, "error": str(error)})
            raise
        journal.record(spark, lake.journal, run_id, name, time.monotonic() - began, metrics)
        out[name] = metrics
        return metrics

    step("raw", lambda: raw_stage(spark, lake, folder, manifest))
    p = _prepared(spark, lake)
    try:
        step("validate", lambda: validate_stage(spark, lake, manifest, p=p))
        step("dds", lambda: load_stage(spark, lake, manifest, p=p))
    finally:
        p.release()
    if publish_marts:
        pinned = {}

        def _calculate():
            made = publish.calculate(spark, lake.publish, run_id, lake.transactions, lake.history)
            pinned.update(made["snapshots"])
            return {"accepted_count": sum(f["records"] for f in made["files"].values())}

        step("calculate", _calculate)
        step("stage", lambda: publish.stage(spark, lake.publish, run_id, pinned))
        step("reconcile", lambda: publish.reconcile_run(spark, lake.publish, run_id))
        step("publish", lambda: {"accepted_count": publish.publish(spark, lake.publish, run_id)["pointer_version"]})
        journal.batch_state(spark, lake.journal, manifest["batch_id"], run_id, "published",
                            dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    return out


def ingest_batches(spark: SparkSession, lake: Lake, folders: Sequence[str]):
    """Check and append the raw records of all folders as one job set; returns (manifests, greatest schema version).

    Manifests are one table (``sources.batches``), all files one scan.  Nothing is stored unless all batches are intact; a batch that is stored already adds nothing.
    """
    manifests = materialize(BS.read_manifests(spark, folders), "manifests")
    span = manifests.agg(F.max("schema_version").alias("version"), F.min("batch_id").alias("lo"), F.max("batch_id").alias("hi")).first()
    require_memo_column(spark, lake, [{"schema_version": span["version"]}])
    problems = BS.check_batches(spark, folders).limit(5).collect()  # an excerpt for the message
    if problems:
        raise ValueError(f"batches are not intact, e.g. {[tuple(r) for r in problems]}")
    incoming = BS.read_batches(spark, folders)
    raw = B.raw_table(spark, lake.raw)
    if raw is not None:  # batch ids begin with the day: only partitions of the range are read
        incoming = B.insert_absent(raw.filter(F.col("batch_id").between(span["lo"], span["hi"])), incoming)
    write_observed(incoming, lake.raw, {"rows": F.count(F.lit(1))}, ("entity", "batch_id"), "append")
    stored = B.raw_table(spark, lake.raw).filter(F.col("batch_id").between(span["lo"], span["hi"]))
    wrong = BS.count_mismatches(stored, manifests).limit(5).collect()
    if wrong:
        raise ValueError(f"raw records stored and listed differ, e.g. {[tuple(r) for r in wrong]}")
    return manifests, span["version"]


def backfill(spark: SparkSession, lake: Lake, folders: Sequence[str], maximum: float = TT.DEFAULT_MAX_REJECT_RATIO) -> dict:
    """Load many daily batches as one job set, whatever their number: one check, one append, one recompute, one upsert.

    Reject ratios are grouped by batch.  The end state equals day-by-day processing whenever every single batch would have passed its checks.
    """
    if not folders:
        raise ValueError("empty backfill range")
    manifests, version = ingest_batches(spark, lake, folders)
    p = _prepared(spark, lake)
    try:
        v = tables.write_version(p.quarantine, lake.quarantine, operation="replace")
        rejected = tables.read_version(spark, lake.quarantine, v).groupBy(F.col("batch_id").alias("_of")).agg(F.count(F.lit(1)).alias("rejected"))
        ratios = BS.listed_counts(manifests).join(rejected, F.col("batch_id") == F.col("_of"), "left").select(
            "batch_id", F.col("listed_count").alias("read_count"), F.coalesce("rejected", F.lit(0).cast("bigint")).alias("rejected_count"))
        worst = ratios.orderBy((F.col("rejected_count") / F.greatest("read_count", F.lit(1))).desc(), "batch_id").first()
        validation.enforce({"batch_id": worst["batch_id"], "read_count": worst["read_count"], "rejected_count": worst["rejected_count"],
                            "accepted_count": worst["read_count"] - worst["rejected_count"]}, maximum)
        return load_stage(spark, lake, {"schema_version": version}, p=p)
    finally:
        p.release()


def backfill_range(start: str, end: str) -> list[str]:
    """Inclusive list of days; start after end is an error."""
    s, e = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    if s > e:
        raise ValueError("start must not be after end")
    return [(s + dt.timedelta(days=i)).isoformat() for i in range((e - s).days + 1)]
