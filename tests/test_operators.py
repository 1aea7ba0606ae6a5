"""Unit tests of single operators on small fixtures, positive and negative."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyframe.functions import predicates as P
from tallyframe.operators import reconcile, scd2, sequence, temporal, validation, versions
from tallyframe.plans import publish, tables
from tallyframe.sources import batch as B
from tallyframe.sources import proxy
from tests import ledger
from tests.conftest import SMALL_SF


def test_money_rule(spark):
    values = ["1.0", "9999999999999999.99", "-9.00", "0", "0.00", "1.234", "12345678901234567", "1e3", None]
    df = spark.createDataFrame([(v,) for v in values], "a string")
    got = dict(df.select("a", F.coalesce(P.money("a"), F.lit(False)).alias("ok")).collect())
    assert got == {"1.0": True, "9999999999999999.99": True, "-9.00": False, "0": False, "0.00": False,
                   "1.234": False, "12345678901234567": False, "1e3": False, None: False}


def test_reason_codes_of_invalid_row(spark):
    raw = spark.createDataFrame(
        [("transactions", '{"transaction_id":"BAD","account_id":"UNKNOWN","amount":"-1","record_version":"1"}',
          "b", "transactions:000000000000", None)],
        "entity string, payload string, batch_id string, source_record_id string, ingested_at timestamp")
    reason = validation.check_entity(raw, "transactions").first()["reason"]
    assert reason == ("required:channel;required:currency;required:direction;required:event_at;"
                      "required:source_updated_at;required:status;currency;event_at;source_updated_at;amount;"
                      "status;direction;channel")


def test_malformed_json_fails_every_required_rule(spark):
    raw = spark.createDataFrame([("accounts", "{not json", "b", "accounts:1", None)],
                                "entity string, payload string, batch_id string, source_record_id string, "
                                "ingested_at timestamp")
    reason = validation.check_entity(raw, "accounts").first()["reason"]
    assert reason.startswith("required:account_id;required:currency;required:customer_id")


def test_reject_ratio_is_strict(spark):
    checked = spark.createDataFrame([("b1", "")] * 9 + [("b1", "amount")] + [("b2", "x"), ("b2", "")],
                                    "batch_id string, reason string")
    rows = {r["batch_id"]: r for r in validation.reject_ratio(checked).collect()}
    assert not rows["b1"]["breach"] and rows["b2"]["breach"]
    with pytest.raises(validation.DataQualityError):
        validation.enforce({"read_count": 1, "rejected_count": 1})
    validation.enforce({"read_count": 10, "rejected_count": 1})


def test_latest_wins_forms_agree_and_break_ties_by_hash(spark):
    li = proxy.lineitem_versions(spark, SMALL_SF)
    keys, order = ["l_orderkey", "l_linenumber"], ["updated_at", "record_hash"]
    a = versions.latest_wins(li, keys, order).collect()
    b = versions.latest_wins(li, keys, order, method="window").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    tie = spark.createDataFrame([("k", 1, "a"), ("k", 1, "b")], "k string, v int, h string")
    assert versions.latest_wins(tie, ["k"], ["v", "h"]).first()["h"] == "b"


def _hot(spark):
    """Events with every user folded onto one key: a key holding all rows."""
    e = proxy.table(spark, SMALL_SF, "events")
    return e.select(F.lit("hot").alias("k"), "ts", "event_id", "event_type")


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_sequence_range_equals_window_on_a_hot_key(spark, partitions):
    df = _hot(spark).withColumn("v", F.when(F.col("event_type") == "purchase", F.col("event_id")))
    kw = dict(lag={"event_id": "prev"}, lead={"event_id": "next"}, fill={"v": "last_v"})
    a = sequence.neighbours(df, ["k"], ["ts"], method="window", **kw)
    b = sequence.neighbours(df, ["k"], ["ts"], method="range", partitions=partitions, **kw)
    cols = ["event_id", "prev", "next", "last_v"]
    assert sorted(map(tuple, a.select(cols).collect())) == sorted(map(tuple, b.select(cols).collect()))


def test_scd2_methods_agree_and_history_is_valid(spark):
    ch = proxy.customer_changes(spark, SMALL_SF)
    args = ("customer_id", "effective_at", ["change_version", "record_hash"], ["region", "segment"])
    w = scd2.history(ch, *args, method="window")
    r = scd2.history(ch, *args, method="range")
    assert sorted(map(tuple, w.collect())) == sorted(map(tuple, r.collect()))
    assert scd2.violations(w).count() == 0
    assert scd2.multiple_current(w).count() == 0


def test_scd2_keeps_first_of_equal_run_and_handles_late_change(spark):
    rows = [("C", "2025-02-01 00:00:00", 1, "RETAIL"), ("C", "2025-02-02 00:00:00", 2, "RETAIL"),
            ("C", "2025-02-03 00:00:00", 3, "PREMIUM"), ("C", "2025-02-01 06:00:00", 4, "BUSINESS")]
    ch = spark.createDataFrame(rows, "customer_id string, t string, change_version bigint, segment string") \
        .withColumn("effective_at", F.to_timestamp("t")).withColumn("received_at", F.current_timestamp())
    h = scd2.history(ch, "customer_id", "effective_at", ["change_version"], ["segment"]).orderBy("valid_from")
    got = [(r["segment"], r["change_version"], r["is_current"]) for r in h.collect()]
    assert got == [("RETAIL", 1, False), ("BUSINESS", 4, False), ("RETAIL", 2, False), ("PREMIUM", 3, True)]


def test_interval_audit_catches_overlap_and_open_gap(spark):
    rows = [("C", "v1", dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 5), False),
            ("C", "v2", dt.datetime(2025, 1, 3), None, True),
            ("D", "v3", dt.datetime(2025, 1, 1), None, False)]
    h = spark.createDataFrame(rows, "customer_id string, customer_version_id string, valid_from timestamp, "
                                    "valid_to timestamp, is_current boolean")
    bad = {r["customer_version_id"] for r in scd2.violations(h).collect()}
    assert bad == {"v2", "v3"}


@pytest.mark.parametrize("method", ["window", "range"])
def test_bind_forms_agree(spark, method):
    ch = proxy.customer_changes(spark, SMALL_SF)
    h = scd2.history(ch, "customer_id", "effective_at", ["change_version", "record_hash"], ["region", "segment"])
    facts = proxy.purchase_facts(spark, SMALL_SF).select("event_id", "customer_id", "event_at")
    cols = ("customer_version_id", "segment")
    for how in ("left", "inner"):
        a = temporal.bind(facts, h, "customer_id", "event_at", columns=cols, how=how, form="range").collect()
        b = temporal.bind(facts, h, "customer_id", "event_at", columns=cols, how=how, form="asof",
                          method=method).collect()
        assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_fk_classification_order(spark):
    tx = spark.createDataFrame(
        [("t1", "A0", "RUB", "2025-02-01 12:00:00"), ("t2", "A1", "USD", "2025-02-01 12:00:00"),
         ("t3", "A1", "RUB", "2025-01-01 12:00:00"), ("t4", "A1", "RUB", "2025-02-01 12:00:00"),
         ("t5", "A2", "RUB", "2025-02-01 12:00:00")],
        "transaction_id string, account_id string, currency string, t string").withColumn("event_at", F.to_timestamp("t"))
    acc = spark.createDataFrame([("A1", "C1", "RUB", dt.date(2025, 1, 15)), ("A2", "C2", "RUB", dt.date(2025, 1, 1))],
                                "account_id string, customer_id string, currency string, opened_at date")
    h = spark.createDataFrame([("v1", "C1", dt.datetime(2025, 2, 1), None)],
                              "customer_version_id string, customer_id string, valid_from timestamp, valid_to timestamp")
    got = {r["transaction_id"]: r["fk_reason"] for r in temporal.bind_to_accounts_and_history(tx, acc, h).collect()}
    assert got == {"t1": "account_fk", "t2": "account_currency", "t3": "before_account_opening", "t4": "",
                   "t5": "customer_interval"}


def test_merge_actions_and_never_delete(spark):
    t = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c")], "k string, h string")
    u = spark.createDataFrame([("2", "b"), ("3", "x"), ("4", "d")], "k string, h string")
    got = {r["k"]: (r["h"], r["_action"]) for r in tables.merge(t, u, ["k"], ["h"]).collect()}
    assert got == {"1": ("a", "kept"), "2": ("b", "same"), "3": ("x", "updated"), "4": ("d", "inserted")}


def test_versioned_table_time_travel_and_schema_guard(spark, scratch):
    table = f"{scratch}/t"
    tables.write_version(spark.createDataFrame([("1", Decimal("1.00"))], "k string, amount decimal(18,2)"), table)
    tables.upsert(spark.createDataFrame([("1", Decimal("2.00"))], "k string, amount decimal(18,2)"), table,
                  ["k"], ["amount"])
    assert tables.read_version(spark, table, 0).first()["amount"] == Decimal("1.00")
    assert tables.read_version(spark, table).first()["amount"] == Decimal("2.00")
    v = tables.add_column(spark, table, "memo", "string")
    assert tables.read_version(spark, table, v).first()["memo"] is None
    with pytest.raises(tables.SchemaError):
        tables.change_type(spark, table, "amount", "string")
    with pytest.raises(tables.SchemaError):
        tables.check_compatible(tables.read_version(spark, table).schema,
                                tables.read_version(spark, table).drop("memo").schema)


def test_batches_are_reproducible_and_sharded(spark, scratch):
    f1, m1 = ledger.derived(spark, f"{scratch}/a", "2025-01-01", SMALL_SF, 5, 2)
    _, m2 = ledger.derived(spark, f"{scratch}/b", "2025-01-01", SMALL_SF, 5, 2)
    _, m3 = ledger.derived(spark, f"{scratch}/c", "2025-01-01", SMALL_SF, 5, 3)
    assert m1["batch_id"] == m2["batch_id"] and m1["batch_id"] != m3["batch_id"]
    assert [(f["records"], f["sha256"]) for f in m1["files"]] == [(f["records"], f["sha256"]) for f in m2["files"]]
    assert B.check_batch(spark, f1, m1).count() == 0
    rows = spark.range(100_001).select(F.col("id").alias("ordinal"), F.col("id").cast("string").alias("customer_id"))
    folder, man = B.write_batch(spark, f"{scratch}/e", "2025-01-01", {"customers": rows})
    assert [f["records"] for f in man["files"]] == [100_000, 1]
    assert B.check_batch(spark, folder, man).count() == 0


def test_manifest_detects_tampering_unknown_fields_and_bad_ordinals(spark, scratch):
    folder, man = ledger.derived(spark, f"{scratch}/t", "2025-01-01", SMALL_SF, 9, 1)
    name = next(f["name"] for f in man["files"] if f["entity"] == "transactions")
    path = f"{folder}/{name}".replace("file:", "")
    with open(path, "a") as fh:
        fh.write("{}\n")
    assert {r["rule"] for r in B.check_batch(spark, folder, man).collect()} >= {"checksum", "record_id"}
    rows = spark.createDataFrame([(0, "x")], "ordinal bigint, unexpected string")
    f2, m2 = B.write_batch(spark, f"{scratch}/u", "2025-01-01", {"transactions": rows})
    assert "unapproved_fields" in {r["rule"] for r in B.check_batch(spark, f2, m2).collect()}
    bad = dict(m2, batch_id="2025-01-01-" + "0" * 20)
    assert "identity" in B.check_manifest(bad)


def test_ingest_is_idempotent(spark, scratch):
    folder, man = ledger.derived(spark, f"{scratch}/src", "2025-01-01", SMALL_SF, 5, 1)
    raw = f"{scratch}/raw"
    first = B.ingest(spark, raw, folder, man)
    again = B.ingest(spark, raw, folder, man)
    assert first == again and spark.read.parquet(raw).count() == first["read_count"]


def test_export_detects_corruption(spark, scratch):
    df = spark.createDataFrame([(dt.date(2025, 2, 1), "RUB", f"CH-{i}", 1, Decimal("9999999999999999.99"))
                                for i in range(50)],
                               "payment_date date, currency string, channel string, transaction_count bigint, "
                               "total_amount decimal(38,2)")
    folder = f"{scratch}/exports/run-x"
    info = publish.export(df, f"{folder}/payments", "run-x")
    assert info["records"] == 50
    import json
    spark.createDataFrame([(json.dumps({"snapshots": {}, "files": {"payments": info}, "expected": []}),)],
                          "m string").coalesce(1).write.text(f"{folder}/manifest")
    publish.stage(spark, scratch, "run-x")
    total = publish.staged(spark, scratch, "payments", "run-x").agg(F.sum("total_amount")).first()[0]
    assert total == Decimal("499999999999999999.50")
    some = next(iter(info["files"]))
    with open(f"{folder}/payments/{some}".replace("file:", ""), "a") as fh:
        fh.write("corruption\n")
    with pytest.raises(ValueError, match="checksum"):
        publish.stage(spark, scratch, "run-x")


def test_reconciliation_negatives(spark):
    expected = spark.createDataFrame([("RUB", 10, Decimal("1.00"))], "currency string, transaction_count bigint, "
                                                                      "total_amount decimal(38,2)")
    staged = spark.createDataFrame([(dt.date(2025, 2, 1), "RUB", "CARD", 11, Decimal("1.00")),
                                    (dt.date(2025, 2, 1), "EUR", "CARD", 1, Decimal("1.00"))],
                                   "payment_date date, currency string, channel string, transaction_count bigint, "
                                   "total_amount decimal(38,2)")
    assert reconcile.control_diff(expected, staged).filter("mismatch").count() == 1
    assert reconcile.unexpected_groups(staged, expected).count() == 1
    empty = staged.limit(0)
    assert reconcile.control_diff(expected, empty).filter("mismatch").count() == 1  # deleted staging rows
    assert not reconcile.is_clean(reconcile.duplicate_keys(staged.unionByName(staged), ["payment_date", "currency"]))


def test_freshness(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 2, 1),)], "published_at timestamp")
    assert reconcile.freshness(df, "published_at", dt.datetime(2025, 2, 3), 86400).first()["is_stale"] is True
    assert reconcile.freshness(df, "published_at", dt.datetime(2025, 2, 1, 1), 86400).first()["is_stale"] is False
    assert reconcile.freshness(df.limit(0), "published_at", dt.datetime(2025, 2, 1), 86400).first()["is_stale"]


def test_event_log_shuffle(spark, scratch):
    import json
    path = f"{scratch}/events.json".replace("file:", "")
    lines = [
        {"Event": "SparkListenerJobStart", "Job ID": 0, "Stage IDs": [1, 2], "Properties": {"spark.jobGroup.id": "g"}},
        {"Event": "SparkListenerTaskEnd", "Stage ID": 1, "Task Metrics": {
            "Shuffle Read Metrics": {"Remote Bytes Read": 5, "Local Bytes Read": 7},
            "Shuffle Write Metrics": {"Shuffle Bytes Written": 11}}},
        {"Event": "SparkListenerTaskEnd", "Stage ID": 2, "Task Metrics": {
            "Shuffle Read Metrics": {"Remote Bytes Read": 0, "Local Bytes Read": 1},
            "Shuffle Write Metrics": {"Shuffle Bytes Written": 0}}},
    ]
    with open(path, "w") as fh:
        fh.write("\n".join(json.dumps(x) for x in lines) + "\n")
    row = B.event_log_shuffle(spark, path).first()
    assert (row["group"], row["shuffle_read_bytes"], row["shuffle_write_bytes"]) == ("g", 13, 11)


def test_streaming_ingest_of_new_batches(spark, scratch):
    from tallyframe.plans import runner
    from tallyframe.streaming import ingest_new_batches
    sources = f"{scratch}/sources"
    _, m1 = ledger.derived(spark, sources, "2025-01-01", SMALL_SF, 9, 1)
    lake = runner.Lake(f"{scratch}/lake")
    q = ingest_new_batches(spark, sources, lake, f"{scratch}/stream-checkpoint")
    q.awaitTermination(300)
    n1 = spark.read.parquet(lake.raw).count()
    assert n1 == sum(f["records"] for f in m1["files"])
    _, m2 = ledger.derived(spark, sources, "2025-01-02", SMALL_SF, 9, 2)
    q = ingest_new_batches(spark, sources, lake, f"{scratch}/stream-checkpoint")
    q.awaitTermination(300)
    raw = spark.read.parquet(lake.raw)
    assert raw.count() == n1 + sum(f["records"] for f in m2["files"])
    assert raw.select("batch_id").distinct().count() == 2


def test_upsert_rewrites_only_touched_days_and_empties_a_moved_day(spark, scratch):
    table = f"{scratch}/facts"
    rows = [("t1", dt.date(2025, 2, 1), "a"), ("t2", dt.date(2025, 2, 1), "b"), ("t3", dt.date(2025, 2, 2), "c"),
            ("t4", dt.date(2025, 2, 3), "d")]
    schema = "k string, event_date date, h string"
    tables.write_version(spark.createDataFrame(rows, schema), table, ["event_date"])
    # t1 moves 02-01 -> 02-04, t2 moves 02-01 -> 02-02: day 02-01 becomes empty; 02-03 is untouched
    upd = spark.createDataFrame([("t1", dt.date(2025, 2, 4), "a2"), ("t2", dt.date(2025, 2, 2), "b2"),
                                 ("t5", dt.date(2025, 2, 5), "e")], schema)
    r = tables.upsert(upd, table, ["k"], ["h"], partition_by=["event_date"])
    assert r["changed_count"] == 3 and r["touched_partitions"] == 4
    got = sorted((x["k"], x["event_date"].isoformat(), x["h"]) for x in tables.read_version(spark, table).collect())
    assert got == [("t1", "2025-02-04", "a2"), ("t2", "2025-02-02", "b2"), ("t3", "2025-02-02", "c"),
                   ("t4", "2025-02-03", "d"), ("t5", "2025-02-05", "e")]
    assert tables._entry(spark, table, None)["row_count"] == 5
    assert tables.read_version(spark, table, 0).count() == 4
    again = tables.upsert(upd, table, ["k"], ["h"], partition_by=["event_date"])
    assert again["changed_count"] == 0
    c = tables.compact(spark, table, ["event_date"])
    assert c["row_count"] == 5 and tables.read_version(spark, table).count() == 5


@pytest.mark.parametrize("partitions", [1, 4])
def test_dense_rank_range_equals_window_on_one_hot_group(spark, partitions):
    e = proxy.table(spark, SMALL_SF, "events")
    df = e.select(F.lit("2025-01-01").alias("d"), F.lit("RUB").alias("c"), "event_id",
                  (F.col("event_id") % 37).cast("decimal(38,2)").alias("t"))
    df = df.unionByName(df.limit(3).withColumn("t", F.lit(None).cast("decimal(38,2)")))
    a = sequence.dense_rank(df, ["d", "c"], "t", "r", method="window")
    b = sequence.dense_rank(df, ["d", "c"], "t", "r", method="range", partitions=partitions)
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def test_mart_constraints(spark):
    rows = [("v1", "C", "R", "S", dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 2), False, 1),
            ("v2", "C", "R", "S", dt.datetime(2025, 1, 2), None, True, 2),
            ("v3", "D", None, "S", dt.datetime(2025, 1, 1), None, False, 1),
            ("v4", "E", "R", "S", dt.datetime(2025, 1, 1), None, True, 1),
            ("v5", "E", "R", "S", dt.datetime(2025, 1, 1), None, True, 2)]
    h = spark.createDataFrame(rows, "customer_version_id string, customer_id string, region string, segment string, "
                                    "valid_from timestamp, valid_to timestamp, is_current boolean, change_version bigint")
    got = {(r["customer_version_id"], r["violation"]) for r in publish.constraint_violations(h, "history").collect()}
    assert got == {("v3", "not_null:region;current_flag"), ("v4", "unique_start"), ("v5", "unique_start"),
                   ("v4", "one_current"), ("v5", "one_current")}
    pay = spark.createDataFrame([(dt.date(2025, 2, 1), "RUB", None, 1, Decimal("1.00"))],
                                "payment_date date, currency string, channel string, transaction_count bigint, "
                                "total_amount decimal(38,2)")
    assert publish.constraint_violations(pay, "payments").first()["violation"] == "not_null:channel"
