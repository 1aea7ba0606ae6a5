"""Rows, columns and characters that must survive: one test per way they were once lost."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import scd2, sequence, temporal
from tallyframe.plans import publish, runner, tables
from tallyframe.sources import batch as B
from tests import ledger


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_version_2_is_refused_before_the_memo_column_exists(spark, scratch):
    opening, undone, noted = (ledger.write(spark, f"{scratch}/sources", n) for n in ("opening", "undone", "noted"))
    first = runner.Lake(f"{scratch}/first")
    with pytest.raises(ValueError, match="Schema v2"):
        runner.process(spark, first, *noted, publish_marts=False)
    assert B.raw_table(spark, first.raw) is None  # refused before anything is stored
    middle = runner.Lake(f"{scratch}/middle")
    with pytest.raises(ValueError, match="Schema v2"):
        runner.backfill(spark, middle, [opening[0], noted[0], undone[0]])
    assert B.raw_table(spark, middle.raw) is None
    runner.backfill(spark, middle, [opening[0]])
    tables.add_column(spark, middle.transactions, "memo", "string")
    runner.backfill(spark, middle, [noted[0], undone[0]])
    assert [r["memo"] for r in tables.read_version(spark, middle.transactions).filter("memo is not null").collect()] == ["re-counted"]


def test_align_refuses_a_column_without_a_place(spark):
    df = spark.createDataFrame([("a", "note")], "k string, memo string")
    with pytest.raises(tables.SchemaError, match="memo"):
        tables.align(df, df.drop("memo").schema)


def test_export_is_exact(spark, scratch):
    at = dt.datetime(2025, 2, 1, 10, 0, 0, 123456)
    text = ["  pad ", "two\nlines", 'quote " and , comma', "back\\slash", "", "\\N", "é\r\nx", None]
    history = spark.createDataFrame([(f"v{i}", "c", t, "S", at, None if i % 2 else at + dt.timedelta(microseconds=1), bool(i % 2), i) for i, t in enumerate(text)],
                                    "customer_version_id string, customer_id string, region string, segment string, valid_from timestamp, valid_to timestamp, is_current boolean, change_version bigint")
    from decimal import Decimal
    activity = spark.createDataFrame([("007", dt.date(2025, 2, 1), "RUB", 1, Decimal("9999999999999999.99"), Decimal("0.10"), at)],
                                     "customer_id string, activity_date date, currency string, transaction_count bigint, incoming_amount decimal(38,2), outgoing_amount decimal(38,2), last_event_at timestamp")
    folder, files = f"{scratch}/exports/0012", {}
    for name, df in (("history", history), ("activity", activity)):
        files[name] = publish.export(df, f"{folder}/{name}", "0012")
        assert files[name]["records"] == df.count()
    spark.createDataFrame([(json.dumps({"snapshots": {"t": 1}, "files": files, "expected": []}),)], "m string").coalesce(1).write.text(f"{folder}/manifest")
    with pytest.raises(ValueError, match="not from"):
        publish.stage(spark, scratch, "0012", {"t": 2})
    publish.stage(spark, scratch, "0012", {"t": 1})
    for name, df in (("history", history), ("activity", activity)):
        back = publish.staged(spark, scratch, name, "0012")
        assert rows_of(back.drop("run_id")) == rows_of(df)
        assert {r["run_id"] for r in back.collect()} == {"0012"}


def test_rows_of_the_null_partition_survive_an_upsert(spark, scratch):
    schema = "k string, event_date date, h string"
    day = dt.date(2025, 2, 1)
    table = f"{scratch}/facts"
    tables.write_version(spark.createDataFrame([("a", None, "1"), ("b", day, "1"), ("c", None, "1")], schema), table, ["event_date"])
    upd = spark.createDataFrame([("a", None, "2"), ("d", None, "1"), ("b", day, "1")], schema)
    r = tables.upsert(upd, table, ["k"], ["h"], ["event_date"])
    assert r["changed_count"] == 2 and r["touched_partitions"] == 1
    assert rows_of(tables.read_version(spark, table).select("k", "event_date", "h")) == [("a", None, "2"), ("b", day, "1"), ("c", None, "1"), ("d", None, "1")]
    assert tables._entry(spark, table, None)["row_count"] == 4


def test_one_changed_row_rewrites_one_day(spark, scratch):
    schema = "k string, event_date date, h string"
    days = [dt.date(2025, 3, 1) + dt.timedelta(days=i) for i in range(20)]
    table = f"{scratch}/days"
    tables.write_version(spark.createDataFrame([(f"k{i}", d, "1") for i, d in enumerate(days)], schema), table, ["event_date"])
    upd = spark.createDataFrame([(f"k{i}", d, "2" if i == 7 else "1") for i, d in enumerate(days)], schema)
    r = tables.upsert(upd, table, ["k"], ["h"], ["event_date"])
    assert (r["changed_count"], r["touched_partitions"]) == (1, 1)
    assert tables.read_version(spark, table).count() == 20


def test_merge_refuses_two_updates_of_one_key(spark):
    t = spark.createDataFrame([("a", "1")], "k string, h string")
    u = spark.createDataFrame([("a", "2"), ("a", "3")], "k string, h string")
    with pytest.raises(Exception, match="two updates of key"):
        tables.merge(t, u, ["k"], ["h"]).collect()


def _orders(spark, n, first=0):
    return spark.range(first, first + n).select(F.col("id").alias("ordinal"), F.col("id").cast("string").alias("transaction_id"), F.lit("1.00").alias("amount"))


def test_a_batch_is_never_replaced(spark, scratch):
    folder, manifest = B.write_batch(spark, scratch, "2025-02-01", {"transactions": _orders(spark, 5)}, "x")
    assert B.write_batch(spark, scratch, "2025-02-01", {"transactions": _orders(spark, 5)}, "x")[1]["batch_id"] == manifest["batch_id"]
    with pytest.raises(ValueError, match="differs"):
        B.write_batch(spark, scratch, "2025-02-01", {"transactions": _orders(spark, 6)}, "x")
    assert B.check_batch(spark, folder, manifest).filter("rule <> 'unapproved_fields'").count() == 0


def test_shards_of_any_number(spark, scratch):
    far = 100_000 * 123_456 + 10 ** 13
    rows = _orders(spark, 3, far)
    folder, manifest = B.write_batch(spark, scratch, "2025-02-01", {"transactions": rows}, "far")
    assert [f["name"].split("/")[1] for f in manifest["files"]] == [f"shard={far // 100_000}"]
    assert B.check_manifest(manifest) == []
    got = B.read_batch(spark, folder, manifest).collect()
    assert {r["entity"] for r in got} == {"transactions"} and f"transactions:{far}" in {r["source_record_id"] for r in got}
    assert B.check_batch(spark, folder, manifest).count() == 0


def test_a_failing_read_is_not_an_empty_table(spark, scratch, monkeypatch):
    folder, manifest = B.write_batch(spark, scratch, "2025-02-01", {"transactions": _orders(spark, 5)}, "y")
    raw = f"{scratch}/raw"
    B.ingest(spark, raw, folder, manifest)

    def failing(*_):
        raise OSError("storage is away")

    monkeypatch.setattr(B, "path_exists", failing)
    with pytest.raises(OSError):
        B.ingest(spark, raw, folder, manifest)
    monkeypatch.undo()
    assert B.ingest(spark, raw, folder, manifest)["accepted_count"] == 5
    assert B.raw_table(spark, raw).count() == 5


@pytest.mark.parametrize("partitions", [1, 5])
def test_null_keys_alike_in_all_forms(spark, partitions):
    df = spark.range(120).select(F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"), F.col("id").alias("t"),
                                 F.when(F.col("id") % 4 == 0, F.col("id")).alias("v"))
    kw = {"lag": {"t": "prev"}, "lead": {"t": "next"}, "fill": {"v": "last_v"}}
    cols = ["t", "prev", "next", "last_v"]
    assert rows_of(sequence.neighbours(df, ["k"], ["t"], method="window", **kw).select(cols)) == rows_of(sequence.neighbours(df, ["k"], ["t"], partitions=partitions, **kw).select(cols))
    a = sequence.dense_rank(df, ["k"], "v", "r", method="window")
    b = sequence.dense_rank(df, ["k"], "v", "r", partitions=partitions)
    assert rows_of(a) == rows_of(b)
    at = lambda c: F.timestamp_seconds(F.lit(1_700_000_000) + c)
    changes = df.select(F.col("k").alias("customer_id"), at(F.col("t") * 10).alias("effective_at"), (F.col("t") % 5).cast("string").alias("segment"), F.col("t").alias("change_version"), F.lit("h").alias("record_hash"), F.lit(None).cast("timestamp").alias("received_at"))
    h = scd2.history(changes, "customer_id", "effective_at", ["change_version", "record_hash"], ["segment"])
    facts = df.select("k", F.col("t").alias("id"), at(F.col("t") * 10 + 5).alias("ts"))
    forms = [rows_of(temporal.bind(facts, h, "k", "ts", "customer_id", ("segment",), form=form, method=method)) for form, method in (("range", "range"), ("asof", "range"), ("asof", "window"))]
    assert forms[0] == forms[1] == forms[2]
    assert all(r[3] is None for r in forms[0] if r[0] is None) and any(r[3] is not None for r in forms[0])
