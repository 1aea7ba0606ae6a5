"""Operators for skew, running aggregates, ordinals, digests and layout against plain forms; plans where they are the point."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyframe.functions import digest
from tallyframe.operators import ordinals, reconcile, scd2, sequence, skew, temporal
from tallyframe.plans import scale
from tallyframe.session import file_bytes, work_dir
from tallyframe.sources import layout, proxy
from tests.conftest import SMALL_SF


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def plan_of(df):
    return df._jdf.queryExecution().toString()


def skewed(spark, seed, n=600):
    """Rows of which a third have one key; NULL keys, NULL values, ties in time."""
    rng = random.Random(seed)
    rows = [("hot" if rng.random() < 0.34 else rng.choice(["a", "b", None]), dt.datetime(2024, rng.randrange(1, 13), rng.randrange(1, 28)) if rng.random() < 0.97 else None, k,
             Decimal(rng.randrange(-500, 500)).scaleb(-2) if rng.random() < 0.9 else None) for k in range(n)]
    return spark.createDataFrame(rows, "k string, t timestamp, id int, v decimal(18,2)").repartition(7, "id")


@pytest.mark.parametrize("frame,order", [("rows", ["t", "id"]), ("before", ["t", "id"]), ("range", ["t"])])
def test_scan_equals_the_window(spark, frame, order):
    df = skewed(spark, 5)
    kw = {"sums": {"v": "s"}, "maxima": {"v": "m"}, "frame": frame}
    want = rows_of(sequence.scan(df, ["k"], order, method="window", **kw).withColumn("s", F.col("s").cast("decimal(28,2)")))
    for form in ({"method": "buckets", "bucket": F.date_trunc("month", "t")}, {"method": "range", "partitions": 5}):
        got = sequence.scan(df, ["k"], order, **kw, **form)
        assert got.columns == [*df.columns, "s", "m"] and rows_of(got.withColumn("s", F.col("s").cast("decimal(28,2)"))) == want


def test_neighbours_in_buckets_equal_the_window_and_shuffle_rows_once(spark):
    df = skewed(spark, 6)
    kw = {"lag": {"v": "p", "t": "pt"}, "lead": {"v": "n"}, "fill": {"v": "f"}}
    got = sequence.neighbours(df, ["k"], ["t", "id"], method="buckets", bucket=F.date_trunc("month", "t"), **kw)
    assert rows_of(got) == rows_of(sequence.neighbours(df, ["k"], ["t", "id"], method="window", **kw))
    with pytest.raises(ValueError):
        sequence.neighbours(df, ["k"], ["t"], method="buckets", **kw)
    empty = df.limit(0)
    assert sequence.scan(empty, ["k"], ["t"], {"v": "s"}, method="buckets", bucket=F.col("t")).count() == 0


def test_one_key_of_a_third_is_cut_into_segments(spark):
    df = skewed(spark, 7, 900)
    part = df.withColumn("_seg", F.date_trunc("month", "t")).groupBy("k", "_seg").count()
    assert part.agg(F.max("count")).first()[0] < df.filter("k = 'hot'").count() / 5


def test_overlap_audit_finds_an_interval_nested_two_rows_back(spark):
    at = lambda d: dt.datetime(2024, 1, d)
    rows = [("c", "1", at(1), at(20)), ("c", "2", at(2), at(3)), ("c", "3", at(5), at(6)), ("c", "4", at(21), None), ("d", "5", at(1), None), ("d", "6", at(2), at(4)), ("e", "7", None, at(1)),
            ("f", "8", at(3), at(3)), (None, "9", at(1), at(5)), (None, "10", at(2), None)]
    h = spark.createDataFrame(rows, "customer_id string, customer_version_id string, valid_from timestamp, valid_to timestamp").withColumn("is_current", F.col("valid_to").isNull())
    bad = {r["customer_version_id"] for r in scd2.overlap_audit(h).filter("is_overlapping").collect()}
    assert bad == {"2", "3", "6", "7", "8", "10"}
    assert "3" not in {r["customer_version_id"] for r in scd2.violations(h).collect()}  # one row back sees nothing


@pytest.mark.parametrize("how", ["left", "inner"])
def test_all_forms_of_binding_agree(spark, how):
    rng = random.Random(8)
    at = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    versions = []
    for key in ["hot", "a", "b", None]:
        cuts = sorted(rng.sample(range(0, 4000), 40 if key == "hot" else 4))
        for i, c in enumerate(cuts):
            end = cuts[i + 1] if i + 1 < len(cuts) else None
            versions.append((key, at(c), None if end is None else at(end - (5 if i % 3 == 0 and end - c > 5 else 0)), f"{key}{i}"))
    versions.append(("b", at(9000), at(9000), "empty"))
    history = spark.createDataFrame(versions, "customer_id string, valid_from timestamp, valid_to timestamp, segment string")
    facts = spark.createDataFrame([(k, rng.choice(["hot", "hot", "a", "b", "z", None]), at(rng.randrange(-100, 4500)) if k % 50 else None, k % 3) for k in range(500)],
                                  "id int, k string, ts timestamp, valid_to int")
    forms = [temporal.bind(facts, history, "k", "ts", "customer_id", ("segment",), how=how, **kw) for kw in
             ({"form": "range"}, {"form": "asof"}, {"form": "asof", "method": "window"}, {"form": "asof", "method": "range"}, {"form": "interval"}, {"form": "interval", "unit": "day"})]
    want = rows_of(forms[0])
    assert all(rows_of(f) == want for f in forms) and any(r[-1] for r in want)
    for none in (facts.limit(0), facts):
        assert temporal.bind(none, history.limit(0), "k", "ts", "customer_id", ("segment",), how=how, form="interval").count() == (none.count() if how == "left" else 0)


def test_interval_form_meets_versions_of_its_bucket_only(spark):
    history = spark.range(2000).select(F.lit("k").alias("customer_id"), (F.timestamp_seconds(F.col("id") * 3600)).alias("valid_from"), (F.timestamp_seconds(F.col("id") * 3600 + 3600)).alias("valid_to"),
                                       F.col("id").alias("v"))
    facts = spark.range(2000).select(F.lit("k").alias("k"), F.timestamp_seconds(F.col("id") * 3600 + 60).alias("ts"), F.col("id"))
    got = temporal.bind(facts, history, "k", "ts", "customer_id", ("v",), form="interval", unit="day")
    assert got.filter("id <> v or v is null").count() == 0 and "CartesianProduct" not in plan_of(got) and "BroadcastNestedLoopJoin" not in plan_of(got)


def test_heavy_keys_and_split_join(spark):
    facts = skewed(spark, 9, 2000).withColumnRenamed("v", "x")
    sums = facts.groupBy("k").agg(F.sum("x").alias("total"), F.count(F.lit(1)).alias("n"))
    heavy = skew.heavy_keys(facts, ["k"], share=0.3)
    assert len(heavy) == 1
    for how in ("inner", "left"):
        got = skew.split_join(facts, sums, ["k"], how, heavy, salts=4)
        assert got.columns == facts.join(sums, ["k"], how).columns and rows_of(got) == rows_of(facts.join(sums, ["k"], how))
    assert rows_of(skew.split_join(facts, sums, ["k"], "left", [])) == rows_of(facts.join(sums, ["k"], "left"))
    assert rows_of(skew.split_join(facts, sums, ["k"], "left", [1, 2, 3])) == rows_of(facts.join(sums, ["k"], "left"))  # wrongly named keys cost nothing but time
    assert skew.heavy_keys(facts.limit(0), ["k"]) == [] and skew.heavy_keys(facts.select(F.lit(None).cast("string").alias("k")), ["k"]) == []
    many = spark.range(20000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), (F.col("id") % 2).alias("l"))
    assert len(skew.heavy_keys(many, ["k"])) == 1 and len(skew.heavy_keys(many, ["k", "l"])) == 2


def test_split_join_deals_a_heavy_key_over_tasks(spark):
    facts = spark.range(0, 40000, 1, 40).select(F.floor(F.col("id") / 100000).alias("k"), F.col("id"))
    sums = facts.groupBy("k").agg(F.max("id").alias("top"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain, split = (df.groupBy(F.spark_partition_id()).count().count() for df in (facts.join(sums, "k"), skew.split_join(facts, sums, ["k"])))
        assert plain == 1 and split > 4
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ordinals(spark):
    rng = random.Random(4)
    rows = [("a", i) for i in range(70000) if i not in (0, 32768, 69998)] + [("a", 5), ("a", 40000)] + [("b", rng.randrange(10**6)) for _ in range(50)] + [(None, 3), ("c", None), ("c", -4), ("b", None)]
    df = spark.createDataFrame(rows, "batch string, n bigint").repartition(5)
    got = {r["batch"]: tuple(r)[1:] for r in ordinals.presence(df, ["batch"], "n").collect()}
    b = [n for k, n in rows if k == "b" and n is not None]
    assert got["a"] == (len([1 for k, _ in rows if k == "a"]), 69997, 2, 69999, 3, 0)
    assert got["b"] == (51, len(set(b)), len(b) - len(set(b)), max(b), max(b) + 1 - len(set(b)), 1)
    assert got[None] == (1, 1, 0, 3, 3, 0) and got["c"] == (2, 0, 0, None, 0, 2)
    missing = ordinals.gaps(df.filter("batch = 'a' or batch is null"), ["batch"], "n")
    assert rows_of(missing) == sorted([("a", 0), ("a", 32768), ("a", 69998), (None, 0), (None, 1), (None, 2)], key=str)
    assert ordinals.gaps(df.limit(0), ["batch"], "n").count() == 0 and ordinals.presence(df.limit(0), ["batch"], "n").count() == 0


@pytest.mark.parametrize("held", ["nothing", "half", "all", "sparse", "none of it"])
def test_insert_absent_by_bitmaps_equals_the_anti_join(spark, held):
    rows = [("x", i, i % 5) for i in range(0, 100000, 3)] + [("y", i, 0) for i in range(10)] + [("y", 4, 1), (None, 7, 0), ("x", None, 1), ("x", None, 2), ("y", -1, 0)]
    incoming = spark.createDataFrame(rows, "batch string, n bigint, other int").repartition(4)
    keep = {"nothing": F.lit(False), "half": F.coalesce(F.col("n") < 50000, F.lit(True)), "all": F.lit(True), "sparse": F.coalesce(F.col("n") % 7 == 0, F.col("other") == 1), "none of it": F.lit(True)}[held]
    target = incoming.filter(keep) if held != "none of it" else incoming.filter("n >= 0").withColumn("batch", F.lit("z"))
    key = F.struct("batch", "n")
    numbered, there = incoming.filter("n >= 0"), target.filter("n >= 0").select(key.alias("_k")).distinct()
    want = numbered.join(there, key == F.col("_k"), "left_anti").unionByName(incoming.filter("n is null or n < 0").join(
        target.filter("n is null or n < 0").select(F.struct("batch", "n", "other").alias("_k")), F.struct("batch", "n", "other") == F.col("_k"), "left_anti"))
    assert rows_of(ordinals.insert_absent(target, incoming, ["batch"], "n")) == rows_of(want)


def test_digests_tell_apart_what_joined_text_does_not(spark):
    a = spark.createDataFrame([("a|", "b", 1), (None, "c", 2), ("x", "", 3)], "p string, q string, n int")
    b = spark.createDataFrame([("a", "|b", 1), ("", "c", 2), ("x", None, 3)], "p string, q string, n int")
    parts = [("even", F.col("n") % 2)]
    ta, tb = digest.tree(a, parts, ["n"]), digest.tree(b, parts, ["n"])
    assert rows_of(digest.differing(ta, tb)) == [(0, ""), (1, "0"), (1, "1")]
    assert rows_of(ta) == rows_of(digest.tree(a.orderBy(F.col("n").desc()).repartition(3), parts, ["n"]))
    from tallyframe.functions.hashing import fingerprint
    assert fingerprint(a).first() != fingerprint(b).first()
    assert rows_of(digest.tree(a.limit(0), parts, ["n"]).select("level", "row_count")) == [(0, 0)]


def test_differences_are_located_in_their_segments(spark):
    left = spark.range(5000).select("id", (F.col("id") % 7).alias("v"), F.lit(None).cast("string").alias("w")).unionByName(spark.createDataFrame([(3, 3, None)], "id bigint, v bigint, w string"))
    right = left.filter("id <> 4100 and id <> 3").withColumn("v", F.when(F.col("id") == 1234, 99).otherwise(F.col("v"))).unionByName(spark.createDataFrame([(3, 3, None), (9000, 1, "new")], "id bigint, v bigint, w string"))
    parts = [("range", F.floor(F.col("id") / 100))]
    got = digest.located(left, right, parts, ["id"])
    assert rows_of(got) == rows_of(left.exceptAll(right).withColumn("side", F.lit("left")).unionByName(right.exceptAll(left).withColumn("side", F.lit("right"))))
    bad = digest.differing(digest.tree(left, parts, ["id"]), digest.tree(right, parts, ["id"]))
    assert {r["path"] for r in bad.filter("level = 1").collect()} == {"0", "12", "41", "90"}


def test_bucketed_join_needs_no_exchange(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = scale.bucketed_join(spark, SMALL_SF)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_file_sizes_follow_measured_rows(spark):
    tx = proxy.transactions(spark, "/root/testdata/sf0.1")
    target = 512 * 1024
    for by in ((), ("status",)):
        path = work_dir(spark, "sized")
        layout.write_sized(tx.coalesce(1) if not by else tx, path, target, by)
        fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        it, sizes = fs.listFiles(spark._jvm.org.apache.hadoop.fs.Path(path), True), []
        while it.hasNext():
            f = it.next()
            if f.getPath().getName().endswith(".parquet"):
                sizes.append(f.getLen())
        assert max(sizes) < 1.3 * target and sorted(sizes)[len(sizes) // 2] > 0.5 * target or len(sizes) <= 3
        assert spark.read.parquet(path).count() == tx.count() and file_bytes(spark, path, ".parquet") == sum(sizes)
    assert layout.bytes_per_row(tx.limit(0)) == 0.0


def test_counts_are_taken_while_writing(spark):
    path = work_dir(spark, "observed")
    seen = layout.write_observed(spark.range(1000).withColumn("odd", F.col("id") % 2), path, {"n": F.count(F.lit(1)), "odd": F.sum("odd"), "top": F.max("id")}, ("odd",))
    assert seen == {"n": 1000, "odd": 500, "top": 999} and spark.read.parquet(path).count() == 1000




def test_fact_reference_check_deals_facts_without_a_version_over_tasks(spark):
    facts = spark.range(0, 40000, 1, 40).select(
        F.col("id").cast("string").alias("transaction_id"), F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("account_id"), F.lit("c").alias("customer_id"),
        F.lit("USD").alias("currency"), F.lit("2024-01-02").cast("timestamp").alias("event_at"), F.when(F.col("id") == 6, "v").alias("customer_version_id"))
    accounts = spark.range(0, 40000, 2).select(F.col("id").cast("string").alias("account_id"), F.lit("c").alias("customer_id"), F.lit("USD").alias("currency"))
    accounts = accounts.unionByName(accounts.filter("account_id = '8'")).unionByName(accounts.filter("account_id = '8'").withColumn("account_id", F.lit(None).cast("string")))
    history = spark.createDataFrame([("v", dt.datetime(2024, 1, 1), None), (None, dt.datetime(2024, 1, 1), None)], "customer_version_id string, valid_from timestamp, valid_to timestamp")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        bad = reconcile.fact_reference_violations(facts, accounts, history)
        tasks = [r["count"] for r in bad.groupBy(F.spark_partition_id()).count().collect()]
        assert len(tasks) == 4 and max(tasks) < 20000
        # all but the bound fact; the fact whose account is there twice comes twice, as in a plain left join
        assert sum(tasks) == 40000 and bad.select("transaction_id").distinct().count() == 39999 and bad.filter("transaction_id = '8'").count() == 2
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
