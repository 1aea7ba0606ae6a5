"""Benchmark: headline operators over $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is executed in full through the ``noop`` sink (every row is
produced, nothing is collected) ``BENCH_REPEATS`` times (default 2); the best
time counts.  The two write variants of the join/write benchmark (shuffle
join + flat small files vs checked broadcast + folders by time) run on top and
must give one checksum.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tallyframe.plans import benchmark as BM  # noqa: E402
from tallyframe.plans import workloads as W  # noqa: E402
from tallyframe.session import build_session  # noqa: E402
from tallyframe.sources import proxy  # noqa: E402

HEADLINE = [
    "segment_payments", "dq_reason_codes", "latest_version_wins", "scd2_history", "point_in_time_join",
    "as_of_bind", "fk_classification", "payments_daily", "customer_activity", "historical_turnover",
    "calendar_fill", "merge_upsert", "prepared_transactions", "prepared_quarantine", "join_broadcast",
    "join_shuffle", "one_day_rollup", "reconcile_full_join", "idempotent_append",
]

#: Unit of the folders that the partitioned variant writes: the facts at hand have some 60 rows a day.
FOLDER_UNIT = "month"


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    scratch = tempfile.mkdtemp(prefix="tally-bench-")
    spark = build_session(f"local[{cpus}]", "tallyframe-bench", cpus,
                          {"spark.driver.memory": "16g", "spark.checkpoint.dir": f"{scratch}/checkpoints",
                           "spark.sql.warehouse.dir": f"{scratch}/warehouse"})
    spark.sparkContext.setCheckpointDir(f"{scratch}/checkpoints")
    run(proxy.table(spark, sf_dir, "orders").groupBy("o_orderstatus").count())  # JVM warm-up
    times = {}
    for name in HEADLINE:
        best = None
        for _ in range(repeats):
            began = time.monotonic()
            run(W.REGISTRY[name](spark, sf_dir))
            took = time.monotonic() - began
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)

    tx = proxy.transactions(spark, sf_dir).select("transaction_id", "account_id", "event_at", "amount", "currency",
                                                 "status", "channel")
    acc = proxy.table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("account_id"),
                                                        F.col("c_custkey").cast("string").alias("customer_id"))
    day = tx.agg(F.max(F.to_date("event_at"))).first()[0]
    checks, filtered = set(), {}
    for name, settings in BM.VARIANTS.items():
        spark.conf.set("spark.sql.shuffle.partitions", str(settings["shuffle_partitions"]))
        unit = FOLDER_UNIT if settings["partitioned"] else None
        for i in range(repeats):
            path = f"{scratch}/bench-{name}-{i}"
            began = time.monotonic()
            joined = BM.join_accounts(tx, acc, "broadcast" if settings["broadcast"] else "shuffle").select(
                "transaction_id", "customer_id", "event_at", "amount", "currency", "status", "channel")
            BM.write_variant(joined, path, settings["target_bytes"], unit)
            checks.add(tuple(BM.measures(spark.read.schema(joined.schema).parquet(path)).first()))
            middle = time.monotonic()
            run(BM.day_rows(spark, path, joined.schema, day, unit).groupBy("currency", "channel").agg(F.sum("amount").alias("amount")))
            done = time.monotonic()
            times[f"write_{name}"] = min(times.get(f"write_{name}", 1e9), round(done - began, 3))
            filtered[name] = min(filtered.get(name, 1e9), round(done - middle, 3))
    spark.conf.set("spark.sql.shuffle.partitions", str(cpus))
    if len(checks) != 1:
        raise SystemExit(f"benchmark variants disagree: {checks}")
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf_dir).replace("sf", ""), "cpus": cpus, "repeats": repeats,
                      "filtered_query_seconds": filtered}))
    spark.stop()


if __name__ == "__main__":
    main()
