"""Proxy model: the ledger entities expressed over the TPC-H-style test tables.

transactions   <- orders (id o_orderkey, account/customer o_custkey, event o_orderdate,
                  amount o_totalprice, status F/O/P -> POSTED/PENDING/CANCELLED,
                  direction by key parity, channel by order priority; no channel
                  when the priority is NOT SPECIFIED)
accounts       <- customer (one account per customer; currency by nation; opened at the
                  first order day; CLOSED when the balance is not positive)
customer changes <- non-purchase events (key user_id, effective hour, version event_id,
                  segment event_type, region from the customer's nation)
facts for binding <- purchase events
versioned duplicates <- lineitem by (l_orderkey, l_linenumber)

Every frame reads whole tables; joins to nation/region use domain-sized sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyframe import types as TT


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def currency_of(nationkey: Column) -> Column:
    m = nationkey % 3
    return F.when(m == 0, "RUB").when(m == 1, "USD").when(m == 2, "EUR")


def status_of(orderstatus: Column) -> Column:
    return (F.when(orderstatus == "F", "POSTED").when(orderstatus == "O", "PENDING")
            .when(orderstatus == "P", "CANCELLED"))


def channel_of(priority: Column) -> Column:
    # "4-NOT SPECIFIED" carries no channel: such rows fail validation.
    return (F.when(priority.isin("1-URGENT", "2-HIGH"), "TRANSFER")
            .when(priority == "3-MEDIUM", "CARD")
            .when(priority == "5-LOW", "ATM"))


def direction_of(key: Column) -> Column:
    return F.when(key % 2 == 0, "IN").otherwise("OUT")


def customer_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey"), currency_of(F.col("c_nationkey")).alias("currency"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed facts: transaction_id, account_id, customer_id, event_at, amount, currency,
    status, direction, channel, record_version, source_updated_at."""
    o = table(spark, sf_dir, "orders")
    j = o.join(customer_currency(spark, sf_dir), o["o_custkey"] == F.col("c_custkey"), "left")
    return j.select(
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        F.col("o_custkey").cast("string").alias("account_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderdate").cast("timestamp").alias("event_at"),
        F.col("o_orderdate").cast("timestamp").alias("source_updated_at"),
        F.lit(1).cast("bigint").alias("record_version"),
        F.col("o_totalprice").cast(TT.MONEY).alias("amount"),
        F.col("currency"),
        status_of(F.col("o_orderstatus")).alias("status"),
        direction_of(F.col("o_orderkey")).alias("direction"),
        channel_of(F.col("o_orderpriority")).alias("channel"),
    )


def iso_utc(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def transaction_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records (entity, payload, batch_id, source_record_id) for transactions; one batch per order day."""
    t = transactions(spark, sf_dir)
    fields = F.struct(
        F.col("account_id"), F.col("amount").cast("string").alias("amount"), F.col("channel"), F.col("currency"),
        F.col("direction"), iso_utc(F.col("event_at")).alias("event_at"),
        F.col("record_version").cast("string").alias("record_version"),
        iso_utc(F.col("source_updated_at")).alias("source_updated_at"), F.col("status"),
        F.col("transaction_id"))
    return t.select(
        F.lit("transactions").alias("entity"),
        F.to_json(fields).alias("payload"),
        F.date_format("event_at", "yyyy-MM-dd").alias("batch_id"),
        F.concat(F.lit("transactions:"), F.lpad(F.col("transaction_id"), 12, "0")).alias("source_record_id"),
        F.col("event_at").alias("ingested_at"),
        F.lit(1).alias("schema_version"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account rows (string fields) from customer + first order day."""
    c = table(spark, sf_dir, "customer")
    first = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order"))
    j = c.join(first, c["c_custkey"] == first["o_custkey"], "left")
    return j.select(
        F.col("c_custkey").cast("string").alias("account_id"),
        F.col("c_custkey").cast("string").alias("customer_id"),
        currency_of(F.col("c_nationkey")).alias("currency"),
        F.date_format("first_order", "yyyy-MM-dd").alias("opened_at"),
        F.when(F.col("c_acctbal") > 0, "ACTIVE").otherwise("CLOSED").alias("status"),
        F.lit("1").alias("record_version"),
    )


def customer_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    # nation and region are domain-sized (25 and 5 rows).
    nr = n.join(r, n["n_regionkey"] == r["r_regionkey"]).select("n_nationkey", "r_name")
    return c.join(F.broadcast(nr), c["c_nationkey"] == nr["n_nationkey"]).select(
        F.col("c_custkey"), F.col("r_name").alias("region"))


def customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-purchase events as customer attribute changes.

    customer_id, region, segment, effective_at (hour), change_version (event_id),
    received_at (event time), record_hash.
    """
    e = table(spark, sf_dir, "events").filter(F.col("event_type") != "purchase")
    j = e.join(customer_region(spark, sf_dir), e["user_id"] == F.col("c_custkey"), "left")
    out = j.select(
        F.col("user_id").cast("string").alias("customer_id"),
        F.col("region"),
        F.col("event_type").alias("segment"),
        F.date_trunc("hour", F.col("ts")).cast("timestamp").alias("effective_at"),
        F.col("event_id").alias("change_version"),
        F.col("ts").cast("timestamp").alias("received_at"),
    )
    return out.withColumn("record_hash", F.sha2(F.concat_ws("|", "customer_id", "segment",
                                                            F.col("change_version").cast("string")), 256))


def purchase_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase events as POSTED facts: event_id, customer_id, event_at, amount, currency, status."""
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    j = e.join(customer_currency(spark, sf_dir), e["user_id"] == F.col("c_custkey"), "left")
    return j.select(
        F.col("event_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.col("ts").cast("timestamp").alias("event_at"),
        F.col("value").cast(TT.MONEY).alias("amount"),
        F.coalesce(F.col("currency"), F.lit("RUB")).alias("currency"),
        F.lit("POSTED").alias("status"),
    )


def lineitem_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as versioned records of key (l_orderkey, l_linenumber).

    Version order: ship date (the source update time), then the record hash
    over the canonical JSON of the text fields.
    """
    li = table(spark, sf_dir, "lineitem")
    out = li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_quantity").cast(TT.MONEY).alias("quantity"),
        F.col("l_extendedprice").cast(TT.MONEY).alias("extended_price"),
        F.col("l_discount").cast(TT.MONEY).alias("discount"),
        F.col("l_returnflag").alias("return_flag"), F.col("l_linestatus").alias("line_status"),
        F.col("l_shipdate").cast("timestamp").alias("updated_at"),
    )
    text = F.struct(*[F.col(c).cast("string").alias(c) for c in
                      ("discount", "extended_price", "l_partkey", "l_suppkey", "line_status", "quantity",
                       "return_flag")])
    return out.withColumn("record_hash", F.sha2(F.to_json(text), 256))


def segment_of(event_type: Column) -> Column:
    """Event type as a customer segment; an unknown type keeps its upper-cased name (and fails validation)."""
    return (F.when(event_type == "view", "RETAIL").when(event_type == "click", "PREMIUM")
            .when(event_type == "signup", "BUSINESS").otherwise(F.upper(event_type)))


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three entities as raw JSON records (the raw table of the ledger model).

    customers    <- non-purchase events (change per event; batch = event day)
    accounts     <- customer (batch "accounts-initial")
    transactions <- purchase events (batch = event day)
    """
    e = table(spark, sf_dir, "events")
    cr = customer_region(spark, sf_dir)
    cc = customer_currency(spark, sf_dir)
    ev = e.join(cr, e["user_id"] == cr["c_custkey"], "left").drop("c_custkey").join(
        cc, e["user_id"] == cc["c_custkey"], "left")
    day = F.date_format("ts", "yyyy-MM-dd")
    ts = F.col("ts").cast("timestamp")

    def rid(entity, key):
        return F.concat(F.lit(f"{entity}:"), F.lpad(key.cast("string"), 12, "0"))

    changes = ev.filter(F.col("event_type") != "purchase").select(
        F.lit("customers").alias("entity"),
        F.to_json(F.struct(
            F.col("event_id").cast("string").alias("change_version"),
            F.col("user_id").cast("string").alias("customer_id"),
            iso_utc(F.date_trunc("hour", ts)).alias("effective_at"),
            F.col("region"), segment_of(F.col("event_type")).alias("segment"))).alias("payload"),
        day.alias("batch_id"), rid("customers", F.col("event_id")).alias("source_record_id"),
        ts.alias("ingested_at"))
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    purchases = ev.filter(F.col("event_type") == "purchase").select(
        F.lit("transactions").alias("entity"),
        F.to_json(F.struct(
            F.col("user_id").cast("string").alias("account_id"),
            F.col("value").cast(TT.MONEY).cast("string").alias("amount"),
            F.when(k % 3 == 0, "CARD").when(k % 3 == 1, "TRANSFER").when(k % 3 == 2, "ATM").alias("channel"),
            F.col("currency"), direction_of(F.col("event_id")).alias("direction"),
            iso_utc(ts).alias("event_at"), F.lit("1").alias("record_version"),
            iso_utc(ts).alias("source_updated_at"), F.lit("POSTED").alias("status"),
            F.col("event_id").cast("string").alias("transaction_id"))).alias("payload"),
        day.alias("batch_id"), rid("transactions", F.col("event_id")).alias("source_record_id"),
        ts.alias("ingested_at"))
    a = accounts(spark, sf_dir)
    accs = a.select(
        F.lit("accounts").alias("entity"),
        F.to_json(F.struct(*[F.col(c) for c in TT.payload_fields("accounts")])).alias("payload"),
        F.lit("accounts-initial").alias("batch_id"), rid("accounts", F.col("account_id")).alias("source_record_id"),
        F.to_timestamp(F.col("opened_at")).alias("ingested_at"))
    return changes.unionByName(accs).unionByName(purchases)
