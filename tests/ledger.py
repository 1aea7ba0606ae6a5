"""A small ledger of nine batches, written out as short calls; what must come of it is worked out by ``tests.model``.

Keys say what happens to them: ``m`` accounts are of merchants, ``h`` of households, ``x`` refer to nothing.
"""

import datetime as dt

from pyspark.sql import functions as F

from tallyframe.sources import proxy
from tallyframe.sources.batch import write_batch

DAY = dt.date(2031, 7, 14)


def change(customer, segment, at, version, region="coast"):
    return {"customer_id": customer, "region": region, "segment": segment, "effective_at": f"2031-07-{at}:00:00Z", "change_version": str(version)}


def account(key, customer, currency, opened="2031-07-10", version=1, status="ACTIVE"):
    return {"account_id": key, "customer_id": customer, "currency": currency, "opened_at": opened, "status": status, "record_version": str(version)}


def entry(key, of, at, amount, currency="EUR", version=1, status="POSTED", direction="IN", channel="TRANSFER", seen="2031-07-20T00:00:00Z", **more):
    return {"transaction_id": key, "account_id": of, "event_at": f"2031-07-{at}:15:00Z", "source_updated_at": seen, "record_version": str(version), "amount": amount, "currency": currency,
            "status": status, "direction": direction, "channel": channel, **more}


#: name -> (records of each entity, schema version); one batch a day from DAY on.
BATCHES = {
    "opening": ({"customers": [change("merchant", "BUSINESS", "10T00", 2), change("house", "RETAIL", "11T00", 1)],
                 "accounts": [account("m-eur", "merchant", "EUR"), account("m-usd", "merchant", "USD"), account("h-eur", "house", "EUR", "2031-07-12"), account("x-acc", "stranger", "RUB")],
                 "transactions": [entry("sale", "m-eur", "14T09", "812.40"), entry("refund", "m-eur", "14T10", "12.00", direction="OUT"), entry("tip", "m-usd", "14T11", "3.33", "USD"),
                                  entry("rent", "h-eur", "13T08", "640.00"), entry("tip", "m-usd", "14T11", "3.33", "USD"), entry("hold", "h-eur", "14T12", "5.05", status="PENDING"),
                                  *[entry(f"coffee-{n}", "h-eur", f"14T{n:02d}", f"2.{n % 10}0", channel="CARD") for n in range(10, 20)]]}, 1),
    # sale moves back a day and shrinks; hold is posted and moves two days on
    "moves": ({"transactions": [entry("sale", "m-eur", "13T09", "800.40", version=2), entry("hold", "h-eur", "16T12", "5.05", version=2, seen="2031-07-21T00:00:00Z"),
                                entry("bread", "h-eur", "15T07", "1.95")]}, 1),
    # the same version twice: the later source time wins, then the greater hash
    "ties": ({"transactions": [entry("bread", "h-eur", "15T07", "2.05", seen="2031-07-22T00:00:00Z"), entry("bread", "h-eur", "15T07", "2.15", seen="2031-07-21T00:00:00Z"),
                               entry("refund", "m-eur", "14T10", "11.00", direction="OUT"), entry("refund", "m-eur", "14T10", "10.00", direction="OUT")]}, 1),
    # a change between others, one that changes nothing, one that an equal instant of a later version hides, and a first one of a stranger
    "past": ({"customers": [change("house", "PREMIUM", "13T12", 1), change("house", "RETAIL", "12T00", 5), change("merchant", "RETAIL", "10T00", 1), change("stranger", "PREMIUM", "09T00", 1)]}, 1),
    "rescued": ({"transactions": [entry("rouble", "x-acc", "14T13", "77.00", "RUB"), *[entry(f"fare-{n}", "m-usd", "17T05", f"{n}.10", "USD") for n in range(1, 10)]]}, 1),
    # m-usd goes over to the household, and closes
    "transfer": ({"accounts": [account("m-usd", "house", "USD", version=2, status="CLOSED")]}, 1),
    "faulty": ({"transactions": [entry("broken", "m-eur", "18T01", "0.00"), entry("", "m-eur", "18T01", "1.00"), entry("early", "h-eur", "11T23", "1.00"), entry("coin", "m-eur", "18T01", "1.00", "USD")]}, 1),
    "noted": ({"transactions": [entry("gift", "h-eur", "19T18", "40.00", memo="for two"), entry("sale", "m-eur", "13T09", "801.00", version=3, memo="re-counted")]}, 2),
    "undone": ({"transactions": [entry("gift", "h-eur", "19T18", "40.00", version=2, status="CANCELLED")]}, 1),
}
#: Batches of which more than a tenth is rejected.
REFUSED = {"faulty"}


def frame(spark, rows):
    """Records with ordinals; a field that no record has is left out."""
    names = sorted({n for r in rows for n in r})
    return spark.createDataFrame([(k, *[r.get(n) for n in names]) for k, r in enumerate(rows)], "ordinal bigint, " + ", ".join(f"{n} string" for n in names))


def write(spark, root, name):
    """(folder, manifest) of a batch."""
    entities, version = BATCHES[name]
    on = DAY + dt.timedelta(days=list(BATCHES).index(name))
    return write_batch(spark, root, on.isoformat(), {e: frame(spark, rows) for e, rows in entities.items()}, name, version)


def records(*names):
    """The batches' records as ``tests.model`` takes them."""
    return [(e, name, f"{e}:{k:012d}", fields, None) for name in names for e, rows in BATCHES[name][0].items() for k, fields in enumerate(rows)]


def derived(spark, root, on, sf, modulus=1, remainder=0, **changes):
    """(folder, manifest) of a batch taken from the given tables: customers by key, their accounts and orders; ``changes`` replace columns of the orders."""
    c = proxy.table(spark, sf, "customer").filter(F.col("c_custkey") % modulus == remainder)
    key = F.col("c_custkey").cast("string")
    first = F.lit("1990-01-01")
    customers = c.select((F.col("c_custkey") - remainder).alias("k"), key.alias("customer_id"), F.lit("sea").alias("region"), F.lit("RETAIL").alias("segment"),
                         F.concat(first, F.lit("T00:00:00Z")).alias("effective_at"), F.lit("1").alias("change_version"))
    accounts = c.select((F.col("c_custkey") - remainder).alias("k"), key.alias("account_id"), key.alias("customer_id"), proxy.currency_of(F.col("c_nationkey")).alias("currency"), first.alias("opened_at"),
                        F.lit("ACTIVE").alias("status"), F.lit("1").alias("record_version"))
    t = proxy.transactions(spark, sf).filter(F.col("account_id").cast("bigint") % modulus == remainder)
    orders = t.select(F.col("transaction_id").cast("bigint").alias("k"), "transaction_id", "account_id", F.col("amount").cast("string").alias("amount"), F.coalesce("channel", F.lit("ATM")).alias("channel"),
                      "currency", "direction", proxy.iso_utc(F.col("event_at")).alias("event_at"), F.lit("1").alias("record_version"), proxy.iso_utc(F.col("source_updated_at")).alias("source_updated_at"), "status")
    orders = orders.withColumns({n: F.lit(v) for n, v in changes.items()})

    def numbered(df):
        return spark.createDataFrame([(k, *list(r)[1:]) for k, r in enumerate(df.orderBy("k").collect())], "ordinal bigint, " + ", ".join(f"{n} string" for n in df.columns[1:]))

    return write_batch(spark, root, on, {"customers": numbered(customers), "accounts": numbered(accounts), "transactions": numbered(orders)}, "derived")
