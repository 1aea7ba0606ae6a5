"""Incremental recompute: new records touch keys, touched keys are recomputed, everything else is carried over.

The state is a folder of Parquet tables, each cut into key buckets (``kb=<n>``):

* checked rows of every entity by their own key, and two maps that lead from a key to those that depend on it: customer -> accounts (of any version),
  account -> transactions (of any version);
* the results: history, accounts, transactions, and the rejects by the key that decides them.

``apply`` propagates: changed customers -> their accounts -> their transactions.  Only rows of touched keys are read again, from
the buckets that hold them (partition filters), and only touched buckets are rewritten.  The result equals the full recompute
(``prepare``) whatever the order of arrival: a late customer rescues older accounts and facts, a newer account version of an unknown customer removes the
account and its facts, and a replay changes nothing.

Per application the driver sees bucket numbers only (at most the number of buckets).  Rows are added if their (batch_id, source_record_id) is absent and
results are replaced whole per bucket, so a load that failed half way is simply applied again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tallyframe import types as TT
from tallyframe.operators import temporal, validation
from tallyframe.plans import prepare as P
from tallyframe.session import delete, materialize, path_exists

BUCKET = "kb"
KEYS = {"customers": "customer_id", "accounts": "account_id", "transactions": "transaction_id"}
#: Columns of the results.
RESULTS = {
    "history": "customer_version_id string, customer_id string, region string, segment string, valid_from timestamp, valid_to timestamp, change_version bigint, "
               "received_at timestamp, is_current boolean",
    "accounts": "account_id string, customer_id string, currency string, opened_at date, status string, record_version bigint, received_at timestamp",
    "transactions": "transaction_id string, account_id string, customer_id string, customer_version_id string, event_at timestamp, source_updated_at timestamp, "
                    "received_at timestamp, record_version bigint, amount decimal(18,2), currency string, status string, direction string, channel string, record_hash string, memo string",
    "quarantine": "entity string, payload string, batch_id string, source_record_id string, reason string, ingested_at timestamp",
}
_IDENTITY = ("entity", "batch_id", "source_record_id")


def _same(columns: Sequence[str]) -> Column:
    """A struct of the columns: NULLs in it equal each other."""
    return F.struct(*[F.col(c) for c in columns])


def within(rows: DataFrame, keys: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    """Rows whose key is (``left_anti``: is not) among ``keys``."""
    return rows.join(keys.select(F.col(key).alias("_among")), F.col(key) == F.col("_among"), how)


@dataclass
class State:
    """The tables under ``root``; ``buckets`` is fixed when the state is created (see ``create`` and ``open_state``)."""

    spark: SparkSession
    root: str
    buckets: int
    _touched: dict = field(default_factory=dict, repr=False)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def with_bucket(self, df: DataFrame, key: str) -> DataFrame:
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int"))

    def touched(self, keys: DataFrame, key: str) -> list[int]:
        """Numbers of the buckets that hold ``keys``; looked up once for each frame."""
        if (id(keys), key) not in self._touched:
            numbers = sorted(r[0] for r in self.with_bucket(keys.select(key), key).select(BUCKET).distinct().collect())
            self._touched[id(keys), key] = (keys, numbers)  # the frame is kept, so its id is not given to another
        return self._touched[id(keys), key][1]

    def holds(self, name: str) -> bool:
        return path_exists(self.spark, self.path(name))

    def read(self, name: str, like: StructType, buckets: list[int] | None = None) -> DataFrame:
        """A table without its bucket column; only ``buckets`` are scanned."""
        if not self.holds(name):
            return self.spark.createDataFrame([], like)
        df = self.spark.read.schema(StructType([*like.fields, StructField(BUCKET, IntegerType())])).parquet(self.path(name))
        return (df if buckets is None else df.filter(F.col(BUCKET).isin(buckets))).drop(BUCKET)

    def rows_of(self, name: str, like: StructType, keys: DataFrame, key: str) -> DataFrame:
        """The rows of ``keys``, from the buckets that hold them."""
        return within(self.read(name, like, self.touched(keys, key)), keys, key)

    def add(self, name: str, df: DataFrame, key: str, identity: tuple[str, ...]) -> None:
        """Append the rows whose ``identity`` is not there; looked up in the touched buckets only.  A new table takes them all."""
        if not self.holds(name):
            return self._write(self.with_bucket(df, key), name, "append")
        there = self.read(name, df.schema, self.touched(df, key))
        new = df.join(there.select(_same(identity).alias("_there")), _same(identity) == F.col("_there"), "left_anti")
        self._write(self.with_bucket(new, key), name, "append")

    def replace(self, name: str, df: DataFrame, key: str, keys: DataFrame) -> None:
        """Make ``df`` all the rows of ``keys``; other keys' rows in the touched buckets are carried over.

        A new table has none to carry over and is written at once.
        """
        if not self.holds(name):
            return self._write(self.with_bucket(df, key), name, "overwrite")
        touched = self.touched(keys, key)
        rest = within(self.read(name, df.schema, touched), keys, key, "left_anti")
        merged = materialize(self.with_bucket(rest.unionByName(df), key), name)
        left = {r[0] for r in merged.select(BUCKET).distinct().collect()}
        self._write(merged, name, "overwrite")
        for b in set(touched) - left:  # nothing is left in these
            delete(self.spark, f"{self.path(name)}/{BUCKET}={b}")

    def _write(self, df: DataFrame, name: str, mode: str) -> None:
        # rebalance: small buckets share a task, a large one is split over several files
        (df.hint("rebalance", F.col(BUCKET)).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.path(name)))


def create(spark: SparkSession, root: str, buckets: int = 64) -> State:
    """An empty state; the number of buckets is written beside the tables."""
    spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.parquet(f"{root}/layout")
    return State(spark, root.rstrip("/"), buckets)


def open_state(spark: SparkSession, root: str) -> State:
    return State(spark, root.rstrip("/"), spark.read.schema("buckets int").parquet(f"{root}/layout").first()["buckets"])


def _distinct(df: DataFrame, name: str) -> DataFrame:
    return materialize(df.distinct(), name)


def apply(state: State, raw: DataFrame) -> dict[str, int]:
    """Take in new raw records (as ``prepare`` takes all of them); returns how many keys of each entity were recomputed."""
    checked = {e: materialize(validation.check_entity(raw, e), f"checked-{e}") for e in TT.ENTITIES}
    valid = {e: validation.split(c)[0] for e, c in checked.items()}
    failed = validation.quarantine(*[validation.as_rejects(validation.split(c)[1]) for c in checked.values()])
    rows = {"customers": P.customer_rows(valid["customers"]), "accounts": P.account_rows(valid["accounts"]), "transactions": P.transaction_rows(valid["transactions"])}
    kinds = {e: df.schema for e, df in rows.items()}
    accounts_of = rows["accounts"].select("customer_id", "account_id").distinct()
    transactions_of = rows["transactions"].select("account_id", "transaction_id").distinct()

    # keys whose results may change, before the maps take in the new rows (a new row touches its own key)
    customers = _distinct(rows["customers"].select("customer_id"), "touched-customers")
    accounts = _distinct(rows["accounts"].select("account_id").unionByName(
        state.rows_of("accounts_of", accounts_of.schema, customers, "customer_id").select("account_id")), "touched-accounts")
    facts = _distinct(rows["transactions"].select("transaction_id").unionByName(
        state.rows_of("transactions_of", transactions_of.schema, accounts, "account_id").select("transaction_id")), "touched-transactions")

    for e, key in KEYS.items():
        state.add(f"rows_{e}", rows[e], key, _IDENTITY[1:])
    state.add("accounts_of", accounts_of, "customer_id", ("customer_id", "account_id"))
    state.add("transactions_of", transactions_of, "account_id", ("account_id", "transaction_id"))
    state.add("failed", failed, "source_record_id", _IDENTITY)

    history = materialize(P.resolve_history(state.rows_of("rows_customers", kinds["customers"], customers, "customer_id")), "history")

    def history_of(keys: DataFrame) -> DataFrame:
        """Versions of customers: the new ones of touched customers, those in the state of others."""
        there = within(state.rows_of("history", history.schema, keys, "customer_id"), customers, "customer_id", "left_anti")
        return there.unionByName(within(history, keys, "customer_id"))

    account_versions = state.rows_of("rows_accounts", kinds["accounts"], accounts, "account_id")
    known = _distinct(history_of(_distinct(account_versions.select("customer_id"), "customers-of-accounts")).select("customer_id"), "known")
    new_accounts, orphans = P.resolve_accounts(account_versions, known)
    new_accounts = materialize(new_accounts, "accounts")

    versions = materialize(state.rows_of("rows_transactions", kinds["transactions"], facts, "transaction_id"), "transaction-versions")
    used = _distinct(versions.select("account_id"), "accounts-of-transactions")
    there = within(state.rows_of("accounts", new_accounts.schema, used, "account_id"), accounts, "account_id", "left_anti")
    needed = materialize(there.unionByName(within(new_accounts, used, "account_id")), "accounts-needed")
    versions_needed = materialize(history_of(_distinct(needed.select("customer_id"), "customers-of-transactions")), "history-needed")
    new_facts, failing = P.chosen_transactions(materialize(temporal.bind_to_accounts_and_history(versions, needed, versions_needed), "bound"))

    state.replace("history", history, "customer_id", customers)
    state.replace("accounts", new_accounts, "account_id", accounts)
    state.replace("transactions", new_facts, "transaction_id", facts)
    state.replace("orphans", orphans.select("account_id", *_reject(F.lit("customer_fk"))), "account_id", accounts)
    state.replace("failing", failing.select("transaction_id", *_reject(F.col("fk_reason"))), "transaction_id", facts)
    state._touched.clear()
    return {"customers": customers.count(), "accounts": accounts.count(), "transactions": facts.count()}


def _reject(reason) -> list:
    return [reason.alias("reason") if c == "reason" else F.col(c) for c in TT.QUARANTINE_COLUMNS]


def result(state: State, name: str) -> DataFrame:
    """history, accounts, transactions or quarantine of the state."""
    like = StructType.fromDDL(RESULTS[name])
    if name != "quarantine":
        return state.read(name, like)
    return validation.quarantine(*[state.read(t, like) for t in ("failed", "orphans", "failing")])
