"""Full recompute from raw: history, accounts, transactions and quarantine (one job graph).

Ordering rules kept from the source contract:
* accounts: winner first, then the known-customer filter (an orphan newest
  version removes the account); every valid orphan version is quarantined;
* transactions: referential checks first, then the winner (a newer version
  that fails a check does not replace an older good one);
* field rejects and referential rejects are disjoint (checks run on valid rows);
* the quarantine is recomputed over all raw rows each time (a late customer
  can rescue older rows).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from tallyframe import types as TT
from tallyframe.operators import scd2, temporal, validation, versions
from tallyframe.session import materialize


@dataclass
class Prepared:
    history: DataFrame
    accounts: DataFrame
    transactions: DataFrame
    quarantine: DataFrame
    checked: DataFrame
    parts: list

    def release(self) -> None:
        for df in self.parts:
            df.unpersist()


def _p(name: str):
    return F.col(f"p.{name}")


def customer_rows(valid: DataFrame) -> DataFrame:
    """Typed attribute changes of checked customer records."""
    return valid.select(
        _p("customer_id").alias("customer_id"), _p("region").alias("region"), _p("segment").alias("segment"),
        _p("effective_at").try_cast("timestamp").alias("effective_at"),
        _p("change_version").try_cast("bigint").alias("change_version"),
        F.col("ingested_at").alias("received_at"), "record_hash", "batch_id", "source_record_id")


def account_rows(valid: DataFrame) -> DataFrame:
    """Typed versions of checked account records, with what a reject keeps."""
    return valid.select(
        _p("account_id").alias("account_id"), _p("customer_id").alias("customer_id"),
        _p("currency").alias("currency"), _p("opened_at").try_cast("date").alias("opened_at"),
        _p("status").alias("status"), _p("record_version").try_cast("bigint").alias("record_version"),
        F.col("ingested_at").alias("received_at"), "record_hash", "entity", "payload", "batch_id", "source_record_id", "ingested_at")


def transaction_rows(valid: DataFrame) -> DataFrame:
    """Typed versions of checked transaction records, with what a reject keeps."""
    return valid.select(
        "entity", "payload", "batch_id", "source_record_id", "ingested_at", "record_hash",
        _p("transaction_id").alias("transaction_id"), _p("account_id").alias("account_id"),
        _p("currency").alias("currency"), _p("event_at").try_cast("timestamp").alias("event_at"),
        _p("source_updated_at").try_cast("timestamp").alias("source_updated_at"),
        _p("record_version").try_cast("bigint").alias("record_version"),
        _p("amount").try_cast(TT.MONEY).alias("amount"), _p("status").alias("status"),
        _p("direction").alias("direction"), _p("channel").alias("channel"), _p("memo").alias("memo"))


def resolve_history(rows: DataFrame, method: str = "buckets") -> DataFrame:
    return scd2.history(rows, "customer_id", "effective_at", ["change_version", "record_hash"], ["region", "segment"], method=method)


def resolve_accounts(rows: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accounts, orphan rows): the winner of each account if its customer is known; every version with an unknown one is an orphan."""
    winners = versions.latest_wins(rows.select(*TT.ACCOUNT_COLUMNS, "record_hash"), ["account_id"], ["record_version", "record_hash"])
    return winners.join(known, "customer_id", "left_semi").select(*TT.ACCOUNT_COLUMNS), rows.join(known, "customer_id", "left_anti")


def resolve_transactions(rows: DataFrame, accounts: DataFrame, history: DataFrame, form: str = "asof",
                         method: str = "buckets") -> tuple[DataFrame, DataFrame]:
    """(facts, failing rows with ``fk_reason``): rows are checked first, the winner is chosen among those that pass."""
    return chosen_transactions(temporal.bind_to_accounts_and_history(rows, accounts, history, form=form, method=method))


def chosen_transactions(bound: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(facts, failing rows) of rows with their ``fk_reason``; ``bound`` is read by both."""
    good = bound.filter(F.col("fk_reason") == "").withColumn("received_at", F.col("ingested_at"))
    cols = [*TT.TRANSACTION_COLUMNS, "memo"]
    latest = versions.latest_wins(good.select(*cols), ["transaction_id"], ["record_version", "source_updated_at", "record_hash"])
    return latest.select(*cols), bound.filter(F.col("fk_reason") != "")


def prepare(raw: DataFrame, form: str = "asof", method: str = "buckets", persist: bool = True) -> Prepared:
    """``raw``: entity, payload, batch_id, source_record_id, ingested_at (all batches).

    The per-entity checked frames are persisted when ``persist`` (each is
    read by a valid and a rejected branch; lost blocks are recomputed).
    """
    # One checked frame per entity (their parsed structs differ); each is
    # read by the valid and the rejected branch, so it is persisted.
    parts = {e: validation.check_entity(raw, e) for e in TT.ENTITIES}
    if persist:
        parts = {e: df.persist(StorageLevel.MEMORY_AND_DISK) for e, df in parts.items()}
    halves = {e: validation.split(df) for e, df in parts.items()}
    rejects = [validation.as_rejects(halves[e][1]) for e in TT.ENTITIES]
    checked = None
    for e in TT.ENTITIES:
        slim = parts[e].select("entity", "batch_id", "source_record_id", "reason")
        checked = slim if checked is None else checked.unionByName(slim)

    # history is dimension-sized and read by four later plans (known keys,
    # accounts filter, orphan check, binding): it is written once to the
    # shared work folder (lineage cut, computed once, survives executor loss).
    history = materialize(resolve_history(customer_rows(halves["customers"][0]), method), "history")
    known = history.select("customer_id").distinct()
    accounts, orphans = resolve_accounts(account_rows(halves["accounts"][0]), known)
    rejects.append(validation.as_rejects(orphans, F.lit("customer_fk")))
    facts, failing = resolve_transactions(transaction_rows(halves["transactions"][0]), accounts, history, form, method)
    rejects.append(validation.as_rejects(failing, "fk_reason"))
    return Prepared(history=history, accounts=accounts, transactions=facts,
                    quarantine=validation.quarantine(*rejects), checked=checked, parts=list(parts.values()))
