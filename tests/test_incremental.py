"""Incremental recompute against the full recompute and against the rules in plain Python."""

import datetime as dt
import random

import pytest

from tallyframe.plans import incremental as I, scale
from tallyframe.plans.prepare import prepare
from tallyframe.session import work_dir
from tests import model
from tests.conftest import SMALL_SF

AT = dt.datetime(2031, 5, 1)


def customer(n, k, segment, hour, version=1, region="north"):
    return ("customers", "b", f"customers:{n:012d}", {"customer_id": k, "region": region, "segment": segment, "effective_at": f"2031-03-01T{hour:02d}:00:00Z", "change_version": str(version)}, AT)


def account(n, a, k, version=1, currency="EUR", opened="2031-03-01"):
    return ("accounts", "b", f"accounts:{n:012d}", {"account_id": a, "customer_id": k, "currency": currency, "opened_at": opened, "status": "ACTIVE", "record_version": str(version)}, AT)


def fact(n, t, a, hour, version=1, currency="EUR", amount="3.10", day="01"):
    return ("transactions", "b", f"transactions:{n:012d}", {
        "transaction_id": t, "account_id": a, "event_at": f"2031-03-{day}T{hour:02d}:30:00Z", "source_updated_at": "2031-04-01T00:00:00Z", "record_version": str(version), "amount": amount,
        "currency": currency, "status": "POSTED", "direction": "IN", "channel": "ATM"}, AT)


def check(state, records):
    history, accounts, facts, quarantine = model.state(records)
    h = I.result(state, "history")
    assert model.history_of(h) == history
    assert model.accounts_of(I.result(state, "accounts")) == accounts
    assert model.facts_of(I.result(state, "transactions"), h) == facts
    assert model.quarantine_of(I.result(state, "quarantine")) == quarantine


def test_rescued_rebound_moved_and_vanished(spark):
    state = I.create(spark, work_dir(spark, "state"), buckets=4)
    loads = [
        # t1 and t2 wait for the customer of p2, t9 breaks a rule
        [customer(0, "k1", "RETAIL", 6), account(0, "p1", "k1"), account(1, "p2", "k2"), fact(0, "t0", "p1", 8), fact(1, "t1", "p2", 8), fact(2, "t2", "p2", 3), fact(3, "t9", "p1", 9, amount="-1")],
        # a late customer rescues t1, and t2 still lies before its first version
        [customer(1, "k2", "PREMIUM", 5)],
        # an earlier version of k1 between the first and t0 rebinds it; a version before t2 rescues it
        [customer(2, "k1", "BUSINESS", 7), customer(3, "k2", "RETAIL", 2)],
        # p1 goes to an unknown customer: account and facts vanish; t1 moves to an account that is not touched otherwise
        [account(2, "p1", "k9", version=2), account(3, "p3", "k2", currency="USD"), fact(4, "t1", "p3", 9, version=2, currency="USD")],
        # and comes back with k9
        [customer(4, "k9", "RETAIL", 1)],
    ]
    so_far = []
    for load in loads:
        touched = I.apply(state, model.raw_frame(spark, load))
        so_far += load
        check(state, so_far)
        assert all(n >= 0 for n in touched.values())
    before = model.quarantine_of(I.result(state, "quarantine"))
    I.apply(I.open_state(spark, state.root), model.raw_frame(spark, loads[3] + loads[0]))  # a replay changes nothing
    check(state, so_far)
    assert model.quarantine_of(I.result(state, "quarantine")) == before


@pytest.mark.parametrize("seed", [1])
def test_random_loads_equal_the_full_recompute(spark, seed):
    rng = random.Random(seed)
    records = []
    for n in range(40):
        records.append(customer(n, f"k{rng.randrange(8)}", rng.choice(["RETAIL", "PREMIUM", "BUSINESS", "GOLD"]), rng.randrange(24), rng.randrange(1, 4)))
    for n in range(30):
        records.append(account(n, f"p{rng.randrange(10)}", f"k{rng.randrange(10)}", rng.randrange(1, 4), rng.choice(["EUR", "USD", "RUB"]), rng.choice(["2031-03-01", "2031-03-02"])))
    for n in range(90):
        # a third of the facts are on one account
        a = "p0" if rng.random() < 0.33 else f"p{rng.randrange(12)}"
        records.append(fact(n, f"t{rng.randrange(60)}", a, rng.randrange(24), rng.randrange(1, 4), rng.choice(["EUR", "EUR", "USD"]), rng.choice(["1.00", "2.50", "0"]), rng.choice(["01", "02"])))
    rng.shuffle(records)
    state = I.create(spark, work_dir(spark, "state"), buckets=3)
    cut = sorted(rng.sample(range(1, len(records)), 2))
    for a, b in zip([0, *cut], [*cut, len(records)]):
        I.apply(state, model.raw_frame(spark, records[a:b]))
    check(state, records)
    full = prepare(model.raw_frame(spark, records), persist=False)
    cols = sorted(c for c in full.transactions.columns)
    assert sorted(map(tuple, full.transactions.select(cols).collect()), key=str) == sorted(map(tuple, I.result(state, "transactions").select(cols).collect()), key=str)


def test_untouched_buckets_are_neither_read_nor_written(spark):
    state = I.create(spark, work_dir(spark, "state"), buckets=8)
    I.apply(state, model.raw_frame(spark, [customer(n, f"k{n}", "RETAIL", 1) for n in range(40)]))
    key = spark.createDataFrame([("k3",)], "customer_id string")
    read = state.rows_of("rows_customers", spark.read.parquet(state.path("rows_customers")).drop(I.BUCKET).schema, key, "customer_id")
    assert "PartitionFilters: [" in (plan := read._jdf.queryExecution().toString()) and I.BUCKET in plan.split("PartitionFilters: [")[1].split("]")[0]
    files = lambda: {f for f in spark.read.parquet(state.path("history")).inputFiles()}
    bucket = lambda f: f.split(f"{I.BUCKET}=")[1].split("/")[0]
    before = files()
    I.apply(state, model.raw_frame(spark, [customer(99, "k3", "PREMIUM", 5)]))
    changed = {bucket(f) for f in before ^ files()}
    assert len(changed) == 1 and changed == {str(state.touched(key, "customer_id")[0])}


def test_empty_load_and_empty_state(spark):
    state = I.create(spark, work_dir(spark, "state"), buckets=2)
    assert I.apply(state, model.raw_frame(spark, [])) == {"customers": 0, "accounts": 0, "transactions": 0}
    I.apply(state, model.raw_frame(spark, [account(0, "p", "nobody")]))
    assert model.quarantine_of(I.result(state, "quarantine")) == [("accounts", "accounts:000000000000", "customer_fk")]


def test_first_load_binds_once_and_writes_results_once(spark, monkeypatch):
    records = [customer(0, "k1", "RETAIL", 6), account(0, "p1", "k1"), account(1, "p2", "k2"), fact(0, "t0", "p1", 8), fact(1, "t1", "p2", 8)]
    made, write = [], I.materialize
    monkeypatch.setattr(I, "materialize", lambda df, name: made.append(name) or write(df, name))
    state = I.create(spark, work_dir(spark, "state"), buckets=4)
    I.apply(state, model.raw_frame(spark, records))
    assert made.count("bound") == 1 and not {"transactions", "failing", "orphans"} & set(made) and made.count("history") == made.count("accounts") == 1
    check(state, records)
    I.apply(state, model.raw_frame(spark, records))
    assert {"transactions", "failing", "orphans"} <= set(made)
    check(state, records)


def test_loads_read_records_that_were_derived_once(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(I, "apply", lambda state, raw: taken.append(raw))
    scale._incremental(spark, SMALL_SF)
    assert len(taken) == 2
    for raw in taken:
        assert all("/raw-" in f for f in raw.inputFiles())
