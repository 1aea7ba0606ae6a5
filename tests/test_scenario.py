"""Nine batches through raw -> validate -> load -> publish; after each, the lake holds what the rules in plain Python say."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyframe.operators.validation import DataQualityError
from tallyframe.plans import journal, publish, runner, tables
from tallyframe.session import work_dir
from tests import ledger, model


def marts(spark, lake):
    return {name: sorted(map(tuple, publish.read_mart(spark, lake.publish, name).collect()), key=str) for name in publish.MART_KEYS}


def published_payments(spark, lake):
    rows = publish.read_mart(spark, lake.publish, "payments").groupBy("payment_date", "currency").agg(F.sum("transaction_count"), F.sum("total_amount")).collect()
    return {(r[0], r[1]): (r[2], r[3]) for r in rows}


def check(spark, lake, names):
    history, accounts, facts, quarantine = model.state(ledger.records(*names))
    h = tables.read_version(spark, lake.history)
    assert model.history_of(h) == history
    assert model.accounts_of(tables.read_version(spark, lake.accounts)) == accounts
    assert model.facts_of(tables.read_version(spark, lake.transactions), h) == facts
    assert model.quarantine_of(tables.read_version(spark, lake.quarantine)) == quarantine
    return facts


def test_nine_batches(spark):
    root = work_dir(spark, "scenario")
    lake = runner.Lake(root)
    batches = {name: ledger.write(spark, f"{root}/sources", name) for name in ledger.BATCHES}
    done = []

    def broken(*_, **__):
        raise RuntimeError("this step fails in the test")

    for name in ledger.BATCHES:
        if name in ledger.REFUSED:
            before = marts(spark, lake)
            with pytest.raises(DataQualityError):
                runner.process(spark, lake, *batches[name])
            assert marts(spark, lake) == before  # nothing is published, but the quarantine shows why
            done.append(name)
            assert model.quarantine_of(tables.read_version(spark, lake.quarantine)) == model.state(ledger.records(*done))[3]
            continue
        if name == "noted":  # records with a memo wait for the column
            with pytest.raises(ValueError, match="Schema v2"):
                runner.process(spark, lake, *batches[name])
            tables.add_column(spark, lake.transactions, "memo", "string")
            with pytest.raises(tables.SchemaError):
                tables.change_type(spark, lake.transactions, "amount", "string")
        if name == "moves":  # a failure at any step leaves the publication, and a second run completes it
            before = marts(spark, lake)
            for module, step in ((publish, "stage"), (publish, "reconcile_run"), (publish, "publish"), (tables, "publish_pointer")):
                with pytest.MonkeyPatch.context() as patch, pytest.raises(RuntimeError, match="fails in the test"):
                    patch.setattr(module, step, broken)
                    runner.process(spark, lake, *batches[name])
                assert marts(spark, lake) == before
        done.append(name)
        runner.process(spark, lake, *batches[name])
        facts = check(spark, lake, done)
        assert published_payments(spark, lake) == model.payments(facts)

    # what the batches are for: a moved day is empty, a rescued fact and a transferred account are bound, ties are decided
    assert (dt.date(2031, 7, 14), "RUB") in model.payments(facts) and facts["tip"][1] == "house" and facts["bread"][3] == Decimal("2.05") and facts["sale"][5].day == 13
    assert facts["gift"][4] == "CANCELLED" and facts["sale"][7] == "re-counted"

    raw, state = spark.read.parquet(lake.raw).count(), marts(spark, lake)
    again = runner.process(spark, lake, *batches["opening"])  # a replay
    assert again["dds"]["changed_count"] == 0 and spark.read.parquet(lake.raw).count() == raw == len(ledger.records(*ledger.BATCHES)) and marts(spark, lake) == state

    assert journal.stage_metrics(spark, lake.journal).filter("error IS NOT NULL").count() >= 6
    assert not journal.check_freshness(spark, lake.journal, 86400, dt.datetime.now() + dt.timedelta(days=2))
    assert journal.check_freshness(spark, lake.journal, 86400, dt.datetime.now())
    assert journal.alerts(spark, lake.journal).filter("kind = 'freshness'").count() == 1


def test_no_journal_is_stale_and_a_broken_one_is_an_error(spark, scratch):
    assert not journal.check_freshness(spark, f"{scratch}/none", 86400)
    spark.createDataFrame([("not parquet",)], "value string").write.text(f"{scratch}/bad/batches")
    with pytest.raises(Exception):  # noqa: B017  (whatever Spark says of a file that is not Parquet)
        journal.check_freshness(spark, f"{scratch}/bad", 86400)
