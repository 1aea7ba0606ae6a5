"""Many batches as one job: equal to loading them day by day, in any order; faulty batches are named."""

import pytest

from tallyframe.operators.validation import DataQualityError
from tallyframe.plans import runner, tables
from tallyframe.session import work_dir
from tallyframe.sources import batch as B
from tallyframe.sources import batches as BS
from tests import ledger, model


def check(spark, lake, names):
    history, accounts, facts, quarantine = model.state(ledger.records(*names))
    h = tables.read_version(spark, lake.history)
    assert model.history_of(h) == history and model.accounts_of(tables.read_version(spark, lake.accounts)) == accounts
    assert model.facts_of(tables.read_version(spark, lake.transactions), h) == facts
    assert model.quarantine_of(tables.read_version(spark, lake.quarantine)) == quarantine


def test_backfill_in_any_order_equals_the_rules(spark):
    root = work_dir(spark, "backfill")
    names = [n for n in ledger.BATCHES if n not in ledger.REFUSED and n != "noted"]
    folders = {n: ledger.write(spark, f"{root}/sources", n)[0] for n in ledger.BATCHES}
    lake = runner.Lake(f"{root}/lake")
    runner.backfill(spark, lake, [folders[n] for n in reversed(names)])
    check(spark, lake, names)
    runner.backfill(spark, lake, [folders[n] for n in names[:3]])  # a replay adds nothing
    check(spark, lake, names)
    assert spark.read.parquet(lake.raw).count() == len(ledger.records(*names))
    with pytest.raises(ValueError, match="Schema v2"):
        runner.backfill(spark, lake, [folders["noted"]])
    with pytest.raises(DataQualityError):
        runner.backfill(spark, lake, [folders["faulty"], folders["moves"]])
    with pytest.raises(ValueError):
        runner.backfill(spark, lake, [])


def test_one_job_set_whatever_the_number_of_batches(spark):
    root = work_dir(spark, "many")
    folders = [ledger.write(spark, root, n)[0] for n in ("opening", "moves", "ties", "past")]
    jobs = []
    for some in (folders[:1], folders):
        spark.sparkContext.setJobGroup(f"check-{len(some)}", "")
        assert BS.check_batches(spark, some).count() == 0 and BS.read_batches(spark, some).count() > 0
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"check-{len(some)}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1]


def test_identity_as_a_column_equals_that_of_the_writer(spark):
    root = work_dir(spark, "identity")
    told = [ledger.write(spark, root, n) for n in ("opening", "noted")]
    rows = BS.read_manifests(spark, [f for f, _ in told]).select("batch_id", BS.identity().alias("given")).collect()
    assert sorted(r["given"] for r in rows) == sorted(r["batch_id"] for r in rows) == sorted(m["batch_id"] for _, m in told)


def test_every_rule_of_a_batch(spark):
    root = work_dir(spark, "rules")
    rows = spark.createDataFrame([(k, f"t{k}") for k in range(5)], "ordinal bigint, transaction_id string")
    folder, manifest = B.write_batch(spark, root, "2031-01-01", {"transactions": rows}, "rules")
    assert BS.check_batches(spark, [folder]).count() == 0
    path = f"{folder}/{manifest['files'][0]['name']}".replace("file:", "")
    lines = open(path).read().splitlines()

    def rules(text=None, told=manifest, also=()):
        with open(path, "w") as f:
            f.write("".join(x + "\n" for x in (lines if text is None else text)))
        for name in also:
            with open(path.rsplit("/", 1)[0] + "/" + name, "w") as f:
                f.write(lines[0] + "\n")
        spark.createDataFrame([told], BS.TT.MANIFEST_SCHEMA).coalesce(1).write.mode("overwrite").json(f"{folder}/manifest")
        return sorted({(r["rule"], r["detail"]) for r in BS.check_batches(spark, [folder]).collect()}, key=str)

    files = manifest["files"]
    changed = lambda **kw: (lambda m: dict(m, batch_id=B.batch_identity(m)))(dict(manifest, **kw))
    assert rules() == []
    assert rules(lines[::-1]) == [("checksum", None), ("order", None)]
    assert ("ordinal", None) in rules(lines[:2] + lines[3:]) and ("count", None) in rules(lines[:2] + lines[3:])
    assert ("ordinal", None) in rules([*lines, lines[-1]])
    assert ("record_id", None) in rules([*lines, "{}"]) and ("record_id", None) in rules([*lines[:-1], lines[-1].replace("transactions:", "accounts:")])
    assert ("unapproved_fields", None) in rules([*lines[:-1], lines[-1][:-1] + ',"odd":1}']) and ("record_id", None) in rules([*lines, "not json"])
    assert rules(told=dict(manifest, batch_id="2031-01-01-" + "0" * 20)) == [("manifest", "identity")]
    assert rules(told=dict(manifest, batch_id="odd")) == [("manifest", "batch_id")]
    assert rules(told=changed(processing_date="2031-02-30")) == [("manifest", "processing_date")]
    assert rules(told=changed(schema_version=3)) == [("manifest", "schema_version")]
    assert ("manifest", "unsafe_name") in rules(told=changed(files=[dict(files[0], name="../x")])) and ("manifest", "unsafe_name") in rules(told=changed(files=files * 2))
    assert rules(told=changed(files=[])) == [("manifest", "empty"), ("unlisted_file", None)]
    assert ("missing_file", None) in rules(told=changed(files=[*files, dict(files[0], name="transactions/shard=00003/part-x.txt")]))
    assert ("unlisted_file", None) in rules(also=["part-more.txt"])


def test_backfill_range_rules():
    assert runner.backfill_range("2025-02-01", "2025-02-03") == ["2025-02-01", "2025-02-02", "2025-02-03"]
    with pytest.raises(ValueError):
        runner.backfill_range("2025-02-03", "2025-02-01")
