"""Every registered query against its DuckDB oracle (row count, columns, value multiset)."""

import pytest

import __spark_entry__ as E
from tests.conftest import SMALL_SF
from tests.oracle import compare, duck

QUERIES = E.queries()
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SMALL_SF)


def test_every_query_has_an_oracle_or_is_rows_only():
    rows_only = {n for n in set(QUERIES) - set(ORACLES) if n != "pipeline" and not n.startswith("op")}
    assert rows_only <= {"file_metadata", "manifest_integrity"}
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    info = compare(spark, name, QUERIES[name], ORACLES[name], SMALL_SF, con)
    assert info["ok"], info


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["payment_date", "currency", "segment", "transaction_count", "total_amount"]


def test_rows_only_queries(spark):
    meta = QUERIES["file_metadata"](spark, SMALL_SF).first()
    assert meta["file_count"] >= 14 and meta["total_bytes"] > 0
    assert QUERIES["manifest_integrity"](spark, SMALL_SF).count() == 0
