"""The sieve never loses a row, and drops most strangers."""

from pyspark.sql import functions as F

from tallyframe.llm.sieve import sieve


def test_sieve(spark):
    rows = spark.range(20000).select(F.col("id").alias("key"), F.lit("x").alias("_x"))
    keys = spark.range(0, 20000, 7).select(F.col("id").alias("k"))
    out = {r["key"] for r in sieve(rows, "key", keys, "k").collect()}
    wanted = set(range(0, 20000, 7))
    assert wanted <= out and len(out) < len(wanted) + 50
    assert sieve(rows, "key", keys.limit(0), "k").count() == 0 and sieve(rows.limit(0), "key", keys, "k").count() == 0
