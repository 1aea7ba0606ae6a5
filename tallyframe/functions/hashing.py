"""Hash columns: record hash, version keys and order-insensitive fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyframe.functions.digest import exact_text


def record_hash(*cols: Column | str) -> Column:
    """SHA-256 of the canonical JSON of a struct: keys sorted, NULL fields omitted.

    Pass a single struct column (its fields are re-ordered alphabetically) or
    several named columns.  Hashing raw strings keeps ``"10.0"`` and
    ``"10.00"`` distinct.
    """
    if len(cols) == 1:
        # A struct column: to_json keeps its declared field order, and payloads
        # are parsed with an alphabetical schema (types.payload_schema).
        column = F.col(cols[0]) if isinstance(cols[0], str) else cols[0]
        return F.sha2(F.to_json(column), 256)
    named = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.sha2(F.to_json(F.struct(*named)), 256)


def version_key(key: Column | str, start: Column | str) -> Column:
    """Surrogate key of an SCD2 version: sha256 of ``key|start`` as text."""
    key = F.col(key) if isinstance(key, str) else key
    start = F.col(start) if isinstance(start, str) else start
    return F.sha2(F.concat(key.cast("string"), F.lit("|"), start.cast("string")), 256)


def row_hash60(cols: Sequence[str]) -> Column:
    """First 60 bits of md5 over the row's exact text (length before each value, mark for NULL) as a non-negative bigint."""
    return F.conv(F.substring(F.md5(exact_text(cols)), 1, 15), 16, 10).cast("bigint")


def fingerprint(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Order-insensitive table fingerprint: row count and decimal sum of row hashes.

    Fully distributed (partial aggregation, no ordering, no single-task
    string concatenation); the decimal sum cannot overflow under ANSI.
    """
    cols = list(cols or df.columns)
    return df.select(row_hash60(cols).alias("_h")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.col("_h").cast("decimal(38,0)")).cast("decimal(38,0)").alias("hash_sum"),
    )
