"""Physical layout of written tables: bucketed tables, files of a wanted size, and counts taken while writing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from tallyframe.session import file_bytes, work_dir

#: Rows written to learn how large a row is; the bound does not grow with the table.
SAMPLE_ROWS = 50_000


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """Write ``df`` as a table of the session catalog, dealt to ``buckets`` by ``key`` and sorted by it, and read it back.

    Two tables bucketed alike are joined, or aggregated, on the key without an exchange.  Rows are dealt to their buckets before the
    write, so each bucket is one file a task and not one file of every task.
    """
    where = path or work_dir(df.sparkSession, name)
    (df.repartition(buckets, key).write.mode("overwrite").option("path", where).bucketBy(buckets, key).sortBy(key).saveAsTable(name))
    return df.sparkSession.table(name)


def bytes_per_row(df: DataFrame, sample_rows: int = SAMPLE_ROWS) -> float:
    """Measured size of a written row: a sample of at most ``sample_rows`` rows is written in the table's format."""
    path = work_dir(df.sparkSession, "sample")
    seen = Observation()
    df.limit(sample_rows).observe(seen, F.count(F.lit(1)).alias("rows")).coalesce(1).write.parquet(path)
    rows = seen.get["rows"]
    return file_bytes(df.sparkSession, path, ".parquet") / rows if rows else 0.0


def write_sized(df: DataFrame, path: str, target_bytes: int, partition_by: Sequence[str] = (), row_bytes: float | None = None) -> float:
    """Write files of about ``target_bytes``; returns the bytes per row that were measured (or given).

    Rows per file follow from the measured row size.  Rows are dealt by their partition values (rebalance: small partitions share a task, a
    large one is split), each task cuts its files at that number of rows.
    """
    size = row_bytes or bytes_per_row(df)
    rows = max(1, int(target_bytes / size)) if size else 0
    dealt = df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df
    writer = dealt.write.mode("overwrite").option("maxRecordsPerFile", rows)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return size


def write_observed(df: DataFrame, path: str, counts: Mapping[str, Column], partition_by: Sequence[str] = (), mode: str = "overwrite") -> dict:
    """Write ``df`` and return ``counts`` (name -> aggregate) taken from the rows as they pass: one scan, no second count."""
    seen = Observation()
    writer = df.observe(seen, *[c.alias(n) for n, c in counts.items()]).write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return {n: seen.get[n] for n in counts}
