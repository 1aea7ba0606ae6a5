"""Neighbour values and running aggregates within a key in time order: lag, lead, forward fill, prefix sums, running maxima.

Three physical forms with one result:

* ``window``: ``Window.partitionBy(keys).orderBy(order)``.  One shuffle by key; every row of a key is sorted and scanned by one task.
* ``buckets``: a key's rows are cut into segments by a bucket of the order (``bucket``, such as the month of the time), which the caller names.
  Rows are shuffled once, by (key, bucket); nothing is sampled or written.
* ``range``: rows are range-partitioned on (keys, order) and written once; a segment is one partition.  For callers who can name no bucket.

In the last two a key that holds a third of all rows is cut into many segments (two-level scan): each segment is scanned by itself, a
summary with one row a segment is scanned exclusively over the segments of its key, and what it carries is joined
to the segment.  The segment is one struct column of (keys, segment): NULL keys equal each other in it, and rows
are dealt by it once for the scan, the summary and the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyframe.session import materialize

_PART = "_part"
_ALL_BEFORE = (Window.unboundedPreceding, -1)


def _cut(df: DataFrame, keys: Sequence[str], order: Sequence[str], method: str, bucket: Column | None, partitions: int | None) -> DataFrame:
    """``df`` with its segment: a struct of the keys and ``_seg``, which ascends with the order."""
    if method == "range":
        df = segments(df, keys, order, partitions)
    elif method == "buckets":
        if bucket is None:
            raise ValueError("method 'buckets' needs a bucket of the order")
        df = df.withColumn("_seg", bucket)
    elif method != "segmented":
        raise ValueError(f"unknown method {method}")
    return df.withColumn(_PART, F.struct(*keys, "_seg"))


def _over_segments(summary: DataFrame, keys: Sequence[str]):
    """The window over a key's segments, in order."""
    return Window.partitionBy(F.struct(*[F.col(f"{_PART}.{k}") for k in keys])).orderBy(f"{_PART}._seg")


def _carry(local: DataFrame, summary: DataFrame) -> DataFrame:
    return local.join(summary.withColumnRenamed(_PART, "_of"), F.col(_PART) == F.col("_of"))


def neighbours(df: DataFrame, keys: Sequence[str], order: Sequence[str], lag: dict | None = None,
               lead: dict | None = None, fill: dict | None = None, method: str = "range",
               partitions: int | None = None, bucket: Column | None = None) -> DataFrame:
    """Add ``lag[src]``/``lead[src]``/``fill[src]`` output columns.

    ``lag``: value of the previous row of the key; ``lead``: of the next row;
    ``fill``: last non-NULL value at or before the row.  ``(keys, order)``
    must be unique for a deterministic result.  NULL is a key like any other in every form.
    ``bucket``: non-decreasing in the order, for method "buckets".
    """
    lag, lead, fill = dict(lag or {}), dict(lead or {}), dict(fill or {})
    if method == "window":
        w = Window.partitionBy(*keys).orderBy(*order)
        out = df
        for src, dst in lag.items():
            out = out.withColumn(dst, F.lag(src).over(w))
        for src, dst in lead.items():
            out = out.withColumn(dst, F.lead(src).over(w))
        wf = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        for src, dst in fill.items():
            out = out.withColumn(dst, F.last(src, ignorenulls=True).over(wf))
        return out
    return _segment_neighbours(_cut(df, keys, order, method, bucket, partitions), keys, order, lag, lead, fill).select(
        *(c for c in df.columns if c != "_seg" or method == "segmented"), *lag.values(), *lead.values(), *fill.values())


def segments(df: DataFrame, keys: Sequence[str], order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """``df`` range-partitioned on (keys, order) with the partition as ``_seg``, for ``method="segmented"``.

    Segment ids must stay fixed between passes, so the partitioning is written once to the shared work folder
    (survives executor loss) instead of being re-sampled by each later job.  Several passes may use it, also after a filter.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(df.repartitionByRange(n, *keys, *order).withColumn("_seg", F.spark_partition_id()), "segments")


def _segment_neighbours(seg, keys, order, lag, lead, fill):
    w = Window.partitionBy(_PART).orderBy(*order)
    wf = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = seg
    if lag:
        local = local.withColumn("_first", F.lag(F.lit(True)).over(w).isNull())
    if lead:
        local = local.withColumn("_last", F.lead(F.lit(True)).over(w).isNull())
    for src, dst in lag.items():
        local = local.withColumn(dst, F.lag(src).over(w))
    for src, dst in lead.items():
        local = local.withColumn(dst, F.lead(src).over(w))
    for src, dst in fill.items():
        local = local.withColumn(dst, F.last(src, ignorenulls=True).over(wf))

    ordkey = F.struct(*[F.col(c) for c in order])
    aggs = []
    if lag:
        aggs.append(F.max_by(F.struct(*[F.col(s).alias(s) for s in lag]), ordkey).alias("_seg_last"))
    if lead:
        aggs.append(F.min_by(F.struct(*[F.col(s).alias(s) for s in lead]), ordkey).alias("_seg_first"))
    for i, src in enumerate(fill):
        aggs.append(F.max_by(F.col(src), F.when(F.col(src).isNotNull(), ordkey)).alias(f"_seg_fill{i}"))
    summary = seg.groupBy(_PART).agg(*aggs)
    ws = _over_segments(summary, keys)
    carried = [F.col(_PART)]
    if lag:
        carried.append(F.lag("_seg_last").over(ws).alias("_in_lag"))
    if lead:
        carried.append(F.lead("_seg_first").over(ws).alias("_in_lead"))
    for i, _ in enumerate(fill):
        carried.append(F.last(f"_seg_fill{i}", ignorenulls=True).over(ws.rowsBetween(*_ALL_BEFORE)).alias(f"_in_fill{i}"))
    out = _carry(local, summary.select(*carried))
    for src, dst in lag.items():
        out = out.withColumn(dst, F.when(F.col("_first"), F.col(f"_in_lag.{src}")).otherwise(F.col(dst)))
    for src, dst in lead.items():
        out = out.withColumn(dst, F.when(F.col("_last"), F.col(f"_in_lead.{src}")).otherwise(F.col(dst)))
    for i, (src, dst) in enumerate(fill.items()):
        out = out.withColumn(dst, F.coalesce(F.col(dst), F.col(f"_in_fill{i}")))
    return out


def scan(df: DataFrame, keys: Sequence[str], order: Sequence[str], sums: dict | None = None, maxima: dict | None = None,
         frame: str = "rows", method: str = "range", partitions: int | None = None, bucket: Column | None = None) -> DataFrame:
    """Add running sums (``sums[src]``) and running maxima (``maxima[src]``) within ``keys`` in ``order``.

    frame="rows": the rows up to and with this one; ``order`` should be total.  frame="before": the rows before this one.
    frame="range": all rows whose order is not greater, so rows of equal order get equal values; rows are summed per (key, order) first, so very many
    ties do not meet in one segment.  NULLs are skipped, and nothing but NULLs gives NULL, as in SQL.  Exact for integers and decimals.
    """
    sums, maxima = dict(sums or {}), dict(maxima or {})
    if frame not in ("rows", "before", "range"):
        raise ValueError(f"unknown frame {frame}")
    added = [*sums.values(), *maxima.values()]
    if method == "window":
        w = Window.partitionBy(*keys).orderBy(*order)
        w = (w.rangeBetween(Window.unboundedPreceding, Window.currentRow) if frame == "range"
             else w.rowsBetween(Window.unboundedPreceding, Window.currentRow if frame == "rows" else -1))
        return df.select("*", *[F.sum(s).over(w).alias(d) for s, d in sums.items()], *[F.max(s).over(w).alias(d) for s, d in maxima.items()])
    if frame == "range":
        place = F.struct(*[F.col(c) for c in (*keys, *order)])
        peers = df.groupBy(*keys, *order).agg(*[F.sum(s).alias(d) for s, d in sums.items()], *[F.max(s).alias(d) for s, d in maxima.items()])
        own = {d: f"_run{i}" for i, d in enumerate(added)}
        run = scan(peers, keys, order, {d: own[d] for d in sums.values()}, {d: own[d] for d in maxima.values()}, "rows", method, partitions, bucket)
        run = run.select(place.alias("_at"), *[F.col(c).cast(peers.schema[d].dataType).alias(d) for d, c in own.items()])
        return df.withColumn("_here", place).join(run, F.col("_here") == F.col("_at")).select(*df.columns, *added)
    seg = _cut(df, keys, order, method, bucket, partitions)
    w = Window.partitionBy(_PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow if frame == "rows" else -1)
    local = seg.select("*", *[F.sum(s).over(w).alias(d) for s, d in sums.items()], *[F.max(s).over(w).alias(d) for s, d in maxima.items()])
    totals = seg.groupBy(_PART).agg(*[F.sum(s).alias(f"_s{i}") for i, s in enumerate(sums)], *[F.max(s).alias(f"_m{i}") for i, s in enumerate(maxima)])
    before = _over_segments(totals, keys).rowsBetween(*_ALL_BEFORE)
    totals = totals.select(_PART, *[F.sum(f"_s{i}").over(before).alias(f"_s{i}") for i in range(len(sums))], *[F.max(f"_m{i}").over(before).alias(f"_m{i}") for i in range(len(maxima))])
    out = _carry(local, totals)
    whole = [F.coalesce(F.col(d) + F.col(f"_s{i}"), F.col(d), F.col(f"_s{i}")).cast(local.schema[d].dataType).alias(d) for i, d in enumerate(sums.values())]
    greatest = [F.greatest(F.col(d), F.col(f"_m{i}")).alias(d) for i, d in enumerate(maxima.values())]
    return out.select(*(c for c in df.columns if c != "_seg" or method == "segmented"), *whole, *greatest)


def dense_rank(df: DataFrame, partition: Sequence[str], order: str, out: str, descending: bool = True,
               method: str = "range", partitions: int | None = None) -> DataFrame:
    """``dense_rank() OVER (PARTITION BY partition ORDER BY order [DESC])`` as column ``out``.

    window: the plain window.  range (skew-safe): the distinct values per
    group are range-partitioned on (group, value); each segment numbers its
    values and adds the count of distinct values in the group's earlier
    segments (a window over at most one row per partition).  The ranks are
    joined back on (group, value), NULL-safe.
    """
    by = F.col(order).desc() if descending else F.col(order).asc()
    if method == "window":
        return df.withColumn(out, F.dense_rank().over(Window.partitionBy(*partition).orderBy(by)))
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    values = df.select(*partition, order).distinct()
    seg = materialize(values.repartitionByRange(n, *[F.col(c) for c in partition], by)
                      .withColumn("_seg", F.spark_partition_id()), "rank-segments")
    seg = seg.withColumn(_PART, F.struct(*partition, "_seg"))
    local = seg.withColumn("_local", F.row_number().over(Window.partitionBy(_PART).orderBy(by)))
    counts = seg.groupBy(_PART).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(_PART, F.coalesce(F.sum("_n").over(_over_segments(counts, partition).rowsBetween(*_ALL_BEFORE)), F.lit(0)).alias("_offset"))
    value = F.struct(*[F.col(c) for c in (*partition, order)])
    ranked = _carry(local, offsets).select(value.alias("_of_value"), (F.col("_local") + F.col("_offset")).cast("int").alias(out))
    return df.withColumn("_value", value).join(ranked, F.col("_value") == F.col("_of_value"), "left").drop("_value", "_of_value")
