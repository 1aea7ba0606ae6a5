"""Versioned Parquet tables: every change writes a new version; readers pin a version.

Layout under a table folder (any Hadoop-compatible path):

    <table>/data/<n>/           Parquet files written by version n (optionally partitioned)
    <table>/_log/<n>/           one JSON row: version, data path, schema DDL, partition column,
                                rows, operation, parts

A version is committed when its log row exists.  The log row is written
with ``mode("errorifexists")`` so two writers cannot claim one version
(optimistic concurrency).  ``parts`` lists the data folders a version
reads and which partition values each contributes (``include``) or no
longer contributes (``exclude``): an upsert on a partitioned table
rewrites only the partitions it touches and inherits the rest without
copying them.  A version may also reuse an older folder with a wider schema
(metadata-only column addition).  Data folders are never overwritten, so a
reader pinned to a version always sees the same rows.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallyframe.functions.hashing import fingerprint
from tallyframe.session import materialize, path_exists

LOG_SCHEMA = ("version BIGINT, data STRING, schema STRING, partition_by STRING, row_count BIGINT, operation STRING, "
              "created_at STRING, parts STRING")


class SchemaError(ValueError):
    pass


def _log(spark: SparkSession, table: str) -> DataFrame | None:
    if not path_exists(spark, f"{table}/_log/*"):
        return None
    return spark.read.schema(LOG_SCHEMA).json(f"{table}/_log/*")


def versions(spark: SparkSession, table: str) -> DataFrame:
    log = _log(spark, table)
    if log is None:
        return spark.createDataFrame([], LOG_SCHEMA)
    return log


def latest_version(spark: SparkSession, table: str) -> int | None:
    log = _log(spark, table)
    if log is None:
        return None
    row = log.agg(F.max("version").alias("v")).first()
    return None if row["v"] is None else int(row["v"])


def _entry(spark: SparkSession, table: str, version: int | None) -> dict:
    v = latest_version(spark, table) if version is None else version
    if v is None:
        raise FileNotFoundError(f"no committed version of {table}")
    row = versions(spark, table).filter(F.col("version") == v).first()
    if row is None:
        raise FileNotFoundError(f"{table} has no version {v}")
    return row.asDict()


def _parts(e: dict) -> list[dict]:
    return json.loads(e["parts"]) if e.get("parts") else [{"path": e["data"], "include": None, "exclude": []}]


def read_version(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """Read a committed version (default: latest).  Time travel = pass an older id.

    Each part is a partition-pruned scan of one data folder (the filter is on
    the partition column only, so Spark lists and reads just those values).
    """
    e = _entry(spark, table, version)
    pcol = (e["partition_by"] or "").split(",")[0]
    out = None
    for part in _parts(e):
        df = spark.read.schema(e["schema"]).option("basePath", part["path"]).parquet(part["path"])
        if part.get("include") is not None:
            df = df.filter(_one_of(pcol, part["include"]))
        if part.get("exclude"):
            df = df.filter(~_one_of(pcol, part["exclude"]))
        out = df if out is None else out.unionByName(df)
    return out


def _one_of(column: str, values: list) -> Column:
    """Whether the column's text is one of ``values``; None stands for NULL (never NULL itself)."""
    text = F.col(column).cast("string")
    named = [v for v in values if v is not None]
    found = F.coalesce(text.isin(named), F.lit(False)) if named else F.lit(False)
    return found | text.isNull() if None in values else found


def _commit(spark: SparkSession, table: str, version: int, data: str, schema: T.StructType,
            partition_by: Sequence[str], rows: int, operation: str, parts: list[dict] | None = None) -> int:
    row = [(version, data, _ddl(schema), ",".join(partition_by), rows, operation,
            dt.datetime.now(dt.timezone.utc).isoformat(), json.dumps(parts) if parts else None)]
    spark.createDataFrame(row, LOG_SCHEMA).coalesce(1).write.mode("errorifexists").json(
        f"{table}/_log/{version:09d}")
    return version


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def write_version(df: DataFrame, table: str, partition_by: Sequence[str] = (), operation: str = "write",
                  rebalance: bool = False) -> int:
    """Write ``df`` as the next version and commit it; returns the version id.

    ``rebalance`` evens out the files: rows are dealt by partition value, small values share a task, and a value
    too large for one task is split over several (Spark's rebalance hint).
    """
    spark = df.sparkSession
    current = latest_version(spark, table)
    version = 0 if current is None else current + 1
    data = f"{table}/data/{version:09d}"
    out = df
    if rebalance:
        out = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = out.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(data)
    rows = spark.read.parquet(data).count()
    return _commit(spark, table, version, data, df.schema, partition_by, rows, operation)


def check_compatible(old: T.StructType, new: T.StructType) -> None:
    """Additive evolution only: every old column keeps its name and type; new ones are nullable."""
    new_fields = {f.name: f for f in new.fields}
    for f in old.fields:
        if f.name not in new_fields:
            raise SchemaError(f"column {f.name} would be dropped")
        if new_fields[f.name].dataType != f.dataType:
            raise SchemaError(f"column {f.name}: {f.dataType.simpleString()} -> "
                              f"{new_fields[f.name].dataType.simpleString()} is not allowed")
    old_names = {f.name for f in old.fields}
    for f in new.fields:
        if f.name not in old_names and not f.nullable:
            raise SchemaError(f"added column {f.name} must be nullable")


def add_column(spark: SparkSession, table: str, name: str, data_type: str) -> int:
    """Metadata-only migration: the new version reuses the data; old rows read NULL."""
    e = _entry(spark, table, None)
    old = read_version(spark, table).schema
    if name in old.names:
        return int(e["version"])
    new = T.StructType(old.fields + [T.StructField(name, T.DataType.fromDDL(data_type), True)])
    check_compatible(old, new)
    return _commit(spark, table, int(e["version"]) + 1, e["data"], new,
                   [p for p in (e["partition_by"] or "").split(",") if p], int(e["row_count"]),
                   f"add_column {name}", _parts(e))


def change_type(spark: SparkSession, table: str, name: str, data_type: str) -> int:
    """Only the present type is accepted (returns the latest version); any other raises SchemaError."""
    e = _entry(spark, table, None)
    old = read_version(spark, table).schema
    new = T.StructType([T.StructField(f.name, T.DataType.fromDDL(data_type) if f.name == name else f.dataType,
                                      f.nullable) for f in old.fields])
    check_compatible(old, new)
    return int(e["version"])


def align(df: DataFrame, target: T.StructType) -> DataFrame:
    """Project onto the target's columns; a missing nullable column becomes NULL.

    A column that the target does not have is refused: its values would be lost.  Callers drop it on purpose, or migrate the target.
    """
    names = set(df.columns)
    if extra := sorted(names - set(target.names)):
        raise SchemaError(f"the target has no column {', '.join(extra)}")
    return df.select(*[(F.col(f.name) if f.name in names else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in target.fields])


def merge(target: DataFrame, updates: DataFrame, keys: Sequence[str], compare: Sequence[str]) -> DataFrame:
    """Conditional upsert as one full outer join on the key; never deletes.

    Returns the merged rows with ``_action``: ``inserted`` (new key),
    ``updated`` (some ``compare`` column differs; plain ``<>`` as in a MERGE
    condition), ``same`` (matched, unchanged: target row kept) or ``kept``
    (target row without update).  Two updates of one key fail the job, as in a MERGE statement.
    """
    cols = [c for c in target.columns if c not in keys]
    t = target.select(*keys, F.struct(*cols).alias("_t"), F.lit(True).alias("_in_t"))
    u = _one_per_key(align(updates, target.schema), keys, F.struct(*cols)).withColumnRenamed("_row", "_u").withColumn("_in_u", F.lit(True))
    j = t.join(u, list(keys), "full")
    changed = F.lit(False)
    for c in compare:
        changed = changed | F.coalesce(F.col(f"_t.{c}") != F.col(f"_u.{c}"), F.lit(False))
    action = (F.when(F.col("_in_u").isNull(), "kept").when(F.col("_in_t").isNull(), "inserted")
              .when(changed, "updated").otherwise("same"))
    j = j.withColumn("_action", action)
    take_u = F.col("_action").isin("inserted", "updated")
    return j.select(*keys, *[F.when(take_u, F.col(f"_u.{c}")).otherwise(F.col(f"_t.{c}")).alias(c) for c in cols],
                    "_action").select(*target.columns, "_action")


def _one_per_key(updates: DataFrame, keys: Sequence[str], row: Column) -> DataFrame:
    """keys and ``_row``; evaluating a key that occurs twice raises (same exchange as the join on the keys)."""
    found = updates.groupBy(*keys).agg(F.first(row).alias("_row"), F.count(F.lit(1)).alias("_n"))
    return found.select(*keys, F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("two updates of key "), F.to_json(F.struct(*keys)))).cast(
        found.schema["_row"].dataType)).otherwise(F.col("_row")).alias("_row"))


def changed_rows(target: DataFrame, updates: DataFrame, keys: Sequence[str], compare: Sequence[str], partition: str) -> DataFrame:
    """The updates that are new or differ in a ``compare`` column, with ``_old``: the partition of the row they replace, and ``_new`` (no such row)."""
    t = target.select(*keys, F.struct(*compare).alias("_t"), F.col(partition).alias("_old"), F.lit(True).alias("_in_t"))
    differs = F.lit(False)
    for c in compare:
        differs = differs | F.coalesce(F.col(f"_t.{c}") != F.col(c), F.lit(False))
    return (updates.join(t, list(keys), "left").filter(F.col("_in_t").isNull() | differs)
            .withColumn("_new", F.col("_in_t").isNull()).drop("_t", "_in_t"))


def change_count(target: DataFrame, updates: DataFrame, keys: Sequence[str], compare: Sequence[str]) -> DataFrame:
    """Counts per action of a prospective merge (one row per action)."""
    return merge(target, updates, keys, compare).groupBy("_action").agg(F.count(F.lit(1)).alias("row_count"))


def upsert(updates: DataFrame, table: str, keys: Sequence[str], compare: Sequence[str],
           partition_by: Sequence[str] = ()) -> dict:
    """Merge ``updates`` into the latest version and commit the result as a new version.

    The change set comes first: updates that are new or differ.  On a table partitioned by one column (e.g. ``event_date``)
    only the partitions that it touches are rewritten: those of the changed rows and of the rows they replace (a correction that moves a row to
    another day empties its old day, which is rewritten too, possibly empty; NULL is a partition like any other).
    Untouched partitions are inherited from their folders.  The touched values are collected to the driver: at most one per partition.
    """
    spark = updates.sparkSession
    current = latest_version(spark, table)
    if current is None:
        v = write_version(updates, table, partition_by, operation="upsert")
        return {"version": v, "changed_count": _entry(spark, table, v)["row_count"]}
    e = _entry(spark, table, current)
    target = read_version(spark, table)
    pcols = [p for p in (e["partition_by"] or "").split(",") if p]
    if len(pcols) != 1:
        return _upsert_full(spark, table, target, updates, keys, compare, pcols, current)
    pcol = pcols[0]
    changes = materialize(changed_rows(target, align(updates, target.schema), keys, compare, pcol), "changes")
    days = changes.select(F.col(pcol).cast("string").alias("p")).unionByName(changes.filter("not _new").select(F.col("_old").cast("string").alias("p")))
    touched = sorted((r["p"] for r in days.distinct().collect()), key=lambda v: (v is not None, v))
    if not touched:
        return {"version": current, "changed_count": 0, "touched_partitions": 0}
    scope = target.filter(_one_of(pcol, touched))
    merged = merge(scope, changes.drop("_old", "_new"), keys, compare).persist()
    try:
        counts = {r["_action"]: r["n"] for r in merged.groupBy("_action").agg(F.count(F.lit(1)).alias("n")).collect()}
        changed = counts.get("inserted", 0) + counts.get("updated", 0)
        if changed == 0:
            return {"version": current, "changed_count": 0}
        version = current + 1
        data = f"{table}/data/{version:09d}"
        merged.drop("_action").hint("rebalance", F.col(pcol)).write.mode("errorifexists").partitionBy(pcol).parquet(data)
        rows = int(e["row_count"]) - scope.count() + sum(counts.values())
    finally:
        merged.unpersist()
    parts = []
    for part in _parts(e):
        if part.get("include") is not None:
            keep = [x for x in part["include"] if x not in touched]
            if keep:
                parts.append({"path": part["path"], "include": keep, "exclude": []})
        else:
            parts.append({"path": part["path"], "include": None,
                          "exclude": sorted(set(part.get("exclude") or []) | set(touched), key=lambda v: (v is not None, v))})
    parts.append({"path": data, "include": touched, "exclude": []})
    _commit(spark, table, version, data, target.schema, [pcol], rows, "upsert", parts)
    return {"version": version, "changed_count": changed, "touched_partitions": len(touched)}


def _upsert_full(spark, table, target, updates, keys, compare, partition_by, current) -> dict:
    merged = merge(target, updates, keys, compare).persist()
    try:
        counts = {r["_action"]: r["n"] for r in merged.groupBy("_action").agg(F.count(F.lit(1)).alias("n")).collect()}
        changed = counts.get("inserted", 0) + counts.get("updated", 0)
        if changed == 0:
            return {"version": current, "changed_count": 0}
        v = write_version(merged.drop("_action"), table, partition_by, operation="upsert")
    finally:
        merged.unpersist()
    return {"version": v, "changed_count": changed}


def compact(spark: SparkSession, table: str, partition_by: Sequence[str]) -> dict:
    """Rewrite the latest version into few, even files per partition; the fingerprint must not change."""
    before = read_version(spark, table)
    fp_before = fingerprint(before).first()
    v = write_version(before, table, partition_by, operation="compact", rebalance=True)
    fp_after = fingerprint(read_version(spark, table, v)).first()
    if fp_before != fp_after:
        raise ValueError("compaction changed the table contents")
    return {"version": v, "row_count": fp_after["row_count"]}


def publish_pointer(spark: SparkSession, pointer: str, run_id: str, marts: dict[str, str]) -> int:
    """Switch all marts at once: one committed pointer row names the run and every mart path."""
    current = latest_version(spark, pointer)
    version = 0 if current is None else current + 1
    payload = ",".join(f"{k}={v}" for k, v in sorted(marts.items()))
    row = [(version, payload, "run_id string", "", 0, f"publish {run_id}",
            dt.datetime.now(dt.timezone.utc).isoformat(), None)]
    spark.createDataFrame(row, LOG_SCHEMA).coalesce(1).write.mode("errorifexists").json(
        f"{pointer}/_log/{version:09d}")
    return version


def published(spark: SparkSession, pointer: str) -> dict[str, str]:
    """Mart name -> path of the latest publication ({} when nothing is published)."""
    v = latest_version(spark, pointer)
    if v is None:
        return {}
    row = versions(spark, pointer).filter(F.col("version") == v).first()
    return dict(item.split("=", 1) for item in row["data"].split(",") if item)


def read_published(spark: SparkSession, pointer: str, mart: str) -> DataFrame:
    return spark.read.parquet(published(spark, pointer)[mart])
