"""Many batches as one: all manifests are one table, all files one scan, and every check one grouped result.

The number of Spark jobs does not depend on the number of batch folders.  Rules and layout are those of ``batch``; a file is bounded by its
shard (100,000 lines), so what concerns the lines of one file is decided in the row of the file, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyframe import types as TT
from tallyframe.sources.batch import BATCH_ID_PATTERN, NAME_PATTERN

_FILE = r"^(.*)/([a-z]+/shard=\d{5,}/[^/]+)$"


def read_manifests(spark: SparkSession, folders: Sequence[str]) -> DataFrame:
    """folder and the columns of the manifest, one row a folder; folders are named as Spark's file listing names them."""
    rows = spark.read.schema(TT.MANIFEST_SCHEMA).json([f"{f.rstrip('/')}/manifest" for f in folders])
    return rows.select(F.regexp_extract(F.col("_metadata.file_path"), r"^(.*)/manifest/[^/]+$", 1).alias("folder"), "*")


def identity() -> Column:
    """The batch id that a manifest's content gives (see ``batch.batch_identity``)."""
    logical = F.transform("files", lambda f: F.struct(f["entity"].alias("entity"), F.regexp_replace(f["name"], r"^([a-z]+/shard=\d{5,})/.*$", "$1").alias("name"),
                                                      f["records"].alias("records"), f["sha256"].alias("sha256")))
    in_order = F.array_sort(F.transform(logical, lambda f: F.struct(f["name"], f["sha256"], f.alias("f"))))
    told = F.struct(F.transform(in_order, lambda x: x["f"]).alias("files"), "label", "processing_date", "schema_version")
    return F.concat("processing_date", F.lit("-"), F.substring(F.sha2(F.to_json(told), 256), 1, 20))


def manifest_problems(manifests: DataFrame) -> DataFrame:
    """folder, batch_id, rule "manifest", name (NULL), detail: the violated rule of the manifest."""
    names = F.transform("files", lambda f: f["name"])
    entities = F.array(*[F.lit(e) for e in TT.ENTITIES])
    size = F.coalesce(F.size("files"), F.lit(0))
    holds = {
        "processing_date": F.col("processing_date").rlike(r"^\d{4}-\d{2}-\d{2}$") & F.col("processing_date").try_cast("date").isNotNull(),
        "schema_version": F.col("schema_version").isin(1, 2),
        "batch_id": F.col("batch_id").rlike(f"^{BATCH_ID_PATTERN}$"),
        "empty": size > 0,
        "unsafe_name": (F.size(F.array_distinct(names)) == size) & F.forall(names, lambda n: n.rlike(f"^{NAME_PATTERN}$")),
        "entity": F.forall("files", lambda f: F.array_contains(entities, f["entity"]) & f["name"].startswith(F.concat(f["entity"], F.lit("/")))),
    }
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in holds.items()]))
    wrong_id = F.when(~F.coalesce(identity() == F.col("batch_id"), F.lit(False)), F.array(F.lit("identity"))).otherwise(F.array().cast("array<string>"))
    found = manifests.withColumn("detail", F.explode(F.when(F.size(broken) > 0, broken).otherwise(wrong_id)))
    return found.select("folder", "batch_id", F.lit("manifest").alias("rule"), F.lit(None).cast("string").alias("name"), "detail")


def listed_files(manifests: DataFrame) -> DataFrame:
    """folder, batch_id, schema_version, entity, name, records, sha256 of every listed file."""
    return manifests.select("folder", "batch_id", "schema_version", F.inline("files"))


def scanned_files(spark: SparkSession, folders: Sequence[str], schema_versions: DataFrame) -> DataFrame:
    """One row for every data file there is, with its checksum, its number of lines and which rules its lines break."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load([f.rstrip("/") for f in folders])
    path = F.col("_metadata.file_path")
    files = files.select(F.regexp_extract(path, _FILE, 1).alias("folder"), F.regexp_extract(path, _FILE, 2).alias("name"), F.sha2("content", 256).alias("actual_sha256"),
                         F.split(F.rtrim(F.col("content").cast("string"), F.lit("\n")), "\n").alias("lines"), (F.length("content") > 0).alias("some"))
    files = files.join(schema_versions.select(F.col("folder").alias("_f"), F.col("schema_version").alias("_version")), F.col("folder") == F.col("_f"), "left").drop("_f")
    entity = F.regexp_extract("name", r"^([a-z]+)/", 1)
    allowed = F.lit(None).cast("array<string>")
    for e in TT.ENTITIES:
        for version in (1, 2):
            fields = [*TT.payload_fields(e, version), "source_record_id"]
            known = (F.col("_version") == 2) if version == 2 else ~F.coalesce(F.col("_version") == 2, F.lit(False))
            allowed = F.when((entity == e) & known, F.array(*[F.lit(x) for x in fields])).otherwise(allowed)
    files = files.withColumn("lines", F.when(F.col("some"), F.col("lines")).otherwise(F.array().cast("array<string>"))).withColumn("allowed", allowed)
    number = lambda line: F.regexp_extract(F.get_json_object(line, "$.source_record_id"), r"^[a-z]+:(\d{12,})$", 1)
    mine = lambda line: F.regexp_extract(F.get_json_object(line, "$.source_record_id"), r"^([a-z]+):", 1) == entity
    files = files.withColumn("ordinals", F.transform("lines", lambda x: F.when(mine(x), number(x).try_cast("bigint"))))
    n, base = F.size("lines"), F.regexp_extract("name", r"shard=(\d{5,})/", 1).cast("bigint") * TT.SHARD_RECORDS
    numbered = ~F.exists("ordinals", lambda o: o.isNull())
    dense = (F.size(F.array_distinct("ordinals")) == n) & (F.array_min("ordinals") == base) & (F.array_max("ordinals") == base + n - 1)
    broken = {"unapproved_fields": F.exists("lines", lambda x: F.size(F.array_except(F.coalesce(F.json_object_keys(x), F.array().cast("array<string>")), F.col("allowed"))) > 0),
              "record_id": ~numbered, "ordinal": (n > 0) & ~F.coalesce(dense, F.lit(False)), "order": numbered & (F.array_sort("ordinals") != F.col("ordinals"))}
    rules = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(True)), F.lit(r)) for r, c in broken.items()]))
    return files.select("folder", "name", "actual_sha256", n.cast("bigint").alias("actual_records"), rules.alias("rules"))


def check_batches(spark: SparkSession, folders: Sequence[str]) -> DataFrame:
    """folder, batch_id, rule, name, detail of every violated rule of all batches; no rows: all are intact.

    Rules: "manifest" (its own rules, or an id that its content does not give), "missing_file", "unlisted_file", "checksum", "count", and of the lines of a file
    "unapproved_fields", "record_id", "ordinal" (not 0, 1, 2, ... of its shard, each once) and "order" (not ascending).
    """
    manifests = read_manifests(spark, folders)
    listed, actual = listed_files(manifests), scanned_files(spark, folders, manifests)
    there = actual.select(F.col("folder").alias("_folder"), F.col("name").alias("_name"), "actual_sha256", "actual_records", "rules")
    both = listed.join(there, (F.col("folder") == F.col("_folder")) & (F.col("name") == F.col("_name")), "full")
    missing, unlisted = F.col("_name").isNull(), F.col("folder").isNull()
    broken = F.array_compact(F.concat(
        F.array(F.when(missing, F.lit("missing_file")), F.when(unlisted, F.lit("unlisted_file")), F.when(~missing & ~unlisted & (F.col("sha256") != F.col("actual_sha256")), F.lit("checksum")),
                F.when(~missing & ~unlisted & (F.col("records") != F.col("actual_records")), F.lit("count"))), F.coalesce("rules", F.array().cast("array<string>"))))
    of_files = both.select(F.coalesce("folder", "_folder").alias("folder"), "batch_id", F.explode(broken).alias("rule"), F.coalesce("name", "_name").alias("name"), F.lit(None).cast("string").alias("detail"))
    return manifest_problems(manifests).unionByName(of_files)


def read_batches(spark: SparkSession, folders: Sequence[str]) -> DataFrame:
    """Raw records with provenance of every listed file of all batches, as ``batch.read_batch`` gives them for one."""
    listed = listed_files(read_manifests(spark, folders)).select(F.col("folder").alias("_folder"), F.col("name").alias("_name"), "batch_id", "schema_version")
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").text([f.rstrip("/") for f in folders])
    path = F.col("_metadata.file_path")
    lines = lines.select("value", path.alias("source_file"), F.regexp_extract(path, _FILE, 1).alias("folder"), F.regexp_extract(path, _FILE, 2).alias("name"))
    joined = lines.join(listed, (F.col("folder") == F.col("_folder")) & (F.col("name") == F.col("_name")))
    return joined.select(F.regexp_extract("name", r"^([a-z]+)/", 1).alias("entity"), F.col("value").alias("payload"), "batch_id", "source_file",
                         F.get_json_object("value", "$.source_record_id").alias("source_record_id"), F.current_timestamp().alias("ingested_at"), "schema_version")


def listed_counts(manifests: DataFrame) -> DataFrame:
    """batch_id, listed_count of every batch."""
    return manifests.select("batch_id", F.coalesce(F.aggregate("files", F.lit(0).cast("bigint"), lambda a, f: a + f["records"]), F.lit(0).cast("bigint")).alias("listed_count"))


def count_mismatches(raw: DataFrame, manifests: DataFrame) -> DataFrame:
    """batch_id, listed_count, stored_count of the batches of which not every listed record is stored once."""
    stored = raw.groupBy(F.col("batch_id").alias("_of")).agg(F.count(F.lit(1)).alias("stored"))
    both = listed_counts(manifests).join(stored, F.col("batch_id") == F.col("_of"), "left")
    found = both.select("batch_id", "listed_count", F.coalesce("stored", F.lit(0).cast("bigint")).alias("stored_count"))
    return found.filter("listed_count <> stored_count")
