"""Incremental raw ingest on Structured Streaming.

A file stream watches ``<sources>/*/manifest/*.json``.  ``write_batch``
writes a batch's manifest after its data files, so a manifest row means a
complete batch.  Each micro-batch hands its folders to the batch path
(integrity check + insert-if-absent append + raw count check).  The
stream's checkpoint records which manifests were processed; a replayed
micro-batch appends nothing twice because the append is insert-if-absent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyframe import types as TT
from tallyframe.plans import runner


def manifest_stream(spark: SparkSession, sources: str) -> DataFrame:
    return (spark.readStream.schema(TT.MANIFEST_SCHEMA).option("maxFilesPerTrigger", 100)
            .json(f"{sources.rstrip('/')}/*/manifest")
            .withColumn("folder", F.regexp_replace(F.col("_metadata.file_path"), r"/manifest/[^/]+$", "")))


def ingest_new_batches(spark: SparkSession, sources: str, lake: runner.Lake, checkpoint: str,
                       available_now: bool = True):
    """Start the stream; with ``available_now`` it processes what exists and stops.

    A micro-batch is one job set for all its batches (``runner.ingest_batches``); the driver sees folder names only, at most as many
    as a trigger takes files.
    """
    def process(df: DataFrame, epoch_id: int) -> None:
        folders = [r["folder"] for r in df.select("folder").distinct().collect()]
        if folders:
            runner.ingest_batches(spark, lake, folders)

    writer = (manifest_stream(spark, sources).writeStream.foreachBatch(process)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
