"""Training-corpus pipeline: quality, near duplicates, repeated passages, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and reread as the next one's
docs.  All but the last return the columns of ``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import decontaminate, jaccard, packing, paragraphs, quality, training
from tallyframe.llm.queries import with_code
from tallyframe.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the convolutional network accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    params = quality.learn(docs, labels, "quality", keep=~training.held_out(5, 0))
    return quality.filter_documents(docs.select(*COLUMNS), params)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of the 75 % Jaccard links, that with the smallest (doc_id, row hash); all rows without words stay.

    Rows are told apart by their whole content, not by doc_id, which may be null or repeated.
    """
    content = [c for name in COLUMNS for c in (F.col(name).isNull(), F.col(name))]
    rows = docs.select(*COLUMNS)
    marked = rows.withColumn("_row", F.xxhash64(*content)).withColumn("_row2", F.xxhash64(F.lit(1), *content))
    first = jaccard.first_rows(marked, ("_row", "_row2"))
    words = F.coalesce(F.col("text").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))
    kept = marked.filter(words).join(first, ["_row", "_row2"], "left_semi").dropDuplicates(["_row", "_row2"])
    return kept.select(*COLUMNS).unionByName(rows.filter(~words))


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines and passages that an earlier document has."""
    return _counted(paragraphs.remove(docs.select(*COLUMNS)))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without benchmark windows; documents mostly made of them go."""
    return _counted(decontaminate.decontaminate(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bins of whole or cut documents, no two of one source or of equal text in a bin."""
    return packing.pack(docs)


STAGES = [(name, with_code(stage)) for name, stage in (
    ("quality", good_quality), ("near_duplicates", one_of_each_group), ("repeated_passages", without_repeated_passages), ("decontamination", without_benchmark), ("packing", packed))]

#: The first stage is a learned network, which SQL cannot express; tests/llm checks the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
