"""Ordinal bitmaps: which ordinals (0, 1, 2, ...) of a batch are present, as 4 KB bitmaps of 32,768 ordinals each.

Bitmaps are built with partial aggregation (``bitmap_construct_agg``), so a table of raw rows is reduced to one row per
32,768 ordinals of a (batch, entity) before anything is compared.  Exact: no hashing, and no row leaves its place.

Rows without an ordinal, or with a negative one, belong to no bitmap: ``presence`` counts them, ``insert_absent`` takes them by their other columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Ordinals of one bitmap, as the bitmap functions have it.
CHUNK = 32_768


def _chunk(ordinal: str) -> Column:
    return F.floor(F.col(ordinal) / CHUNK)


def _numbered(ordinal: str) -> Column:
    return F.coalesce(F.col(ordinal) >= 0, F.lit(False))


def bitmaps(rows: DataFrame, by: Sequence[str], ordinal: str) -> DataFrame:
    """``by``, chunk, map, rows: one bitmap for each chunk that has a row."""
    place = F.col(ordinal).cast("bigint") + 1
    return (rows.filter(_numbered(ordinal)).groupBy(*by, _chunk(ordinal).alias("chunk"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("map"), F.count(F.lit(1)).alias("rows")))


def presence(rows: DataFrame, by: Sequence[str], ordinal: str) -> DataFrame:
    """``by``, row_count, distinct_count, duplicate_count, greatest, gap_count, unnumbered_count of every group.

    Gaps are the ordinals below the greatest one that no row has.
    """
    bit = bitmaps(rows, by, ordinal)
    # the greatest ordinal of a chunk from its rows; sums and maxima of chunks need no second pass over the rows
    tops = rows.groupBy(*by).agg(F.max(F.when(_numbered(ordinal), F.col(ordinal))).cast("bigint").alias("greatest"), F.count_if(~_numbered(ordinal)).alias("unnumbered_count"),
                                 F.count(F.lit(1)).alias("row_count"))
    counts = bit.groupBy(*by).agg(F.sum(F.bitmap_count("map")).alias("distinct_count"), F.sum("rows").alias("numbered"))
    key = F.struct(*[F.col(c) for c in by])
    out = tops.withColumn("_key", key).join(counts.select(key.alias("_of"), "distinct_count", "numbered"), F.col("_key") == F.col("_of"), "left")
    distinct = F.coalesce("distinct_count", F.lit(0).cast("bigint"))
    return out.select(*by, "row_count", distinct.alias("distinct_count"), (F.coalesce("numbered", F.lit(0).cast("bigint")) - distinct).alias("duplicate_count"), "greatest",
                      (F.coalesce(F.col("greatest") + 1, F.lit(0).cast("bigint")) - distinct).alias("gap_count"), "unnumbered_count")


def _is_set(map_: str, ordinal: Column) -> Column:
    """Whether the bit of an ordinal is set in its chunk's bitmap (NULL: no bitmap)."""
    bit = F.bitmap_bit_position(ordinal.cast("bigint") + 1)
    byte = F.conv(F.hex(F.substring(F.col(map_), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.call_function("shiftright", byte, (bit % 8).cast("int")).bitwiseAND(F.lit(1)) == 1, F.lit(False))


def gaps(rows: DataFrame, by: Sequence[str], ordinal: str) -> DataFrame:
    """``by``, ordinal of every ordinal below the group's greatest that no row has; only chunks that are not full are listed."""
    bit = bitmaps(rows, by, ordinal).withColumn("_key", F.struct(*[F.col(c) for c in by]))
    last = rows.filter(_numbered(ordinal)).groupBy(*by).agg(F.max(ordinal).cast("bigint").alias("greatest"))
    chunks = last.select(*by, "greatest", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(F.col("greatest") / CHUNK))).alias("chunk"))
    whole = F.least(F.col("greatest") + 1 - F.col("chunk") * CHUNK, F.lit(CHUNK))
    there = bit.select(F.col("_key").alias("_of"), F.col("chunk").alias("_chunk"), "map")
    open_ = (chunks.withColumn("_key", F.struct(*[F.col(c) for c in by])).join(there, (F.col("_key") == F.col("_of")) & (F.col("chunk") == F.col("_chunk")), "left")
             .filter(F.coalesce(F.bitmap_count("map"), F.lit(0).cast("bigint")) < whole))
    listed = open_.select(*by, "map", F.explode(F.sequence(F.col("chunk") * CHUNK, F.col("chunk") * CHUNK + whole - 1)).alias(ordinal))
    return listed.filter(~_is_set("map", F.col(ordinal))).select(*by, ordinal)


def insert_absent(target: DataFrame, incoming: DataFrame, by: Sequence[str], ordinal: str) -> DataFrame:
    """Rows of ``incoming`` whose (``by``, ordinal) ``target`` does not have.

    The bitmaps of both sides are merged by OR: a chunk whose union is no larger than the target's part is a replay and falls out whole, one that the target
    lacks goes in whole; only rows of other chunks look at bits.  Incoming rows are not deduplicated among themselves.  Rows without a valid
    ordinal are compared by all their columns.
    """
    cols = incoming.columns
    key = F.struct(*[F.col(c) for c in by], "chunk")
    have = bitmaps(target, by, ordinal).select(key.alias("_of"), F.col("map").alias("have"))
    news = bitmaps(incoming, by, ordinal).select(key.alias("_of"), F.col("map").alias("new"))
    both = (have.select("_of", "have", F.col("have").alias("any")).unionByName(news.select("_of", F.lit(None).cast("binary").alias("have"), F.col("new").alias("any")))
            .groupBy("_of").agg(F.bitmap_or_agg(F.coalesce("have", F.lit(b""))).alias("have"), F.bitmap_count(F.bitmap_or_agg("any")).alias("together"), F.count("have").alias("held")))
    status = both.filter("held > 0").select("_of", F.when(F.col("together") > F.bitmap_count("have"), F.col("have")).alias("have"), F.lit(True).alias("held"))
    rows = incoming.filter(_numbered(ordinal)).withColumn("chunk", _chunk(ordinal)).withColumn("_key", key)
    joined = rows.join(status, F.col("_key") == F.col("_of"), "left")
    # held without a bitmap: the whole chunk is a replay
    fresh = joined.filter(F.col("held").isNull() | (F.col("have").isNotNull() & ~_is_set("have", F.col(ordinal)))).select(*cols)
    other = incoming.filter(~_numbered(ordinal)).withColumn("_row", F.struct(*[F.col(c) for c in cols]))
    gone = target.filter(~_numbered(ordinal)).select(F.struct(*[F.col(c) for c in cols]).alias("_there"))
    return fresh.unionByName(other.join(gone, F.col("_row") == F.col("_there"), "left_anti").select(*cols))
