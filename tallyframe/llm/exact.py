"""Exact dedup by two-pass Bloom filtering (operator 12), in DataFrame functions only.

Texts are equal when they are identical after every blank, tab, line feed, vertical tab, form feed and return is deleted.

1. First pass: the hash of each text falls into HASHES of the cells of a counting Bloom filter that has CELLS_PER_ROW cells a row.  The
   filter is kept sparse, as (cell, count) pairs with partial sums, so a copy that fills a third of the table sends one pair a task.  Neither
   texts, ids nor digests take part in this shuffle.
2. Cells counted twice or more become bitmaps.  A hash all of whose cells are set is possibly repeated; a hash that occurs
   twice always is, so no copy is missed.
3. Second pass: rows are held against the bitmaps, which are broadcast in parts of at most PART_CELLS cells (32 MB); a larger filter has more
   parts, and a row is only held against the part that its hash names.  Possibly repeated rows are shuffled and compared by SHA-256 of the whole normalised text;
   the rest pass straight through, as groups of one.

Of equal texts the row with the most code points in its original text stays, then that with the smallest doc_id (null last), then the first one read.

Defined cases: a null text counts as empty, so null, empty and blank texts are one group; repeated rows are rows like any
other, of which one stays; an empty table gives no rows; extra columns are ignored by ``exact_groups`` and kept by ``keep_one`` (its own are prefixed ``_ex_``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.session import materialize

BLANKS = r"[\x20\x09-\x0D]"
HASHES = 2
CELLS_PER_ROW = 16
#: Cells of one bitmap row (4 KB), as the bitmap functions have it.
BITMAP = 1 << 15
PART_CELLS = 1 << 28
#: Groups of more than 1 / HOT_SHARE of the possibly repeated rows, of which there are fewer than HOT_SHARE, are joined by broadcast.
HOT_SHARE = 1000


def normalised(text: str) -> Column:
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), BLANKS, "")


def _cells(h: str, n: int) -> list[Column]:
    """The cells of a hash among ``n`` of its part."""
    return [F.pmod(F.xxhash64(F.col(h), F.lit(k)), F.lit(n)) for k in range(HASHES)]


def repeated_cells(hashes: DataFrame, part: str, h: str, n: int) -> DataFrame:
    """(part, bucket, map): bitmaps of the cells that more than one row falls into."""
    cells = hashes.select(part, F.explode(F.array(*_cells(h, n))).alias("cell"))
    twice = cells.groupBy(part, "cell").agg(F.count("*").alias("rows")).filter("rows > 1")
    place = F.col("cell") + 1
    return twice.groupBy(part, F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("map"))


def _holds(bits: str, cell: Column) -> Column:
    """Whether the bitmap has the bit of a cell set."""
    bit = F.bitmap_bit_position(cell + 1)
    byte = F.conv(F.hex(F.substring(F.col(bits), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, (bit % 8).cast("int")).bitwiseAND(F.lit(1)) == 1


def maybe_repeated(rows: DataFrame, maps: DataFrame, part: str, h: str, n: int, parts: int) -> DataFrame:
    """``rows`` with a column ``again``: whether all cells of the hash are set; one branch of broadcast joins for each part."""
    def held(p: int) -> DataFrame:
        out = rows.filter(F.col(part) == p).withColumn("again", F.lit(True))
        for k, cell in enumerate(_cells(h, n)):
            mine = maps.filter(F.col("part") == p).select(F.col("bucket").alias(f"bucket{k}"), F.col("map").alias(f"map{k}"))
            out = out.join(F.broadcast(mine), F.bitmap_bucket_number(cell + 1) == F.col(f"bucket{k}"), "left")
            out = out.withColumn("again", F.col("again") & F.col(f"map{k}").isNotNull() & F.coalesce(_holds(f"map{k}", cell), F.lit(False))).drop(f"bucket{k}", f"map{k}")
        return out

    return reduce(DataFrame.unionByName, [held(p) for p in range(parts)])


def filtered(rows: DataFrame, h: str) -> DataFrame:
    """Rows of a written table with ``again``: False only if no other row has the hash ``h``."""
    n = rows.count()
    cells = max(BITMAP, CELLS_PER_ROW * n)
    parts = -(-cells // PART_CELLS)
    per_part = -(-cells // parts)
    marked = rows.withColumn("part", F.pmod(F.hash(h), F.lit(parts)))
    maps = materialize(repeated_cells(marked.select("part", h), "part", h, per_part), "cells")
    return maybe_repeated(marked, maps, "part", h, per_part, parts).drop("part")


def exact_groups(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of (doc_id, text)."""
    text = docs.select("doc_id", F.length(F.coalesce("text", F.lit(""))).alias("length"), normalised("text").alias("norm"))
    signed = text.select("doc_id", "length", F.xxhash64("norm").alias("h"), F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("sha"), F.monotonically_increasing_id().alias("row"))
    marked = materialize(filtered(materialize(signed, "signed"), "h"), "marked")
    again, alone = marked.filter("again"), marked.filter("not again")
    # the least is the row that stays: longest original, then doc_id, null last, then order of reading
    rank = F.struct((-F.col("length")).alias("shorter"), F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")
    groups = materialize(again.groupBy(F.col("sha").alias("of")).agg(F.min(rank).alias("first"), F.count("*").alias("n")), "groups")
    least = F.greatest(F.lit(HOT_SHARE), F.floor(F.lit(again.count()) / HOT_SHARE))
    hot = F.broadcast(groups.filter(F.col("n") > least))

    def joined(rows: DataFrame, found: DataFrame) -> DataFrame:
        return rows.join(found, F.col("sha") == F.col("of"))

    rest = again.join(hot.select("of"), F.col("sha") == F.col("of"), "left_anti")
    repeated = joined(again, hot).unionByName(joined(rest, groups.filter(F.col("n") <= least)))
    digest = F.lower(F.hex("sha")).alias("text_sha256")
    return (alone.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), digest)
            .unionByName(repeated.select("doc_id", F.col("first.doc_id").alias("keep_id"), F.col("n").alias("group_size"), (F.col("row") == F.col("first.row")).alias("kept"), digest)))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts; rows without a copy are not shuffled."""
    norm = normalised("text")
    h = F.xxhash64(norm)
    n = docs.count()
    cells = max(BITMAP, CELLS_PER_ROW * n)
    parts = -(-cells // PART_CELLS)
    per_part = -(-cells // parts)
    maps = materialize(repeated_cells(docs.select(F.pmod(F.hash(h), F.lit(parts)).alias("part"), h.alias("h")), "part", "h", per_part), "cells")
    wide = docs.withColumn("_ex_h", h).withColumn("_ex_part", F.pmod(F.hash("_ex_h"), F.lit(parts)))
    marked = maybe_repeated(wide, maps, "_ex_part", "_ex_h", per_part, parts)
    columns = [F.col(c) for c in docs.columns]
    rank = F.struct((-F.length(F.coalesce("text", F.lit("")))).alias("shorter"), F.col("doc_id").isNull().alias("unnamed"), "doc_id", F.xxhash64(*columns).alias("row"))
    again = marked.filter("again").groupBy(F.sha2(norm.cast("binary"), 256).alias("_ex_sha")).agg(F.min_by(F.struct(*columns), rank).alias("_ex_row"))
    return marked.filter("not again").select(*docs.columns).unionByName(again.select("_ex_row.*"))


def op12_two_pass_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
