"""A bounded Bloom sieve before an exact join, in DataFrame functions.

``sieve`` keeps the rows whose key may be among ``keys``: keys are hashed to BITS positions of bitmaps (aggregated with partial
sums, at most BITS / 32768 rows of 4 KB, so the broadcast is bounded whatever the data), and a row stays if its position is set.  No row with a
key among ``keys`` is lost; strangers that stay fall out in the exact join that follows.  With very many keys
the bitmaps fill up and the join simply shuffles more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 1 << 25


def sieve(rows: DataFrame, column: str, keys: DataFrame, key: str) -> DataFrame:
    def place(c):
        return F.pmod(F.xxhash64(c), F.lit(BITS)) + F.lit(1)

    maps = (keys.select(place(key).alias("_place")).groupBy(F.bitmap_bucket_number("_place").alias("_bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_map")))
    bit = F.bitmap_bit_position(place(column))
    byte = F.conv(F.hex(F.substring(F.col("_map"), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.call_function("shiftright", byte, (bit % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
    return rows.join(F.broadcast(maps), F.bitmap_bucket_number(place(column)) == F.col("_bucket")).filter(hit).select(*rows.columns)
