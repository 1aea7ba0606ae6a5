"""Hilbert-curve sharding (operator 6), DataFrame functions only.

Each row is placed on a three-dimensional Hilbert curve by its quantised metadata (language, source, text
size).  All rows are ordered along the curve and the order is cut into shards of equal row counts, so a
shard's file covers a compact box of the metadata space and readers prune files on any of the dimensions.

The global position of a row needs no global sort in one task.  Rows of a cell are ordered by text checksum, so equal texts of one cell are
one stretch of the order.  A row's run is (cell, range of checksums, phase, salt); runs are counted with a partial aggregation, running totals
over these counts give each run its first position, and a row's position inside its run comes from a window over the run.  The number of ranges follows the number of
rows.  A text that repeats very often is found by a sketch of fixed size and gets a phase of its own, whose rows are salted: it is spread over
several window groups and yet stays one stretch.

Which groups of equal texts are torn: those that stand on one of the cuts between shards, as any law of equal counts must cut a group that is larger than a
shard, and those whose rows differ in language or source, which lie in different cells of the curve.

Defined cases: a null language or source has coordinate 0; a null text has size 1 and checksum 0; equal
rows are interchangeable and get different slots; an empty table gives no rows; extra columns are
dropped by ``assign`` and kept by ``write_shards``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BITS = 4
DIMS = 3
CELLS = 1 << (BITS * DIMS)
#: Rows that a range of checksums of a cell, or a salt of one text, is meant for.
RUN_ROWS = 50_000
#: Texts with at least 1 / HOT_SHARE of all rows (in one cell) are salted; the sketch tracks TRACKED of them.
HOT_SHARE, TRACKED = 1000, 8192


def _rotate_right(x: int, k: int) -> int:
    k %= DIMS
    return ((x >> k) | (x << (DIMS - k))) & ((1 << DIMS) - 1)


def _rotate_left(x: int, k: int) -> int:
    return _rotate_right(x, DIMS - k % DIMS)


def curve_table() -> list[list[int]]:
    """Rows [state * 2**DIMS + corner] -> [rank of the corner on the curve, next state].

    A state is (entry corner, axis) of a sub-cube; corners are visited in the order of the reflected Gray
    code, turned and mirrored by the state (the published construction of compact Hilbert indices).
    """
    corners = 1 << DIMS
    gray = [i ^ (i >> 1) for i in range(corners)]
    rank = {g: i for i, g in enumerate(gray)}

    def trailing_ones(i: int) -> int:
        n = 0
        while i & 1:
            i, n = i >> 1, n + 1
        return n

    entry = [0] + [gray[2 * ((i - 1) // 2)] for i in range(1, corners)]
    axis = [0] + [trailing_ones(i - 1 if i % 2 == 0 else i) % DIMS for i in range(1, corners)]
    rows = []
    for state in range(corners * DIMS):
        e, d = state // DIMS, state % DIMS
        for corner in range(corners):
            w = rank[_rotate_right(corner ^ e, d + 1)]
            e2, d2 = e ^ _rotate_left(entry[w], d + 1), (d + axis[w] + 1) % DIMS
            rows.append([w, e2 * DIMS + d2])
    return rows


def hilbert_index(x: Column, y: Column, z: Column) -> Column:
    """Position (0 .. CELLS-1) on the curve of a point with BITS-bit coordinates."""
    table = curve_table()
    ranks = F.array(*[F.lit(r) for r, _ in table])
    nexts = F.array(*[F.lit(s) for _, s in table])
    levels = F.array(*[F.lit(b) for b in reversed(range(BITS))])
    start = F.struct(F.lit(0).alias("h"), F.lit(0).alias("s"), x.cast("int").alias("x"), y.cast("int").alias("y"), z.cast("int").alias("z"))

    def step(acc, level):
        def bit(c):
            return F.call_function("shiftright", c, level).bitwiseAND(F.lit(1))

        slot = acc["s"] * F.lit(1 << DIMS) + bit(acc["x"]) * F.lit(4) + bit(acc["y"]) * F.lit(2) + bit(acc["z"]) + F.lit(1)
        return F.struct((acc["h"] * F.lit(1 << DIMS) + F.element_at(ranks, slot)).alias("h"),
                        F.element_at(nexts, slot).alias("s"), acc["x"].alias("x"), acc["y"].alias("y"), acc["z"].alias("z"))

    return F.aggregate(levels, start, step, lambda acc: acc["h"])


def _name_coordinate(c: Column) -> Column:
    """A stable BITS-bit coordinate of a category; 0 for null."""
    return F.coalesce(F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(1 << BITS)), F.lit(0)).cast("int")


def placed(docs: DataFrame, bits: int) -> DataFrame:
    """``docs`` with _size, _crc, _cell and _sub, the range of checksums (their first ``bits`` bits)."""
    raw = F.encode(F.col("text"), "UTF-8")
    size = F.coalesce(F.octet_length(F.col("text")), F.lit(0)).cast("long") + 1
    crc = F.coalesce(F.crc32(raw), F.lit(0)).cast("long")
    log_size = F.least(F.floor(F.log2(F.col("_size").cast("double"))), F.lit((1 << BITS) - 1)).cast("int")
    base = docs.withColumn("_size", size).withColumn("_crc", crc)
    cell = hilbert_index(_name_coordinate(F.col("lang")), _name_coordinate(F.col("source")), log_size)
    return base.withColumn("_cell", cell).withColumn("_sub", F.floor(F.col("_crc") / (1 << (32 - bits))).cast("int"))


def frequent_texts(rows: DataFrame) -> DataFrame:
    """(cell, hot): checksum and number of salts of each text that repeats very often in a cell; at most HOT_SHARE."""
    code = (F.col("_cell").cast("long") * (1 << 32) + F.col("_crc")).alias("code")
    top = rows.select(code).agg(F.expr(f"approx_top_k(code, {2 * HOT_SHARE}, {TRACKED})").alias("top"), F.count("*").alias("n"))
    each = top.select(F.explode("top").alias("x"), "n").filter((F.col("x.count") * HOT_SHARE >= F.col("n")) & (F.col("x.count") > RUN_ROWS))
    crc, cell = F.col("x.item") % (1 << 32), F.floor(F.col("x.item") / (1 << 32)).cast("int")
    return each.select(cell.alias("cell"), F.struct(crc.alias("crc"), (F.floor(F.col("x.count") / RUN_ROWS) + 1).alias("salts")).alias("hot"))


def ranked(docs: DataFrame, shards: int) -> DataFrame:
    """``docs`` with _size, _crc, _cell, _shard and _slot."""
    bits = max(4, (docs.count() // RUN_ROWS).bit_length())
    rows = placed(docs, bits)
    hot = frequent_texts(rows).groupBy("cell").agg(F.sort_array(F.collect_list("hot")).alias("hots"))
    # texts before a frequent one, itself, those after it, and so on
    mine = F.filter("hots", lambda h: h.crc == F.col("_crc"))
    before = F.size(F.filter("hots", lambda h: h.crc < F.col("_crc")))
    phase = F.when(F.col("hots").isNull(), 0).otherwise(2 * before + F.size(mine))
    salt = F.when(F.size(mine) > 0, F.pmod(F.xxhash64("doc_id"), F.try_element_at(mine, F.lit(1))["salts"])).otherwise(0)
    rows = (rows.join(F.broadcast(hot), F.col("_cell") == F.col("cell"), "left").withColumn("_phase", phase).withColumn("_salt", F.coalesce(salt, F.lit(0)).cast("long")).drop("cell", "hots"))
    run = ["_cell", "_sub", "_phase", "_salt"]
    counts = rows.groupBy(*run).agg(F.count("*").alias("n"))
    # running totals in two levels: inside a cell (its runs), over the cells (at most CELLS)
    inside = Window.partitionBy("_cell").orderBy("_sub", "_phase", "_salt").rowsBetween(Window.unboundedPreceding, -1)
    within = counts.withColumn("before", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    cells = counts.groupBy("_cell").agg(F.sum("n").alias("cell_n"))
    along = Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("_cell", F.coalesce(F.sum("cell_n").over(along), F.lit(0)).alias("first"),
                         F.sum("cell_n").over(Window.partitionBy()).alias("total"))
    starts = within.join(F.broadcast(cells), "_cell").select(*run, (F.col("before") + F.col("first")).alias("_start"), F.col("total").alias("_total"))
    order = Window.partitionBy(*run).orderBy("_crc", "doc_id", "_size")
    placed_rows = rows.withColumn("_place", F.row_number().over(order) - 1)
    shard = F.expr(f"cast((_rank * {shards}) div _total as int)")
    first_of_shard = F.expr(f"(cast(_shard as bigint) * _total + {shards - 1}) div {shards}")
    return (placed_rows.join(starts, run).withColumn("_rank", (F.col("_start") + F.col("_place")).cast("long"))
            .withColumn("_shard", shard).withColumn("_slot", (F.col("_rank") - first_of_shard).cast("long"))
            .select(*docs.columns, "_size", "_crc", "_cell", "_shard", "_slot"))


def assign(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Shard and slot of every row: runs of the curve order whose row counts differ by at most one.

    Needs doc_id, text, lang, source; returns doc_id, size, text_crc32, cell, shard, slot.
    """
    names = {"_size": "size", "_crc": "text_crc32", "_cell": "cell", "_shard": "shard", "_slot": "slot"}
    return ranked(docs.select("doc_id", "text", "lang", "source"), shards).select("doc_id", *[F.col(a).alias(b) for a, b in names.items()])


def write_shards(docs: DataFrame, path: str, shards: int = 8) -> None:
    """Write all columns of ``docs`` with ``_shard``, ``_cell`` as one folder per shard, in curve order inside each file.

    Every row is written once, whatever its doc_id: null and repeated ids too lie in one of the shards 0 to ``shards`` - 1.
    """
    out = ranked(docs, shards).drop("_size", "_crc")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (out.repartitionByRange(max(parts, shards), "_shard", "_slot").sortWithinPartitions("_shard", "_slot")
     .write.partitionBy("_shard").parquet(path))


def op6_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return assign(docs, 8).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                                  F.lit(None).cast("int").alias("grown_shard"), "cell")
