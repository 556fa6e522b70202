"""Sharding along a Hilbert curve (operator 4).

Several metadata dimensions are quantised into ``2 ** bits`` bins of nearly
equal numbers of rows, a row's cell gets its index on the Hilbert curve
through all cells, rows are ordered by it, and the order is cut into runs: a
shard then covers a compact box of every dimension, so filters on any of them
prune files.  The law is ``rows``: shards differ by at most one row.

No row is ranked by a global sort: rows are counted by (cell, part), where
part splits a cell by an internal row number, the counts are summed up along
the curve, and a row's rank is its part's offset plus its place in the part.
So a cell with a third of all rows is spread over as many parts as it needs.

Cases: a null in a dimension is the lowest bin; a null text has no bytes.  Ties
and repeated rows are ordered by the internal number, given once when the
narrow table is written.  An empty table gives an empty result.  An extra
column with the name of an output is replaced by that output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .stage import stage


def hilbert_index(coords: list[int], bits: int) -> int:
    """Index of a cell on the Hilbert curve through a cube of ``2 ** bits`` cells a side (Skilling 2004)."""
    x, n = list(coords), len(coords)
    q = 1 << (bits - 1)
    while q > 1:  # undo the excess rotations from the top bit down
        p = q - 1
        for i in range(n):
            if x[i] & q:
                x[0] ^= p
            else:
                t = (x[0] ^ x[i]) & p
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, n):  # Gray code
        x[i] ^= x[i - 1]
    t = 0
    q = 1 << (bits - 1)
    while q > 1:
        if x[n - 1] & q:
            t ^= q - 1
        q >>= 1
    x = [v ^ t for v in x]
    out = 0
    for b in range(bits - 1, -1, -1):
        for v in x:
            out = out << 1 | (v >> b & 1)
    return out


def _bins(df: DataFrame, dims: dict[str, Column], bits: int) -> list[Column]:
    """A bin column for each dimension: how many of its quantile cuts lie below it."""
    at = [i / 2 ** bits for i in range(1, 2 ** bits)]
    cuts = df.agg(*[F.percentile_approx(c, at, 10_000).alias(k) for k, c in dims.items()]).first()
    out = []
    for k, c in dims.items():
        steps = sorted(set(cuts[k] or []))
        binned = F.lit(0)
        for s in steps:
            binned = binned + F.when(c > F.lit(s), 1).otherwise(0)
        out.append(binned)
    return out


def category(c: str) -> Column:
    """A text as a number whose quantiles are those of its hash: frequent values get bins of their own."""
    return F.shiftright(F.xxhash64(F.col(c).cast("string")), 12).cast("double")


def hilbert_shards(rows: DataFrame, dims: dict[str, Column], n_shards: int, bits: int = 4, part_rows: int = 20_000) -> DataFrame:
    """``rows`` plus curve (int), shard (int) and slot (long).

    ``dims``: name -> numeric column.  To the driver come the cuts
    (``2 ** bits - 1`` a dimension) and one count.  ``rows`` is written once
    in the shared folder: give it the columns that are needed.
    """
    spark = rows.sparkSession
    n_cells = 1 << (bits * len(dims))
    cell = F.lit(0)
    for b in _bins(rows, dims, bits):
        cell = cell * (1 << bits) + b
    base = rows.drop("curve", "shard", "slot", "_cell", "_no", "_part")
    numbered = stage(base.select("*", cell.alias("_cell"), F.monotonically_increasing_id().alias("_no")), "shard-rows")
    places = []
    for c in range(n_cells):
        at = [(c >> (bits * (len(dims) - 1 - i))) & ((1 << bits) - 1) for i in range(len(dims))]
        places.append((c, hilbert_index(at, bits)))
    curve = spark.createDataFrame(places, "_cell int, curve int")  # 2 ** (bits * dims) rows, whatever the input
    cells = numbered.groupBy("_cell").agg(F.count(F.lit(1)).alias("_n")).join(F.broadcast(curve), "_cell").select(
        "_cell", "curve", F.ceil(F.col("_n") / part_rows).cast("long").alias("_parts"))
    # at most n_cells rows: a bound that doesn't follow the input
    dealt = numbered.join(F.broadcast(cells), "_cell").withColumn("_part", F.pmod(F.xxhash64("_no"), F.col("_parts")))
    counts = dealt.groupBy("curve", "_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = stage(_running(counts), "shard-offsets")
    total = offsets.agg(F.sum("_n")).first()[0] or 0
    placed = dealt.join(offsets.select("curve", "_part", "_before"), ["curve", "_part"])
    rank = F.col("_before") + F.row_number().over(Window.partitionBy("curve", "_part").orderBy("_no")) - 1
    # the first ``more`` shards hold ``each + 1`` rows, the others ``each``
    each, more = divmod(total, n_shards)
    head = more * (each + 1)
    placed = placed.withColumn("_rank", rank)
    shard = F.when(F.col("_rank") < head, F.expr(f"_rank div {each + 1}")).otherwise(F.expr(f"{more} + (_rank - {head}) div {max(each, 1)}"))
    slot = F.when(F.col("_rank") < head, F.col("_rank") % (each + 1)).otherwise((F.col("_rank") - head) % max(each, 1))
    return placed.select(*base.columns, "curve", shard.cast("int").alias("shard"), slot.cast("long").alias("slot"))


def _running(counts: DataFrame) -> DataFrame:
    """``_before``: the sum of ``_n`` of all smaller (curve, _part).

    Within a curve index by a window over its parts, between indices by a
    window over one row for each of the bounded number of cells.
    """
    within = counts.withColumn("_in", F.sum("_n").over(Window.partitionBy("curve").orderBy("_part")) - F.col("_n"))
    of_curve = counts.groupBy("curve").agg(F.sum("_n").alias("_all"))
    between = of_curve.select("curve", (F.sum("_all").over(Window.orderBy("curve")) - F.col("_all")).alias("_base"))
    return within.join(between, "curve").select("curve", "_part", "_n", (F.col("_base") + F.col("_in")).alias("_before"))


def write_shards(sharded: DataFrame, folder: str) -> None:
    """The shards as folders ``shard=N`` of Parquet files, each in slot order."""
    n = sharded.agg(F.max("shard")).first()[0]
    sharded.repartition((n or 0) + 1, "shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)


def q_op4(spark, sf_dir: str) -> DataFrame:
    """Contract query: all documents on a curve through source, language and size, cut into 40 shards."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = docs.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
                       category("source").alias("_source"), category("lang").alias("_lang"))
    out = hilbert_shards(rows, {"source": F.col("_source"), "lang": F.col("_lang"), "size": F.col("size")}, 40)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
