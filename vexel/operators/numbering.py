"""Dense append positions and byte offsets for rows spread over many tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vexel.schema import record_bytes
from vexel.session import work_dir

# monotonically_increasing_id() keeps the row number of a partition in its low
# 33 bits and the partition above them.
_ROW_BITS = 33


def in_key_order(df: DataFrame, key: str, text: str) -> DataFrame:
    """``df`` ordered by key, then text: an order of the data alone.

    Neither the number of cores nor the cut of the input changes it.  The hash
    lets one key with many rows take several ranges.  There are twice as many ranges
    as the input has splits, so they stay as small as those.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    number = 2 * max(cores, df.rdd.getNumPartitions())
    keys = [F.col(key), F.xxhash64(key, text)]
    return df.repartitionByRange(number, *keys).sortWithinPartitions(*keys, text)


def assign_offsets(
    df: DataFrame, dim: int, start_offset: int = 0, path: str | None = None
) -> DataFrame:
    """Add ``pos`` (0-based) and ``offset`` (byte offset of the record's end).

    ``offset = start_offset + (n + 1) * dim * 4`` for the n-th row, in the order
    of ``df``'s partitions and the rows inside them.  ``df`` is evaluated once and
    written to ``path``, by default in the shared work folder; the rows of each
    partition are counted in what was written, so positions have no gap or repeat
    even if another evaluation of ``df`` would give other rows.  The numbering
    itself shuffles no row: its broadcast side has one row per partition.
    """
    width = record_bytes(dim)
    if start_offset % width:
        raise ValueError(f"offset {start_offset} is not a multiple of {width}")
    spark = df.sparkSession
    path = path or work_dir(spark, "numbered")
    rows = df.withColumn("__row", F.monotonically_increasing_id())
    rows.write.parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)

    def part() -> Column:
        return F.shiftrightunsigned("__row", _ROW_BITS)

    counts = rows.groupBy(part().alias("__pid")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "__pid", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")
    )
    numbered = rows.withColumn("__pid", part()).join(F.broadcast(starts), "__pid")
    inside = F.col("__row").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        numbered.withColumn("__n", F.col("__start") + inside)
        .withColumn("pos", F.col("__n") + F.lit(start_offset // width))
        .withColumn("offset", (F.col("pos") + 1) * F.lit(width).cast("bigint"))
        .drop("__pid", "__row", "__start", "__n")
    )
