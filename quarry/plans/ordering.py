"""Consecutive 0-based ids in a global order without a single-task window.

The rows are range-partitioned and sorted by the order columns; a row's place in its partition plus
the number of rows of all earlier partitions (a table of one row per partition) is its id.  The
numbered rows are kept (memory, spilling to disk): a lost partition is read again from the same ranges.
Equal rows may be dealt anyhow; no value of the leading column need be rare, since ranges go by all
order columns.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# monotonically_increasing_id: the partition above, the place in it below
_PLACE_BITS = 33


def dense_index(df: DataFrame, order_cols: list[str], out_col: str,
                num_partitions: int | None = None) -> DataFrame:
    ranged = df.repartitionByRange(num_partitions, *order_cols) if num_partitions else df.repartitionByRange(*order_cols)
    placed = (ranged.sortWithinPartitions(*order_cols).withColumn("__at", F.monotonically_increasing_id())
              .persist(StorageLevel.MEMORY_AND_DISK))
    part = F.shiftright("__at", _PLACE_BITS).alias("__part")
    counts = placed.groupBy(part).agg(F.count(F.lit(1)).alias("__n"))
    # one row per partition: this running sum needs no distribution
    before = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("__part", F.coalesce(before, F.lit(0)).alias("__off"))
    local = F.col("__at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return (placed.withColumn("__part", F.shiftright("__at", _PLACE_BITS)).join(F.broadcast(offsets), "__part")
                  .withColumn(out_col, (F.col("__off") + local).cast("long"))
                  .drop("__part", "__at", "__off"))
