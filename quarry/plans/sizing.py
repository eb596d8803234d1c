"""Size checks that gate broadcasts.

A side is broadcast only after its rows and bytes are measured and found within
bounds; beyond the bound it is returned as is and the planner shuffles (with
AQE skew-join splitting hot keys).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# rows of a (id, term, count) side: about 60 bytes each, so ~120 MB at the
# largest bound; the bound used is also limited by the driver's memory
DEFAULT_BROADCAST_ROWS = 2_000_000
# driver heap per broadcast row allowed (the hashed relation is built there)
DRIVER_BYTES_PER_ROW = 4096
# bytes of a measured side that is broadcast, at most, and its share of the driver's memory
DEFAULT_BROADCAST_BYTES = 256 << 20
DRIVER_SHARE = 16


def _bytes(size: str) -> int:
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
    s = size.strip().lower().rstrip("b")
    return int(float(s[:-1]) * units[s[-1]]) if s and s[-1] in units else int(s)


def _driver_memory(spark) -> int:
    return _bytes(spark.conf.get("spark.driver.memory", "1g"))


def broadcast_rows(spark, cap: int = DEFAULT_BROADCAST_ROWS) -> int:
    """Row bound for a broadcast of short rows: ``cap``, or less on a small driver."""
    return max(1, min(cap, _driver_memory(spark) // DRIVER_BYTES_PER_ROW))


def broadcast_bytes(spark, cap: int = DEFAULT_BROADCAST_BYTES) -> int:
    """Byte bound for a measured broadcast: ``cap``, or less on a small driver."""
    return max(1, min(cap, _driver_memory(spark) // DRIVER_SHARE))


@dataclass
class Sized:
    df: DataFrame
    rows: int
    bytes: int
    broadcast: bool


def _row_bytes(df: DataFrame):
    """Bytes of a row: eight for each column, and the length of texts."""
    texts = [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in df.dtypes if kind in ("string", "binary")]
    return sum(texts, F.lit(16 + 8 * len(df.columns)).cast("long"))


def measure(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> Sized:
    """Persist ``df`` (so the measure and later joins read the same rows once)
    and sum its rows and bytes.  Persisted blocks are recomputed from lineage if lost.
    The side may be broadcast within both bounds, which default to those of the session."""
    spark = df.sparkSession
    rows_bound = broadcast_rows(spark) if max_rows is None else max_rows
    bytes_bound = broadcast_bytes(spark) if max_bytes is None else max_bytes
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    n, size = kept.agg(F.count(F.lit(1)), F.coalesce(F.sum(_row_bytes(df)), F.lit(0))).first()
    return Sized(kept, n, size, n <= rows_bound and size <= bytes_bound)


def hinted(df: DataFrame, sized: Sized) -> DataFrame:
    """Broadcast-hint a side derived from ``sized`` whose row count cannot
    exceed ``sized.rows`` (e.g. an inner join on a unique key of the other side)."""
    return F.broadcast(df) if sized.broadcast else df


# below this estimated size an input is spread over all cores before heavy
# per-row work; above it the scan already yields plenty of splits
SMALL_INPUT_BYTES = 1 << 30


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of the optimized plan (file sizes for a scan)."""
    plan = getattr(df, "_jdf", None)  # not there on a remote session
    return None if plan is None else int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))


# file bytes of text that make one task of the text stage (about twice that as text, and as many bytes
# again in the task's counts), and the number of tasks beyond which they grow instead
TEXT_TASK_BYTES = 8 << 20
MAX_TEXT_TASKS = 20_000


def input_bytes(df: DataFrame) -> int | None:
    """Bytes of the tables that ``df`` reads, by Catalyst; None where they are not known."""
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return None
    leaves = plan.queryExecution().analyzed().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return size if size < 1 << 60 else None


def text_tasks(df: DataFrame) -> int | None:
    """Partitions for the text of ``df``, whole waves of the cluster's cores; None for small inputs,
    which the session's defaults divide.  Without a number, partitions are merged to a fixed size of compressed
    text, whose counts a task may not hold in memory, and the last wave may be nearly empty."""
    size, cores = input_bytes(df), df.sparkSession.sparkContext.defaultParallelism
    if size is None or size <= TEXT_TASK_BYTES * cores:
        return None
    return min(-(-size // (TEXT_TASK_BYTES * cores)) * cores, max(MAX_TEXT_TASKS, cores))


def spread_small_input(df: DataFrame, max_bytes: int = SMALL_INPUT_BYTES) -> DataFrame:
    """Round-robin a small input over the cluster's cores.

    A small file can hold a single row group, which the scan gives to one
    task however many splits it plans; the per-row text work (regexes,
    stemming) then runs on one core.  Only inputs whose estimated size is
    within ``max_bytes`` are moved (a cheap shuffle); large inputs keep
    their scan splits and are never shuffled here.
    """
    size = estimated_bytes(df)
    if size is None or size > max_bytes:
        return df
    n = df.sparkSession.sparkContext.defaultParallelism * 2
    return df.repartition(n)
