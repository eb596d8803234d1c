"""Tables in the cluster's shared folder, bounded key filters, and connected components."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_NO_KEY = 2**63 - 1


def to_key(column: str) -> Column:
    """A key column as a long that is never null: rows without a key get the largest one."""
    return F.coalesce(F.col(column).cast("long"), F.lit(_NO_KEY))


def from_key(column: str) -> Column:
    """The key as it was: null again where there was none."""
    return F.nullif(F.col(column), F.lit(_NO_KEY))


_HELD: dict[str, object] = {}
try:
    _TRIM = ctypes.CDLL(None).malloc_trim
except (OSError, AttributeError):  # another C library
    _TRIM = None


def held(name: str, make: Callable[[], object]) -> object:
    """What a worker keeps from task to task of one operator under `name`; see `in_arrow`."""
    if name not in _HELD:
        _HELD[name] = make()
    return _HELD[name]


def _begin(keep: str) -> None:
    for name in [n for n in _HELD if not keep or not n.startswith(keep)]:
        del _HELD[name]


def give_back() -> None:
    """What a worker no longer uses goes back to the system."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def _released(run: Callable, keep: str) -> Callable:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _begin(keep)
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def in_arrow(df: DataFrame, run: Callable, schema, keep: str = "") -> DataFrame:
    """mapInArrow, but a worker's memory goes back to the system when a task ends, and what other
    operators hold in it goes when a task begins: idle workers share an executor's memory with others.
    keep: how the names of what this operator holds begin."""
    return df.mapInArrow(_released(run, keep), schema)


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; one of our own only in local mode where that is unset (tests)."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if folder is None and not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    if folder is None:
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="quarry-checkpoint-"))
        folder = sc.getCheckpointDir()
    return folder.rstrip("/")


def write_shared(df: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """The frame written once as Parquet in the shared folder, and read back: lineage is cut,
    and a lost executor costs a re-read only. by: columns that get a folder for each value."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/quarry-{uuid.uuid4().hex}/{name}"
    df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class KeyFilter:
    """Bitmap over the top bits of 64-bit keys: a set of fixed size (2**bits / 8 bytes), so it
    may be broadcast whatever the number of keys. It lets every added key through and some
    others; users must treat it as a pre-filter, never as the answer."""

    def __init__(self, shared: Broadcast, bits: int):
        self.shared, self.bits = shared, bits

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slot = keys.astype(np.uint64, copy=False) >> np.uint64(64 - self.bits)
        words = self.shared.value
        return (words[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def key_filter(keys: DataFrame, column: str, bits: int = 26) -> KeyFilter:
    """Filter of all keys of a column (long). The driver gets 2**bits / 64 rows at most."""
    slot = F.shiftrightunsigned(F.col(column), 64 - bits)
    rows = (keys.select(slot.alias("slot"))
            .groupBy(F.shiftrightunsigned("slot", 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits")).toArrow())
    words = np.zeros(1 << (bits - 6), dtype=np.uint64)
    words[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return KeyFilter(keys.sparkSession.sparkContext.broadcast(words), bits)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node of each connected component, for every node that has an edge.

    edges: two long columns a, b. Alternating large-star and small-star steps; each step joins the
    edges with one minimum per node (a partial aggregate, so a hub of any size is no hot task, and
    the join may be split by AQE). Each round is written to the shared folder.
    """
    def smallest(df: DataFrame) -> DataFrame:  # of each node u and its neighbours v
        return df.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))

    now = write_shared(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                       .where("u != v").distinct(), "edges-0")
    before = None
    for i in range(1, rounds):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.join(smallest(both), "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct())
        # small-star: a node's neighbours that are smaller than it, and itself, go to their minimum
        least = smallest(large)
        small = (large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct())
        now = write_shared(small, f"edges-{i}")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    stars = now.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    roots = stars.select(F.col("component").alias("node"), "component").distinct()
    return stars.union(roots)
