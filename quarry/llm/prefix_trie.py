"""Prefix trie of conversations: one row per distinct sequence of first turns, with its members.

Method. A turn is a 24-byte element (128 bits of the SHA-256 of role and text, and the text's length),
a conversation the byte string of its elements. The distinct strings are sorted; the LCPs of neighbours
(in turns) go into a sparse table of range minima. A prefix of depth d of the string at place i is a
node; by binary descent over the table its members' left and right extents are found independently of
each other and of all other nodes, without a stack: the places around i that no LCP below d parts. A
second table gives the smallest member of an extent, a running sum the number of members.

Scale. The strings are sorted by range over all partitions and searched in blocks of about `block`
elements, so a task holds one block. A node whose extent goes over the end of a block is found by
several blocks, which agree on its key (a hash of the prefix): an aggregate by key adds them up, and
that is the only thing that a prefix shared by a third of all conversations costs. Subtree sums are
differences of running sums in the order of (first place, depth), in which a subtree is one stretch:
running sums by partition, plus one row per partition. Children that look for a parent with more than
1 in `share` of all nodes meet it in a broadcast of at most `share` rows. Texts do not move, only
elements do. Equal strings are one row with a count before they are sorted. The conversations that end
in a node are joined to text in ranges of (node, conv_id), so a large group is joined in pieces;
SHA-256 can only be taken of one text by one task, which reads those pieces as a stream.
A conversation's elements are one row: 24 bytes for each turn.

Defined cases: a null role or text is empty; null turns come first, turns of equal number are ordered
by role and text digest; repeated rows are turns of their own; rows without conv_id belong to no
conversation and are left out; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.shared import in_arrow, write_shared

WIDTH = 24  # bytes of an element: digest, length


def turns(rows: DataFrame) -> DataFrame:
    """(conv_id, spot, element): the turns in order, from 1; the element as hexadecimal digits."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       text("role").alias("role"), text("text").alias("text")).where("conv_id is not null")
    both = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    element = F.concat(F.substring(F.sha2(both.cast("binary"), 256), 1, 32), F.lpad(F.lower(F.hex(F.octet_length("text").cast("long"))), 16, "0"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "element")
    return rows.select("conv_id", "turn", element.alias("element")).select("conv_id", F.row_number().over(order).alias("spot"), "element")


def rebuilt(found: DataFrame, ids: DataFrame, period: int = 5, heads: int = 9) -> DataFrame:
    """(conv_id, spot, element) where the first h turns of conversation c are those of c - c % period,
    h = crc32(c) % heads; own turns follow after the first h. `found` are the turns(), ids all conv_id."""
    head = lambda c: F.crc32(F.col(c).cast("string").cast("binary")) % heads
    own = found.where(F.col("spot") > head("conv_id"))
    base = found.where((F.col("conv_id") % period == 0) & (F.col("spot") < heads)).withColumnRenamed("conv_id", "base")
    lent = (ids.select("conv_id", (F.col("conv_id") - F.col("conv_id") % period).alias("base"))
            .join(base, "base").where(F.col("spot") <= head("conv_id")).select("conv_id", "spot", "element"))
    return own.unionByName(lent)


def strings(found: DataFrame, ids: DataFrame) -> DataFrame:
    """(conv_id, seq) for every id: the elements of its turns as one byte string."""
    marks = ids.select("conv_id", F.lit(0).alias("spot"), F.lit("").alias("element"))
    return (found.unionByName(marks).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("spot", "element"))).alias("all"))
            .select("conv_id", F.unhex(F.array_join(F.col("all.element"), "")).alias("seq")))


def _ranges(first: np.ndarray, op) -> list[np.ndarray]:
    """Sparse table: at level k the op of 2**k values from each place on."""
    table = [first]
    while len(table[-1]) > 1 << len(table) - 1:
        half = 1 << len(table) - 1
        table.append(op(table[-1][:-half], table[-1][half:]))
    return table


def _extents(table: list[np.ndarray], place: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of each prefix: the runs around `place` in which every LCP is at least `depth`.
    table[0][j] is the LCP of j and j - 1 (-1 at 0)."""
    n = len(table[0])
    left, right = place.copy(), place.copy()
    for k in range(len(table) - 1, -1, -1):
        row, step = table[k], 1 << k
        # the step LCPs that end at `left`, and those that begin after `right`
        at = left - step + 1
        ok = (at >= 0) & (row[np.maximum(at, 0)] >= depth)
        left = np.where(ok, at - 1, left)
        at = right + 1
        ok = (at + step <= n) & (row[np.minimum(at, len(row) - 1)] >= depth)
        right = np.where(ok, at + step - 1, right)
    return left, right


def _least(table: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    out = np.empty(len(left), dtype=np.int64)
    level = np.floor(np.log2(right - left + 1)).astype(np.int64)
    for k in np.unique(level):
        i = level == k
        out[i] = np.minimum(table[k][left[i]], table[k][right[i] - (1 << k) + 1])
    return out


def _lcps(parts: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """LCP of each string with the one before it; parts: the elements of all strings, a row of three words each."""
    both = np.minimum(size[1:], size[:-1])
    out = np.full(len(size), -1, dtype=np.int64)
    out[1:] = both
    row = np.repeat(np.arange(1, len(size)), both)
    if len(row):
        step = np.arange(len(row)) - np.repeat(np.cumsum(both) - both, both)
        differ = np.flatnonzero((parts[start[row] + step] != parts[start[row - 1] + step]).any(axis=1))
        rows, first = np.unique(row[differ], return_index=True)
        out[rows] = step[differ[first]]
    return out


_NODE = [("key", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("n", pa.int64()), ("conv", pa.int64()),
         ("low", pa.int64()), ("high", pa.int64()), ("bytes", pa.int64())]


def _hash(data: bytes):
    return hashlib.blake2b(data, digest_size=16)


def _nodes(seqs: list[bytes], count: np.ndarray, conv: np.ndarray, place: int) -> Iterator[pa.RecordBatch]:
    """The nodes of one block of sorted strings; its first string has the place `place`."""
    size = np.array([len(s) // WIDTH for s in seqs], dtype=np.int64)
    start = np.cumsum(size) - size
    parts = np.frombuffer(b"".join(seqs), dtype=np.uint64).reshape(-1, WIDTH // 8) if size.any() else np.zeros((0, 3), np.uint64)
    lcp = _lcps(parts, start, size)
    # candidates: the prefixes of each string that the string before it does not have
    fresh = size - lcp
    at = np.repeat(np.arange(len(seqs)), fresh)
    depth = np.arange(len(at)) - np.repeat(np.cumsum(fresh) - fresh, fresh) + lcp[at] + 1
    low, high = _extents(_ranges(lcp, np.minimum), at, depth)
    members = np.concatenate([[0], np.cumsum(count)])
    least = _least(_ranges(conv, np.minimum), low, high)
    last = parts[np.maximum(start[at] + depth - 1, 0), 2].byteswap().astype(np.int64) if len(parts) else np.zeros(len(at), np.int64)
    keys, parents = [], []
    for i, s in enumerate(seqs):
        d = int(lcp[i]) + 1
        hasher = _hash(s[:max(0, d - 1) * WIDTH])
        before = hasher.digest() if d else None
        for d in range(d, int(size[i]) + 1):
            if d:
                hasher.update(s[(d - 1) * WIDTH:d * WIDTH])
            parents.append(before)
            before = hasher.digest()
            keys.append(before)
    columns = [pa.array(keys, pa.binary()), pa.array(parents, pa.binary()), depth, members[high + 1] - members[low], least,
               place + low, place + high, np.where(depth > 0, last, 0)]
    batch = pa.record_batch([pa.array(c) for c in columns], [n for n, _ in _NODE])
    for i in range(0, batch.num_rows, 50_000):
        yield batch.slice(i, 50_000)


def _found(block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, seqs, count, conv, held = TaskContext.get().partitionId() << 40, [], [], [], 0
        for batch in batches:
            for s, n, c in zip(*(batch.column(x).to_pylist() for x in ("seq", "n", "conv")), strict=True):
                if seqs and held + len(s) // WIDTH > block:
                    yield from _nodes(seqs, np.array(count), np.array(conv), place)
                    place, seqs, count, conv, held = place + len(seqs), [], [], [], 0
                seqs.append(s)
                count.append(n)
                conv.append(c)
                held += len(s) // WIDTH + 1
        if seqs:
            yield from _nodes(seqs, np.array(count), np.array(conv), place)

    return run


def trie(seqs: DataFrame, block: int = 100_000, share: int = 1000) -> DataFrame:
    """The nodes of the trie of the strings (conv_id, seq): key, conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens."""
    distinct = seqs.groupBy("seq").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv"))
    found = (distinct.repartitionByRange("seq").sortWithinPartitions("seq")
             .transform(in_arrow, _found(block), "key binary, parent binary, depth long, n long, conv long, low long, high long, bytes long"))
    nodes = write_shared(found.groupBy("key", "parent", "depth", "bytes").agg(
        F.sum("n").alias("n"), F.min("conv").alias("conv"), F.min("low").alias("low"), F.max("high").alias("high")), "trie-nodes")
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = write_shared(nodes.withColumn("leaf", (F.col("n_children") == 0).cast("long")).withColumn("own", (F.col("n") - 1) * F.col("bytes"))
                         .withColumn("part", F.shiftright("low", 40)), "trie-counted")
    # at most `share` nodes have more than a 1 / share of all nodes as children
    wide = max(1, nodes.count() // share)
    parents = nodes.where("n_children > 0").select(F.col("key").alias("parent"), F.col("conv").alias("parent_conv_id"), "n_children")
    few = F.broadcast(parents.where(F.col("n_children") > wide).select("parent", F.col("parent_conv_id").alias("wide_conv")))
    with_parent = (nodes.join(few, "parent", "left")
                   .withColumn("ask", F.when(F.col("wide_conv").isNull(), F.col("parent")).otherwise(F.concat("key", F.lit(b"-"))))  # meets nothing
                   .join(parents.where(F.col("n_children") <= wide).select(F.col("parent").alias("ask"), "parent_conv_id"), "ask", "left")
                   .withColumn("parent_conv_id", F.coalesce("wide_conv", "parent_conv_id")))
    # running sums in the order of (low, depth)
    parts = nodes.groupBy("part").agg(F.sum("leaf").alias("leaf"), F.sum("own").alias("own"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition of the sorted strings
    offsets = parts.select("part", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("leaf", "own")))
    run = Window.partitionBy("part").orderBy("low", "depth").rowsBetween(Window.unboundedPreceding, 0)
    summed = (with_parent.select("*", F.sum("leaf").over(run).alias("leaf_sum"), F.sum("own").over(run).alias("own_sum"))
              .join(F.broadcast(offsets), "part")
              .withColumn("leaf_sum", F.col("leaf_sum") + F.col("leaf_before")).withColumn("own_sum", F.col("own_sum") + F.col("own_before")))
    summed = write_shared(summed, "trie-summed")
    # the sums after the last node that begins at a place: every place has one, that of its whole string
    ends = summed.groupBy(F.col("low").alias("high")).agg(F.max("leaf_sum").alias("leaf_end"), F.max("own_sum").alias("own_end"))
    return summed.join(ends, "high").select(
        "key", F.col("conv").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children",
        (F.col("leaf_end") - F.col("leaf_sum") + F.col("leaf")).alias("n_leaves"),
        (F.col("own_end") - F.col("own_sum") + F.col("own")).alias("saved_tokens"))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, conv_id) rows of a range: the ids of each key as text, in pieces of a bounded number."""
    place, key, held, low = TaskContext.get().partitionId() << 40, None, [], 0

    def piece() -> pa.RecordBatch:
        return pa.record_batch([pa.array([key], pa.binary()), pa.array([place], pa.int64()), pa.array([",".join(map(str, held))])], ["key", "place", "ids"])

    out, size = [], 0
    for batch in batches:
        for k, c in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
            if held and (k != key or len(held) == 4096):
                out.append(piece())
                size += len(held)
                place += 1
                held = []
                if size > 50_000:
                    yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
                    out, size = [], 0
            key = k
            held.append(c)
    if held:
        out.append(piece())
    if out:
        yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, hasher, keys, out = None, None, [], []

    def rows() -> pa.RecordBatch:
        return pa.record_batch([pa.array(keys, pa.binary()), pa.array(out, pa.string())], ["key", "ends_sha256"])

    for batch in batches:
        for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if k != key:
                if key is not None:
                    keys.append(key)
                    out.append(hasher.hexdigest())
                key, hasher = k, hashlib.sha256(ids.encode())
            else:
                hasher.update(b"," + ids.encode())
        if len(keys) > 10_000:
            yield rows()
            keys, out = [], []
    if key is not None:
        keys.append(key)
        out.append(hasher.hexdigest())
    if keys:
        yield rows()


def ends(seqs: DataFrame) -> DataFrame:
    """(key, ends_sha256) of the nodes in which conversations end: the hash of their ids, ascending, joined by commas."""
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([pa.array([_hash(s).digest() for s in batch.column("seq").to_pylist()], pa.binary()), batch.column("conv_id")], ["key", "conv_id"])

    pieces = (seqs.transform(in_arrow, keyed, "key binary, conv_id long").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
              .transform(in_arrow, _joined, "key binary, place long, ids string"))
    return (pieces.repartition("key").sortWithinPartitions("key", "place").transform(in_arrow, _hashed, "key binary, ends_sha256 string"))


def prefix_trie(rows: DataFrame, block: int = 100_000, share: int = 1000) -> DataFrame:
    """The trie of the rebuilt conversations, one row per node."""
    ids = rows.select(F.col("conv_id").cast("long").alias("conv_id")).where("conv_id is not null").distinct()
    seqs = write_shared(strings(rebuilt(turns(rows), ids), ids), "conversation-strings")
    none = hashlib.sha256(b"").hexdigest()
    return trie(seqs, block, share).join(ends(seqs), "key", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))
