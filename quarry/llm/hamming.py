"""Exact top-k of binary codes under Hamming distance, by multi-index hashing.

A vector's code is the signs of its components, in 64-bit words. An index block holds up to
`block_rows` distinct codes, cut into segments; each segment has a table from its value to the codes
that have it. A query grows its search radius step by step: at step (r, s) it looks up, in segment
s, all values at distance exactly r from its own, and verifies the codes found by full Hamming
distance. After step (r, s) of m segments every code at distance below m * r + s + 1 has been seen,
so the search ends as soon as the k-th verified distance is below that bound.

Scale: queries (in chunks) meet index blocks, a stated query set against all rows in blocks; each
(chunk, block) pair is one bounded group, its best k are found there exactly, and a window with a
group limit merges them. Rows with one code are an equivalence class: only its k smallest ids can
ever be returned, so at most k rows of a code enter the index, whatever the number of copies, and
equal query codes are searched once.

Defined cases: null vectors and vectors of a length other than `dims` have no code and are left out
(as rows and as queries); ties go to the smaller id; a row is its own neighbour at distance 0; with
fewer than k rows all are returned; empty tables give an empty result; other columns are left out.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.shared import write_shared


def sign_codes(rows: DataFrame, key: str, vector: str, dims: int) -> DataFrame:
    """(id, code): bit j of word j / 64 is set where component j is above 0."""
    words = [sum((F.when(F.get(vector, F.lit(j)) > 0, F.lit((1 << j % 64) - (1 << 64 if j % 64 == 63 else 0)))
                  .otherwise(F.lit(0)).cast("long") for j in range(w, min(w + 64, dims))), F.lit(0).cast("long"))
             for w in range(0, dims, 64)]
    return rows.where(F.size(vector) == dims).select(F.col(key).alias("id"), F.array(*words).alias("code"))


class Index:
    """Segment tables of a block of codes: codes is (n, words) uint64."""

    def __init__(self, codes: np.ndarray, bits: int, segments: int):
        self.codes, self.bits, self.m = codes, bits, segments
        edges = [bits * i // segments for i in range(segments + 1)]
        self.cuts = list(zip(edges[:-1], edges[1:], strict=True))
        self.tables = []
        for cut in self.cuts:
            value = self.segment(codes, cut)
            order = np.argsort(value, kind="stable")
            starts = np.searchsorted(value[order], np.arange((1 << (cut[1] - cut[0])) + 1))
            self.tables.append((order, starts))

    @staticmethod
    def segment(codes: np.ndarray, cut: tuple[int, int]) -> np.ndarray:
        low, high = cut
        word, shift = low // 64, np.uint64(low % 64)
        value = codes[:, word] >> shift
        if high > 64 * (word + 1):
            value = value | codes[:, word + 1] << np.uint64(64 * (word + 1) - low)
        return (value & np.uint64((1 << (high - low)) - 1)).astype(np.int64)

    def search(self, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, code, distance): for each query every code within its k-th smallest distance."""
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        count = np.zeros((len(queries), self.bits + 1), dtype=np.int64)  # verified codes by distance
        seen = np.zeros((len(queries), len(self.codes)), dtype=bool)
        active = np.arange(len(queries))
        k = min(k, len(self.codes))
        for r in range(max(b - a for a, b in self.cuts) + 1):
            for s, cut in enumerate(self.cuts):
                width = cut[1] - cut[0]
                if r <= width and len(active):
                    masks = np.array([sum(1 << j for j in c) for c in combinations(range(width), r)], dtype=np.int64)
                    order, starts = self.tables[s]
                    own = self.segment(queries[active], cut)
                    for at in range(0, len(active), 64):
                        q = active[at:at + 64]
                        value = own[at:at + 64, None] ^ masks
                        first, size = starts[value], starts[value + 1] - starts[value]
                        total = size.sum(axis=1)
                        row = np.repeat(q, total)
                        first, size = first.ravel(), size.ravel()
                        head = np.cumsum(size) - size
                        c = order[np.repeat(first - head, size) + np.arange(int(size.sum()))]
                        new = ~seen[row, c]
                        row, c = row[new], c[new]
                        seen[row, c] = True
                        distance = np.bitwise_count(queries[row] ^ self.codes[c]).sum(axis=1).astype(np.int64)
                        np.add.at(count, (row, distance), 1)
                        found.append((row, c, distance))
                covered = self.m * r + s  # all codes at this distance or nearer have been seen
                near = count[active, :covered + 1].sum(axis=1)
                active = active[near < k]
            if not len(active):
                break
        row, c, distance = (np.concatenate(x) for x in zip(*found, strict=True))
        kth = (count.cumsum(axis=1) >= k).argmax(axis=1)
        keep = distance <= kth[row]
        return row[keep], c[keep], distance[keep]


def top_k(rows: DataFrame, queries: DataFrame, k: int = 10, dims: int = 64, segments: int = 6, key: str = "vec_id",
          vector: str = "embedding", block_rows: int = 16_384, chunk: int = 512) -> DataFrame:
    """(query_id, rank, neighbour_id, distance): the k nearest rows of each query, exactly."""
    first = Window.partitionBy("code").orderBy("id")
    kept = sign_codes(rows, key, vector, dims).withColumn("n", F.row_number().over(first)).where(f"n <= {k}").drop("n")
    kept = write_shared(kept, "codes")  # at most k rows of each code
    asked = write_shared(sign_codes(queries, key, vector, dims), "queries")
    distinct = kept.select("code").distinct()
    blocks = max(1, math.ceil(kept.count() / block_rows))
    chunks = max(1, math.ceil(asked.count() / chunk))
    index = (distinct.withColumn("block", F.pmod(F.xxhash64("code"), F.lit(blocks)).cast("int"))
             .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))).withColumn("is_query", F.lit(False)))
    ask = (asked.select("code").distinct().withColumn("chunk", F.pmod(F.xxhash64("code", F.lit(1)), F.lit(chunks)).cast("int"))
           .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("is_query", F.lit(True)))

    def run(cell: pa.Table) -> pa.Table:
        is_query = cell["is_query"].to_numpy()
        words = -(-dims // 64)
        code = cell["code"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, words)
        q, codes = code[is_query], code[~is_query]
        if not len(q) or not len(codes):
            return pa.table({"query": pa.array([], pa.list_(pa.int64())), "code": pa.array([], pa.list_(pa.int64())), "distance": pa.array([], pa.int32())})
        row, c, distance = Index(codes, dims, segments).search(q, k)
        lists = lambda x: pa.array(list(np.ascontiguousarray(x).view(np.int64)), pa.list_(pa.int64()))
        return pa.table({"query": lists(q[row]), "code": lists(codes[c]), "distance": pa.array(distance, pa.int32())})

    cells = index.select("block", "chunk", "code", "is_query").union(ask.select("block", "chunk", "code", "is_query"))
    near = cells.groupBy("block", "chunk").applyInArrow(run, "query array<long>, code array<long>, distance int")
    # ids of the codes found (at most k each), then the best k of each query code, then the queries with that code
    with_ids = near.join(kept, "code").select("query", "id", "distance")
    best = Window.partitionBy("query").orderBy("distance", "id")
    top = with_ids.withColumn("rank", F.row_number().over(best)).where(f"rank <= {k}")
    return (asked.join(top.withColumnRenamed("id", "neighbour_id"), F.col("code") == F.col("query"))
            .select(F.col("id").alias("query_id"), "rank", "neighbour_id", "distance"))
