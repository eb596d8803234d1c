"""Blocked postings: the entries of a word in a block of documents as one row.

A block is 2**bits consecutive document ids, ``blk = doc_id >> bits``, so a row holds at most 2**bits
entries whatever the word, and block numbers need no global numbering.  Columns: ``blk, term, idf, n,
first_id, last_id, offs`` (ids as offsets in the block, ascending), ``tfs, nws`` (counts and
normalised weights in the same order) and ``maxnw``, the largest weight, which bounds what the word
can add to any score in the block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 5
BLOCKS_DDL = ("blk BIGINT, term STRING, idf DOUBLE, n INT, first_id BIGINT, last_id BIGINT, "
              "offs ARRAY<INT>, tfs ARRAY<BIGINT>, nws ARRAY<DOUBLE>, maxnw DOUBLE")


# the block of rows without an id (no id lies there: a block number has at most 64 - bits bits)
NO_BLOCK = -(1 << 63)


def block_of(doc_id: Column | str, bits: int = BLOCK_BITS) -> Column:
    return F.coalesce(F.shiftright(doc_id, bits), F.lit(NO_BLOCK))


def block_postings(weights: DataFrame, bits: int = BLOCK_BITS) -> DataFrame:
    """The blocks of weights (term, doc_id, tf, idf, nw)."""
    if "blk" not in weights.columns:
        weights = weights.withColumn("blk", block_of("doc_id", bits))
    entry = F.struct("doc_id", "tf", "nw")
    rows = weights.groupBy("blk", "term").agg(F.max("idf").alias("idf"), F.sort_array(F.collect_list(entry)).alias("p"), F.max("nw").alias("maxnw"))
    return rows.select(
        "blk", "term", "idf", F.size("p").alias("n"), F.get("p", F.lit(0))["doc_id"].alias("first_id"),
        F.get("p", F.size("p") - 1)["doc_id"].alias("last_id"),
        F.transform("p", lambda x: (x["doc_id"] - F.shiftleft(F.col("blk"), bits)).cast("int")).alias("offs"),
        F.col("p.tf").alias("tfs"), F.col("p.nw").alias("nws"), "maxnw")


def doc_id_at(off: Column | str, bits: int) -> Column:
    return F.shiftleft(F.col("blk"), bits) + (F.col(off) if isinstance(off, str) else off)


def posting_rows(blocks: DataFrame, bits: int = BLOCK_BITS) -> DataFrame:
    """(term, doc_id, tf, w, nw, blk): one row per entry again."""
    rows = blocks.select("blk", "term", "idf", F.explode(F.arrays_zip("offs", "tfs", "nws")).alias("e"))
    return rows.select("term", doc_id_at(F.col("e.offs"), bits).alias("doc_id"), F.col("e.tfs").alias("tf"),
                       (F.col("e.tfs") * F.col("idf")).alias("w"), F.col("e.nws").alias("nw"), "blk")
