"""Exact top-k by maximum scores of words and of blocks: the same rows as ``search.search``.

A query word held by most documents makes most documents candidates.  Here documents are scored in
full only where they can still be among the k best:

1. Words in at most ``rare_ratio`` of the documents are rare.  Their entries are summed per
   (query, document): a part of the score, so the k-th best part, theta, is at most the k-th best score.
2. Of the other words only one number per block of documents is read, the largest weight.  Their sum
   bounds what they add to any score in the block; so does the length of their part of the query
   (document vectors have length one), and the smaller bound counts.
3. A document stays if its part plus the bound of its block reaches theta; a block as a whole if the
   bound alone does.  What stays of a block is one bit per document.
4. The entries of all words are summed for those documents, and ranked.

Steps 1 and 2 are one scan of the blocked postings, whose aggregates need no exchange (blocks are
where their documents are), and whose sums are kept until step 3 is done; theta is one row per query.  The table of (query, block, bits) is measured:
within the bound it is broadcast, beyond it the join is shuffled.  No query is scored in full instead.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators import search as S
from quarry.operators.blocks import doc_id_at
from quarry.operators.index import Index
from quarry.plans import sizing

# scores are ranked after rounding to 6 digits: a full unit of the 6th digit
# lies between a bound that drops a document and theta
MARGIN = 1e-6
ALL = -1  # every bit


def _parts_and_bounds(c: S.QuerySide, rare_ratio: float) -> DataFrame:
    """(query_id, blk, off, part): per rare word's entry its part; per other word and block, with a
    null off, what it adds at most."""
    index = c.index
    n_docs = index.docs.select(F.count(F.lit(1))).scalar()
    words = sizing.hinted(c.qweights.drop("qtf").join(c.of_words(index.term_stats).select("term", "df"), "term")
                          .withColumn("rare", F.col("df") <= n_docs * rare_ratio).drop("df"), c.sized)
    rows = c.of_words(index.blocks).select("term", "blk", "offs", "nws", "maxnw").join(words, "term")
    most = F.array(F.struct(F.lit(None).cast("int").alias("offs"), F.col("maxnw").alias("nws")))
    entries = F.when(F.col("rare"), F.arrays_zip("offs", "nws")).otherwise(most)
    return (rows.select("query_id", "blk", "qw", F.explode(entries).alias("e"))
            .select("query_id", "blk", F.col("e.offs").alias("off"), (F.col("qw") * F.col("e.nws")).alias("part")))


def sums(c: S.QuerySide, rare_ratio: float = 0.2) -> DataFrame:
    """(query_id, blk, off, part): the part of a document's score, or with a null off the bound of the block."""
    rows = _parts_and_bounds(c, rare_ratio).groupBy("query_id", "blk", "off").agg(F.sum("part").alias("part"))
    return rows.join(c.qnorms, "query_id").select("query_id", "blk", "off", F.try_divide(F.col("part"), F.col("qnorm")).alias("part"))


def survivors(c: S.QuerySide, sums: DataFrame, k: int, rare_ratio: float = 0.2) -> DataFrame:
    """(query_id, blk, bits): the documents of a block that can be among the k best of a query."""
    best = Window.partitionBy("query_id").orderBy(F.col("part").desc_nulls_last())
    theta = (sums.where(F.col("off").isNotNull()).select("query_id", "part", F.row_number().over(best).alias("rank"))
             .where(F.col("rank") <= k).where(F.col("rank") == k).select("query_id", F.col("part").alias("theta")))
    # the length of the query's part that is not rare, over that of the query
    n_docs = c.index.docs.select(F.count(F.lit(1))).scalar()
    other = (c.qweights.join(c.of_words(c.index.term_stats).select("term", "df"), "term").where(F.col("df") > n_docs * rare_ratio)
             .groupBy("query_id").agg(F.sqrt(F.sum(F.col("qw") * F.col("qw"))).alias("length")))
    limits = sizing.hinted(c.qnorms.join(theta, "query_id", "left").join(other, "query_id", "left").select(
        "query_id", "theta", F.coalesce(F.try_divide(F.col("length"), F.col("qnorm")), F.lit(0.0)).alias("cut")), c.sized)
    blocks = (sums.groupBy("query_id", "blk").agg(
        F.collect_list(F.when(F.col("off").isNotNull(), F.struct("off", "part"))).alias("docs"),
        F.max(F.when(F.col("off").isNull(), F.col("part"))).alias("bound")).join(limits, "query_id"))
    least = F.col("theta") - MARGIN
    bound = F.least(F.coalesce("bound", F.lit(0.0)), F.col("cut"))
    bits = F.aggregate("docs", F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(
        F.when(x["part"] + bound >= least, _bit(x["off"])).otherwise(F.lit(0).cast("long"))))
    return blocks.select("query_id", "blk", F.when(F.col("theta").isNull() | (bound >= least), F.lit(ALL).cast("long")).otherwise(bits).alias("bits")).where("bits != 0")


def _bit(off):
    return F.call_function("shiftleft", F.lit(1).cast("long"), off)


def scored_parts(c: S.QuerySide, kept: DataFrame) -> DataFrame:
    """(query_id, blk, doc_id, part) of the entries of the documents that stay."""
    index = c.index
    rows = (c.of_words(index.blocks).select("term", "blk", "offs", "nws").join(c.qweights.drop("qtf"), "term")
            .join(kept, ["query_id", "blk"]))
    rows = rows.select("query_id", "blk", "qw", "bits", F.explode(F.arrays_zip("offs", "nws")).alias("e")).where(
        F.call_function("shiftrightunsigned", F.col("bits"), F.col("e.offs")).bitwiseAND(F.lit(1)) == 1)
    return rows.select("query_id", "blk", doc_id_at(F.col("e.offs"), index.bits).alias("doc_id"), (F.col("qw") * F.col("e.nws")).alias("part"))


def search_pruned(index: Index, queries: DataFrame, k: int = 10, rare_ratio: float = 0.2, **kw) -> DataFrame:
    """Same result as ``search.search`` (query_id, rank, doc_id, score)."""
    if index.bits > 6:
        raise ValueError("a block's documents must fit the bits of a long")
    c = S.QuerySide(index, queries, **kw)
    if not index.stored:
        # read twice, and only the rows of query words
        asked = sizing.hinted(c.qtf.select("term").distinct(), c.sized)
        c.index = replace(index, blocks=index.blocks.join(asked, "term", "left_semi").persist(StorageLevel.MEMORY_AND_DISK))
    found = sums(c, rare_ratio).persist(StorageLevel.MEMORY_AND_DISK)
    kept = sizing.measure(survivors(c, found, k, rare_ratio), c.max_rows)
    found.unpersist()
    return S.rank_top_k(S._scores(S._dots(scored_parts(c, sizing.hinted(kept.df, kept))), c.qnorms), k)
