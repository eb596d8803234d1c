"""T5 as a stored dictionary: each distinct surface word is stemmed once, and tokens look it up.

A dictionary has one row per surface word: ``surface, term, n``, n being how often the word was met.
On storage it is a Parquet table that is only ever appended to, one set of rows per batch of documents
(the words of the batch with their counts there), so a repeated or lost write cannot change a stem; reading
adds the counts up.  The words of a new batch are joined with what is stored, and the stem rules run
for the words that are not there.

Tokens meet the dictionary by surface word.  It is measured: within the bound it is broadcast, and no
token moves.  Beyond it the counts tell the frequent words: those with n >= h = (all counts) / bound are
at most ``bound`` words whatever the data, are broadcast, and hold most tokens; tokens of other words,
none of which has more than h tokens in the counted batches, are shuffled by word.

Defined cases: a word that the dictionary lacks is stemmed where it is met; a null word stays null;
an empty dictionary stems every token in place; rows of one surface have one stem, so the least is taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.plans import sizing

DDL = "surface STRING, term STRING, n BIGINT"


def surface_counts(toks: DataFrame, word: str = "surface") -> DataFrame:
    """(surface, n) of a table of lower-cased tokens, by partial aggregates."""
    return toks.where(F.col(word).isNotNull()).groupBy(F.col(word).alias("surface")).agg(F.count(F.lit(1)).alias("n"))


def stem_dictionary(counts: DataFrame, known: DataFrame | None = None, mode: str = "porter") -> DataFrame:
    """(surface, term, n) for (surface, n): words of ``known`` keep their stored stem, the others are stemmed."""
    if known is None:
        return T.stem_column(counts, "surface", "term", mode).select("surface", "term", "n")
    stored = known.select("surface", F.col("term").alias("stored"))
    found = counts.join(stored, "surface", "left")
    return found.select("surface", F.coalesce("stored", T.stem_expr("surface", mode)).alias("term"), "n")


def extend_stored(path: str, counts: DataFrame, mode: str = "porter") -> None:
    """Append the words of a batch of documents to the dictionary at ``path`` (shared storage)."""
    rows = stem_dictionary(counts, load_stored(counts.sparkSession, path, mode), mode)
    rows.write.mode("append").parquet(f"{path}/{mode}")


def load_stored(spark: SparkSession, path: str, mode: str = "porter") -> DataFrame:
    """The dictionary at ``path``: one row per surface word; empty where nothing was written."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{mode}")
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], DDL)
    return spark.read.schema(DDL).parquet(f"{path}/{mode}").groupBy("surface").agg(F.min("term").alias("term"), F.sum("n").alias("n"))


def stem_by_dictionary(toks: DataFrame, dictionary: DataFrame, src: str = "surface", dst: str = "term",
                       mode: str = "porter", max_rows: int | None = None) -> DataFrame:
    """``toks`` with the stem of ``src`` as ``dst``, looked up in ``dictionary``."""
    sized = sizing.measure(dictionary.select(F.col("surface").alias(src), F.col("term").alias("__stem"), "n"), max_rows)
    stem = F.coalesce("__stem", T.stem_expr(src, mode)).alias(dst)
    columns = [F.col(c) for c in toks.columns if c != dst]
    words = sized.df.drop("n")
    if sized.broadcast:
        return toks.join(F.broadcast(words), src, "left").select(*columns, stem)
    bound = sizing.broadcast_rows(toks.sparkSession) if max_rows is None else max(1, max_rows)
    h = sized.df.select(F.greatest(F.lit(1), F.ceil(F.sum("n") / bound))).scalar()
    often = sized.df.where(F.col("n") >= h).drop("n")
    hot = toks.join(F.broadcast(often), src).select(*columns, stem)
    rest = toks.join(F.broadcast(often.select(src)), src, "left_anti")
    return hot.unionByName(rest.join(sized.df.where(F.col("n") < h).drop("n"), src, "left").select(*columns, stem))
