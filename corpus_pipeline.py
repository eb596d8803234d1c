"""The corpus pipeline: toxic documents go, low-quality documents go, one document of each
near-duplicate group stays, repeated passages go, and what is left is packed into sequences.

Each stage takes (spark, docs, sf_dir) and returns the documents that it kept, with the columns of
`documents`; the last one returns the packed pieces. Between stages the rows are written as Parquet in
the cluster's shared folder and read again. A null in any column is allowed: the operators define what
they do with it, and rows are never lost for it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import ngram_join, packing, quality, substring, toxicity
from quarry.llm.queries import fold
from quarry.llm.shared import write_shared

#: Toxicity and packing have no SQL form; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half; labels are learned outside fold 0."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.clean(docs, toxicity.fit(docs, labels, fold() != 0))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and their host's verdict keep."""
    return quality.clean(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a Jaccard similarity of 0.8 on five-word shingles, the row with the smallest id (copies in one id count once)."""
    return ngram_join.firsts(docs, n=5, percent=80)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of 13-word windows that a smaller id has too; others stay as they were."""
    other = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    cut = substring.dedup(docs, window=13, keep=(*other, "n_chars"), as_is=True)
    return (cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("n_chars")))
            .withColumnRenamed("kept", "text").select(*docs.columns))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of at most 2048 tokens."""
    return packing.pack(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_low_quality),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, applied to the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = write_shared(stage(spark, docs, sf_dir), name)
    return docs
