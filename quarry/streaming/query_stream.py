"""Queries arriving over time, answered against a stored index.

The reference answers one typed query at a time in a loop.  Here queries
land as files in a folder; Structured Streaming picks up each new batch and
``foreachBatch`` runs the same set-at-a-time search on it.  Each micro-batch
writes its hits to ``out/batch=<id>`` with overwrite, so a batch replayed
after a failure replaces its own output instead of adding duplicates; the
checkpoint records which files were consumed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quarry.operators import search as S
from quarry.sources.store import load_index

QUERY_SCHEMA = "query_id long, text string"


def answer_batches(index_dir: str, out_dir: str, k: int = 10):
    """The foreachBatch function: search one micro-batch of queries."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        index = load_index(spark, index_dir)
        qs = S.QuerySide(index, batch.select("query_id", "text"))
        try:
            hits = S.rank_top_k(S.cosine_scores(index, qs), k)
            (hits.withColumn("answered_batch", F.lit(batch_id).cast("long"))
                 .write.mode("overwrite").parquet(f"{out_dir}/batch={batch_id}"))
        finally:
            qs.release()

    return run


def start_query_stream(spark: SparkSession, query_dir: str, index_dir: str, out_dir: str,
                       checkpoint_dir: str, k: int = 10, available_now: bool = False,
                       max_files_per_trigger: int | None = None) -> StreamingQuery:
    reader = spark.readStream.schema(QUERY_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(query_dir)
    writer = (stream.writeStream.foreachBatch(answer_batches(index_dir, out_dir, k))
              .option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="2 seconds")
    return writer.start()
