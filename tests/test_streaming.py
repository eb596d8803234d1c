"""Queries arriving as files, answered batch by batch against a stored index."""

import os

from quarry.operators import index as I
from quarry.operators import search as S
from quarry.sources.store import save_index
from quarry.streaming.query_stream import start_query_stream


def test_query_stream(spark, tmpdir_path):
    docs = spark.createDataFrame([(1, "apple banana apple"), (2, "banana cherry"), (3, "cherry pie")],
                                 "doc_id long, text string")
    idx_dir = os.path.join(tmpdir_path, "idx")
    save_index(I.build_index(docs), idx_dir)
    qdir = os.path.join(tmpdir_path, "queries")
    q1 = spark.createDataFrame([(1, "apple")], "query_id long, text string")
    q2 = spark.createDataFrame([(2, "cherry pie"), (3, "durian")], "query_id long, text string")
    q1.write.parquet(os.path.join(qdir, "a"))
    q2.write.parquet(os.path.join(qdir, "b"))
    out = os.path.join(tmpdir_path, "hits")
    sq = start_query_stream(spark, qdir + "/*", idx_dir, out, os.path.join(tmpdir_path, "ckpt"),
                            available_now=True, max_files_per_trigger=1)
    sq.awaitTermination(120)
    got = sorted((r.query_id, r.rank, r.doc_id, r.score) for r in spark.read.parquet(out).collect())
    want = sorted(tuple(r) for r in S.search(I.build_index(docs), q1.unionByName(q2)).collect())
    assert got == want
