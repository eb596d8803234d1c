"""The physical plans keep the shape the design relies on."""

import contextlib
import io
import os
import re

from pyspark.sql import functions as F

from quarry.operators import index as I
from quarry.operators import search as S
from quarry.plans.registry import QUERIES, query_table
from quarry.sources.store import load_index, save_index

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_query_step_plan(spark, tmpdir_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    save_index(I.build_index(docs), os.path.join(tmpdir_path, "idx"))
    idx = load_index(spark, os.path.join(tmpdir_path, "idx"))
    p = plan(S.search(idx, query_table(spark, SF), k=10))
    # query side broadcast, weights scanned with only the needed columns, no
    # shuffle join of the weights, partial top-k before the shuffle, pruning
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    assert "ReadSchema: struct<blk:bigint,term:string,offs:array<int>,nws:array<double>>" in p
    assert p.count("WindowGroupLimit") >= 2
    # document-partitioned index: the (query, document) sums need no exchange
    assert "Bucketed: true" in p
    assert not re.search(r"hashpartitioning\(query_id#\d+L?, blk", p)


def jobs(spark, name, run) -> int:
    """Spark jobs that a call starts."""
    sc = spark.sparkContext
    sc.setJobGroup(name, name)
    try:
        run()
        return len(sc.statusTracker().getJobIdsForGroup(name))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_build_is_lazy(spark):
    """No job runs while the index is planned; a search runs jobs over the queries only."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    made = []
    assert jobs(spark, "build", lambda: made.append(I.build_index(docs))) == 0
    stored = lambda: len(spark.sparkContext._jsc.sc().getRDDStorageInfo())
    before = stored()
    assert jobs(spark, "search", lambda: S.search(made[0], query_table(spark, SF))) <= 4
    assert stored() <= before + 1  # the counted query side; no posting was made


def test_documents_move_once(spark):
    """Documents are hashed by block before their texts are exploded: postings are counted in place."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    placed = docs.withColumn("blk", F.shiftright("doc_id", 5)).repartition("blk")
    p = plan(I.postings(I.normalized_terms(placed, keep=("blk",)), keep=("blk",)))
    assert p.split("== Initial Plan ==")[0].count("Exchange") <= 2 and "hashpartitioning(term" not in p


def test_pruned_search_sums_fewer_rows(spark):
    from quarry.operators import prune
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "text")
    idx = I.build_index(docs)
    c = S.QuerySide(idx, query_table(spark, SF.replace("0.001", "0.01")))
    full = c.parts().count()
    kept = prune.survivors(c, prune.sums(c), 10).persist()
    some = prune._parts_and_bounds(c, 0.2).count() + prune.scored_parts(c, kept).count()
    assert some < 0.7 * full, (some, full)
    idx.release()


def test_postings_shuffle_on_term_and_doc(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    p = plan(I.postings(I.normalized_terms(docs)))
    assert "hashpartitioning(term" in p and "doc_id" in p.split("hashpartitioning(term")[1][:80]
    assert "Exchange" in p and p.count("HashAggregate") >= 2   # partial + final


def test_no_python_evaluation_anywhere(spark):
    for key, fn in QUERIES.items():
        p = plan(fn(spark, SF))
        assert "EvalPython" not in p and "FlatMapGroupsInPandas" not in p, key
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, key


def test_keep_last_hashes_the_order_only(spark):
    """Rows are fetched by their order: no sort aggregate, no sort, partial aggregation."""
    from quarry.operators.clean import keep_last, keep_last_chained
    part = spark.read.parquet(f"{SF}/part.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for df in (keep_last(part, ["p_name"], "p_partkey"), keep_last_chained(docs, [["lang", "n_chars"], ["text"]], "doc_id"), QUERIES["clean_catalog"](spark, SF)):
        p = plan(df)
        assert "SortAggregate" not in p and "partial_max" in p and "max_by" not in p
    assert "Sort " not in plan(keep_last(part, ["p_name"], "p_partkey"))


def test_vocabulary_is_hash_aggregated(spark):
    p = plan(QUERIES["vocabulary"](spark, SF))
    assert "SortAggregate" not in p and "rangepartitioning" in p


def test_numbering_with_more_partitions_than_rows(spark):
    from quarry.plans.ordering import dense_index
    rows = [("b", 2), ("a", 1), (None, 7), ("b", 1), ("a", 9)]
    df = spark.createDataFrame(rows, "k string, n int")
    got = {(r.k, r.n): r.i for r in dense_index(df, ["k", "n"], "i", num_partitions=40).collect()}
    assert got == {(None, 7): 0, ("a", 1): 1, ("a", 9): 2, ("b", 1): 3, ("b", 2): 4}
    assert dense_index(df.limit(0), ["k"], "i").collect() == []


def test_documents_of_hits_are_not_shuffled(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    hits = spark.createDataFrame([(1, 1, 5, 0.5)], "query_id long, rank long, doc_id long, score double")
    p = plan(S.attach_attrs(hits, docs, ["lang"])).split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in p and "hashpartitioning(doc_id" not in p


def test_stop_words_use_a_hash_set(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    p = plan(I.normalized_terms(docs).where(F.col("term").isNotNull()))
    assert "INSET" in p.upper()
