"""The corpus pipeline, stage by stage, against brute force; the registered queries against their SQL."""

import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import brute  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """Awkward documents and labelled ones, a few of them toxic, as a test-data folder."""
    d = str(tmp_path_factory.mktemp("sf"))
    rows = list(brute.awkward_docs())
    labels = []
    for i in range(150):
        toxic = i % 10 == 0
        words = [f"t{(i * 37 + j * 11) % 400}" for j in range(70)] + (["vile", "awful", "nasty", "vile"] if toxic else [])
        rows.append((1000 + i, " ".join(words), "en", "host2", 7, "h", 1, "s", 2, "r"))
        labels.append((1000 + i, 1, int(toxic)))
    spark.createDataFrame(rows, brute.SCHEMA).repartition(2).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def ids(df):
    return sorted((r.doc_id for r in df.select("doc_id").collect()), key=lambda k: (k is None, k))


def test_stages(spark, small):
    import corpus_pipeline as p

    from quarry.llm import quality, toxicity
    from quarry.llm.queries import fold
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    assert [name for name, _ in p.STAGES] == ["toxicity", "quality_rules", "ngram_jaccard_join", "substring_dedup", "best_fit_packing"]
    stages = iter(f for _, f in p.STAGES)
    step = lambda: p.write_shared(next(stages)(spark, docs, small), "step")

    model = toxicity.fit(docs, spark.read.parquet(f"{small}/labels.parquet"), fold() != 0)
    want = ids(toxicity.score(docs, model).where("score < 0.5"))
    docs, before = step(), docs
    assert docs.columns == columns and ids(docs) == want
    assert not {1000 + i for i in range(0, 150, 10)} & set(ids(docs)) and len(want) >= before.count() - 16

    want = ids(quality.judge(docs).where("kept"))
    docs = step()
    assert docs.columns == columns and ids(docs) == want and want

    rows = [tuple(r) for r in docs.collect()]
    groups = brute.components(rows, 5, 80)
    docs = step()
    assert docs.columns == columns and ids(docs) == sorted((k for k, (_, c) in groups.items() if c == k), key=lambda k: (k is None, k))

    rows = {r.doc_id: r for r in docs.collect()}
    want = brute.without_repeats([tuple(r) for r in rows.values()], 13)
    docs = step()
    assert docs.columns == columns
    for r in docs.collect():
        _, removed, kept = want[r.doc_id]
        assert r.text == (kept if removed else rows[r.doc_id].text)
        assert r.n_chars == (len(kept) if removed else rows[r.doc_id].n_chars) and r.h == "h" and r.row == "r"

    last = step()
    assert ids(last.where("piece = 0")) == ids(docs)
    fill = last.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()
    assert all(r.n == r.end <= 2048 for r in fill)


def test_run_and_empty_tables(spark, small, tmp_path):
    import corpus_pipeline as p
    assert p.run(spark, small).count() > 0
    d = str(tmp_path)
    for t in ("documents", "labels"):
        spark.read.parquet(f"{small}/{t}.parquet").limit(0).write.parquet(f"{d}/{t}.parquet")
    assert p.run(spark, d).collect() == []


@pytest.mark.parametrize("name", ["op1_url_filter", "op2_ngram_join", "op4_substring_dedup", "op9_quality", "op10_hamming_topk"])
def test_query_matches_sql(spark, name):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from oracle_compare import duck, rows_of

    from quarry.llm.oracle import ORACLE
    from quarry.llm.queries import QUERIES
    got = QUERIES[name](spark, SF)
    want = duck(SF).execute(ORACLE[name])
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of([c[0] for c in want.description], want.fetchall())


def test_registered_names():
    import __spark_entry__ as entry
    names = list(entry.queries())
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10 and "pipeline" in names
