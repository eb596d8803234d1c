"""Scores from kept postings, and distinct words before the token rules: the same rows, with less moved or cut."""

import random

import pytest
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators import index as I
from quarry.operators import search as S


def test_tokens_of_words_are_the_tokens_of_the_text(spark):
    r = random.Random(7)
    parts = [*" \t\n\r\x0b\f.,:;!?\"'()[]{}<>-@1aYé*", ". ", "'s ", "n't", "--", "..", "''", "'LL", "word", "\\", "$", ".) \n"]
    rows = [("".join(r.choice(parts) for _ in range(r.randint(0, 30))),) for _ in range(3000)] + [(None,), ("",), (" ",)]
    df = spark.createDataFrame(rows, "text string")
    of_words = F.flatten(F.transform(F.filter(T.words("text"), lambda w: w != ""), T.word_tokens))
    assert df.where(~of_words.eqNullSafe(T.tokens("text"))).collect() == []


def test_surfaces_cut_each_distinct_word_once(spark):
    docs = spark.createDataFrame([(i, f"The cat's \"running\", don't. (Word{i % 3}) the\nend.") for i in range(9)] + [(9, None)], "doc_id long, text string")
    found = I.surfaces(docs)
    toks = docs.select(F.explode(T.tokens("text")).alias("tok")).where(~T.is_stopword(F.col("tok")))
    assert sorted(r.surface for r in found.collect()) == sorted(r.s for r in toks.select(F.lower("tok").alias("s")).distinct().collect())
    plan = found._jdf.queryExecution().optimizedPlan().toString().split("\n")
    contractions = next(i for i, line in enumerate(plan) if "'re|" in line)
    assert any("Aggregate [word" in line for line in plan[contractions + 1:])  # below the rules for the tokens of a word


@pytest.fixture(params=[(1_000_000, False), (2, False), (2, True)])
def index(spark, request):
    docs = [(i, f"alpha common{i % 5} beta word{i} {'gamma ' * (i % 4)}") for i in range(-3, 80)]
    bound, twice = request.param
    docs += [(None, "alpha nothing"), (500, ""), (501, None), *([(7, "alpha twice")] if twice else [])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    # a word of all documents: idf 0 where ids differ, so a document of it alone has length 0
    df = df.withColumn("text", F.concat(F.lit("every "), F.coalesce("text", F.lit(""))))
    idx = I.build_index(df, max_broadcast_rows=bound)
    yield idx
    idx.release()


@pytest.fixture()
def queries(spark):
    rows = [(1, "alpha gamma gamma"), (2, "common3 word5 every"), (3, "unknown"), (4, "every"), (None, "beta"), (5, None)]
    return spark.createDataFrame(rows, "query_id long, text string")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_scores_are_those_of_the_weights(index, queries):
    qs = S.QuerySide(index, queries)
    assert qs.broadcast
    by_weights = S._scores(S._dots(S._dot_parts(qs.qweights, index.weights)), qs.qnorms)
    got = rows_of(S.cosine_scores(index, qs))
    assert got == rows_of(by_weights)
    assert {d for _, d, _ in got} >= {None, 7, 500, 501}
    norms = {r.doc_id: r.norm for r in index.doc_norms.collect()}
    assert (norms[500] == 0) == ((4, 500, None) in got)
    placed, index.placed = index.placed, None
    before = rows_of(S.search_exhaustive(index, queries))
    index.placed = placed
    assert rows_of(S.search_exhaustive(index, queries)) == before


def test_no_weight_moves_for_a_score(index, queries):
    plan = S.search(index, queries)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    windows = [line.strip(" :+-")[:400] for line in plan if "Window [" in line]
    assert windows and not any("blk" in line for line in windows)  # the ranks only; lengths are sums by document
