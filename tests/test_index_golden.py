"""Hand-worked tf-idf / cosine values on tiny corpora (numbers computed
here from the formulas, not by the library)."""

import math

import pytest
from pyspark.sql import functions as F

from quarry.operators import index as I
from quarry.operators import search as S


def docs_df(spark, texts):
    return spark.createDataFrame([(i + 1, t) for i, t in enumerate(texts)], "doc_id long, text string")


def queries_df(spark, texts):
    return spark.createDataFrame([(i + 1, t) for i, t in enumerate(texts)], "query_id long, text string")


FOUR = ["apple banana apple", "banana cherry", "apple cherry banana", ""]


@pytest.fixture(scope="module")
def four(spark):
    return I.build_index(docs_df(spark, FOUR))


def test_idf_and_stats(four):
    st = {r.term: r for r in four.term_stats.collect()}
    assert set(st) == {"appl", "banana", "cherri"}
    assert (st["appl"].df, st["appl"].cf) == (2, 3)
    assert (st["banana"].df, st["banana"].cf) == (3, 3)
    # N = 4 counts the empty document too
    assert st["appl"].idf == pytest.approx(1.0)
    assert st["banana"].idf == pytest.approx(math.log2(4 / 3))


def test_weights_and_norms(four):
    b = math.log2(4 / 3)
    w = {(r.term, r.doc_id): r.w for r in four.weights.collect()}
    assert w[("appl", 1)] == pytest.approx(2.0)
    assert w[("banana", 2)] == pytest.approx(b)
    norms = {r.doc_id: r.norm for r in four.doc_norms.collect()}
    assert norms[1] == pytest.approx(math.sqrt(4 + b * b))
    assert norms[2] == pytest.approx(math.sqrt(b * b + 1))
    assert norms[3] == pytest.approx(math.sqrt(2 + b * b))
    assert norms[4] == 0.0


def test_cosine_and_rank(spark, four):
    b = math.log2(4 / 3)
    hits = S.search(four, queries_df(spark, ["apple"]), k=10).orderBy("rank").collect()
    assert [h.doc_id for h in hits] == [1, 3]
    assert hits[0].score == pytest.approx(round(2 / math.sqrt(4 + b * b), 6))
    assert hits[1].score == pytest.approx(round(1 / math.sqrt(2 + b * b), 6))
    assert [h.rank for h in hits] == [1, 2]


def test_self_query_is_one(spark, four):
    hits = S.search(four, queries_df(spark, FOUR[:3]), k=1).collect()
    assert {h.query_id: h.doc_id for h in hits} == {1: 1, 2: 2, 3: 3}
    assert all(h.score == pytest.approx(1.0) for h in hits)


def test_unknown_query_has_no_rows_and_status(spark, four):
    q = queries_df(spark, ["durian", "apple"])
    hits = S.search(four, q, k=10)
    assert hits.where(F.col("query_id") == 1).count() == 0
    st = {r.query_id: r.status for r in S.search_status(q, hits).collect()}
    assert st == {1: "no_result", 2: "found"}


def test_zero_idf_candidates_and_zero_norm(spark):
    # x is in every document: idf 0.  Document 3 holds only x: norm 0.
    # (single letters such as y, s, t are stop words, so w and z are used)
    idx = I.build_index(docs_df(spark, ["x w", "x z", "x"]))
    hits = S.search(idx, queries_df(spark, ["x w", "x"]), k=10).orderBy("query_id", "rank").collect()
    q1 = [(h.doc_id, h.score) for h in hits if h.query_id == 1]
    # candidates come from postings, so idf-0 matches stay in the list (Q8):
    # doc 1 positive, doc 2 scores 0, doc 3 has zero length -> NULL, last (Q7)
    assert [d for d, _ in q1] == [1, 2, 3]
    assert q1[1][1] == 0.0 and q1[2][1] is None
    # doc 1: dot = idf(w)^2, |d1| = |q| = idf(w)  ->  1
    assert q1[0][1] == pytest.approx(1.0)
    # query of only idf-0 words: zero query length, every score NULL, ranked by id
    q2 = [(h.doc_id, h.score) for h in hits if h.query_id == 2]
    assert q2 == [(1, None), (2, None), (3, None)]


def test_exhaustive_fills_with_zero_scores(spark, four):
    q = queries_df(spark, ["apple", "durian"])
    ex = S.search_exhaustive(four, q, k=3).orderBy("query_id", "rank").collect()
    a = [(h.doc_id, h.score) for h in ex if h.query_id == 1]
    assert [d for d, _ in a] == [1, 3, 2]
    assert a[2][1] == 0.0
    # no known word: every document scores NULL, the first ids come back
    d = [(h.doc_id, h.score) for h in ex if h.query_id == 2]
    assert d == [(1, None), (2, None), (3, None)]


def test_exhaustive_agrees_with_pruned_on_positive_scores(spark, four):
    q = queries_df(spark, ["apple banana", "cherry"])
    pr = {(h.query_id, h.doc_id): h.score for h in S.search(four, q, k=4).collect()}
    ex = {(h.query_id, h.doc_id): h.score for h in S.search_exhaustive(four, q, k=4).collect()}
    for key, s in ex.items():
        if s:
            assert pr[key] == s


def test_eval_cut_9_10_11(spark):
    texts = []
    for i in range(11):
        words = ["gamma"]
        if i < 10:
            words.append("beta")
        if i < 9:
            words.append("alpha")
        texts.append(" ".join(words + ["filler%d" % i]))
    idx = I.build_index(docs_df(spark, texts + ["other"]))
    out = S.search_eval(idx, queries_df(spark, ["alpha", "beta", "gamma"]))
    counts = {r.query_id: r.n for r in out.groupBy("query_id").agg(F.count("*").alias("n")).collect()}
    assert counts == {1: 9, 2: 5, 3: 5}


def test_query_repeats_add_up(spark, four):
    qs = S.QuerySide(four, queries_df(spark, ["apple apple cherry"]))
    qw = {r.term: (r.qtf, r.qw) for r in qs.qweights.collect()}
    assert qw["appl"] == (2, pytest.approx(2.0))
    assert qw["cherri"] == (1, pytest.approx(1.0))


def test_vocabulary_first_seen_order(spark, four):
    v = {r.term: r.term_id for r in I.vocabulary(I.normalized_terms(four.docs)).collect()}
    assert v == {"appl": 0, "banana": 1, "cherri": 2}


def test_synonyms_bag_and_own_tokens(spark, four):
    syn = spark.createDataFrame(
        [("fruit", 0, 0, "fruit"), ("fruit", 0, 1, "apple"), ("pome", 0, 1, "apple"),
         ("apple", 0, 1, "fruit"), ("tree", 1, 1, "cherry")],
        "word string, sense_rank int, lemma_rank int, lemma string")
    q = queries_df(spark, ["fruit pome", "fruit apple", "tree"])
    t = S.normalize_queries(q, synonyms=syn)
    got = sorted((r.query_id, r.term) for r in t.collect())
    # q1: fruit and pome both give "apple" -> added twice (bag)
    # q2: "apple" is already a token; "fruit" is too -> nothing added
    # q3: only a second sense exists -> nothing added
    assert got == [(1, "appl"), (1, "appl"), (1, "fruit"), (1, "pome"),
                   (2, "appl"), (2, "fruit"), (3, "tree")]


def test_augment_query(spark):
    q = spark.createDataFrame([(1, "war", True, False), (2, "war", True, True), (3, "war", False, False)],
                              "query_id long, text string, sp boolean, ol boolean")
    out = S.augment_query(q, {"single_player": F.col("sp"), "online": F.col("ol")})
    got = {r.query_id: r.text for r in out.collect()}
    assert got == {1: "war Singleplayer", 2: "war Singleplayer Online", 3: "war"}


def test_labels(spark, four):
    docs = spark.createDataFrame([(1, "Title one"), (3, "Title three")], "doc_id long, title string")
    hits = S.search(four, queries_df(spark, ["apple"]), k=10)
    labels = sorted(r.label for r in S.label_hits(hits, docs).collect())
    assert labels == ["1 : Title one", "3 : Title three"]


def test_hot_term_split_join_matches_plain_join(spark):
    """Force the split path: with a bound of 2 rows, terms in 4 of the 8 postings or more are hot."""
    docs = docs_df(spark, ["apple banana", "apple cherry", "apple banana date", "apple"])
    post = I.postings(I.normalized_terms(docs))
    stats = I.term_stats(post, I.collection_size(docs))
    split = I.tfidf_weights(post, stats, max_broadcast_rows=2)
    plain = post.join(stats, "term").select("term", "doc_id", "tf", (F.col("tf") * F.col("idf")).alias("w"))
    assert sorted(split.collect()) == sorted(plain.collect())
    assert split.count() == 8


def test_oversized_query_side_is_spread(spark, four):
    """With a broadcast bound of 2 rows the weights are joined by term in one scan, frequent
    terms spread over several keys; results equal the broadcast run."""
    texts = ["apple", "banana cherry", "apple cherry", "cherry", "banana apple", "durian"]
    q = queries_df(spark, texts)
    qs = S.QuerySide(four, q, max_broadcast_rows=2)
    assert not qs.broadcast
    small = sorted(S.search(four, q, k=3, max_broadcast_rows=2).collect())
    whole = sorted(S.search(four, q, k=3).collect())
    assert small == whole and len(whole) > 0
    ex_small = sorted(S.search_exhaustive(four, q, k=3, max_broadcast_rows=2).collect(), key=repr)
    ex_whole = sorted(S.search_exhaustive(four, q, k=3).collect(), key=repr)
    assert ex_small == ex_whole
    ev_small = sorted(S.search_eval(four, q, max_broadcast_rows=2).collect())
    assert ev_small == sorted(S.search_eval(four, q).collect())


def test_cut_lineage_gives_the_same_index(spark, four):
    cut = I.build_index(docs_df(spark, FOUR), cut_lineage=True)
    q = queries_df(spark, ["apple cherry", "banana"])
    assert sorted(S.search(cut, q).collect()) == sorted(S.search(four, q).collect())
