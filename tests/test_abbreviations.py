"""Learned sentence breaks: the table, goldens, both join paths, awkward input."""

import math

import pytest
from pyspark.sql import functions as F

from quarry.functions.text import tokens
from quarry.operators import abbreviations as A
from quarry.operators.index import build_index, normalized_terms
from quarry.operators.search import search

PLAIN = ["the ship came and left port there", "a long book was read by them there", "no one there came to the light", "he came home in the rain from there"]
TEXTS = [f"{PLAIN[i % 4]}, see vol. {i} and H.C. Andrews there. It was Dr. Wold who came." for i in range(40)]


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")


@pytest.fixture(scope="module")
def learned(corpus):
    return A.learn_abbreviations(corpus)


def toks(spark, learned, *texts, **kw):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = A.tokens_of_sentences(docs, learned, **kw).collect()
    out = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.pos)):
        assert r.pos == len(out.setdefault(r.doc_id, []))
        out[r.doc_id].append(r.tok)
    return [" ".join(out.get(i, [])) for i in range(len(texts))]


def test_learned_words_and_scores(learned):
    got = {r.word: r for r in learned.collect()}
    assert {"vol", "h.c", "dr"} <= set(got) and not {"there", "came", "the", "it"} & set(got)
    words = [w.strip(",") for t in TEXTS for w in t.split() if w.strip(",.")[0].isalpha()]
    stops = sum(w.endswith(".") for w in words)
    p = stops / len(words)
    assert got["h.c"].n_stop == 40 and got["h.c"].n_plain == 0
    want = 2 * 40 * (math.log(0.99) - math.log(p)) * 2 * math.exp(-2)  # two letters, one stop inside
    assert math.isclose(got["h.c"].score, want, rel_tol=1e-9)


@pytest.mark.parametrize("text,want", [
    ("in vol. 82 it was. Then", "in vol. 82 it was . Then"),
    ("(see vol. 3) ends. End", "( see vol. 3 ) ends . End"),
    ("by H.C. Andrews.", "by H.C. Andrews ."),
    ("the last vol.", "the last vol ."),          # a stop that ends the text ends the sentence
    ("vol.\n82 of Dr.\tWold", "vol. 82 of Dr. Wold"),
    ("revol. 82", "revol . 82"),                  # a longer word is another word
    ("3vol. 82", "3vol . 82"),
    ("a vol.. 82 vol! Yes", "a vol .. 82 vol ! Yes"),
    ("", ""), ("  \n ", ""), (".", "."), ("Dr. ", "Dr ."),
])
def test_goldens(spark, learned, text, want):
    assert toks(spark, learned, text) == [want]


def test_both_join_paths_and_order(spark, learned):
    texts = [*TEXTS[:5], "vol. 1 " * 2000, "", "no stops at all", None]
    assert toks(spark, learned, *texts) == toks(spark, learned, *texts, max_rows=0, salts=3)


def test_empty_table_gives_the_default_tokens(spark, learned):
    texts = [*TEXTS[:3], "a.b. c) x.\n\n.\ny (q.) z... \"w.\" 1.5, 2:3! ok?  end.", "one.two three.", "x. ) y"]
    want = [" ".join(r[0]) for r in spark.createDataFrame([(t,) for t in texts], "t string").select(tokens(F.col("t"))).collect()]
    assert toks(spark, learned.limit(0), *texts) == want


def test_nothing_to_learn(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert A.learn_abbreviations(none).collect() == []
    every = spark.createDataFrame([(1, "a. b. c."), (2, None)], "doc_id long, text string")
    assert A.learn_abbreviations(every).collect() == []
    assert A.tokens_of_sentences(none, A.learn_abbreviations(none)).collect() == []


def test_index_and_query_use_the_same_breaks(spark, corpus, learned):
    got = {r.term for r in normalized_terms(corpus.limit(1), abbreviations=learned).collect()}
    assert {"vol.", "h.c.", "dr."} <= got and "vol" not in got
    queries = spark.createDataFrame([(1, "vol. 7")], "query_id long, text string")
    hits = search(build_index(corpus, abbreviations=learned), queries, k=1, abbreviations=learned).collect()
    assert [(h.query_id, h.doc_id) for h in hits] == [(1, 7)]
