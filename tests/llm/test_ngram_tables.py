"""The backoff tables of any order against a recursive model of our own, by text, and against `katz` at order 2."""

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quarry.llm import katz, ngram_tables

import brute


class Recursive:
    """P(word | history) by its definition, over dictionaries of whole histories."""

    def __init__(self, texts, order):
        self.order, self.seen = order, [defaultdict(Counter) for _ in range(order)]
        for t in texts:
            for i, w in enumerate(t):
                for m in range(order):
                    if m <= i + 1:
                        self.seen[m][tuple([None, *t][i + 1 - m:i + 1])][w] += 1
        self.d = [brute.good_turing(c for x in level.values() for c in x.values()) for level in self.seen]
        self.n = sum(self.seen[0][()].values())
        self.words = self.seen[0][()]

    def star(self, m, c):
        return c * self.d[m](c)

    def p(self, h, w):
        m, counts = len(h), self.seen[len(h)].get(h)
        if counts and counts[w]:
            return self.star(m, counts[w]) / sum(counts.values())
        left = 1 - sum(self.star(m, c) for c in counts.values()) / sum(counts.values()) if counts else 1.0
        if m == 0:
            return left
        return (left / (1 - sum(self.p(h[1:], x) for x in counts)) if counts else 1.0) * self.p(h[1:], w)

    def score(self, t):
        out = 0.0
        for i, w in enumerate(t):
            m = min(self.order - 1, i + 1)
            out += math.log10(self.p(tuple([None, *t][i + 1 - m:i + 1]), w))
        base = sum(math.log10((self.words[w] + 0.5) / (self.n + 0.5 * (len(self.words) + 1))) for w in t)
        return len(t), sum(self.words[w] > 0 for w in t), base, out


def own_rows():
    rows = [(k, t) for k, t, *_ in brute.awkward_docs() if t is None or len(t) < 3000]
    rows += [(1, "a b c a b d a b c"), (1, "a b c"), (1, "a b c"), (2, "the a b The B c the a b"), (None, "x"), (None, "y z w q"), (None, "x"), (3, None), (3, "")]
    rows += [(10 + i, f"the cat sat on the mat {'and' if i % 3 else 'or'} the dog w{i % 7} sat on w{i}") for i in range(40)]
    return rows


@pytest.mark.parametrize("order,hot_rows", [(1, 1000), (2, 1000), (3, 1000), (3, 5), (4, 20)])
def test_scores_by_definition(spark, order, hot_rows):
    rows = own_rows()
    keeps = lambda k: k is not None and brute.fold(k) != 1
    tokens = [[*brute.words_of(t, lower=True), 0] for _, t in rows]
    want = Recursive([t for (k, _), t in zip(rows, tokens, strict=True) if keeps(k)], order)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    docs = docs.withColumn("row", F.lit("mine")).withColumn("word", F.lit(1))  # clashing names
    model = ngram_tables.fit(docs, order, train=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1, hot_rows=hot_rows)
    got = ngram_tables.score(docs, model).collect()
    assert {r.train_tokens for r in got} == {want.n}
    asked = lambda x: (str(x[0]), x[1], x[2], round(x[3], 6), round(x[4], 6))
    assert sorted(asked((r.doc_id, r.n_tokens, r.n_known, r.base_score, r.score)) for r in got) == sorted(
        asked((k, *want.score(t))) for (k, _), t in zip(rows, tokens, strict=True))


def test_contexts_sum_to_one():
    rows = [[*brute.words_of(t, lower=True), 0] for _, t in own_rows()]
    model = Recursive(rows, 3)
    for level in model.seen:
        for h in list(level)[:25]:
            assert math.isclose(sum(model.p(h, w) for w in model.words) + model.p(h, "never met"), 1, rel_tol=1e-9)


def test_other_texts_and_the_bucketed_bigram(spark):
    """Order 2 scores as `katz.score` does; a model scores texts that it was not fitted on."""
    docs = spark.createDataFrame([r for r in own_rows() if r[0] is not None], "doc_id long, text string")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1
    model = ngram_tables.fit(docs, 2, train=fold)
    rows = lambda df: sorted((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in df.collect())
    assert rows(ngram_tables.score(docs, model)) == rows(katz.score(docs, fold))
    other = spark.createDataFrame([(1, "the cat sat"), (2, "the zebra sat"), (3, "")], "doc_id long, text string")
    got = {r.doc_id: r for r in ngram_tables.score(other, model).collect()}
    assert got[1].score > got[2].score and got[2].n_known == 3 and got[3].n_tokens == 1


def test_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    model = ngram_tables.fit(none, 3)
    assert ngram_tables.score(none, model).collect() == []
    some = ngram_tables.score(spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string"), model).collect()
    assert all(r.train_tokens == 0 and r.score == 0 and r.n_known == 0 for r in some)
    with pytest.raises(ValueError):
        ngram_tables.fit(none, 0)
