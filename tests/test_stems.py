"""The stored stem dictionary: stems once per word, both join paths, appends, awkward input."""

import pytest
from pyspark.sql import functions as F

from quarry.operators import stems as S
from quarry.operators.index import build_index, normalized_terms

WORDS = ["running", "runs", "hopping", "nation", "nations", "sky", "a", "was"]


def words(spark, values):
    return spark.createDataFrame([(i, w) for i, w in enumerate(values)], "doc_id long, surface string")


def counted(spark, values):
    return S.surface_counts(words(spark, values))


def test_words_of_a_batch_keep_their_stored_stem(spark, tmpdir_path):
    path = f"{tmpdir_path}/stems"
    assert S.load_stored(spark, path).collect() == []
    S.extend_stored(path, counted(spark, ["running", "running", "nations", None]))
    # a stem that no rule gives shows that the rules are not run again for a stored word
    spark.createDataFrame([("sky", "STORED", 1)], S.DDL).write.mode("append").parquet(f"{path}/porter")
    S.extend_stored(path, counted(spark, ["sky", "sky", "running", "hopping"]))
    got = {r.surface: (r.term, r.n) for r in S.load_stored(spark, path).collect()}
    assert got == {"running": ("run", 3), "nations": ("nation", 1), "sky": ("STORED", 3), "hopping": ("hop", 1)}
    assert S.load_stored(spark, path, "nltk").collect() == []  # another variant has a table of its own


@pytest.mark.parametrize("max_rows", [None, 2, 1, 0])
def test_lookup_equals_the_rules(spark, max_rows):
    """A word in a third of the rows, words that the dictionary lacks, nulls; broadcast and split joins."""
    values = [*WORDS * 5, *["running"] * 40, "unheard", "unhearing", None, None]
    toks = words(spark, values).withColumn("term", F.lit("old"))  # a clashing column is replaced
    dictionary = S.stem_dictionary(counted(spark, [*WORDS * 5, *["running"] * 40]))
    got = S.stem_by_dictionary(toks, dictionary, max_rows=max_rows).collect()
    from quarry.functions.text import stem_column
    want = stem_column(words(spark, values), "surface").collect()
    assert sorted((r.doc_id, r.surface or "", r.term or "") for r in got) == sorted((r.doc_id, r.surface or "", r.term or "") for r in want)
    assert S.stem_by_dictionary(toks.limit(0), dictionary, max_rows=max_rows).collect() == []


def test_empty_dictionary(spark):
    toks = words(spark, WORDS)
    got = {r.surface: r.term for r in S.stem_by_dictionary(toks, spark.createDataFrame([], S.DDL)).collect()}
    assert got["running"] == "run" and got["nations"] == "nation"


def test_frequent_words_are_not_shuffled(spark):
    toks = words(spark, ["running"] * 50 + WORDS)
    plan = S.stem_by_dictionary(toks, S.stem_dictionary(counted(spark, ["running"] * 50 + WORDS)), max_rows=2)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "LeftAnti" in text
    small = S.stem_by_dictionary(toks, S.stem_dictionary(counted(spark, WORDS)))
    assert "SortMergeJoin" not in small._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("stem", [True, "nltk"])
def test_index_by_dictionary(spark, stem):
    docs = spark.createDataFrame([(1, "Running nations ran."), (2, "The skies were running"), (3, None), (4, "")], "doc_id long, text string")
    surfaces = S.surface_counts(normalized_terms(docs.limit(1), stem=False).withColumnRenamed("term", "surface"))
    stems = S.stem_dictionary(surfaces, mode="porter" if stem is True else stem)
    rows = lambda index: sorted(map(tuple, index.postings.collect()))
    assert rows(build_index(docs, stem=stem, stems=stems)) == rows(build_index(docs, stem=stem))
