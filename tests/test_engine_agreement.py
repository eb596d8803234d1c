"""Spark and DuckDB give the same tokens and stems on random text.

The rules are written once and rendered per dialect; these properties
catch dialect differences (anchors, character classes, replacement syntax).
"""

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.functions import rules
from quarry.functions.text import stem_column, tokens

ALPHABET = ("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
            " \n\t.,;:!?'\"()[]{}<>-@#$%&*éüßç")
texts = st.lists(st.text(alphabet=ALPHABET, max_size=60), min_size=1, max_size=25)
words = st.lists(st.text(alphabet="abcdefghijklmnopqrstuvwxyz", min_size=1, max_size=14),
                 min_size=1, max_size=40)


@settings(max_examples=5, deadline=None)
@given(batch=texts)
def test_tokens_agree(spark, batch):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(batch)], "id long, t string")
    got = {r.id: list(r.toks) for r in df.select("id", tokens(F.col("t")).alias("toks")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE x(id BIGINT, t VARCHAR)")
    con.executemany("INSERT INTO x VALUES (?, ?)", list(enumerate(batch)))
    want = dict(con.execute(f"SELECT id, {rules.duckdb_tokens_sql('t')} FROM x").fetchall())
    assert got == want


@settings(max_examples=5, deadline=None)
@given(batch=words, mode=st.sampled_from(["porter", "nltk"]))
def test_stems_agree(spark, batch, mode):
    df = spark.createDataFrame([(w,) for w in set(batch)], "surface string")
    got = dict(stem_column(df, "surface", "term", mode).collect())
    con = duckdb.connect()
    con.execute("CREATE TABLE words(surface VARCHAR)")
    con.executemany("INSERT INTO words VALUES (?)", [(w,) for w in set(batch)])
    ctes, name = rules.duckdb_stem_ctes("words", "surface", mode=mode)
    want = dict(con.execute(f"WITH {ctes} SELECT surface, term FROM {name}").fetchall())
    assert got == want
