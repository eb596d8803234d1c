"""The text stage at size: cheap rejections change nothing, tasks follow the input, and what plans read often is made once."""

import pytest
from pyspark.sql import functions as F

from quarry.functions import rules
from quarry.functions import text as T
from quarry.operators import index as I
from quarry.operators import prune
from quarry.operators import search as S
from quarry.plans import sizing


@pytest.fixture()
def docs(spark):
    rows = [(i, f"common running relational word{i} the cat's {'hoping' if i % 2 else 'generalizations'}") for i in range(200)]
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("mode", ["porter", "nltk"])
def test_unchanged_words_are_what_the_rules_leave(spark, mode):
    ends = sorted({e for s in [rules.PORTER_STEP1A, rules.PORTER_STEP1B, rules.PORTER_STEP2, rules.PORTER_STEP3] for e in (x[0] for x in s)}
                  | set(rules.PORTER_STEP4) | {"y", "e", "ll", "bli", "fulli", "logi", "ied", "alli", "a", "t", "an", "o", " ", "é", "7", "q"})
    heads = ["", "b", "tr", "tree", "oat", "hop", "Yell", "yell", "relat", "gener", "controll", "ñu"]
    words = [(h + e + f,) for h in heads for e in ends for f in ("", "s", "ed", "ing", "ly")] + [(None,), ("",)]
    df = spark.createDataFrame(words, "w string").distinct()
    e = "w"
    for stage in rules.porter_stages("duckdb", "x", mode):  # the plain lists, without the look by last letter
        e = f"transform(array({e}), x -> {stage.replace('regexp_matches', 'regexp_like')})[0]"
    plain = F.expr(rules.irregular_case("w", e, mode))
    assert df.where(~T.stem_expr("w", mode).eqNullSafe(plain)).collect() == []
    assert df.where(F.expr(rules.unchanged("w"))).count() > 0
    assert df.where(F.expr(rules.unchanged("w")) & ~F.col("w").eqNullSafe(plain) & ~F.col("w").isin("sky")).collect() == []


def test_look_ahead_matches_what_the_rule_matches(spark, monkeypatch):
    texts = [("the cat's n't don't DON'T I'LL x' 'tis 'S he'd they've O'Neil nn't n' ' '' can't. \"a\" l'eau 'll 's",), ("",), (None,)]
    df = spark.createDataFrame(texts, "text string")
    fast = [r.t for r in df.select(T.tokens("text").alias("t")).collect()]
    monkeypatch.setattr(rules, "SPARK_PATTERNS", {})
    assert fast == [r.t for r in df.select(T.tokens("text").alias("t")).collect()]


def test_text_tasks_follow_the_input(spark, docs, tmpdir_path, monkeypatch):
    docs.write.parquet(f"{tmpdir_path}/d")
    stored = spark.read.parquet(f"{tmpdir_path}/d")
    assert sizing.text_tasks(stored) is None
    monkeypatch.setattr(sizing, "TEXT_TASK_BYTES", sizing.input_bytes(stored) // 20)
    n = sizing.text_tasks(stored)
    assert n >= 20 and n % spark.sparkContext.defaultParallelism == 0
    idx = I.build_index(stored)
    assert idx.postings.rdd.getNumPartitions() == n
    assert idx.postings.count() == I.build_index(docs).postings.count()
    idx.release()


def test_prepared_index_is_made_once(spark, docs):
    idx = I.build_index(docs).prepare()
    kept = {r.id(): r for r in spark.sparkContext._jsc.sc().getRDDStorageInfo()}
    assert sum(r.numCachedPartitions() == r.numPartitions() for r in kept.values()) >= 2
    assert all("InMemoryRelation" in df._jdf.queryExecution().withCachedData().toString() for df in idx.kept)
    plan = idx.weights._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
    assert "count(" not in plan  # the statistics are read, not counted again
    idx.release()


def test_fill_list_reads_the_lengths_once(spark, docs):
    empty = spark.createDataFrame([(900 + i, "the") for i in range(15)], "doc_id long, text string")
    idx = I.build_index(docs.unionByName(empty))
    queries = spark.createDataFrame([(1, "word7"), (2, "absent")], "query_id long, text string")
    got = S.search_exhaustive(idx, queries, k=3)
    whole = got._jdf.queryExecution().analyzed().toString()
    assert "GlobalLimit" not in whole
    assert [(r.query_id, r["rank"], r.doc_id) for r in got.orderBy("query_id", "rank").collect()] == [
        (1, 1, 7), (1, 2, 0), (1, 3, 1), (2, 1, 0), (2, 2, 1), (2, 3, 2)]
    idx.release()


def test_pruned_search_keeps_blocks_of_query_words_only(spark, docs, monkeypatch):
    idx = I.build_index(docs)
    queries = spark.createDataFrame([(1, "word7 common"), (2, "word9 running hoping")], "query_id long, text string")
    seen, sums = [], prune.sums
    monkeypatch.setattr(prune, "sums", lambda c, *a: seen.append(c.index.blocks) or sums(c, *a))
    got = prune.search_pruned(idx, queries, k=5)
    assert sorted(got.collect()) == sorted(S.search(idx, queries, k=5).collect())
    assert {r.term for r in seen[0].select("term").distinct().collect()} == {"word7", "common", "word9", "run", "hope"}
    idx.release()


def test_stem_steps_bind_no_arrays_and_count_no_branches():
    """What is interpreted for each word has no CASE (its branches are a list that is counted each time) and makes no array."""
    for mode in ("porter", "nltk"):
        assert not any("CASE" in stage for stage in rules.porter_stages("spark", "w", mode))
        assert any("CASE" in stage for stage in rules.porter_stages("duckdb", "w", mode))
        assert "transform(" not in str(T.stem_expr("w", mode))


@pytest.mark.parametrize("mode", ["porter", "nltk"])
def test_passed_over_steps_change_nothing(spark, mode):
    """Words of one suffix on another, so that one step makes the ending of a later one."""
    ends = ["s", "ed", "ing", "ied", "ies", "y", "e", "lle", "ll", *(a for a, _ in rules.PORTER_STEP2), *(a for a, _ in rules.PORTER_STEP3), *rules.PORTER_STEP4,
            "fulli", "logi", "bly", "ily", "ility", "encies", "izers", "izing"]
    words = {h + a + b for h in ("y", "yell", "tr", "hop", "gener", "é") for a in ends for b in ends}
    df = spark.createDataFrame([(w,) for w in sorted(words)], "w string")
    plain = "w"
    for stage in rules.porter_stages("duckdb", "x", mode):
        plain = f"transform(array({plain}), x -> {stage.replace('regexp_matches', 'regexp_like')})[0]"
    assert df.where(~T.stem_expr("w", mode).eqNullSafe(F.expr(rules.irregular_case("w", plain, mode)))).collect() == []


def test_tokens_of_odd_punctuation(spark, monkeypatch):
    """The renderings for Spark against the rules by one regex each."""
    import re
    texts = ['.. ... a..b --- -- a-b -.- .-. ;;. "" " \'" (") {["a"]} "" "x', "\u00a0 a\u2003b\t\n\x0b\x0c\r c.\n\n.\n", " ", '"', "--", "é..ü--ñ;"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for row in df.select("text", T.tokens("text").alias("t")).collect():
        s, space = row.text, r"[ \t\n\x0b\f\r]+"
        part = lambda rep: lambda m: "".join((m.group(p) or "") if isinstance(p, int) else p for p in rep)
        for pat, rep in rules.TOKEN_RULES_BEFORE_PAD:
            s = re.sub(pat.replace(r"\s", r"[ \t\n\x0b\f\r]").replace("$)", r"(?=\n?\Z))"), part(rep), s)
        s = " " + re.sub(space, " ", s) + " "
        for pat, rep in rules.TOKEN_RULES_AFTER_PAD:
            s = re.sub(pat, part(rep), s)
        assert row.t == [x for x in re.split(space, s) if x], row.text
