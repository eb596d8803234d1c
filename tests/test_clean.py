"""Null and duplicate rules of the cleaning flow (Q1-Q5)."""

from pyspark.sql import functions as F

from quarry.functions.text import doc_text
from quarry.operators.clean import clean_catalog, drop_null, keep_last, keep_last_chained, merge_on

CAT = "url string, name string, categories string, developer string, publisher string, row_seq long"
DES = "url string, desc string, full_desc string, row_seq long"


def test_keep_last_and_null_group(spark):
    df = spark.createDataFrame(
        [("u1", "a", 1), ("u1", "b", 2), (None, "c", 3), (None, "d", 4), ("u2", "e", 5)],
        "url string, name string, row_seq long")
    got = sorted(keep_last(df, ["url"], "row_seq").collect(), key=lambda r: r.row_seq)
    # nulls form one group: only the last null-url row survives
    assert [(r.url, r.name) for r in got] == [("u1", "b"), (None, "d"), ("u2", "e")]


def test_chained_order_matters(spark):
    df = spark.createDataFrame(
        [("u1", "x", 1), ("u2", "x", 2), ("u2", "y", 3), ("u3", "y", 4)],
        "url string, desc string, row_seq long")
    a = sorted(r.row_seq for r in keep_last_chained(df, [["url"], ["desc"]], "row_seq").collect())
    b = sorted(r.row_seq for r in keep_last_chained(df, [["desc"], ["url"]], "row_seq").collect())
    assert a == [1, 4]      # url first: u1/x(1), u2/y(3), u3/y(4) -> desc: x(1), y(4)
    assert b == [2, 4]      # desc first: x(2), y(4) -> url: u2(2), u3(4)


def test_dedup_before_null_drop(spark):
    # the last row of u1 has no name: the whole url goes (Q3)
    df = spark.createDataFrame([("u1", "a", 1), ("u1", None, 2), ("u2", "b", 3)],
                               "url string, name string, row_seq long")
    got = drop_null(keep_last(df, ["url"], "row_seq"), ["name"])
    assert [r.url for r in got.collect()] == ["u2"]


def test_null_url_merges_with_null_url(spark):
    left = spark.createDataFrame([(None, "n"), ("u", "m")], "url string, name string")
    right = spark.createDataFrame([(None, "d0"), ("u", "d1"), ("v", "d2")], "url string, desc string")
    got = sorted(((r.url, r.name, r.desc) for r in merge_on(left, right, "url").collect()), key=repr)
    assert got == sorted([(None, "n", "d0"), ("u", "m", "d1")], key=repr)


def test_clean_catalog_flow(spark):
    cat = spark.createDataFrame([
        ("u1", "A", "c", "d", "p", 1),
        ("u1", "A2", "c", "d", "p", 2),       # later duplicate url wins
        ("u2", None, "c", "d", "p", 3),       # no name -> dropped
        ("u3", "C", "c", "d", "p", 4),
        (None, "N", "c", "d", "p", 5),        # null url, merges with null url
    ], CAT)
    des = spark.createDataFrame([
        ("u1", "same text", "full", 1),
        ("u3", "same text", "full", 2),       # later duplicate desc wins, u1 loses it
        ("u2", "other", "full", 3),
        ("u4", "x", None, 4),                 # no full_desc -> dropped
        (None, "null url text", "full", 5),
    ], DES)
    out = clean_catalog(cat, des).orderBy("doc_id").collect()
    assert [(r.doc_id, r.url, r.name, r.desc) for r in out] == [
        (0, "u3", "C", "same text"), (1, None, "N", "null url text")]
    # post-merge url is unique (C6 has nothing to remove)
    assert len({r.url for r in out}) == len(out)


def test_doc_text_null_is_nan(spark):
    df = spark.createDataFrame([("Game", None, "Dev", "desc")], "name string, categories string, developer string, desc string")
    got = df.select(doc_text(["name", "categories", "developer", "desc"])).first()[0]
    assert got == " Game nan Dev desc"
