"""Sources and sinks on files written by the tests themselves."""

import os

import pytest
from pyspark.sql import functions as F

from quarry.operators import index as I
from quarry.operators import search as S
from quarry.sources.catalog import read_catalog, read_descriptions
from quarry.sources.store import load_index, save_index
from quarry.sources.tagged import read_tagged_docs, read_tagged_queries

QUERY_FILE = """.I 1
.W
 Which gardens by the river grow quinces (Cydonia), a
fruit for autumn jam?
.N
 1. First remark
.I 2
.W
 Lanterns painted by Oduya
.A
Oduya, T.
.N
 2. Second remark
.I 3
.W
 Harbour tides in winter months
.N
 3. Third remark
"""

DOC_FILE = """.I 1
.T
Keeping Bees on a Flat Roof
.B
Rooftop Quarterly, May
.A
Marlow, H. R.
.N
RQ0001 entered on Monday
.X
41\t7\t1
.I 2
.T
Seven Ways to Mend a Kite
.W
Tails and the .T marker inside a line.
.B
Rooftop Quarterly, June
.I 3
.T
Winter Paths along the Canal
.X
9\t7\t9
"""


def write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def test_tagged_queries(spark, tmpdir_path):
    p = write(os.path.join(tmpdir_path, "query.txt"), QUERY_FILE)
    q = {r.query_id: r for r in read_tagged_queries(spark, p).collect()}
    assert sorted(q) == [1, 2, 3]
    assert q[1].text.strip().startswith("Which gardens") and "autumn jam?" in q[1].text
    assert q[2].authors.strip() == "Oduya, T." and q[1].authors is None
    assert q[3].note.strip() == "3. Third remark"


def test_tagged_queries_odd_only(spark, tmpdir_path):
    p = write(os.path.join(tmpdir_path, "query.txt"), QUERY_FILE)
    q = read_tagged_queries(spark, p, odd_only=True).collect()
    # record 1 kept (renumbered 1); record 3 is odd but nothing follows it
    assert [r.query_id for r in q] == [1]
    assert ".N" in q[0].text and "First remark" in q[0].text


def test_tagged_docs(spark, tmpdir_path):
    p = write(os.path.join(tmpdir_path, "docs.txt"), DOC_FILE)
    d = {r.doc_id: r for r in read_tagged_docs(spark, p).collect()}
    assert sorted(d) == [1, 2, 3]
    assert d[1].title == "Keeping Bees on a Flat Roof"
    assert "Marlow" in d[1].text and "41\t7\t1" not in d[1].text
    assert ".B" not in d[1].text.split()          # marker lines dropped
    assert "marker inside a line" in d[2].text     # a record without .X ends at the record
    assert "Rooftop Quarterly" in d[2].text
    kept = {r.doc_id: r for r in read_tagged_docs(spark, p, keep_markers=True).collect()}
    assert ".B" in kept[1].text.split()


def test_catalog_csv(spark, tmpdir_path):
    p = write(os.path.join(tmpdir_path, "catalogue.csv"),
              'url,name,categories,developer,publisher\n'
              'u1,"Game, One","Action;Multi-player",Dev,Pub\n'
              'u2,"Two ""quoted""\nname",Indie,Dev2,Pub2\n'
              'u1,Game One again,Action,Dev,Pub\n')
    rows = read_catalog(spark, p).orderBy("row_seq").collect()
    assert [r.url for r in rows] == ["u1", "u2", "u1"]
    assert rows[0].name == "Game, One" and rows[1].name == 'Two "quoted"\nname'
    assert rows[0].row_seq < rows[1].row_seq < rows[2].row_seq


def test_catalog_csv_by_name(spark, tmpdir_path):
    """Columns by name from a file with other columns and another order; null words are nulls."""
    p = write(os.path.join(tmpdir_path, "wide.csv"),
              'publisher,img_url,name,url,date,developer,categories\n'
              'Pub,i.png,Kite,u1,2019,NA,"Games;Toys"\n'
              'NULL,i.png,NaN,u2,2020,Dev,n/a\n')
    rows = read_catalog(spark, p).orderBy("row_seq").collect()
    assert [tuple(r)[:5] for r in rows] == [("u1", "Kite", "Games;Toys", None, "Pub"), ("u2", None, None, "Dev", None)]


def test_catalog_csv_missing_column(spark, tmpdir_path):
    p = write(os.path.join(tmpdir_path, "narrow.csv"), "url,name\nu1,Kite\n")
    with pytest.raises(ValueError, match="categories, developer, publisher"):
        read_catalog(spark, p)


def test_clean_catalog_from_wide_file(spark, tmpdir_path):
    """The cleaning flow over files with extra columns: rows without a name go, the last duplicate stays."""
    from quarry.operators.clean import clean_catalog
    c = write(os.path.join(tmpdir_path, "c.csv"), "img,publisher,developer,categories,name,url\n"
              "x,P,D,C,Kite,u1\nx,P,D,C,N/A,u2\nx,P2,D2,C2,Kite again,u1\n")
    d = write(os.path.join(tmpdir_path, "d.csv"), "full_desc,date,url,desc\nlong one,1,u1,short\nlong two,1,u3,NULL\n")
    got = clean_catalog(read_catalog(spark, c), read_descriptions(spark, d)).collect()
    assert [(r.url, r.name, r.publisher) for r in got] == [("u1", "Kite again", "P2")]


def test_index_round_trip(spark, tmpdir_path):
    docs = spark.createDataFrame([(1, "apple banana apple"), (2, "banana cherry"), (3, "")],
                                 "doc_id long, text string")
    idx = I.build_index(docs)
    q = spark.createDataFrame([(1, "apple cherry")], "query_id long, text string")
    before = sorted(S.search(idx, q).collect())
    save_index(idx, os.path.join(tmpdir_path, "idx"))
    loaded = load_index(spark, os.path.join(tmpdir_path, "idx"))
    after = sorted(S.search(loaded, q).collect())
    assert before == after
    assert loaded.doc_norms.count() == 3
    assert sorted(r.term for r in loaded.term_stats.collect()) == ["appl", "banana", "cherri"]


def explained(df) -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def hundred(spark):
    return spark.createDataFrame([(i, f"word{i} common rest{i % 7}") for i in range(100)], "doc_id long, text string")


def test_stored_index_is_read_by_word(spark, tmpdir_path):
    """Few query words reach the scans as a filter; the file of a shard is sorted by word."""
    save_index(I.build_index(hundred(spark)), os.path.join(tmpdir_path, "idx"))
    idx = load_index(spark, os.path.join(tmpdir_path, "idx"))
    hits = S.search(idx, spark.createDataFrame([(1, "word7")], "query_id long, text string"), k=3)
    assert explained(hits).count("PushedFilters: [IsNotNull(term), EqualTo(term,word7)]") >= 2
    assert [h.doc_id for h in hits.collect()] == [7]
    many = spark.createDataFrame([(1, " ".join(f"word{i}" for i in range(30)))], "query_id long, text string")
    assert "EqualTo(term" not in explained(S.search(idx, many))
    assert S.search(idx, many, k=50).count() == 30


def test_files_are_shards(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "idx")
    meta = save_index(I.build_index(hundred(spark)), path, shards=3)
    folder = os.path.join(path, meta["folder"], "blocks")
    assert meta["shards"] == 3 and len([f for f in os.listdir(folder) if f.endswith(".parquet")]) <= 3
    assert meta["tables"]["blocks"]["files"] <= 3 and meta["docs"] == 100 and meta["postings"] == 300 and meta["terms"] == 108


def test_failed_write_leaves_the_old_version(spark, tmpdir_path, monkeypatch):
    from quarry.sources import store
    path = os.path.join(tmpdir_path, "idx")
    save_index(I.build_index(hundred(spark)), path)
    q = spark.createDataFrame([(1, "word7 rest3")], "query_id long, text string")
    before = S.search(load_index(spark, path), q).collect()
    other = spark.createDataFrame([(1, "word7")], "doc_id long, text string")
    monkeypatch.setattr(store._Files, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        save_index(I.build_index(other), path)
    monkeypatch.undo()
    assert store.versions(spark, path) == [1]
    assert S.search(load_index(spark, path), q).collect() == before


def test_saving_onto_the_loaded_path(spark, tmpdir_path):
    """An index loaded from a path may be written there again; old versions can be read and dropped."""
    from quarry.sources import store
    path = os.path.join(tmpdir_path, "idx")
    save_index(I.build_index(hundred(spark)), path)
    q = spark.createDataFrame([(1, "word7 rest3"), (2, "common")], "query_id long, text string")
    loaded = load_index(spark, path)
    before = sorted(S.search(loaded, q).collect())
    save_index(loaded, path)
    assert store.versions(spark, path) == [1, 2]
    assert sorted(S.search(loaded, q).collect()) == before  # the open index still reads its own files
    assert sorted(S.search(load_index(spark, path), q).collect()) == before
    assert sorted(S.search(load_index(spark, path, version=1), q).collect()) == before
    with pytest.raises(FileExistsError):
        store._Files(spark, path).commit(f"{path}/manifest/2.json", "{}")
    store.drop_versions(spark, path, keep=1)
    assert store.versions(spark, path) == [2] and sum(f.startswith("v") for f in os.listdir(path)) == 1
    assert sorted(S.search(load_index(spark, path), q).collect()) == before
    with pytest.raises(FileNotFoundError):
        load_index(spark, path, version=1)


def test_loading_runs_no_listing_of_partitions(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "idx")
    save_index(I.build_index(hundred(spark)), path)
    idx = load_index(spark, path)
    assert not [f for f in idx.blocks.inputFiles() if "=" in os.path.basename(os.path.dirname(f))]
    post = {(r.term, r.doc_id, r.tf) for r in idx.postings.collect()}
    assert post == {(r.term, r.doc_id, r.tf) for r in I.build_index(hundred(spark)).postings.collect()}
    w = {(r.term, r.doc_id): (round(r.w, 9), round(r.nw, 9)) for r in idx.weights.collect()}
    assert w == {(r.term, r.doc_id): (round(r.w, 9), round(r.nw, 9)) for r in I.build_index(hundred(spark)).weights.collect()}


def test_tagged_queries_64_vs_32(spark, tmpdir_path):
    recs = []
    for i in range(1, 65):
        authors = f".A\nAuthor{i}, X.\n" if i % 8 == 0 else ""
        recs.append(f".I {i}\n.W\n query number {i} about topic{i}\nsecond line {i}\n{authors}.N\n {i}. note\n")
    p = write(os.path.join(tmpdir_path, "q64.txt"), "".join(recs))
    every = read_tagged_queries(spark, p)
    assert every.count() == 64
    assert every.where(F.col("authors").isNotNull()).count() == 8
    odd = {r.query_id: r.text for r in read_tagged_queries(spark, p, odd_only=True).collect()}
    assert sorted(odd) == list(range(1, 33))
    # query k of the odd-only reader is record 2k - 1, note included
    assert "topic5" in odd[3] and "5. note" in odd[3]


def test_tagged_queries_every_second_record(spark, tmpdir_path):
    """The first, third, ... record, whatever the ids are; the last one is left out."""
    text = "".join(f".I {i}\n.W\nquery {i}\n" for i in (2, 4, 7, 9, 20))
    p = write(os.path.join(tmpdir_path, "q.txt"), text)
    odd = {r.query_id: r.text for r in read_tagged_queries(spark, p, odd_only=True).collect()}
    assert {k: v.split()[-1] for k, v in odd.items()} == {1: "2", 2: "7"}
    four = write(os.path.join(tmpdir_path, "q4.txt"), "".join(f".I {i}\n.W\nquery {i}\n" for i in (2, 4, 7, 9)))
    assert [(r.query_id, r.text.split()[-1]) for r in read_tagged_queries(spark, four, odd_only=True).orderBy("query_id").collect()] == [(1, "2"), (2, "7")]


def test_tagged_queries_over_several_splits(spark, tmpdir_path):
    text = "".join(f".I {i * 3}\n.W\nquery {i} {'word ' * (i % 13)}\n" for i in range(1, 400))
    p = write(os.path.join(tmpdir_path, "q.txt"), text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        odd = {r.query_id: int(r.text.split()[2]) for r in read_tagged_queries(spark, p, odd_only=True).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert odd == {k: 2 * k - 1 for k in range(1, 200)}


def test_stored_postings_answer_lookups(spark, tmpdir_path):
    """inverted_index and term_lookup from the blocked postings; one word reaches the scan as a filter."""
    from quarry.operators.lookup import term_lookup
    idx = I.build_index(hundred(spark))
    save_index(idx, os.path.join(tmpdir_path, "idx"))
    loaded = load_index(spark, os.path.join(tmpdir_path, "idx"))
    assert sorted(I.inverted_index(loaded.postings, loaded.term_stats).collect()) == sorted(I.inverted_index(idx.postings, idx.term_stats).collect())
    found = term_lookup(loaded.postings, loaded.term_stats, "rest3")
    assert explained(found).count("EqualTo(term,rest3)") >= 2
    assert sorted(found.collect()) == sorted(term_lookup(idx.postings, idx.term_stats, "rest3").collect())
    assert found.count() == len([i for i in range(100) if i % 7 == 3])


def test_clean_flow_from_csv_files(spark, tmpdir_path):
    from quarry.operators.clean import clean_catalog
    from quarry.sources.catalog import read_descriptions
    cat = write(os.path.join(tmpdir_path, "cat.csv"),
                "url,name,categories,developer,publisher\n"
                "u1,Old,Action,D,P\n"
                "u2,,Puzzle,D,P\n"
                "u1,New,Action;RPG,D,P\n"
                "u3,Third,Indie,D,P\n")
    des = write(os.path.join(tmpdir_path, "des.csv"),
                "url,desc,full_desc\n"
                'u1,"shared, text",x\n'
                "u3,\"shared, text\",x\n"
                "u2,two,x\n"
                "u3,three,\n")
    out = clean_catalog(read_catalog(spark, cat), read_descriptions(spark, des)).orderBy("doc_id").collect()
    # catalogue: u1 keeps its last row ("New"); u2's last row has no name.
    # descriptions: u3 keeps its last row, which has no full_desc; so u1's
    # "shared, text" is no longer a duplicate and survives; u2 has no catalogue row.
    assert [(r.doc_id, r.url, r.name, r.desc) for r in out] == [(0, "u1", "New", "shared, text")]
