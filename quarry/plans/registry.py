"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame
over the whole driver tables, with the same column names as its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import index as I
from quarry.operators import search as S
from quarry.plans.sizing import spread_small_input

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread_small_input(table(spark, sf_dir, "documents").select("doc_id", "text"))


def query_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def corpus_index(spark: SparkSession, sf_dir: str, **kw) -> I.Index:
    return I.build_index(corpus(spark, sf_dir), **kw).prepare()


def r6(x: str):
    return F.round(F.col(x), 6).alias(x)


# --- flagship -------------------------------------------------------------
@register("search_top10")
def search_top10(spark, d):
    return S.search(corpus_index(spark, d), query_table(spark, d), k=10)


@register("search_top10_pruned")
def search_top10_pruned(spark, d):
    """The flagship with exact upper-bound pruning of frequent words: the
    same rows as search_top10 (checked against the same oracle)."""
    from quarry.operators.prune import search_pruned
    return search_pruned(corpus_index(spark, d), query_table(spark, d), k=10)


@register("search_top10_nltk")
def search_top10_nltk(spark, d):
    idx = corpus_index(spark, d, stem="nltk")
    return S.search(idx, query_table(spark, d), k=10, stem="nltk")


# --- index build stages -----------------------------------------------------
@register("tokenize")
def tokenize(spark, d):
    from quarry.functions.text import tokens
    docs = corpus(spark, d)
    return docs.select("doc_id", F.posexplode(tokens(F.col("text"))).alias("pos", "tok")).select(
        "doc_id", F.col("pos").cast("long").alias("pos"), "tok")


@register("abbreviations")
def abbreviations(spark, d):
    from quarry.operators.abbreviations import learn_abbreviations
    return learn_abbreviations(corpus(spark, d)).select("word", "n_stop", "n_plain", r6("score"))


@register("tokenize_learned")
def tokenize_learned(spark, d):
    """Tokens with sentence breaks by the abbreviations that the corpus itself teaches."""
    from quarry.operators.abbreviations import learn_abbreviations, tokens_of_sentences
    docs = corpus(spark, d)
    return tokens_of_sentences(docs, learn_abbreviations(docs)).select(
        "doc_id", F.col("pos").cast("long").alias("pos"), "tok")


@register("remove_stopwords")
def remove_stopwords(spark, d):
    from quarry.functions.text import is_stopword, tokens
    docs = corpus(spark, d)
    t = docs.select("doc_id", F.posexplode(tokens(F.col("text"))).alias("pos", "tok"))
    return t.where(~is_stopword(F.col("tok"))).select(
        "doc_id", F.col("pos").cast("long").alias("pos"), "tok")


@register("normalized_terms")
def normalized_terms(spark, d):
    t = I.normalized_terms(corpus(spark, d))
    return t.select("doc_id", F.col("pos").cast("long").alias("pos"), "term")


@register("stem_vocabulary")
def stem_vocabulary(spark, d):
    from quarry.functions.text import stem_column
    return stem_column(I.surfaces(corpus(spark, d)), "surface", "term").select("surface", "term")


def corpus_surfaces(spark, d) -> DataFrame:
    """(surface, n) of the corpus: lower-cased words that are no stop words."""
    from quarry.operators.stems import surface_counts
    return surface_counts(I.normalized_terms(corpus(spark, d), stem=False).withColumnRenamed("term", "surface"))


@register("stem_dictionary")
def stem_dictionary(spark, d):
    from quarry.operators.stems import stem_dictionary
    return stem_dictionary(corpus_surfaces(spark, d)).select("surface", "term", "n")


@register("postings_by_dictionary")
def postings_by_dictionary(spark, d):
    """The postings, with stems looked up in the corpus's dictionary: the same rows as `postings`."""
    from quarry.operators.stems import stem_dictionary
    words = stem_dictionary(corpus_surfaces(spark, d))
    return I.postings(I.normalized_terms(corpus(spark, d), stems=words))


@register("vocabulary")
def vocabulary(spark, d):
    return I.vocabulary(I.normalized_terms(corpus(spark, d))).select(
        "term", "term_id", "first_doc_id", F.col("first_pos").cast("long").alias("first_pos"))


@register("postings")
def postings(spark, d):
    return corpus_index(spark, d).postings


@register("term_stats")
def term_stats(spark, d):
    return corpus_index(spark, d).term_stats.select("term", "df", "cf")


@register("term_idf")
def term_idf(spark, d):
    return corpus_index(spark, d).term_stats.select("term", "df", r6("idf"))


@register("tfidf_weights")
def tfidf_weights(spark, d):
    return corpus_index(spark, d).weights.select("term", "doc_id", "tf", r6("w"))


@register("sparse_matrix")
def sparse_matrix(spark, d):
    return I.sparse_weights(corpus_index(spark, d).weights).select("term", "doc_id", r6("w"))


@register("doc_norms")
def doc_norms(spark, d):
    return corpus_index(spark, d).doc_norms.select("doc_id", r6("norm"))


@register("inverted_index")
def inverted_index(spark, d):
    idx = corpus_index(spark, d)
    return I.inverted_index(idx.postings, idx.term_stats)


# --- query side -------------------------------------------------------------
@register("normalized_queries")
def normalized_queries(spark, d):
    q = S.normalize_queries(query_table(spark, d))
    return q.select("query_id", F.col("pos").cast("long").alias("pos"), "term")


@register("query_weights")
def query_weights(spark, d):
    qs = S.QuerySide(corpus_index(spark, d), query_table(spark, d))
    return qs.qweights.select("query_id", "term", "qtf", r6("qw"))


@register("query_norms")
def query_norms(spark, d):
    qs = S.QuerySide(corpus_index(spark, d), query_table(spark, d))
    return qs.qnorms.select("query_id", r6("qnorm"))


@register("candidate_docs")
def candidate_docs(spark, d):
    idx = corpus_index(spark, d)
    qs = S.QuerySide(idx, query_table(spark, d))
    return S.candidate_docs(qs.qtf, idx.postings)


@register("cosine_scores")
def cosine_scores(spark, d):
    idx = corpus_index(spark, d)
    return S.cosine_scores(idx, S.QuerySide(idx, query_table(spark, d)))


# --- cleaning ---------------------------------------------------------------
@register("dedup_keep_last")
def dedup_keep_last(spark, d):
    from quarry.operators.clean import keep_last
    part = table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    return keep_last(part, ["p_name"], "p_partkey")


@register("dedup_chained")
def dedup_chained(spark, d):
    from quarry.operators.clean import keep_last_chained
    docs = table(spark, d, "documents").select("doc_id", "lang", "n_chars", "source", "text")
    out = keep_last_chained(docs, [["lang", "n_chars"], ["text"]], "doc_id")
    return out.select("doc_id", "lang", "n_chars", "source")


@register("drop_null_rows")
def drop_null_rows(spark, d):
    from quarry.operators.clean import drop_null, keep_last
    docs = table(spark, d, "documents").select(
        "doc_id", "source", F.nullif(F.col("lang"), F.lit("fr")).alias("name"))
    return drop_null(keep_last(docs, ["source"], "doc_id"), ["name"])


def catalog_frames(spark, d):
    """Catalogue and description tables made from the corpus: url =
    source/lang (so urls repeat), names null for Spanish rows, descriptions
    from labelled documents with full_desc null for toxic ones."""
    docs = table(spark, d, "documents")
    url = F.concat(F.col("source"), F.lit("/"), F.col("lang"))
    catalog = docs.select(url.alias("url"), F.nullif(F.col("lang"), F.lit("es")).alias("name"),
                          F.col("source").alias("categories"), F.col("lang").alias("developer"),
                          F.col("n_chars").cast("string").alias("publisher"),
                          F.col("doc_id").alias("row_seq"))
    labels = table(spark, d, "labels")
    desc = docs.join(labels, "doc_id").select(
        url.alias("url"), F.col("text").alias("desc"),
        F.when(F.col("toxic") == 1, F.lit(None)).otherwise(F.col("text")).alias("full_desc"),
        F.col("doc_id").alias("row_seq"))
    return catalog, desc


@register("clean_catalog")
def clean_catalog(spark, d):
    from quarry.operators.clean import clean_catalog as cc
    catalog, desc = catalog_frames(spark, d)
    return cc(catalog, desc, "row_seq")


@register("doc_text")
def doc_text(spark, d):
    from quarry.functions.text import doc_text as dt
    part = table(spark, d, "part").select(
        "p_partkey", F.col("p_name").alias("name"),
        F.nullif(F.col("p_type"), F.lit("SMALL")).alias("categories"),
        F.col("p_brand").alias("developer"), F.col("p_size").cast("string").alias("desc"))
    return part.select("p_partkey", dt(["name", "categories", "developer", "desc"]).alias("text"))


@register("tagged_sections")
def tagged_sections(spark, d):
    """Sections of tagged query records, composed of the benchmark's texts; every third has no authors."""
    from quarry.sources.tagged import query_fields
    i = F.col("item_id").cast("string")
    authors = F.when(F.col("item_id") % 3 != 0, F.concat(F.lit(".A\nAuthor "), i, F.lit("\n"))).otherwise(F.lit(""))
    body = F.concat(F.lit(".W\n"), "text", F.lit("\n"), authors, F.lit(".N\n "), i, F.lit(". remark"))
    return query_fields(table(spark, d, "benchmark").select(F.col("item_id").alias("rid"), body.alias("body")))


@register("record_text")
def record_text(spark, d):
    """Title and text of tagged document records, composed of the documents; odd ids end with a .X section."""
    from quarry.sources.tagged import doc_fields
    i = F.col("doc_id").cast("string")
    tail = F.when(F.col("doc_id") % 2 == 1, F.lit(".X\n9\t5\t9")).otherwise(F.lit(""))
    body = F.concat(F.lit(".T\nTitle "), i, F.lit("\n.W\n"), "text", F.lit("\n"), tail)
    return doc_fields(table(spark, d, "documents").select(F.col("doc_id").alias("rid"), body.alias("body")))


# --- retrieval variants -----------------------------------------------------
def corpus_synonyms(spark, d):
    """Synonym table derived from the corpus: each surface word's first sense
    lists the word itself, its stem (when it differs), and the word reversed; a
    second sense lists the reversed word too, which no query may pick."""
    vocab = stem_vocabulary(spark, d).persist()
    first = vocab.select(F.col("surface").alias("word"), F.lit(0).alias("sense_rank"),
                         F.lit(0).alias("lemma_rank"), F.col("surface").alias("lemma"))
    second = vocab.where(F.col("term") != F.col("surface")).select(
        F.col("surface").alias("word"), F.lit(0).alias("sense_rank"),
        F.lit(1).alias("lemma_rank"), F.col("term").alias("lemma"))
    other = vocab.select(F.col("surface").alias("word"), F.explode(F.array(F.struct(F.lit(0), F.lit(2)), F.struct(F.lit(1), F.lit(1)))).alias("r"),
                         F.reverse("surface").alias("lemma"))
    other = other.select("word", F.col("r.col1").alias("sense_rank"), F.col("r.col2").alias("lemma_rank"), "lemma")
    return first.unionByName(second).unionByName(other)


@register("synonym_expand")
def synonym_expand(spark, d):
    q = S.normalize_queries(query_table(spark, d), synonyms=corpus_synonyms(spark, d))
    return q.select("query_id", F.col("pos").cast("long").alias("pos"), "term")


@register("search_synonyms")
def search_synonyms(spark, d):
    return S.search(corpus_index(spark, d), query_table(spark, d), k=10,
                    synonyms=corpus_synonyms(spark, d))


@register("search_exhaustive")
def search_exhaustive(spark, d):
    return S.search_exhaustive(corpus_index(spark, d), query_table(spark, d), k=10)


@register("search_eval_cut")
def search_eval_cut(spark, d):
    return S.search_eval(corpus_index(spark, d), query_table(spark, d))


def name_queries(spark, d):
    """Benchmark items plus the distinct part names (ids -1 - min key), which
    hold no indexed word: queries with and without results."""
    names = table(spark, d, "part").groupBy("p_name").agg(
        (-1 - F.min("p_partkey")).alias("query_id")).select("query_id", F.col("p_name").alias("text"))
    return query_table(spark, d).unionByName(names)


@register("search_status")
def search_status(spark, d):
    qs = name_queries(spark, d)
    hits = S.search(corpus_index(spark, d), qs, k=10)
    return S.search_status(qs, hits)


def titled_docs(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", F.substring_index(F.col("text"), "\n", 1).alias("title"), "lang", "source")


@register("search_labels")
def search_labels(spark, d):
    hits = S.search_eval(corpus_index(spark, d), query_table(spark, d))
    return S.label_hits(hits, titled_docs(spark, d))


@register("augmented_query")
def augmented_query(spark, d):
    q = S.augment_query(query_table(spark, d), {"single_player": F.lit(True), "online": F.lit(True)})
    return S.search(corpus_index(spark, d), q, k=10)


@register("search_with_attrs")
def search_with_attrs(spark, d):
    hits = S.search(corpus_index(spark, d), query_table(spark, d), k=10)
    return S.attach_attrs(hits, titled_docs(spark, d), ["lang", "source"])


# --- pages ------------------------------------------------------------------
def test_page_selectors():
    """Selectors for the driver's pages: meta charset, nav links, class "ad"."""
    from quarry.operators.pages import Selectors
    return Selectors(meta_attr="charset", meta_value=None, meta_take="charset",
                     image_class=None, price_class="ad", discount_class="discount_final_price",
                     review_class="ad", tag_class="ad", tag_browse_class=None, tag_browse_tag="a")


def page_table(spark, d):
    return table(spark, d, "pages").select("page_id", "url", "html")


@register("page_meta")
def page_meta(spark, d):
    from quarry.functions import html as H
    h = F.col("html")
    return page_table(spark, d).select(
        "page_id", H.meta_content(h, "charset", None, "charset").alias("charset"),
        H.meta_content(h, "property", "og:description", "content").alias("description"))


@register("page_links")
def page_links(spark, d):
    from quarry.functions import html as H
    return page_table(spark, d).select(
        "page_id", F.array_join(H.links_by_class(F.col("html"), None), "|").alias("links"))


@register("page_pick_link")
def page_pick_link(spark, d):
    from quarry.functions import html as H
    links = H.links_by_class(F.col("html"), None)
    return page_table(spark, d).select("page_id", H.pick_link(links, F.col("page_id")).alias("image"))


@register("page_text_by_class")
def page_text_by_class(spark, d):
    from quarry.functions import html as H
    return page_table(spark, d).select(
        "page_id", H.text_by_class(F.col("html"), "ad", H.NO_PRICE).alias("base_price"))


@register("page_price_rule")
def page_price_rule(spark, d):
    from quarry.functions import html as H
    h = F.col("html")
    base = H.text_by_class(h, "ad", H.NO_PRICE)
    disc = F.nullif(H.text_by_class(h, "discount_final_price", ""), F.lit(""))
    return page_table(spark, d).select(
        "page_id", base.alias("base_price"), H.discount_price(base, disc).alias("discount_price"))


@register("page_text_raw")
def page_text_raw(spark, d):
    from quarry.functions import html as H
    return page_table(spark, d).select(
        "page_id", H.text_by_class(F.col("html"), "ad", H.NO_REVIEW, strip=False).alias("review"))


@register("page_texts")
def page_texts(spark, d):
    from quarry.functions import html as H
    return page_table(spark, d).select(
        "page_id", F.array_join(H.texts_by_class(F.col("html"), None, "a"), "|").alias("texts"))


@register("page_tag_list")
def page_tag_list(spark, d):
    from quarry.functions import html as H
    return page_table(spark, d).select(
        "page_id", F.array_join(H.page_tags(F.col("html"), "ad"), "|").alias("tags"))


@register("tag_counts")
def tag_counts(spark, d):
    from quarry.operators.pages import tag_catalogue
    return tag_catalogue(page_table(spark, d), test_page_selectors())


@register("enrich_hits")
def enrich_hits(spark, d):
    from quarry.operators.pages import enrich_hits as eh
    from quarry.operators.pages import page_fields
    pages = page_table(spark, d)
    n_pages = pages.select(F.count(F.lit(1))).scalar()
    hits = S.search(corpus_index(spark, d), query_table(spark, d), k=10)
    hits = hits.withColumn("page_id", F.pmod(F.col("doc_id"), n_pages))
    out = eh(hits, page_fields(pages, test_page_selectors()), "page_id", "page_id")
    return out.drop("page_id")


# --- lookups ----------------------------------------------------------------
def part_catalog(spark, d):
    return table(spark, d, "part").select(
        "p_partkey", F.concat(F.lit("part/"), F.col("p_partkey").cast("string")).alias("url"),
        F.col("p_name").alias("name"), F.col("p_type").alias("categories"),
        F.col("p_brand").alias("developer"))


@register("docs_by_category")
def docs_by_category(spark, d):
    from quarry.operators.lookup import docs_by_category as f
    return f(part_catalog(spark, d), "AR")


@register("url_by_name")
def url_by_name(spark, d):
    from quarry.operators.lookup import url_by_name as f
    return f(part_catalog(spark, d), "red plate")


@register("doc_by_name")
def doc_by_name(spark, d):
    from quarry.operators.lookup import doc_by_name as f
    return f(part_catalog(spark, d), "red plate")


@register("term_lookup")
def term_lookup(spark, d):
    from quarry.operators.lookup import term_lookup as f
    idx = corpus_index(spark, d)
    return f(idx.postings, idx.term_stats, "the")


# --- the whole interactive flow, for a table of queries -----------------------
@register("search_flow")
def search_flow(spark, d):
    """Facet words appended (R13) -> synonyms (R2) -> ranked top 10 (R6) ->
    status per query (R11) -> hits joined to page fields (J5)."""
    from quarry.operators.pages import enrich_hits as eh
    from quarry.operators.pages import page_fields
    queries = S.augment_query(name_queries(spark, d),
                              {"single_player": F.lit(True), "online": F.lit(True)})
    hits = S.search(corpus_index(spark, d), queries, k=10, synonyms=corpus_synonyms(spark, d))
    pages = page_table(spark, d)
    n_pages = pages.select(F.count(F.lit(1))).scalar()
    hits = hits.withColumn("page_id", F.pmod(F.col("doc_id"), n_pages))
    shown = eh(hits, page_fields(pages, test_page_selectors()), "page_id", "page_id").drop("page_id")
    return S.search_status(queries, hits).join(shown, "query_id", "left")


@register("catalog_search")
def catalog_search(spark, d):
    """The reference's main pipeline: clean the catalogue, index the text
    " name categories developer desc" (publisher not indexed), search, and
    return the url of each hit."""
    from quarry.functions.text import doc_text
    from quarry.operators.clean import clean_catalog as cc
    catalog, desc = catalog_frames(spark, d)
    docs = cc(catalog, desc, "row_seq").select(
        "doc_id", "url", doc_text(["name", "categories", "developer", "desc"]).alias("text"))
    hits = S.search(I.build_index(docs), query_table(spark, d), k=10)
    return S.attach_attrs(hits, docs, ["url"])
