"""Index build: terms -> postings -> term statistics -> tf-idf -> norms.

Everything is a DataFrame keyed by columns (no positional ids, no dense
matrix), and nothing runs before an action.  Shuffles: the documents are
hashed by block of ids before their texts are exploded, so the postings are
counted where their document is; statistics aggregate by term with map-side
partial aggregation; the weights are hashed by block once more, after they
met the statistics, and lengths and blocked postings are made there.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators.abbreviations import tokens_of_sentences
from quarry.operators.blocks import BLOCK_BITS, block_of, block_postings
from quarry.operators.stems import stem_by_dictionary
from quarry.plans import sizing
from quarry.plans.ordering import dense_index


def split_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (),
                 abbreviations: DataFrame | None = None) -> DataFrame:
    """(*keep, doc_id, pos, tok), by the default sentence breaks or by learned ones."""
    if abbreviations is not None:
        return tokens_of_sentences(docs, abbreviations, id_col, text_col, keep)
    return docs.select(*keep, F.col(id_col).cast("long").alias("doc_id"),
                       F.posexplode(T.tokens(F.col(text_col))).alias("pos", "tok"))


def normalized_terms(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     stopwords: list[str] | None = None, stem: bool | str = True,
                     keep: tuple[str, ...] = (), abbreviations: DataFrame | None = None,
                     stems: DataFrame | None = None) -> DataFrame:
    """(doc_id, pos, term) — tokenise, drop stop words (case-sensitive,
    before lower-casing), lower-case, stem.  ``pos`` is the 0-based token
    position in the text before stop words are dropped.  ``stem``: True (the
    1980 Porter rules), "nltk" (NLTK's variant) or False.  Columns of ``keep``
    stay beside them.  ``abbreviations``: a learned table of words whose stop ends no
    sentence (operators.abbreviations); None for the default rules.  ``stems``: a stem
    dictionary (operators.stems) to look words up in; None applies the rules to each token."""
    toks = split_tokens(docs, id_col, text_col, keep, abbreviations)
    toks = toks.where(~T.is_stopword(F.col("tok"), stopwords))
    toks = toks.select(*keep, "doc_id", "pos", F.lower("tok").alias("surface"))
    if stem and stems is not None:
        toks = stem_by_dictionary(toks, stems, mode=stem_mode(stem))
    elif stem:
        toks = T.stem_column(toks, "surface", "term", stem_mode(stem))
    else:
        toks = toks.withColumnRenamed("surface", "term")
    return toks.select(*keep, "doc_id", "pos", "term")


def stem_mode(stem: bool | str) -> str:
    return "porter" if stem is True else str(stem)


def vocabulary(terms: DataFrame) -> DataFrame:
    """A1: distinct terms with ``term_id`` in first-seen order
    (by the first (doc_id, pos) at which the term occurs).  The pair is one decimal
    number, doc_id * 2^31 + pos, so a hash aggregate can hold it."""
    at = F.col("doc_id").cast("decimal(20,0)") * F.lit(1 << 31).cast("decimal(10,0)") + F.col("pos")
    first = terms.groupBy("term").agg(F.min(at.cast("decimal(38,0)")).alias("at"))
    pos = F.expr("cast(pmod(at, 2147483648BD) as long)")
    first = first.select("term", F.expr("(at - pmod(at, 2147483648BD)) div 2147483648BD").alias("first_doc_id"), pos.cast("int").alias("first_pos"))
    return dense_index(first, ["first_doc_id", "first_pos"], "term_id").select(
        "term", "term_id", "first_doc_id", "first_pos")


def postings(terms: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """A2: (term, doc_id, tf), and columns of ``keep`` that depend on doc_id."""
    return terms.groupBy("term", "doc_id", *keep).agg(F.count(F.lit(1)).cast("long").alias("tf"))


def surfaces(docs: DataFrame, text_col: str = "text", stopwords: list[str] | None = None) -> DataFrame:
    """(surface): the distinct lower-cased tokens that are no stop words, by way of the distinct words."""
    found = docs.select(F.explode(T.words(F.col(text_col))).alias("word")).where(F.col("word") != "").distinct()
    toks = found.select(F.explode(T.word_tokens("word")).alias("tok")).where(~T.is_stopword(F.col("tok"), stopwords))
    return toks.select(F.lower("tok").alias("surface")).distinct()


def collection_size(docs: DataFrame) -> Column:
    """N as a scalar subquery (counts documents with no terms too)."""
    return docs.select(F.count(F.lit(1)).cast("double")).scalar()


def term_stats(post: DataFrame, n_docs: Column) -> DataFrame:
    """(term, df, cf, idf) with idf = log2(N / df)."""
    stats = post.groupBy("term").agg(F.count(F.lit(1)).cast("long").alias("df"),
                                     F.sum("tf").cast("long").alias("cf"))
    return stats.withColumn("idf", F.log2(n_docs / F.col("df")))


def join_stats(post: DataFrame, stats: DataFrame, cols: list[str],
               max_broadcast_rows: int | None = None) -> DataFrame:
    """postings ⋈ term statistics on ``term``, safe for hot terms.

    Terms in h = #postings / bound documents or more (a scalar subquery, so no
    job runs while the plan is made) are broadcast and joined map-side: there
    are at most ``bound`` of them, whatever the data; with fewer postings than
    the bound, h is 1 and no posting is shuffled.  The remaining postings, no
    term of which has h rows, go into a shuffled join.
    """
    bound = sizing.broadcast_rows(post.sparkSession) if max_broadcast_rows is None else max_broadcast_rows
    h = stats.select(F.greatest(F.lit(1), F.ceil(F.coalesce(F.sum("df"), F.lit(0)) / bound))).scalar()
    hot = stats.where(F.col("df") >= h).select("term", *cols)
    hot_part = post.join(F.broadcast(hot), "term")
    cold_post = post.join(F.broadcast(hot.select("term")), "term", "left_anti")
    cold_part = cold_post.join(stats.where(F.col("df") < h).select("term", *cols), "term")
    return hot_part.unionByName(cold_part)


def tfidf_weights(post: DataFrame, stats: DataFrame, max_broadcast_rows: int | None = None,
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """(term, doc_id, tf, w) with w = tf * idf (zeros kept), and columns of ``keep``."""
    joined = join_stats(post, stats, ["idf"], max_broadcast_rows)
    return joined.select("term", "doc_id", "tf", (F.col("tf") * F.col("idf")).alias("w"), *keep)


def sparse_weights(weights: DataFrame) -> DataFrame:
    """Stored (non-zero) entries of the document-term matrix."""
    return weights.where(F.col("w") != 0)


def doc_norms(docs: DataFrame, weights: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """A10: (doc_id, norm) = sqrt(sum w^2); 0 for a document with no weight."""
    sq = weights.groupBy("doc_id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"))
    return ids.join(sq, "doc_id", "left").select(
        "doc_id", F.coalesce("norm", F.lit(0.0)).alias("norm"))


def block_lengths(weights: DataFrame) -> DataFrame:
    """(blk, doc_id, norm) of each document with terms, by partial sums: no weight moves for it."""
    return weights.groupBy("blk", "doc_id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))


def unit_weights(weights: DataFrame, bits: int = BLOCK_BITS) -> DataFrame:
    """(term, doc_id, tf, idf, w, nw, blk) with nw = w / |document| (NULL for a zero length), so a
    query scores by one join and one sum.  The weights are hashed by block of documents; the
    length is a sum within the document, so no table of lengths is joined."""
    if "blk" not in weights.columns:
        weights = weights.withColumn("blk", block_of("doc_id", bits))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("blk", "doc_id")))
    return weights.repartition("blk").select("term", "doc_id", "tf", "idf", "w", F.try_divide(F.col("w"), norm).alias("nw"), "blk")


def inverted_index(post: DataFrame, stats: DataFrame) -> DataFrame:
    """A5: index entries in long form, (term, df, cf, doc_id, tf), one row per
    posting.  A frequent term's list can hold every document, so the list is
    never gathered into one row (or one task); read it back ordered by
    (term, doc_id) from the stored, sorted postings."""
    return join_stats(post, stats, ["df", "cf"]).select("term", "df", "cf", "doc_id", "tf")


@dataclass
class Index:
    docs: DataFrame        # doc_id + attributes
    postings: DataFrame    # term, doc_id, tf
    term_stats: DataFrame  # term, df, cf, idf
    weights: DataFrame     # term, doc_id, tf, w, nw, blk
    doc_norms: DataFrame   # doc_id, norm
    blocks: DataFrame      # the weights as blocked postings (operators.blocks)
    bits: int = BLOCK_BITS
    stored: bool = False   # the blocks are a table, bucketed by block and sorted by term
    text_col: str = "text"     # not stored with the index (the corpus stays where it is)
    placed: DataFrame | None = None   # of an index not stored: the postings with blk, hashed by it
    lengths: DataFrame | None = None  # of an index not stored: blk, doc_id, norm of each document with terms
    kept: tuple[DataFrame, ...] = ()

    def prepare(self) -> Index:
        """Make what the build keeps by one job (none if nothing is kept).  Else each place of a plan
        that reads it starts a job of its own to make it, all at the same time, on other executors."""
        if self.kept:
            self.kept[-1].write.format("noop").mode("overwrite").save()
        return self

    def release(self) -> None:
        """Drop what the build keeps in the cache."""
        for df in self.kept:
            df.unpersist()


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                stopwords: list[str] | None = None, stem: bool | str = True,
                max_broadcast_rows: int | None = None,
                cut_lineage: bool = False, bits: int = BLOCK_BITS,
                abbreviations: DataFrame | None = None, stems: DataFrame | None = None) -> Index:
    """The whole offline build, as a plan: no job runs before an action
    (``abbreviations``, a learned table, and ``stems``, a stem dictionary, are measured
    first; give `search` the same abbreviations).

    ``cut_lineage=True`` checkpoints the postings into the session's
    checkpoint folder (``spark.checkpoint.dir``, shared by the cluster; a job),
    so a lost executor later costs a re-read of the postings rather than a
    re-run of the tokeniser over its share of the corpus."""
    docs = docs.withColumn("doc_id", F.col(id_col).cast("long")) if id_col != "doc_id" else docs
    n = sizing.text_tasks(docs)
    placed = docs.select(block_of(F.col("doc_id").cast("long"), bits).alias("blk"), "doc_id", text_col)
    placed = placed.repartition(n, "blk") if n else placed.repartition("blk")
    terms = normalized_terms(placed, "doc_id", text_col, stopwords, stem, keep=("blk",), abbreviations=abbreviations, stems=stems)
    post = postings(terms, keep=("blk",))
    # statistics, weights and norms all read the postings: keep them (memory,
    # spilling to disk; lost blocks are recomputed) so the text is tokenised
    # and stemmed once, not once per consumer
    if cut_lineage:
        from quarry.session import ensure_checkpoint_dir
        ensure_checkpoint_dir(docs.sparkSession)
        post = post.checkpoint(eager=True)
    else:
        post = post.persist(StorageLevel.MEMORY_AND_DISK)
    # read by each weight, norm and query, under other columns and filters each time
    stats = term_stats(post, collection_size(docs)).persist(StorageLevel.MEMORY_AND_DISK)
    weights = tfidf_weights(post, stats, max_broadcast_rows, keep=("idf", "blk"))
    unit = unit_weights(weights, bits)
    return Index(docs, post.select("term", "doc_id", "tf"), stats, unit, doc_norms(docs, weights),
                 block_postings(unit, bits), bits, text_col=text_col, placed=post, lengths=block_lengths(weights), kept=(stats,) if cut_lineage else (post, stats))
