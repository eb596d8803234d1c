"""Query preparation and ranked retrieval for a whole table of queries.

Plan shape of ``search``: the query side (a few rows per query) is counted
and broadcast (or, past a bound, shuffled with frequent terms spread); the weights are scanned
once and joined on ``term`` map-side.  The weights arrive partitioned by
block of documents (a bucketed stored index, whose blocked postings are joined
before they are exploded, or the exchange of the build),
so the (query_id, doc_id) dot products are summed inside each task with no
exchange; ``row_number() <= k`` becomes a partial WindowGroupLimit, so at
most k rows per query and task reach the one shuffle, on ``query_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators.blocks import block_of, doc_id_at
from quarry.operators.index import Index, split_tokens
from quarry.plans import sizing

SCORE_DIGITS = 6
# up to this many distinct words (the scan's limit for exact membership filters) go into a filter
_FEW_WORDS = 10
_FEW_ROWS = 1000
# words the two filter check-boxes append to a query (they rank, not filter)
FACET_WORDS = {"single_player": "Singleplayer", "online": "Online"}


def augment_query(queries: DataFrame, flags: dict[str, Column], text_col: str = "text",
                  words: dict[str, str] | None = None) -> DataFrame:
    """Append the facet word of every ticked flag to the query text."""
    words = words or FACET_WORDS
    text = F.col(text_col)
    for key, flag in flags.items():
        text = F.when(flag, F.concat(text, F.lit(" " + words[key]))).otherwise(text)
    return queries.withColumn(text_col, text)


def query_tokens(queries: DataFrame, id_col: str = "query_id", text_col: str = "text",
                 stopwords: list[str] | None = None, abbreviations: DataFrame | None = None) -> DataFrame:
    """(query_id, pos, tok): tokens left after stop-word removal."""
    toks = split_tokens(sizing.spread_small_input(queries), id_col, text_col, abbreviations=abbreviations)
    toks = toks.withColumnRenamed("doc_id", "query_id")
    return toks.where(~T.is_stopword(F.col("tok"), stopwords))


def _of_word(toks: DataFrame, table: DataFrame, word: str, max_rows: int | None = None, salts: int = 16) -> DataFrame:
    """toks ⋈ table on a word. The table is measured: within the bound it is broadcast; beyond it a
    frequent word is dealt over ``salts`` keys, for each of which the table's row is repeated."""
    sized = sizing.measure(table, max_rows)
    if sized.broadcast:
        return toks.join(F.broadcast(sized.df), word)
    salted = sized.df.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return toks.withColumn("__salt", F.pmod(F.xxhash64("query_id", "pos"), F.lit(salts)).cast("int")).join(salted, [word, "__salt"]).drop("__salt")


def expand_synonyms(toks: DataFrame, synonyms: DataFrame, max_rows: int | None = None) -> DataFrame:
    """R2: per token, the 2nd lemma of its first sense, when there is one and
    it is not already one of the query's own tokens; appended as a bag (two
    tokens with the same synonym add it twice)."""
    pick = synonyms.where((F.col("sense_rank") == 0) & (F.col("lemma_rank") == 1)).select(
        F.col("word").alias("syn_word"), F.col("lemma").alias("syn"))
    asked = toks.select(F.lower("tok").alias("syn_word")).distinct()
    found = _of_word(toks.withColumn("syn_word", F.lower("tok")), pick.join(asked, "syn_word", "left_semi"), "syn_word", max_rows).select(
        "query_id", "pos", F.col("syn").alias("tok"))
    own = toks.select("query_id", F.col("tok").alias("own"))
    fresh = found.join(own, (found.query_id == own.query_id) & (found.tok == own.own), "left_anti")
    return toks.select("query_id", "pos", "tok").unionByName(fresh.select("query_id", "pos", "tok"))


def normalize_queries(queries: DataFrame, id_col: str = "query_id", text_col: str = "text",
                      stopwords: list[str] | None = None, synonyms: DataFrame | None = None,
                      stem: bool | str = True, abbreviations: DataFrame | None = None) -> DataFrame:
    """R1 (+R2): (query_id, pos, term) — same token, stop, lower and stem
    rules as the documents."""
    toks = query_tokens(queries, id_col, text_col, stopwords, abbreviations)
    if synonyms is not None:
        toks = expand_synonyms(toks, synonyms)
    toks = toks.select("query_id", "pos", F.lower("tok").alias("surface"))
    if stem:
        toks = T.stem_column(toks, "surface", "term", "porter" if stem is True else str(stem))
    else:
        toks = toks.withColumnRenamed("surface", "term")
    return toks.select("query_id", "pos", "term")


def query_term_counts(qterms: DataFrame) -> DataFrame:
    """(query_id, term, qtf); repeated words add up."""
    return qterms.groupBy("query_id", "term").agg(F.count(F.lit(1)).cast("long").alias("qtf"))


def query_weights(qtf: DataFrame, stats: DataFrame) -> DataFrame:
    """(query_id, term, qtf, qw = qtf * idf); unknown terms drop out."""
    return qtf.join(stats.select("term", "idf"), "term").select(
        "query_id", "term", "qtf", (F.col("qtf") * F.col("idf")).alias("qw"))


def query_norms(qweights: DataFrame) -> DataFrame:
    """(query_id, qnorm) over in-vocabulary terms."""
    return qweights.groupBy("query_id").agg(
        F.sqrt(F.sum(F.col("qw") * F.col("qw"))).alias("qnorm"))


def candidate_docs(qterms: DataFrame, post: DataFrame) -> DataFrame:
    """Distinct (query_id, doc_id) holding any query term (an
    idf-0 term still makes a candidate)."""
    qt = qterms.select("query_id", "term")
    if "qtf" not in qterms.columns:  # raw query terms repeat; counted ones are distinct
        qt = qt.distinct()
    return qt.join(post.select("term", "doc_id"), "term").select("query_id", "doc_id").distinct()


def _dot_parts(qweights: DataFrame, weights: DataFrame, spread: DataFrame | None = None) -> DataFrame:
    """(query_id, doc_id, blk, part = qw * w / doc_norm) for every matching posting.

    ``spread`` (term, salts): frequent terms of a shuffled join. Their postings are dealt over
    ``salts`` keys by document, and their query rows are repeated for each."""
    keys = ["term"]
    w, q = weights.select("term", "doc_id", "nw", "blk"), qweights.drop("qtf")
    if spread is not None:
        salts = F.coalesce("salts", F.lit(1))
        w = w.join(F.broadcast(spread), "term", "left").withColumn("salt", F.pmod(F.xxhash64("doc_id"), salts)).drop("salts")
        q = q.join(F.broadcast(spread), "term", "left").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))).drop("salts")
        keys = [*keys, "salt"]
    return w.join(q, keys).select("query_id", "doc_id", "blk", (F.col("qw") * F.col("nw")).alias("part"))


def _block_parts(qweights: DataFrame, blocks: DataFrame, bits: int) -> DataFrame:
    """The same from blocked postings: a row per (query word, block) is joined, then its entries come out."""
    rows = blocks.select("term", "blk", "offs", "nws").join(qweights.drop("qtf"), "term")
    rows = rows.select("query_id", "blk", "qw", F.explode(F.arrays_zip("offs", "nws")).alias("e"))
    return rows.select("query_id", doc_id_at(F.col("e.offs"), bits).alias("doc_id"), "blk", (F.col("qw") * F.col("e.nws")).alias("part"))


def _dots(parts: DataFrame) -> DataFrame:
    """(query_id, blk, doc_id, dotn).  The block follows from the document; as a key it tells that no rows need to move."""
    return parts.groupBy("query_id", "blk", "doc_id").agg(F.sum("part").alias("dotn"))


def _placed_parts(qtf: DataFrame, stats: DataFrame, placed: DataFrame) -> DataFrame:
    """(query_id, doc_id, blk, part = qw * w): the postings of query words only, where they are kept."""
    words = F.broadcast(qtf.join(stats.select("term", "idf"), "term"))
    part = (F.col("qtf") * F.col("idf")) * (F.col("tf") * F.col("idf"))
    return placed.select("term", "doc_id", "tf", "blk").join(words, "term").select("query_id", "doc_id", "blk", part.alias("part"))


def _over_lengths(dots: DataFrame, lengths: DataFrame) -> DataFrame:
    """dots / |document|.  The block is the only key, as both sides are hashed by it and the dots stay where
    they are; it has few documents, one of which is the right one."""
    n = lengths.select(F.col("blk").alias("__blk"), F.col("doc_id").alias("__doc"), "norm").hint("shuffle_hash")
    same = (F.col("doc_id") - F.col("__doc") == 0) | (F.col("doc_id").isNull() & F.col("__doc").isNull())
    return dots.join(n, (F.col("blk") == F.col("__blk")) & same, "left").select(
        "query_id", "blk", "doc_id", F.try_divide("dotn", "norm").alias("dotn"))


def _scores(dots: DataFrame, qnorms: DataFrame) -> DataFrame:
    """cosine = dot / (doc_norm * query_norm); a zero length gives NULL."""
    return dots.join(qnorms, "query_id", "left").select(
        "query_id", "doc_id",
        F.round(F.try_divide(F.col("dotn"), F.col("qnorm")), SCORE_DIGITS).alias("score"))


def rank_top_k(scores: DataFrame, k: int) -> DataFrame:
    """O1/O2: per query, score descending (NULL last), then doc_id; first k."""
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc_nulls_last(), F.col("doc_id"))
    return (scores.withColumn("rank", F.row_number().over(w))
                  .where(F.col("rank") <= k)
                  .select("query_id", F.col("rank").cast("long").alias("rank"), "doc_id", "score"))


class QuerySide:
    """Query terms measured once; broadcast when within the bound.

    A query side beyond the bound is shuffled against the weights by term, in one scan of them.
    Terms so frequent that their postings would be a task of their own are spread: with
    h = #postings / bound there are at most ``bound`` terms in h documents or more, so their list
    is broadcast, and each is dealt over df / h keys (see ``_dot_parts``).
    """

    def __init__(self, index: Index, queries: DataFrame, id_col: str = "query_id",
                 text_col: str = "text", stopwords: list[str] | None = None,
                 synonyms: DataFrame | None = None, stem: bool | str = True,
                 max_broadcast_rows: int | None = None, abbreviations: DataFrame | None = None):
        qterms = normalize_queries(queries, id_col, text_col, stopwords, synonyms, stem, abbreviations)
        counts = query_term_counts(qterms)
        self.index = index
        self.max_rows = (sizing.broadcast_rows(queries.sparkSession)
                         if max_broadcast_rows is None else max_broadcast_rows)
        self.sized = sizing.measure(counts, self.max_rows)
        # a few words against a stored index: named in a filter, they skip the row groups of other words
        self.words = None
        if index.stored and self.sized.rows <= _FEW_ROWS:
            words = self.sized.df.select("term").distinct().limit(_FEW_WORDS + 1).collect()
            self.words = [r.term for r in words] if len(words) <= _FEW_WORDS else None
        self.query_ids = queries.select(F.col(id_col).cast("long").alias("query_id"))
        self._use(self.sized.df, self.sized.broadcast)

    def release(self) -> None:
        """Drop the counted query side from the cache once results are written."""
        self.sized.df.unpersist()

    def _use(self, counts: DataFrame, broadcast: bool) -> None:
        hint = F.broadcast if broadcast else (lambda d: d)
        self.broadcast = broadcast
        self.qtf = hint(counts)
        # an inner join on the unique term key cannot add rows
        self.qweights = hint(query_weights(self.qtf, self.of_words(self.index.term_stats)))
        self.qnorms = hint(query_norms(self.qweights))

    def of_words(self, df: DataFrame) -> DataFrame:
        """The rows of the query words, where those are few."""
        return df if self.words is None else df.where(F.col("term").isin(self.words))

    def parts(self) -> DataFrame:
        """(query_id, doc_id, blk, part) over all postings of the query terms."""
        if not self.broadcast:
            return _dot_parts(self.qweights, self.index.weights, self._spread())
        if self.index.stored:
            return _block_parts(self.qweights, self.of_words(self.index.blocks), self.index.bits)
        return _dot_parts(self.qweights, self.index.weights)

    def dots(self, fill: DataFrame | None = None) -> DataFrame:
        """(query_id, blk, doc_id, dotn = dot / |document|) of every candidate, and of rows of ``fill``,
        whose part is 0.  A broadcast query side meets the kept postings of an index that is not stored: only
        postings of query words are weighted, and lengths divide the sums."""
        with_fill = (lambda p: p) if fill is None else (lambda p: p.unionByName(fill))
        if not self.broadcast or self.index.placed is None:
            return _dots(with_fill(self.parts()))
        parts = _placed_parts(self.qtf, self.of_words(self.index.term_stats), self.index.placed)
        return _over_lengths(_dots(with_fill(parts)), self.index.lengths)

    def _spread(self) -> DataFrame:
        stats = self.index.term_stats
        h = max(1, -(-(stats.agg(F.sum("df")).first()[0] or 0) // self.max_rows))
        return stats.where(F.col("df") >= h).select("term", F.ceil(F.col("df") / h).alias("salts"))


def cosine_scores(index: Index, qs: QuerySide) -> DataFrame:
    """(query_id, doc_id, score) for every candidate document."""
    return _scores(qs.dots(), qs.qnorms)


def search(index: Index, queries: DataFrame, k: int = 10, **kw) -> DataFrame:
    """Pruned ranked retrieval for a table of queries:
    (query_id, rank, doc_id, score).  A query without an indexed term has
    no rows (R10)."""
    qs = QuerySide(index, queries, **kw)
    return rank_top_k(cosine_scores(index, qs), k)


def search_exhaustive(index: Index, queries: DataFrame, k: int = 10, **kw) -> DataFrame:
    """Every document is scored, so zero-score documents fill the list.

    Not materialised as |Q| x N pairs: besides the candidates, only the first
    k documents (by doc_id) with a non-zero length and the first k with zero
    length can enter any query's top k — a bounded list of at most 2k ids,
    built once by a scalar subquery and exploded per query.
    """
    qs = QuerySide(index, queries, **kw)
    norms = index.doc_norms
    # one reading of the lengths; row_number() <= k leaves k rows of each kind per task
    kind = Window.partitionBy("has_norm").orderBy("doc_id")
    first = norms.select("doc_id", (F.col("norm") > 0).alias("has_norm")).withColumn("nth", F.row_number().over(kind))
    fill_list = first.where(F.col("nth") <= k).select(F.collect_list(F.struct("doc_id", "has_norm"))).scalar()
    fill = qs.query_ids.select("query_id", F.explode(fill_list).alias("f")).select(
        "query_id", F.col("f.doc_id").alias("doc_id"), block_of("f.doc_id", index.bits).alias("blk"),
        F.when(F.col("f.has_norm"), F.lit(0.0)).alias("part"))
    qnorms = qs.query_ids.join(qs.qnorms, "query_id", "left").select(
        "query_id", F.coalesce("qnorm", F.lit(0.0)).alias("qnorm"))
    return rank_top_k(_scores(qs.dots(fill), qnorms), k)


def search_eval(index: Index, queries: DataFrame, **kw) -> DataFrame:
    """Evaluation cut: top 5 when a query has 10 or more candidates,
    otherwise all of them (up to 9).  No synonym expansion."""
    kw.pop("synonyms", None)
    qs = QuerySide(index, queries, **kw)
    # a query has ten candidates or more exactly when its list has a tenth row, so the
    # ten best rows (a window over rows that the rank limit has cut) tell both
    top = rank_top_k(cosine_scores(index, qs), 10)
    n = F.count(F.lit(1)).over(Window.partitionBy("query_id"))
    return (top.withColumn("n_candidates", n)
            .where(F.col("rank") <= F.when(F.col("n_candidates") >= 10, 5).otherwise(F.col("n_candidates")))
            .select("query_id", "rank", "doc_id", "score"))


def search_status(queries: DataFrame, hits: DataFrame, id_col: str = "query_id") -> DataFrame:
    """(query_id, n_hits, status) with status 'found' or 'no_result'."""
    q = queries.select(F.col(id_col).cast("long").alias("query_id"))
    n = hits.groupBy("query_id").agg(F.count("doc_id").alias("n_hits"))
    out = q.join(n, "query_id", "left").select(
        "query_id", F.coalesce("n_hits", F.lit(0)).cast("long").alias("n_hits"))
    return out.withColumn(
        "status", F.when(F.col("n_hits") > 0, F.lit("found")).otherwise(F.lit("no_result")))


def _documents_of(hits: DataFrame, docs: DataFrame) -> DataFrame:
    """hits ⋈ docs on doc_id.  The hits are counted: within the broadcast bound they go to the
    documents, which are only scanned; beyond it both are shuffled."""
    found = sizing.measure(hits)
    return docs.join(sizing.hinted(found.df, found), "doc_id")


def label_hits(hits: DataFrame, docs: DataFrame, title_col: str = "title") -> DataFrame:
    """``"id : title"`` per hit (J4 join on doc_id)."""
    d = docs.select("doc_id", F.col(title_col).alias("title"))
    return _documents_of(hits, d).select(
        "query_id", "rank", "doc_id", "score",
        F.concat_ws(" : ", F.col("doc_id").cast("string"), F.col("title")).alias("label"))


def attach_attrs(hits: DataFrame, docs: DataFrame, cols: list[str]) -> DataFrame:
    """Document attributes for each hit."""
    return _documents_of(hits, docs.select("doc_id", *cols)).select(
        "query_id", "rank", "doc_id", "score", *cols)
