"""T2, learned mode: sentence breaks that know the corpus's own abbreviations.

Abbreviations are learned without labels from how words and full stops occur together, after
Kiss and Strunk (Computational Linguistics 32:4, 2006): an abbreviation is a short word that nearly
always has a full stop, often with stops inside.  One pass counts each word with and without a stop
(partial aggregates), and a table of one row per accepted word is kept.

Tokenising with that table cuts a text where the default rules break sentences.  A piece that ends
in a listed word and its stop is not a sentence end: the stop stays on the word.  The stop that ends
a text always ends a sentence.  Whether a capital after an abbreviation opens a sentence is not judged.

Scale: pieces meet the table by their last word.  The table is measured; within the bound it is
broadcast, beyond it words are shuffled and a frequent word is dealt over several keys.  Pieces
without a candidate word never take part in that shuffle.  Token positions are running counts
within the document.

Defined cases: a null or empty text has no tokens; positions run over all rows of one id and ``keep``,
so ids should be unique; an empty corpus, or one in which every word has a stop, learns an empty
table, with which the tokens are those of the default rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import rules
from quarry.functions import text as T
from quarry.plans import sizing

#: the word that begins a blank-separated chunk (letters, stops inside), and the stops after it
_CHUNK_WORD = r"""^[(\[{<"'`]*(\p{L}(?:[\p{L}.]*\p{L})?)(\.*)"""
#: the word that ends a piece before its full stop
_LAST_WORD = r"(?:^|[^\p{L}\p{N}.])(\p{L}(?:[\p{L}.]*\p{L})?)\.\z"
#: how surely a stop follows an abbreviation, and the score from which a word counts as one
#: (fixed values of the paper)
SURE, LEAST_SCORE = 0.99, 0.3


def word_stops(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n_stop, n_plain): how often each lower-cased word occurs with and without a full stop."""
    chunk = docs.select(F.explode(F.split(text_col, rules.WHITESPACE)).alias("chunk"))
    found = chunk.select(F.lower(F.regexp_extract("chunk", _CHUNK_WORD, 1)).alias("word"),
                         (F.regexp_extract("chunk", _CHUNK_WORD, 2) == ".").cast("long").alias("stop"))
    return found.where("word != ''").groupBy("word").agg(F.sum("stop").alias("n_stop"), F.sum(1 - F.col("stop")).alias("n_plain"))


def learn_abbreviations(docs: DataFrame, text_col: str = "text", least: float = LEAST_SCORE) -> DataFrame:
    """(word, n_stop, n_plain, score) of the words whose score is at least ``least``.

    score = G * (stops inside + 1) * exp(-letters) / letters ** n_plain, where G is the log-likelihood
    ratio of "a stop follows nearly always" against "as often as it follows any word"."""
    counts = word_stops(docs, text_col)
    share = counts.select((F.sum("n_stop") / F.sum(F.col("n_stop") + F.col("n_plain"))).alias("p")).select("p").scalar()
    letters = F.length(F.replace(F.col("word"), F.lit("."), F.lit("")))
    inside = F.length("word") - letters
    # a corpus where every word has a stop, or none, has nothing to tell apart: the logarithm is null
    gain = F.col("n_stop") * F.ln(F.lit(SURE) / F.col("p")) + F.col("n_plain") * F.ln(F.lit(1 - SURE) / F.nullif(1 - F.col("p"), F.lit(0.0)))
    shrunk = F.exp(-(letters + F.col("n_plain") * F.ln(letters)))
    scored = counts.where("n_stop > 0").withColumn("p", share).withColumn("score", 2 * gain * (inside + 1) * shrunk)
    return scored.where(F.col("score") >= least).select("word", "n_stop", "n_plain", "score")


def _pieces(text: Column) -> Column:
    """The text cut at the sentence breaks and line ends of the default rules."""
    broken = F.regexp_replace(F.regexp_replace(text, r"\s+$", ""), r"([.!?])\s+", "$1\n")
    return F.split(broken, "\n")


def _known(pieces: DataFrame, abbreviations: DataFrame, max_rows: int | None, salts: int) -> DataFrame:
    """pieces with ``known``: whether the last word is listed."""
    listed = sizing.measure(abbreviations.select("word").distinct(), max_rows)
    table = listed.df.withColumn("listed", F.lit(True))
    if listed.broadcast:
        return pieces.join(F.broadcast(table), "word", "left").withColumn("known", F.col("listed").isNotNull()).drop("listed", "word")
    asked = pieces.where("word is not null").withColumn("salt", F.pmod(F.xxhash64("no", "piece"), F.lit(salts)).cast("int"))
    dealt = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    met = asked.join(dealt, ["word", "salt"], "left").withColumn("known", F.col("listed").isNotNull())
    return met.drop("salt", "listed", "word").unionByName(pieces.where("word is null").withColumn("known", F.lit(False)).drop("word"))


def tokens_of_sentences(docs: DataFrame, abbreviations: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        keep: tuple[str, ...] = (), max_rows: int | None = None, salts: int = 16) -> DataFrame:
    """T2 with learned sentence breaks: (*keep, doc_id, pos, tok).

    ``abbreviations`` holds a column ``word``, lower-case, without the last stop."""
    cut = docs.select(*keep, F.col(id_col).cast("long").alias("doc_id"), _pieces(F.col(text_col)).alias("cut"))
    cut = cut.select(*keep, "doc_id", F.size("cut").alias("of"), F.posexplode("cut").alias("no", "piece"))
    word = F.when(F.col("no") < F.col("of") - 1, F.nullif(F.lower(F.regexp_extract("piece", _LAST_WORD, 1)), F.lit("")))
    seen = _known(cut.withColumn("word", word).drop("of"), abbreviations, max_rows, salts)
    # a piece that goes on loses its stop before the rules see it, and its last token gets it back
    plain = T.tokens(F.expr("CASE WHEN known THEN left(piece, length(piece) - 1) ELSE piece END"))
    glued = F.transform(F.array(plain), lambda t: F.when(
        F.col("known"), F.concat(F.slice(t, 1, F.size(t) - 1), F.array(F.concat(F.element_at(t, -1), F.lit("."))))).otherwise(t))[0]
    seen = seen.select(*keep, "doc_id", "no", glued.alias("toks"))
    before = Window.partitionBy(*keep, "doc_id").orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    placed = seen.withColumn("first", F.coalesce(F.sum(F.size("toks")).over(before), F.lit(0)))
    return (placed.select(*keep, "doc_id", "first", F.posexplode("toks").alias("at", "tok"))
            .select(*keep, "doc_id", (F.col("first") + F.col("at")).cast("int").alias("pos"), "tok"))

