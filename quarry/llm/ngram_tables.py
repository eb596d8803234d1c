"""Katz backoff of any order from stored tables, for texts that need not be the training texts.

The model of `katz` with the order as a parameter: a token is scored by the longest history of at most
order - 1 words that begins no earlier than the text's start mark. A gram that was seen in training has
r* / c(h), r* by the Good-Turing discounts of its own level; any other has alpha(h) P(w | h'), h' being
the history without its first word, and so on down to the words, where what the discounts leave goes to
one unknown word. A history that was never seen backs off with weight 1. Each context sums to 1.

Stored (`fit`), Parquet in the shared folder, each partitioned by level and written by hash of the context:
  grams     (level, context, word, c, logp)   one row per distinct gram
  contexts  (level, context, c, backoff)      log10 alpha of each history
Levels are scored together from the longest down (`score`): a row of tokens that is not found at one level
takes that history's weight and is asked at the next. Rows are pre-aggregated by text and slice.

Scale and skew: counts are summed in the slice first, then by partial aggregates. In every lookup, grams
or histories so frequent that their rows would be a task of their own - c >= h = (tokens) / `hot_rows`, so
at most `hot_rows` of them whatever the corpus - are broadcast; only the others are shuffled. Tokens that
are settled keep a key of their own in later shuffles, so they meet in no one task. Words, grams and
histories are 64-bit hashes.

A token is a row of the lookups, so this moves more than `katz.score`, which evaluates order 2 where the
tokens of a bucket lie; the README has the figures.

Defined cases: as in `katz` (null and empty texts have their end token; rows are scored by their own
text; equal rows alike; nothing to learn from: every token is unknown with probability 1).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.katz import END, K, START, _tokens, discounts
from quarry.llm.shared import in_arrow, write_shared
from quarry.llm.words import pairs, signed, slices

HOT_ROWS = 100_000


def histories(word: np.ndarray, size: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For levels 2..order, if any: (hash of each token's last level - 1 words, whether it has that many)."""
    if order < 2:
        return []
    place = np.arange(len(word)) - np.repeat(np.cumsum(size) - size, size)
    before = np.empty_like(word)
    before[1:] = word[:-1]
    before[place == 0] = START
    out = [(before, np.ones(len(word), dtype=bool))]
    for level in range(3, order + 1):
        longer = np.zeros_like(word)
        longer[1:] = pairs(out[-1][0][:-1], word[:-1])
        out.append((longer, place >= level - 2))
    return out


def _counts(docs: DataFrame, order: int) -> DataFrame:
    """(level, context, back, word, c) of the training texts; back: the history without its first word."""
    names = ["level", "context", "back", "word", "c"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.filter(batch.column("train"))):
                word, size = _tokens(part)
                every = np.ones(len(word), dtype=bool)
                levels = [(np.zeros_like(word), every), *histories(word, size, order)]
                for level, (context, there) in enumerate(levels, 1):
                    back = levels[max(0, level - 2)][0]
                    _, first, times = np.unique(pairs(context[there], word[there]), return_index=True, return_counts=True)
                    i = np.flatnonzero(there)[first]
                    yield pa.record_batch([pa.array(np.full(len(i), level, np.int32)), pa.array(signed(context[i])),
                                           pa.array(signed(back[i])), pa.array(signed(word[i])), pa.array(times)], names)

    found = docs.transform(in_arrow, run, "level int, context long, back long, word long, c long")
    return found.groupBy("level", "context", "back", "word").agg(F.sum("c").alias("c"))


@dataclass
class Model:
    order: int
    grams: DataFrame      # level, context, word, c, logp
    contexts: DataFrame   # level, context, c, backoff
    tokens: int           # in training
    words: int            # distinct ones
    unknown: float        # probability of a word that training lacks
    hot_rows: int

    @property
    def hot(self) -> int:
        """Grams and histories that training has this often are broadcast: at most hot_rows at each level."""
        return max(1, -(-self.tokens // self.hot_rows))


def _by_level(values: list[float], level: Column) -> Column:
    return F.element_at(F.array(*(F.lit(float(v)) for v in values)), level)


def fit(docs: DataFrame, order: int = 3, text: str = "text", train: Column | None = None, hot_rows: int = HOT_ROWS) -> Model:
    """The tables of a model of `order` (1 or more), learned from the rows where `train` is true."""
    if order < 1:
        raise ValueError("the order is 1 or more")
    kept = docs.select(F.col(text).alias("text"), F.coalesce(F.lit(True) if train is None else train, F.lit(False)).alias("train"))
    counts = write_shared(_counts(kept, order), "counts")
    tallies = [F.sum((F.col("c") == r).cast("long")).alias(f"n{r}") for r in range(1, K + 3)]
    facts = {r.level: r for r in counts.groupBy("level").agg(F.sum("c").alias("n"), F.count("*").alias("v"), *tallies).collect()}
    factors = [discounts([float(facts[m][f"n{r}"]) if m in facts else 0.0 for r in range(1, K + 3)]) for m in range(1, order + 1)]
    n = facts[1].n if facts else 0
    # r*: one factor per level and low count, and one for the larger counts
    factor = F.coalesce(*(F.when(F.col("c") == r, _by_level([d[r - 1] for d, _ in factors], F.col("level"))) for r in range(1, K + 1)),
                        _by_level([top for _, top in factors], F.col("level")))
    starred = counts.withColumn("star", F.col("c") * factor)
    totals = starred.where("level > 1").groupBy("level", "context").agg(F.sum("c").alias("total"), F.sum("star").alias("kept"))
    long = starred.where("level > 1").join(totals, ["level", "context"])
    single = starred.where("level = 1").withColumn("total", F.lit(n).cast("long")).withColumn("kept", F.lit(0.0))
    rows = write_shared(long.unionByName(single).withColumn("p", F.col("star") / F.col("total")), "probabilities")
    # alpha: what the discounts leave of a history, over what the next level leaves of the same words
    lower = rows.select((F.col("level") + 1).alias("level"), F.col("context").alias("back"), "word", F.col("p").alias("below"))
    weight = (rows.where("level > 1").join(lower, ["level", "back", "word"]).groupBy("level", "context")
              .agg(F.max("total").alias("c"), F.max("kept").alias("kept"), F.sum("below").alias("below")))
    alpha = (1 - F.col("kept") / F.col("c")) / (1 - F.col("below"))
    contexts = weight.select("level", "context", "c", F.log10(F.greatest(alpha, F.lit(1e-300))).alias("backoff"))
    grams = rows.select("level", "context", "word", "c", F.log10("p").alias("logp"))
    mass = rows.where("level = 1").agg(F.sum("p")).first()[0]
    unknown = 1 - mass if mass is not None else 1.0
    return Model(order, _stored(grams, "grams"), _stored(contexts, "contexts"), n, facts[1].v if facts else 0, unknown, hot_rows)


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Written by hash of the context, a folder for each level."""
    return write_shared(df.repartition("level", "context"), name, by=("level",))


def _looked_up(asked: DataFrame, table: DataFrame, keys: dict[str, str], wanted: Column, hot: int, value: str) -> DataFrame:
    """asked with the table's `value` (null: not there, or not wanted). keys: column of asked -> of the table."""
    def left(asked: DataFrame, part: DataFrame, wanted: Column, to: str, broadcast: bool) -> DataFrame:
        part = part.select(*(F.col(c).alias(f"__{c}") for c in keys.values()), F.col(value).alias(to))
        # a row that is not asked gets a key of its own instead of one that all such rows would share
        own = {a: F.when(wanted, F.col(a)).otherwise(F.xxhash64("row", "word", a)) for a in keys}
        asked = asked.withColumns({f"__of_{a}": own[a] for a in keys} | {"__wanted": wanted})
        on = [F.col(f"__of_{a}") == F.col(f"__{c}") for a, c in keys.items()]
        out = asked.join(F.broadcast(part) if broadcast else part, [*on, F.col("__wanted")], "left")
        return out.drop(*(f"__{c}" for c in keys.values()), *(f"__of_{a}" for a in keys), "__wanted")

    first = left(asked, table.where(F.col("c") >= hot), wanted, "__hot", True)
    both = left(first, table.where(F.col("c") < hot), wanted & F.col("__hot").isNull(), "__cold", False)
    return both.withColumn(value, F.coalesce("__hot", "__cold")).drop("__hot", "__cold")


def _asked(docs: DataFrame, order: int) -> DataFrame:
    """(row, word, h2..h<order>, n): the tokens of each text, equal ones of a slice counted; a null history: too short."""
    names = ["row", "word", *(f"h{m}" for m in range(2, order + 1)), "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                word, size = _tokens(part)
                row = np.repeat(part.column("row").to_numpy(), size)
                levels = histories(word, size, order)
                key = pairs(row.view(np.uint64), word)
                for context, there in levels:
                    key = pairs(key, np.where(there, context, np.uint64(0)))
                _, first, times = np.unique(key, return_index=True, return_counts=True)
                columns = [pa.array(signed(c[first]), mask=~there[first]) for c, there in levels]
                yield pa.record_batch([pa.array(row[first]), pa.array(signed(word[first])), *columns, pa.array(times)], names)

    return docs.transform(in_arrow, run, ", ".join(f"{c} long" for c in names))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score) of every row of docs; scores are log10."""
    docs = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    docs = docs.withColumn("row", F.xxhash64(F.col("text").isNull(), "text"))
    rows = _asked(docs, model.order).withColumn("acc", F.lit(0.0)).withColumn("open", F.lit(True))
    for level in range(model.order, 1, -1):
        here, at = f"h{level}", F.col("level") == level
        wanted = F.col("open") & F.col(here).isNotNull()
        rows = _looked_up(rows, model.grams.where(at), {here: "context", "word": "word"}, wanted, model.hot, "logp")
        rows = rows.withColumn("acc", F.col("acc") + F.coalesce("logp", F.lit(0.0)))
        rows = rows.withColumn("open", F.col("open") & F.col("logp").isNull()).drop("logp")
        rows = _looked_up(rows, model.contexts.where(at), {here: "context"}, F.col("open") & F.col(here).isNotNull(), model.hot, "backoff")
        rows = rows.withColumn("acc", F.col("acc") + F.coalesce("backoff", F.lit(0.0))).drop("backoff", here)
    words = model.grams.where("level = 1").withColumn("known", F.struct("c", "logp"))
    rows = _looked_up(rows, words, {"word": "word"}, F.lit(True), model.hot, "known")
    count = F.coalesce("known.c", F.lit(0))
    base = F.log10((count + 0.5) / F.lit(model.tokens + 0.5 * (model.words + 1)))
    last = F.when(F.col("open"), F.coalesce("known.logp", F.log10(F.lit(model.unknown)))).otherwise(0.0)
    end = F.lit(int(signed(np.array([END]))[0]))
    # rows of equal text share their sums: each has one end token, which counts them
    sums = rows.groupBy("row").agg(
        F.sum("n").alias("tokens"), F.sum(F.when(count > 0, F.col("n")).otherwise(0)).alias("known"),
        F.sum(F.col("n") * base).alias("base"), F.sum(F.col("n") * (F.col("acc") + last)).alias("score"),
        F.sum(F.when(F.col("word") == end, F.col("n")).otherwise(0)).alias("rows"))
    of = lambda c: F.col(c) / F.col("rows")
    return docs.select("doc_id", "row").join(sums, "row").select(
        F.col("doc_id").alias(key), of("tokens").cast("long").alias("n_tokens"), of("known").cast("long").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"), of("base").alias("base_score"), of("score").alias("score"))
