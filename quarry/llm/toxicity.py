"""Toxicity: maximum-scoring segments of token log-odds, calibrated as extreme values.

Model: tokens of labelled documents are counted by class, once per document. Tokens are the words
(A-Z folded to a-z) and their first 6 and 4 bytes, so inflected and compound forms count together. A
token's score is its log-odds between the classes with an informative Dirichlet prior (the prior
follows the token's frequency in both classes together). A word scores by the most specific of its
tokens whose z-score is high enough, its log-odds drawn towards 0 by their uncertainty; every other
word scores -drift, so a text's sum falls where nothing is toxic. A word less than twice as frequent in one
class as in the other scores nothing of its own. The prior's weight, the least
z-score and how many standard errors scores are drawn by are those of `choices` with the least log
loss over folds inside the training rows: each fold is scored by what the others teach. So rarer
words score where the training rows show that they help. K and the logistic curve come from these
scores too, as a text's own words fit it too well. With fewer than 8 texts of a class there are no folds:
the first choice is taken and calibrated on the training texts. A linear scan
(Ruzzo and Tompa) finds all maximal-scoring segments of a text. A segment of score s in a text of n
words is expected K n exp(-lambda s) times by chance; lambda solves the Karlin-Altschul equation on the
clean class's score distribution and K comes from the clean texts' best segments (method of
moments for their Gumbel law). A segment is significant if that expectation is below `max_e`. A
document's evidence is the sum of its significant segments' log-expectations (negated), and a
logistic curve over log(1 + evidence) turns it into a score from 0 to 1: a few long clean texts
of much evidence would draw a curve over the evidence itself flat.

Bounds: the model is fitted on at most `max_train` labelled documents, taken by a hash of their id,
and holds at most `max_words` words; both are parameters, and both are what is broadcast. All documents
are scored, whole, in one pass without a shuffle.

Defined cases: a null or empty text has no segments and the score of no evidence; rows with a null
label are no training rows; labelled ids without a document are ignored; equal texts count once in
training; with one class or none in training every score is 0; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.shared import in_arrow, write_shared
from quarry.llm.words import hashes, signed, slices, spans, text_buffers, unsigned


@dataclass
class Model:
    """Scoring words (sorted 64-bit hashes) with their scores, and the calibration."""
    word: np.ndarray
    score: np.ndarray
    drift: float
    rate: float = 1.0  # lambda
    scale: float = 1.0  # K
    max_e: float = 0.05
    slope: float = 1.0
    offset: float = 0.0

    def evidence(self, segments: list[tuple[int, int, float]], n: int) -> tuple[float, list[tuple[int, int, float, float]]]:
        """(evidence, the significant segments with their expectation) of a text of n words."""
        out, total = [], 0.0
        for a, b, s in segments:
            log_e = math.log(self.scale * max(1, n)) - self.rate * s
            if log_e < math.log(self.max_e):
                out.append((a, b, s, math.exp(max(-700.0, log_e))))
                total -= log_e
        return total, out

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return np.zeros(len(evidence)) if self.offset == -math.inf else 1 / (1 + np.exp(-np.clip(self.slope * np.log1p(evidence) + self.offset, -500, 500)))


def maximal_segments(place: list[int], score: list[float], drift: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first word, last word, score): `place` holds the scoring words'
    positions, and each word between them costs `drift`. One pass; each segment is merged at most once."""
    stack: list[tuple[int, int, float, float]] = []  # first, last, sum before, sum to the end
    total, at = 0.0, -1
    for p, s in zip(place, score, strict=True):
        total -= drift * (p - at - 1)
        at = p
        if s <= 0:
            total += s
            continue
        first, before = p, total
        total += s
        while True:
            # the last candidate that starts lower; those above it cannot be extended from here
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= before:
                j -= 1
            if j < 0 or stack[j][3] >= total:
                break
            first, before = stack[j][0], stack[j][2]
            del stack[j:]
        stack.append((first, p, before, total))
    return [(a, b, high - low) for a, b, low, high in stack]


def _features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[np.ndarray]:
    """Features of each word, the most specific first: the word, and its first 6 and 4 bytes."""
    yield hashes(data, starts, ends, lower=True)
    for n in (6, 4):
        yield hashes(data, starts, np.minimum(ends, starts + n), lower=True) ^ np.uint64(n * 0x9E3779B97F4A7C15 % 2**64)


def _scan(part: pa.RecordBatch, model: Model) -> Iterator[tuple[int, int, list[tuple[int, int, float]]]]:
    """(row, words, segments) of each text of a slice that has a scoring word."""
    data, offsets = text_buffers(part.column("text"))
    starts, ends, first = spans(data, offsets)
    if not len(model.word) or not len(starts):
        return
    score = np.zeros(len(starts))
    known = np.zeros(len(starts), dtype=bool)
    for feature in _features(data, starts, ends):  # the most specific one that the model has
        at = np.minimum(np.searchsorted(model.word, feature), len(model.word) - 1)
        new = ~known & (model.word[at] == feature)
        score[new] = model.score[at[new]]
        known |= new
    hit = np.flatnonzero(known)
    row = np.searchsorted(first, hit, "right") - 1
    edge = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1], [True]])) if len(hit) else []
    for a, b in zip(edge[:-1], edge[1:], strict=True):
        r = int(row[a])
        yield r, int(first[r + 1] - first[r]), maximal_segments((hit[a:b] - first[r]).tolist(), score[hit[a:b]].tolist(), model.drift)


_FOLDS = 4
#: (prior's weight as a share of the smaller class, least z-score, standard errors to draw scores by), the most cautious first.
CHOICES = tuple((share, z, draw) for share in (1.0, 0.3, 0.1) for z in (4.0, 3.0, 2.0) for draw in (0.0, 1.0))

#: The least score, and the least log-ratio of a word's shares of documents (a word in nearly all has high odds, too).
#: A word that is hardly more frequent in one class tells a text's length or language, and a long text of such
#: words would gain without end: segments need scores whose sum falls in every clean text.
LEAST_SCORE = math.log(2)


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, fold, toxic, clean): in how many documents of a fold and either class each word is."""
    for batch in batches:
        for part in slices(batch):
            data, offsets = text_buffers(part.column("text"))
            starts, ends, first = spans(data, offsets)
            features = np.concatenate(list(_features(data, starts, ends)))
            word, back = np.unique(features, return_inverse=True)
            row = np.tile(np.repeat(np.arange(len(first) - 1), np.diff(first)), 3)
            both = np.unique(back * np.int64(len(first)) + row)  # once per document
            row = both % len(first)
            toxic = part.column("toxic").to_numpy()[row] == 1
            group, back = np.unique(both // len(first) * _FOLDS + part.column("fold").to_numpy()[row], return_inverse=True)
            yield pa.record_batch([pa.array(signed(word[group // _FOLDS])), pa.array((group % _FOLDS).astype(np.int32)),
                                   pa.array(np.bincount(back, toxic, len(group)).astype(np.int64)),
                                   pa.array(np.bincount(back, ~toxic, len(group)).astype(np.int64))], ["word", "fold", "toxic", "clean"])


def _models(count: DataFrame, size: dict[int, int], per_document: float, choices, max_words: int, drift: float) -> list[Model]:
    """A model for each choice from the counts (word, t, c) and the classes' sizes."""
    out: dict[tuple[float, float, float], Model] = {}
    for share in dict.fromkeys(x for x, _, _ in choices):
        cuts = [(z, draw) for x, z, draw in choices if x == share]
        # prior: a share of the smaller class's weight, spread as the words are in both classes
        weight = share * min(size.values())
        prior = (F.col("t") + F.col("c")) * (weight / (size[0] + size[1])) + 1e-3
        n = {c: size[c] + weight for c in (0, 1)}
        odds = {c: F.log((F.col(x) + prior) / (n[c] - F.col(x) - prior + 1)) for c, x in ((1, "t"), (0, "c"))}
        ratio = F.log((F.col("t") + prior) / n[1]) - F.log((F.col("c") + prior) / n[0])
        error = F.sqrt(1 / (F.col("t") + prior) + 1 / (F.col("c") + prior))
        rows = (count.select("word", (odds[1] - odds[0]).alias("odds"), error.alias("error"), (F.col("c") + prior).alias("c"), ratio.alias("ratio"))
                .where((F.abs("odds") > min(z for z, _ in cuts) * F.col("error")) & (F.abs("ratio") >= LEAST_SCORE)).orderBy(F.desc(F.abs(F.col("odds") / F.col("error"))), "word")
                .limit(max_words).toPandas())
        word, odds, error, c = (rows[x].to_numpy() for x in ("word", "odds", "error", "c"))
        order = np.argsort(unsigned(word.astype(np.int64)))
        for z, draw in cuts:
            score = np.sign(odds) * (np.abs(odds) - draw * error)
            i = order[(np.abs(odds[order]) > z * error[order]) & (np.abs(odds[order]) - draw * error[order] >= LEAST_SCORE)]
            model = out[share, z, draw] = Model(unsigned(word[i].astype(np.int64)), score[i].astype(float), drift)
            model.rate = _rate(score[i].astype(float), c[i] / (n[0] * per_document), drift)
    return [out[x] for x in choices]


def fit(docs: DataFrame, labels: DataFrame, train, key: str = "doc_id", text: str = "text", label: str = "toxic",
        max_train: int = 20_000, max_words: int = 20_000, choices: tuple[tuple[float, float, float], ...] = CHOICES, drift: float = 0.05) -> Model:
    """The model of labelled documents whose `train` (a Boolean column of the labels) holds."""
    marked = (labels.where(train).where(F.col(label).isin(0, 1)).groupBy(F.col(key).alias("k")).agg(F.max(label).alias("toxic"))
              .orderBy(F.xxhash64("k"), "k").limit(max_train))
    known = (docs.select(F.col(key).alias("k"), F.col(text).alias("text")).join(F.broadcast(marked), "k")  # max_train rows
             .groupBy(F.md5("text").alias("m")).agg(F.first("text").alias("text"), F.max("toxic").alias("toxic"))
             .where("text is not null").select("text", "toxic", F.pmod(F.xxhash64("m"), F.lit(_FOLDS)).cast("int").alias("fold")))
    known = write_shared(known, "training")
    sizes = {(r["fold"], r["toxic"]): r["n"] for r in known.groupBy("fold", "toxic").agg(F.count("*").alias("n")).collect()}
    size = {c: sum(n for (_, t), n in sizes.items() if t == c) for c in (0, 1)}
    empty = Model(np.empty(0, np.uint64), np.empty(0), drift, slope=0.0, offset=-math.inf)
    if not size[0] or not size[1]:
        return empty
    counts = write_shared(known.transform(in_arrow, _words, "word long, fold int, toxic long, clean long")
                          .groupBy("word", "fold").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")), "word-counts")
    total = lambda rows: rows.groupBy("word").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    length = _per_document(known)
    rest = [{c: size[c] - sizes.get((f, c), 0) for c in (0, 1)} for f in range(_FOLDS)]
    if min(size.values()) < 8 or not all(min(x.values()) for x in rest):
        model = _models(total(counts), size, length, choices[:1], max_words, drift)[0]
        return _calibrated([model], [[model]] * _FOLDS, known)
    others = [_models(total(counts.where(F.col("fold") != f)), rest[f], length, choices, max_words, drift) for f in range(_FOLDS)]
    return _calibrated(_models(total(counts), size, length, choices, max_words, drift), others, known)


def _per_document(known: DataFrame) -> float:
    """Words of a clean document, on average (at least 1)."""
    words = F.size(F.split(F.trim("text"), r"[\x20\x09-\x0D]+"))
    return max(1.0, known.where("toxic = 0").agg(F.avg(words)).first()[0] or 1.0)


def _rate(score: np.ndarray, share: np.ndarray, drift: float) -> float:
    """The positive root of sum p exp(lambda s) = 1, by bisection; share: how often each scoring word is in clean text."""
    rest = max(0.0, 1 - share.sum())

    def above(x: float) -> bool:
        return float((share * np.exp(np.minimum(700, x * score))).sum() + rest * math.exp(-x * drift)) > 1

    low, high = 1e-6, 1.0
    while not above(high) and high < 1e3:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if above(mid) else (mid, high)
    return high


def _calibrated(models: list[Model], others: list[list[Model]], known: DataFrame) -> Model:
    """The model of the least log loss, with K and its logistic curve; `others` scores the rows of each
    fold, one model for each of `models`. (At most max_train rows, a few numbers each, reach the driver.)"""
    def pass_over(value) -> list:
        held = known.sparkSession.sparkContext.broadcast(others)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for fold, with_ in enumerate(held.value):
                    for part in slices(batch.filter(pa.array(batch.column("fold").to_numpy() == fold))):
                        x, n = np.zeros((part.num_rows, len(with_))), np.zeros(part.num_rows, dtype=np.int64)
                        for i, model in enumerate(with_):
                            for row, words, segments in _scan(part, model):
                                x[row, i], n[row] = value(model, segments, words), words
                        yield pa.record_batch([part.column("toxic"), part.column("fold"), pa.array(n), pa.array(x.tolist(), pa.list_(pa.float64()))],
                                              ["toxic", "fold", "n", "x"])

        return known.transform(in_arrow, run, "toxic int, fold int, n long, x array<double>").collect()

    rows = [r for r in pass_over(lambda model, segments, n: max((s for _, _, s in segments), default=0.0)) if not r["toxic"]]
    for i, model in enumerate(models):
        # of a Gumbel law with location ln(K n) / lambda the mean is location + 0.5772 / lambda
        best = [others[r["fold"]][i].rate * r["x"][i] - math.log(r["n"]) for r in rows if r["x"][i] > 0]
        if best:
            model.scale = float(np.clip(math.exp(float(np.mean(best)) - 0.5772), 1e-6, 1.0))
        for with_ in others:
            with_[i].scale = model.scale
    rows = pass_over(lambda model, segments, n: model.evidence(segments, n)[0])
    y = np.array([r["toxic"] for r in rows], dtype=float)
    x = np.array([r["x"] for r in rows])
    losses = [_curve(model, x[:, i], y) for i, model in enumerate(models)]
    return models[int(np.argmin(losses))]


def _curve(model: Model, x: np.ndarray, y: np.ndarray) -> float:
    """Fits the logistic curve of the model over the evidence; returns its log loss."""
    raw, x = x, np.log1p(x)
    middle = float(np.median(x[y == 1])) or 1.0
    at = np.array([4.0 / max(1e-3, middle), -2.0])

    def cost(at: np.ndarray) -> float:
        z = at[0] * x + at[1]
        return float((np.logaddexp(0, z) - y * z).sum() + 5e-4 * (at ** 2).sum())

    for _ in range(50):  # Newton's method, with a small ridge so that separable classes have a finite curve
        p = 1 / (1 + np.exp(-np.clip(at[0] * x + at[1], -500, 500)))
        w = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((y - p) * x).sum() - 1e-3 * at[0], (y - p).sum() - 1e-3 * at[1]])
        h = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-3]])
        step = np.clip(np.linalg.solve(h, g), -1, 1)
        while np.abs(step).max() >= 1e-8 and cost(at + step) > cost(at):
            step = step / 2
        at = at + step
        if np.abs(step).max() < 1e-8:
            break
    a, b = at
    model.slope, model.offset = max(0.0, float(a)), float(b)
    p = np.clip(model.probability(raw), 1e-12, 1 - 1e-12)
    return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).sum())


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, passages): the document's score and its significant passages
    (first word, last word, score, how many such would be expected by chance)."""
    docs = docs.select(F.col(key).alias("k"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    passage = T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType()),
                            T.StructField("score", T.DoubleType()), T.StructField("expected", T.DoubleType())])
    schema = T.StructType([docs.schema["k"], T.StructField("score", T.DoubleType()), T.StructField("passages", T.ArrayType(passage))])
    kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in slices(batch):
                evidence = np.zeros(part.num_rows)
                found: list[list[dict]] = [[] for _ in range(part.num_rows)]
                for row, words, segments in _scan(part, m):
                    evidence[row], held = m.evidence(segments, words)
                    found[row] = [dict(zip(("first", "last", "score", "expected"), x, strict=True)) for x in held]
                yield pa.record_batch([part.column("k"), pa.array(m.probability(evidence)), pa.array(found, kind)], ["k", "score", "passages"])

    return docs.transform(in_arrow, run, schema).withColumnRenamed("k", key)


def clean(docs: DataFrame, model: Model, text: str = "text", limit: float = 0.5) -> DataFrame:
    """The documents, with all their columns, whose score is below `limit`; one pass, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in slices(batch, text):
                evidence = np.zeros(part.num_rows)
                for row, words, segments in _scan(pa.record_batch([part.column(text)], ["text"]), m):
                    evidence[row] = m.evidence(segments, words)[0]
                yield part.filter(pa.array(m.probability(evidence) < limit))

    return docs.transform(in_arrow, run, docs.schema)
