"""Quality classifier: regularised quadratic discriminant analysis over document statistics.

A document is a short vector of statistics of its whole text (shares of letters, capitals, digits,
symbols and repeated words, word triples and lines, lengths, the spread of the vocabulary), transformed
so that each is roughly normal: the arcsine of the root for shares, the logarithm for sizes. Each class
is a normal density. Its covariance S_c is shrunk twice: towards the one pooled over the classes, and
that towards the identity (the statistics are standardised first):
(1 - g) ((1 - p) S_c + p S) + g I. A score is the difference of the two log densities, from Mahalanobis
distances by the classes' Cholesky factors (kept in the model), put on a logistic curve. p and g are
those of the least log loss over folds inside the training rows; the curve is fitted on the same
held-out differences, so scores are calibrated without a look at other rows.

Scale. Scoring is one pass without a shuffle; a task holds a slice of some megabytes of text. Training
reads the statistics of at most `max_train` labelled rows (the documented bound of the fit; taken by a
hash of the key), some 20 numbers each, to the driver. The model is a few kilobytes.

Defined cases: a null text is empty, and has all statistics zero; words are runs of bytes other than
white space; rows without a key or a label of 0 or 1 do not train; of several labels of one key the
largest counts; copies of a text with one label count once; with one class only, every score is that
class's smoothed share, with no labels one half; repeated rows are scored each; an empty table gives an
empty result; columns other than key and text are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.shared import in_arrow
from quarry.llm.words import hashes, ngrams, slices, spans, text_buffers

FOLDS = 4
#: (share of the pooled covariance, share of the identity), of which the folds choose.
CHOICES = tuple((p, g) for p in (0.0, 0.1, 0.3, 0.6, 1.0) for g in (0.003, 0.03, 0.1, 0.3))

_LOWER, _UPPER, _DIGIT, _STOP, _MARK, _SYMBOL, _SPACE, _LINE, _HIGH, _OTHER = range(10)
_KIND = np.full(256, _OTHER, dtype=np.uint8)
for _kind, _bytes in ((_LOWER, b"abcdefghijklmnopqrstuvwxyz"), (_UPPER, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (_DIGIT, b"0123456789"),
                      (_STOP, b".,;:'\"()-"), (_MARK, b"!?"), (_SYMBOL, b"#$%&*+/<=>@[\\]^_`{|}~"), (_SPACE, b" \t\x0b\x0c\r"), (_LINE, b"\n")):
    _KIND[list(_bytes)] = _kind
_KIND[128:] = _HIGH


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the values between each bound and the next."""
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def _again(row: np.ndarray, value: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row, how many distinct values it has, and how often its most frequent one occurs."""
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    first = np.flatnonzero(new)
    most = np.zeros(rows, dtype=np.int64)
    np.maximum.at(most, row[first], np.diff(np.append(first, len(row))))
    return np.bincount(row[first], minlength=rows), most


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces between line ends, of all rows."""
    low, top = int(offsets[0]), int(offsets[-1])
    cut = np.flatnonzero(data[low:top] == 10) + low
    starts = np.unique(np.concatenate([offsets[:-1], cut + 1]))
    starts = starts[starts < top]
    if not len(starts):
        return starts, starts
    ends = np.append(starts[1:], top)
    return starts, np.where(data[ends - 1] == 10, ends - 1, ends)


def statistics(column: pa.Array) -> np.ndarray:
    """The transformed statistics of each text, one row each."""
    data, offsets = text_buffers(column)
    rows, base = len(offsets) - 1, int(offsets[0])
    starts, ends, at = spans(data, offsets)
    kind = _KIND[data[base:int(offsets[-1])]]
    counts = np.stack([_sums(kind == k, offsets - base) for k in range(10)], axis=1).astype(float)
    words, size = np.diff(at).astype(float), np.maximum(1.0, np.diff(offsets))
    solid = np.maximum(1.0, size - counts[:, _SPACE] - counts[:, _LINE])
    row = np.repeat(np.arange(rows), np.diff(at))
    value = hashes(data, starts, ends, lower=True) if len(starts) else np.empty(0, np.uint64)
    distinct, most = _again(row, value, rows)
    n = np.maximum(1.0, words)
    twice = np.bincount(row[1:][(value[1:] == value[:-1]) & (row[1:] == row[:-1])], minlength=rows) if len(row) else np.zeros(rows)
    triple = ngrams(value, 3)
    same = row[2:] == row[:-2] if len(row) > 2 else np.zeros(0, dtype=bool)
    triples = np.bincount(row[2:][same], minlength=rows) if len(same) else np.zeros(rows)
    unique, _ = _again(row[2:][same], triple[same], rows) if len(same) else (np.zeros(rows), None)
    line_starts, line_ends = _lines(data, offsets)
    full = line_ends > line_starts
    line_row = np.searchsorted(offsets, line_starts[full], "right") - 1
    line = hashes(data, line_starts[full], line_ends[full], lower=False) if full.any() else np.empty(0, np.uint64)
    lines = np.bincount(line_row, minlength=rows).astype(float)
    own_lines, _ = _again(line_row, line, rows)
    first = _KIND[data[starts]] if len(starts) else np.empty(0, np.uint8)
    last = _KIND[data[ends - 1]] if len(starts) else np.empty(0, np.uint8)
    share = lambda x, of: np.arcsin(np.sqrt(np.clip(x / of, 0.0, 1.0)))
    letters = np.maximum(1.0, counts[:, _LOWER] + counts[:, _UPPER])
    out = np.stack([
        np.log1p(words), np.log(solid / n), np.log1p(lines), share(counts[:, _UPPER], letters), share(counts[:, _DIGIT], solid),
        share(counts[:, _STOP], solid), share(counts[:, _MARK], solid), share(counts[:, _SYMBOL], solid), share(counts[:, _OTHER], solid),
        share(counts[:, _HIGH], solid), np.log1p(distinct) / np.log1p(n), share(most, n), share(twice, n),
        share(triples - unique, np.maximum(1.0, triples)), share(lines - own_lines, np.maximum(1.0, lines)),
        share(np.bincount(row[first == _UPPER], minlength=rows), n), share(np.bincount(row[last == _SYMBOL], minlength=rows), n),
        share(np.bincount(row[(last == _STOP) | (last == _MARK)], minlength=rows), n)], axis=1)
    out[words == 0] = 0.0
    return out


@dataclass
class Model:
    """Standardisation, and for each class the mean, the Cholesky factor of its covariance and its log determinant."""
    middle: np.ndarray
    scale: np.ndarray
    mean: tuple[np.ndarray, ...] = ()
    factor: tuple[np.ndarray, ...] = ()
    volume: tuple[float, ...] = ()
    slope: float = 0.0
    offset: float = 0.0

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 less that of class 0."""
        z = (x - self.middle) / self.scale
        far = [(np.linalg.solve(f, (z - m).T) ** 2).sum(axis=0) for m, f in zip(self.mean, self.factor, strict=True)]
        return 0.5 * (far[0] + self.volume[0] - far[1] - self.volume[1])

    def probability(self, x: np.ndarray) -> np.ndarray:
        d = _bounded(self.difference(x)) if self.mean else np.zeros(len(x))
        return 1 / (1 + np.exp(-np.clip(self.slope * d + self.offset, -500, 500)))


def _bounded(d: np.ndarray) -> np.ndarray:
    """Differences of densities have very long tails; beyond a few dozen they say nothing more."""
    return np.sign(d) * np.log1p(np.abs(d))


def _model(x: np.ndarray, y: np.ndarray, pool: float, shrink: float) -> Model:
    middle, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = (x - middle) / scale
    means = tuple(z[y == c].mean(axis=0) for c in (0, 1))
    around = z - np.where(y[:, None] == 1, means[1], means[0])
    pooled = around.T @ around / len(z)
    factors = []
    for c in (0, 1):
        own = around[y == c]
        s = (1 - pool) * (own.T @ own / len(own)) + pool * pooled
        factors.append(np.linalg.cholesky((1 - shrink) * s + shrink * np.eye(x.shape[1])))
    return Model(middle, scale, means, tuple(factors), tuple(2 * float(np.log(np.diag(f)).sum()) for f in factors))


def _curve(d: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """(slope, offset, log loss) of the logistic curve of y over d, by Newton's method with a small ridge."""
    a, b = 1.0, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * d + b, -500, 500)))
        w = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((y - p) * d).sum() - 1e-2 * a, (y - p).sum() - 1e-2 * b])
        h = np.array([[(w * d * d).sum() + 1e-2, (w * d).sum()], [(w * d).sum(), w.sum() + 1e-2]])
        step = np.clip(np.linalg.solve(h, g), -1, 1)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    p = np.clip(1 / (1 + np.exp(-np.clip(a * d + b, -500, 500))), 1e-12, 1 - 1e-12)
    return max(0.0, float(a)), float(b), float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())


def train(x: np.ndarray, y: np.ndarray, fold: np.ndarray, choices: tuple[tuple[float, float], ...] = CHOICES) -> Model:
    """The model of statistics x with labels y (0 or 1); fold tells which rows are held out together."""
    size = [(y == c).sum() for c in (0, 1)]
    if not min(size):
        share = (size[1] + 1) / (sum(size) + 2)
        return Model(np.zeros(x.shape[1]), np.ones(x.shape[1]), offset=float(np.log(share / (1 - share))))
    groups = [f for f in np.unique(fold) if all(((y == c) & (fold != f)).any() for c in (0, 1)) and (fold == f).any()]
    best = None
    for pool, shrink in choices:
        d, at = [], []
        for f in groups:
            model = _model(x[fold != f], y[fold != f], pool, shrink)
            d.append(_bounded(model.difference(x[fold == f])))
            at.append(y[fold == f])
        if not groups:  # too few rows to hold any out
            d, at = [_bounded(_model(x, y, pool, shrink).difference(x))], [y]
        slope, offset, loss = _curve(np.concatenate(d), np.concatenate(at))
        if best is None or loss < best[0]:
            best = loss, pool, shrink, slope, offset
    model = _model(x, y, *best[1:3])
    model.slope, model.offset = best[3:]
    return model


def _with_statistics(docs: DataFrame, text: str, kept: list[str]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                x = statistics(part.column(text))
                yield pa.record_batch([*(part.column(c) for c in kept), pa.array(list(x), pa.list_(pa.float64()))], [*kept, "x"])

    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField("x", T.ArrayType(T.DoubleType()))])
    return docs.transform(in_arrow, run, schema)


def fit(docs: DataFrame, labels: DataFrame, where: Column, key: str = "doc_id", text: str = "text", label: str = "quality",
        max_train: int = 20_000, choices: tuple[tuple[float, float], ...] = CHOICES) -> Model:
    """The model of labelled documents for which `where` (a Boolean column of the labels) holds; of more
    than max_train of them those with the least hash."""
    marked = (labels.where(where).where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(F.col(key).alias("k"))
              .agg(F.max(label).cast("int").alias("y")).orderBy(F.xxhash64("k"), "k").limit(max_train))
    known = (docs.select(F.col(key).alias("k"), F.col(text).alias("text")).join(F.broadcast(marked), "k")  # max_train rows
             .select("text", "y", F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int").alias("fold")))
    rows = _with_statistics(known, "text", ["y", "fold"]).toArrow()
    if not rows.num_rows:
        return train(np.zeros((0, 1)), np.zeros(0), np.zeros(0), choices)
    x = np.array(rows["x"].to_pylist())
    # copies of a text have equal statistics; in a set order, whatever the order of the rows
    all_ = np.unique(np.column_stack([x, rows["y"].to_numpy(), rows["fold"].to_numpy()]), axis=0)
    return train(all_[:, :-2], all_[:, -2].astype(int), all_[:, -1].astype(int), choices)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score): how likely the label 1 is."""
    docs = docs.select(F.col(key).alias("k"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                x = statistics(part.column("text"))
                yield pa.record_batch([part.column("k"), pa.array(shared.value.probability(x))], ["k", "score"])

    return docs.transform(in_arrow, run, T.StructType([docs.schema["k"], T.StructField("score", T.DoubleType())])).withColumnRenamed("k", key)
