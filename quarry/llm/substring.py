"""Substring dedup: seed and extend over winnowed anchors.

A document's words are hashed. Of the hashes of its `gram`-word runs, winnowing keeps the least of
every `window - gram + 1` consecutive ones, so any stretch of `window` words holds at least one
anchor, and equal stretches hold equal anchors at equal places. Anchors that only one document has
are no seeds. Around each seed, the match is extended both ways: every stretch of `window` words
that contains the seed is compared (by hash) with those of the other documents that have it, and a
word is covered if one of its stretches also starts in a document with a smaller id. Overlapping
covered stretches join to maximal repeats, which are at least `window` words long.

Scale: of equal texts only the one with the smallest id is searched; the others lose all their
stretches anyway. One row per anchor (about a quarter of the words) is grouped by a partial aggregate;
the seeds become a bounded bitmap, so texts are scanned again rather than shuffled. Within a slice of
documents, stretches that a smaller id of the same slice has are settled on the spot; only one
occurrence per stretch and slice is shuffled, so a passage in a third of all documents is one row per
slice, and it is read in order, one row at a time. Texts move only for documents that lose words.

Defined cases: a null text has no words; a text of fewer than `window` words loses none; windows that
repeat only within a document stay; rows of one id are one document for the rule "smaller id" only:
what a row loses is kept by id and text digest, so unlike texts of one id are cut each by their own
stretches; rows without an id count as the largest id; an empty table gives an empty table.
Stretches are compared by 64-bit hashes of the word sequence, texts of one id by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.shared import KeyFilter, from_key, in_arrow, key_filter, to_key, write_shared
from quarry.llm.words import hashes, ngrams, signed, slices, spans, text_buffers, unsigned


class _Text:
    """Words of a slice of documents, hashed, with their anchors."""

    def __init__(self, part: pa.RecordBatch, window: int, gram: int):
        self.data, self.offsets = text_buffers(part.column("text"))
        self.starts, self.ends, self.first = spans(self.data, self.offsets)
        self.word = hashes(self.data, self.starts, self.ends, lower=False)
        size = np.diff(self.first)
        self.row = np.repeat(np.arange(len(size)), size)
        self.window = window
        stretches = max(0, len(self.word) - window + 1)
        self.whole = self.row[:stretches] == self.row[window - 1:window - 1 + stretches]  # within one document
        self.gram = ngrams(self.word, gram)
        span = window - gram + 1  # anchors are the least gram of each stretch, the last of equal ones
        if stretches:
            seen = sliding_window_view(self.gram, span)[:stretches]
            at = np.arange(stretches) + (span - 1 - seen[:, ::-1].argmin(axis=1))
            self.anchor_of = at  # of each stretch
            self.anchors = np.unique(at[self.whole])
        else:
            self.anchor_of = self.anchors = np.empty(0, np.int64)


def _scan(docs: DataFrame, first: KeyFilter, window: int, gram: int) -> DataFrame:
    """(gram, doc_id) of each anchor of the documents that pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(_passing(batch, first)):
                t = _Text(part, window, gram)
                key, doc = t.gram[t.anchors], part.column("doc_id").to_numpy()[t.row[t.anchors]]
                yield pa.record_batch([pa.array(signed(key)), pa.array(doc)], ["gram", "doc_id"])
    return docs.transform(in_arrow, run, "gram long, doc_id long")


def _passing(batch: pa.RecordBatch, passes: KeyFilter, want: bool = True) -> pa.RecordBatch:
    return batch.filter(pa.array(passes(unsigned(batch.column("h").to_numpy())) == want))


def _stretches(docs: DataFrame, first: KeyFilter, seeds: KeyFilter, window: int, gram: int) -> DataFrame:
    """(stretch, doc_id, t, at): the stretches around seeds, the smallest document's first one for each slice.
    Those of larger documents of the slice are settled: their runs are rows with at = -1 - begin, and the
    end in the low half of the key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(_passing(batch, first)):
                t = _Text(part, window, gram)
                at = np.flatnonzero(t.whole)
                at = at[seeds(t.gram[t.anchor_of[at]])]
                key, doc, text = ngrams(t.word, window)[at], part.column("doc_id").to_numpy()[t.row[at]], part.column("t").to_numpy()[t.row[at]]
                place = at - t.first[t.row[at]]
                order = np.lexsort((doc, key))
                head = np.concatenate([[True], key[order][1:] != key[order][:-1]]) if len(order) else np.empty(0, bool)
                least = doc[order][np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
                settled = np.zeros(len(at), dtype=bool)
                settled[order] = doc[order] > least
                send = order[head]
                yield pa.record_batch([pa.array(signed(key[send])), pa.array(doc[send]), pa.array(text[send]), pa.array(place[send].astype(np.int32))], names)
                # the smallest document's other occurrences wait for the same answer as its first
                more = order[~head & (doc[order] == least)]
                yield pa.record_batch([pa.array(signed(key[more])), pa.array(doc[more]), pa.array(text[more]), pa.array(place[more].astype(np.int32))], names)
                i = np.flatnonzero(settled)
                if len(i):  # in text order: neighbours of one row make a run
                    cut = np.concatenate([[True], (at[i][1:] != at[i][:-1] + 1) | (t.row[at[i]][1:] != t.row[at[i]][:-1])])
                    begin, last = i[cut], i[np.append(np.flatnonzero(cut)[1:] - 1, len(i) - 1)]
                    low = (place[last] + window).astype(np.uint64)
                    yield pa.record_batch([pa.array(signed(key[begin] >> np.uint64(32) << np.uint64(32) | low)), pa.array(doc[begin]),
                                           pa.array(text[begin]), pa.array((-1 - place[begin]).astype(np.int32))], names)

    names = ["stretch", "doc_id", "t", "at"]
    return docs.transform(in_arrow, run, "stretch long, doc_id long, t long, at int")


def _covered(found: DataFrame, window: int) -> DataFrame:
    """(doc_id, t, at, upto): the settled runs, and the stretches that a smaller id has too (upto is 0 there).
    Rows come in order of stretch and id, so the smallest id of a stretch is seen first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, least = None, 0
        for batch in batches:
            key, doc, text, at = (batch.column(c).to_numpy() for c in ("stretch", "doc_id", "t", "at"))
            if not len(key):
                continue
            done = at < 0
            yield pa.record_batch([pa.array(doc[done]), pa.array(text[done]), pa.array(-1 - at[done], pa.int32()),
                                   pa.array((key[done] & 0x7FFFFFFF).astype(np.int32))], names)
            key, doc, text, at = key[~done], doc[~done], text[~done], at[~done]
            if not len(key):
                continue
            head = np.concatenate([[key[0] != before], key[1:] != key[:-1]])
            from_ = np.maximum.accumulate(np.where(head, np.arange(len(key)), -1))
            low = np.where(from_ >= 0, doc[from_], least)
            before, least = key[-1], low[-1]
            more = doc > low
            yield pa.record_batch([pa.array(doc[more]), pa.array(text[more]), pa.array(at[more]), pa.array(np.zeros(int(more.sum()), np.int32))], names)

    names = ["doc_id", "t", "at", "upto"]
    return found.repartition("stretch").sortWithinPartitions("stretch", "doc_id").transform(in_arrow, run, "doc_id long, t long, at int, upto int")


def repeats(docs: DataFrame, window: int = 13, gram: int = 6, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, t, starts, runs, copy): what the rows of an id and text (by its digest t) lose: stretches by their first word, runs of words
    [at, upto), and whether its text is a copy of a smaller document's (which then loses all stretches)."""
    docs = docs.select(to_key(key).alias("doc_id"), F.col(text).alias("text"))
    docs = docs.withColumn("t", F.xxhash64("text")).withColumn("h", F.xxhash64("doc_id", "t"))
    digest = write_shared(docs.where("text is not null").select("doc_id", "t", F.unhex(F.md5("text")).alias("m")), "digests")
    least = digest.groupBy("m").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.min("t").alias("t"))
    first = key_filter(least.select(F.xxhash64("low", "t").alias("h")), "h")  # every first one passes; a copy that does is searched too
    copies = digest.join(least.where("low < high").drop("t"), "m").where("doc_id > low").select("doc_id", "t").distinct()
    shared = (_scan(docs, first, window, gram).groupBy("gram").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
              .where("low < high"))
    seeds = key_filter(shared, "gram")
    again = _covered(_stretches(docs, first, seeds, window, gram), window)
    again = again.groupBy("doc_id", "t").agg(F.collect_list(F.expr("if(upto = 0, at, null)")).alias("starts"),
                                             F.collect_list(F.expr("if(upto > 0, struct(at, upto), null)")).alias("runs"))
    again = again.withColumn("copy", F.lit(False)).union(copies.select("doc_id", "t", F.expr("cast(array() as array<int>)"),
                                                                       F.expr("cast(array() as array<struct<at: int, upto: int>>)"), F.lit(True)))
    again = again.groupBy("doc_id", "t").agg(F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("runs")).alias("runs"),
                                             F.max("copy").alias("copy"))
    return write_shared(again, "repeats")


def _marked(first: np.ndarray, part: pa.RecordBatch, window: int, n: int) -> np.ndarray:
    """The words of a slice that its documents lose."""
    edge = np.zeros(n + 1, dtype=np.int64)
    count = np.diff(first)

    def mark(rows: np.ndarray, begin: np.ndarray, end: np.ndarray) -> None:
        np.add.at(edge, first[rows] + np.minimum(begin, count[rows]), 1)
        np.add.at(edge, first[rows] + np.minimum(end, count[rows]), -1)

    for name in ("starts", "runs"):
        lists = part.column(name).fill_null([])
        size = np.diff(lists.offsets.to_numpy())
        rows, flat = np.repeat(np.arange(len(size)), size), lists.flatten()
        if name == "starts":
            mark(rows, flat.to_numpy(), flat.to_numpy() + window)
        else:
            mark(rows, flat.field("at").to_numpy(), flat.field("upto").to_numpy())
    whole = np.flatnonzero(pc.fill_null(part.column("copy"), False).to_numpy(zero_copy_only=False) & (count >= window))
    mark(whole, np.zeros(len(whole), np.int64), count[whole])
    return np.cumsum(edge)[:n] > 0


def dedup(docs: DataFrame, window: int = 13, gram: int = 6, key: str = "doc_id", text: str = "text",
          keep: tuple[str, ...] = (), as_is: bool = False) -> DataFrame:
    """(key, n_words, n_removed, kept, *keep): each document with its covered words removed and the others
    joined by one space; with `as_is` the text of a document that loses none stays as it was."""
    carried = [F.col(c).alias(f"c{i}") for i, c in enumerate(keep)]
    plain = docs.select(to_key(key).alias("doc_id"), F.col(text).alias("text"), *carried).withColumn("t", F.xxhash64("text"))
    again = repeats(docs, window, gram, key, text)
    touched = key_filter(again.select(F.xxhash64("doc_id", "t").alias("h")), "h")
    hashed = plain.withColumn("h", F.xxhash64("doc_id", "t"))
    names = [f"c{i}" for i in range(len(keep))]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                           T.StructField("kept", T.StringType()), *(hashed.schema[c] for c in names)])

    def to_cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _passing(batch, touched)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            with_starts = "starts" in batch.schema.names
            for part in slices(batch if with_starts else _passing(batch, touched, False)):
                data, offsets = text_buffers(part.column("text"))
                starts, ends, first = spans(data, offsets)
                drop = _marked(first, part, window, len(starts)) if with_starts else np.zeros(len(starts), dtype=bool)
                removed = np.diff(np.concatenate([[0], np.cumsum(drop)])[first])
                kept = pa.array(_joined(data, starts, ends, first, ~drop), pa.string())
                if as_is:
                    kept = pc.if_else(pa.array(removed == 0), part.column("text"), kept)
                yield pa.record_batch([part.column("doc_id"), pa.array(np.diff(first)), pa.array(removed), kept,
                                       *(part.column(c) for c in names)], schema.names)

    clean = hashed.transform(in_arrow, run, schema)
    cut = hashed.transform(in_arrow, to_cut, hashed.schema).drop("h").join(again, ["doc_id", "t"], "left").transform(in_arrow, run, schema)
    return clean.union(cut).select(from_key("doc_id").alias(key), "n_words", "n_removed", "kept",
                                   *[F.col(n).alias(c) for n, c in zip(names, keep, strict=True)])


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, keep: np.ndarray) -> list[bytes]:
    """Each row's kept words joined by one space."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))[keep]
    s, e = starts[keep], ends[keep]
    # stretches of words with a single space between them in the text are taken in one go
    if not len(s):
        return [b""] * (len(first) - 1)
    near = (s[1:] == e[:-1] + 1) & (row[1:] == row[:-1])
    near[near] = data[e[:-1][near]] == 0x20
    head = np.concatenate([[True], ~near])
    tail = np.concatenate([~near, [True]])
    out: list[list[bytes]] = [[] for _ in range(len(first) - 1)]
    for r, a, b in zip(row[head].tolist(), s[head].tolist(), e[tail].tolist(), strict=True):
        out[r].append(data[a:b].tobytes())
    return [b" ".join(x) for x in out]

