"""Byte-level BPE over whole texts: every match of a pattern is encoded by merging byte pairs.

Distinct matches of a slice of documents become rows of padded id matrices, one matrix for each
length bucket. In each round every row merges its leftmost pair of least rank; pairs are looked up
in a hashed table, finished rows leave, and the rest is compacted. Where a row holds the same least
pair several times, the round merges all of them at once if the outcome is provably the same as
one by one (checked on the ranks around them); other rows merge the leftmost only.

Defined cases: a null text is empty and has no ids; duplicates are encoded like any row; matches of
any length go through the same rounds; an empty table gives an empty table; columns other than the
key and the text are left out of the result.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quarry.llm.shared import held, in_arrow
from quarry.llm.words import RunCache, slices, spans, take_runs, text_buffers

_NONE = np.int32(2**31 - 1)
_CELLS = 1 << 20  # of a matrix, at most
_KNOWN = 100_000  # matches a worker remembers


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class PairTable:
    """Open-addressed hash table (a, b) -> rank of the joined token."""

    def __init__(self, ranks: dict[bytes, int]):
        keys, values = [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(rank)
        key, value = np.array(keys, dtype=np.uint64), np.array(values, dtype=np.int32)
        self.shift = 64 - max(4, (2 * len(key)).bit_length())
        size = 1 << (64 - self.shift)
        self.mask = np.int64(size - 1)
        self.key = np.full(size, np.iinfo(np.uint64).max, dtype=np.uint64)
        self.value = np.full(size, _NONE, dtype=np.int32)
        slot, left = self._slot(key), np.arange(len(key))
        while len(left):  # of the keys that want a free slot, the last written stays; the others move on
            free = self.key[slot[left]] == np.iinfo(np.uint64).max
            self.key[slot[left[free]]] = key[left[free]]
            here = self.key[slot[left]] == key[left]
            self.value[slot[left[here]]] = value[left[here]]
            left = left[~here]
            slot[left] = (slot[left] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(self.shift)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or 2**31 - 1; ids below 0 are padding."""
        out = np.full(left.shape, _NONE, dtype=np.int32)
        at = np.flatnonzero((left >= 0) & (right >= 0))
        key = left.ravel()[at].astype(np.uint64) << np.uint64(32) | right.ravel()[at].astype(np.uint64)
        slot, flat = self._slot(key), out.ravel()
        while len(at):
            found = self.key[slot]
            same = found == key
            flat[at[same]] = self.value[slot[same]]
            go = ~same & (found != np.iinfo(np.uint64).max)
            at, key, slot = at[go], key[go], (slot[go] + 1) & self.mask
        return flat.reshape(left.shape)


class Codec:
    """Encoder and decoder of one rank file and pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        self.ranks, self.pairs, self.split = ranks, PairTable(ranks), regex.compile(pattern).findall
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.known: dict[str, list[int]] = {}  # match -> its ids
        self.cache = RunCache(self._units)

    def encode_matches(self, matches: list[bytes]) -> list[np.ndarray]:
        out: list[np.ndarray] = [np.empty(0, np.int32)] * len(matches)
        buckets: dict[int, list[int]] = {}
        for i, m in enumerate(matches):
            rank = self.ranks.get(m)
            if rank is not None or not m:
                out[i] = np.array([rank] if m else [], dtype=np.int32)
            else:
                buckets.setdefault(max(4, 1 << (len(m) - 1).bit_length()), []).append(i)
        for width, rows in buckets.items():
            step = max(1, _CELLS // width)
            for at in range(0, len(rows), step):
                part = rows[at:at + step]
                for i, ids in zip(part, self._merge([matches[i] for i in part]), strict=True):
                    out[i] = ids
        return out

    def _merge(self, words: list[bytes]) -> list[np.ndarray]:
        length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ids = np.full((len(words), int(length.max())), -1, dtype=np.int32)
        ids[np.arange(ids.shape[1]) < length[:, None]] = self.byte[np.frombuffer(b"".join(words), dtype=np.uint8)]
        row = np.arange(len(words))
        done: list[np.ndarray] = [np.empty(0, np.int32)] * len(words)
        rank = self.pairs(ids[:, :-1], ids[:, 1:])
        while len(row):
            least = rank.min(axis=1, initial=_NONE)
            over = least == _NONE
            if over.any():
                for i, r in zip(row[over], ids[over], strict=True):
                    done[i] = r[r >= 0]
                go = ~over
                row, ids, rank, least = row[go], ids[go], rank[go], least[go]
                if not len(row):
                    break
            ids = self._round(ids, rank, least)
            ids = ids[:, :int((ids >= 0).sum(axis=1).max())]
            rank = self.pairs(ids[:, :-1], ids[:, 1:])
        return done

    def _round(self, ids: np.ndarray, rank: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The rows after a merge of their least pair."""
        first = rank.argmin(axis=1)
        hit = rank == least[:, None]
        many = np.flatnonzero(hit.sum(axis=1) > 1)
        one = np.zeros_like(hit)
        one[np.arange(len(ids)), first] = True
        if len(many):
            some = hit[many]
            place = np.arange(some.shape[1])
            gap = np.maximum.accumulate(np.where(some, -1, place), axis=1)
            some &= (place - gap) % 2 == 1  # of overlapping ones, from the left
            after = _compact(ids[many], some, least[many])
            good = self.pairs(after[:, :-1], after[:, 1:]).min(axis=1, initial=_NONE) > least[many]
            r, c = np.nonzero(some[:, 2:] & some[:, :-2])  # two pairs in a row: what stands between the merges
            if len(r):
                between = self.pairs(least[many][r], ids[many][r, c + 2])
                good[r[between <= least[many][r]]] = False
            one[many[good]] = some[good]
        return _compact(ids, one, least)

    def _units(self, units: list[bytes]) -> list[list[int]]:
        found = [self.split(u.decode()) for u in units]
        new = list({m for f in found for m in f if m not in self.known})
        if len(self.known) + len(new) > _KNOWN:
            self.known.clear()
            new = list({m for f in found for m in f})
        for m, ids in zip(new, self.encode_matches([m.encode() for m in new]), strict=True):
            self.known[m] = ids.tolist()
        return [[i for m in f for i in self.known[m]] for f in found]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in turn, where each text's begin).

        A text is cut into units: a word with the white space before it. No match of the pattern
        reaches over a unit's end, as the pattern joins a word only with one space before it; only
        texts with white space beyond ASCII are one unit each.
        """
        data, offsets = text_buffers(column)
        starts, ends, first = spans(data, offsets)
        size = np.diff(first)
        row = np.repeat(np.arange(len(size)), size)
        begin = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        head = first[:-1][size > 0]
        begin[head] = offsets[:-1][size > 0]  # a row's first unit begins with the row
        tail = offsets[:-1].copy()  # white space after a row's last word
        tail[size > 0] = ends[first[1:][size > 0] - 1]
        left = tail < offsets[1:]
        rows = np.concatenate([row, np.flatnonzero(left)])
        begin, end = np.concatenate([begin, tail[left]]), np.concatenate([ends, offsets[1:][left]])
        odd = _other_space(data, offsets)
        if odd.any():
            keep = ~odd[rows]
            at = np.flatnonzero(odd)
            rows, begin, end = np.concatenate([rows[keep], at]), np.concatenate([begin[keep], offsets[at]]), np.concatenate([end[keep], offsets[at + 1]])
        order = np.argsort(begin, kind="stable")
        rows, begin, end = rows[order], begin[order], end[order]
        at, many = self.cache(data, begin, end)
        total = np.concatenate([[0], np.cumsum(many)])
        return take_runs(self.cache.pool, at, many), total[np.searchsorted(rows, np.arange(len(offsets)))]


def _other_space(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows that hold white space other than the six ASCII characters (U+1C-1F, 85, A0, 1680, 2000-200A, 2028, 2029, 202F, 205F, 3000)."""
    d = data[int(offsets[0]):int(offsets[-1])]
    hit = (d >= 0x1C) & (d <= 0x1F)
    two = (d[:-1] == 0xC2) & ((d[1:] == 0x85) | (d[1:] == 0xA0))
    hit[:-1] |= two
    a, b, c = d[:-2], d[1:-1], d[2:]
    hit[:-2] |= (((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80))
                 | ((a == 0xE2) & (b == 0x81) & (c == 0x9F))
                 | ((a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))))
    out = np.zeros(len(offsets) - 1, dtype=bool)
    at = np.flatnonzero(hit) + int(offsets[0])
    out[np.searchsorted(offsets, at, "right") - 1] = True
    return out


def _compact(ids: np.ndarray, hit: np.ndarray, merged: np.ndarray) -> np.ndarray:
    """Each hit pair becomes the row's merged id; the gaps close to the left."""
    out = ids.copy()
    r, c = np.nonzero(hit)
    out[r, c] = merged[r]
    out[r, c + 1] = -1
    keep = out >= 0
    place = keep.cumsum(axis=1) - 1
    closed = np.full_like(ids, -1)
    r, c = np.nonzero(keep)
    closed[r, place[r, c]] = out[r, c]
    return closed


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids): the token ids of each whole text, by the rank file at `path` (read on the driver;
    the file bounds what is broadcast)."""
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = held(f"codec {path} {pattern}", lambda: Codec(shared.value, pattern))
        for batch in batches:
            for part in slices(batch, text, target=2 << 20):
                flat, first = codec.encode(part.column(text))
                offsets, flat = first.astype(np.int32), pa.array(flat.astype(np.int32))
                yield pa.record_batch([part.column(key), pa.ListArray.from_arrays(pa.array(offsets), flat)], ["k", "ids"])

    kind = docs.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return docs.select(key, text).transform(in_arrow, _renamed(run, [key, "ids"]), schema, f"codec {path}")


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """The frame with a binary column `decoded`: the bytes of its ids (null ids: no bytes)."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_ranks(path))
    encoded = encoded.drop("decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = shared.value
        size = np.zeros(max(token.values()) + 1, dtype=np.int64)
        size[list(token.values())] = list(map(len, token))
        begin = np.zeros(len(size), dtype=np.int64)
        begin[list(token.values())] = np.cumsum(list(map(len, token))) - list(map(len, token))
        pool = np.frombuffer(b"".join(token), dtype=np.uint8)
        for whole in batches:
            for batch in _some_ids(whole, ids):
                lists = batch.column(ids).fill_null([])
                first, flat = lists.offsets.to_numpy(), lists.values.to_numpy()[lists.offsets[0].as_py():lists.offsets[-1].as_py()]
                data = take_runs(pool, begin[flat], size[flat]).tobytes()
                at = np.concatenate([[0], np.cumsum(size[flat])])[first - first[0]]
                out = pa.array([data[a:b] for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())
                yield pa.record_batch([*batch.columns, out], [*batch.schema.names, "decoded"])

    return encoded.transform(in_arrow, run, T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())]), f"codec {path}")


def _some_ids(batch: pa.RecordBatch, ids: str, target: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about `target` ids, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(ids)), 0).to_numpy(zero_copy_only=False))
    at, before = 0, 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, before + target, "right")))
        yield batch.slice(at, to - at)
        before, at = int(ends[to - 1]), to


def _renamed(run, names):
    def inner(batches):
        for b in run(batches):
            yield b.rename_columns(names)
    return inner
