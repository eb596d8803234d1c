"""Words of whole texts as numpy arrays, read straight from Arrow's text buffers.

A word is a maximal run of bytes other than space, \\t, \\n, \\v, \\f and \\r.
Null texts count as empty. Work arrays are bounded: texts are taken in slices
of a few MB, and words are hashed half a megabyte at a time, however long a text is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

WORD = r"[^\x20\x09-\x0D]+"

_CHUNK = 1 << 19  # bytes hashed at once
_LONG = 1 << 16  # longer words are hashed one by one
_P = 0x9E3779B97F4A7C15

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finishing steps of a 64-bit hash (the public splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _random(seed: int, n: int) -> np.ndarray:
    """n fixed odd numbers that look random."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_P) + np.uint64(seed)) | np.uint64(1)


_SEEDS = (0x51ED270B, 0xB5297A4D)
_TABLES: dict[tuple[int, bool], tuple[np.ndarray, np.ndarray]] = {}


def _tables(which: int, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """A number for each byte value, and a factor for each place in a word."""
    if (which, lower) not in _TABLES:
        byte = _random(_SEEDS[which], 256)
        if lower:
            byte = byte.copy()
            byte[ord("A"):ord("Z") + 1] = byte[ord("a"):ord("z") + 1]
        _TABLES[which, lower] = byte, _random(_SEEDS[which] + 1, _LONG)
    return _TABLES[which, lower]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return data, offsets


def slices(batch: pa.RecordBatch, text: str = "text", target: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in consecutive runs of rows of about `target` bytes of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    at, before = 0, 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(ends, before + target, "right")))
        yield batch.slice(at, to - at)
        before, at = int(ends[to - 1]), to


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words, and the word number at which each row begins (rows + 1 numbers)."""
    base, top = int(offsets[0]), int(offsets[-1])
    solid = ~IS_SPACE[data[base:top]]
    if not len(solid):
        zero = np.zeros(0, dtype=np.int64)
        return zero, zero, np.zeros(len(offsets), dtype=np.int64)
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    edge = offsets[(offsets > base) & (offsets < top)] - base  # words do not run on into the next row
    first[edge] = solid[edge]
    last[edge - 1] = solid[edge - 1]
    starts = np.flatnonzero(first) + base
    ends = np.flatnonzero(last) + base + 1
    return starts, ends, np.searchsorted(starts, offsets).astype(np.int64)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """64-bit hash of each word; `lower` folds A-Z to a-z. The sum, over the word, of a number for the
    byte times a factor for its place: factors of their own, not powers of one, so that no pair of words
    is equal by construction; words over `_LONG` bytes by xxHash."""
    return _hashes(data, starts, ends, lower, (0,))[0]


def wide_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each word, as two independent hashes."""
    return _hashes(data, starts, ends, False, (0, 1))


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool, which: tuple[int, ...]) -> tuple[np.ndarray, ...]:
    out = tuple(np.empty(len(starts), dtype=np.uint64) for _ in which)
    length = ends - starts
    long = length > _LONG
    for i in np.flatnonzero(long):
        word = data[starts[i]:ends[i]].tobytes()
        for held, w in zip(out, which, strict=True):
            held[i] = xxhash.xxh64_intdigest(word.lower() if lower else word, w)
    rest = np.flatnonzero(~long) if long.any() else None
    total = np.cumsum(length if rest is None else length[rest])
    at, before, n = 0, 0, len(total)
    while at < n:
        to = max(at + 1, int(np.searchsorted(total, before + _CHUNK, "right")))
        keep = slice(at, to) if rest is None else rest[at:to]
        size = length[keep].astype(np.int32)
        head = np.cumsum(size, dtype=np.int32) - size
        place = np.arange(int(total[to - 1]) - before, dtype=np.int32) - np.repeat(head, size)
        low = int(starts[keep][0])
        seg = data[np.repeat((starts[keep] - low), size) + place + low]
        for held, w in zip(out, which, strict=True):
            byte, factor = _tables(w, lower)
            held[keep] = np.add.reduceat(byte[seg] * factor[place], head)
        at, before = to, int(total[to - 1])
    return tuple(mix(held + length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) for held in out)


def ngrams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive words (len - n + 1 of them, across rows too)."""
    size = max(0, len(words) - n + 1)
    out = words[:size] * np.uint64(0xC2B2AE3D27D4EB4F)
    for j in range(1, n):
        out ^= out >> np.uint64(32)
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += words[j:j + size]
    return mix(out)


def pairs(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of each (left, right)."""
    out = left * np.uint64(0xC2B2AE3D27D4EB4F)
    out ^= out >> np.uint64(32)
    out *= np.uint64(0x9E3779B97F4A7C15)
    out += right
    return mix(out)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def unsigned(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.uint64)


def take_runs(pool: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """pool[begin:begin + size] of each run, one after the other."""
    total = int(size.sum())
    keep = size > 0
    begin, size = begin[keep], size[keep]
    if not total:
        return np.empty(0, pool.dtype)
    step = np.ones(total, dtype=np.int64)
    step[np.cumsum(size) - size] = begin - np.concatenate([[0], begin[:-1] + size[:-1] - 1])
    return pool[np.cumsum(step)]


class RunCache:
    """Token ids of byte strings, remembered by 128 bits of hash in flat arrays; cleared when `limit`
    strings or `most` ids are held."""

    def __init__(self, encode: Callable[[list[bytes]], list], limit: int = 500_000, most: int = 8_000_000):
        self.encode, self.limit, self.most = encode, limit, most
        self.clear()

    def clear(self) -> None:
        self.key, self.check = np.empty(0, np.uint64), np.empty(0, np.uint64)
        self.begin, self.size = np.empty(0, np.int64), np.empty(0, np.int32)
        self.pool, self.used = np.empty(1 << 16, np.uint32), 0

    def _runs(self, strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(begin, size) of the strings' ids, which now end the pool."""
        runs = self.encode(strings)
        size = np.fromiter(map(len, runs), dtype=np.int64, count=len(runs))
        end = self.used + int(size.sum())
        if end > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty(max(end - len(self.pool), len(self.pool) // 2), np.uint32)])
        self.pool[self.used:end] = np.fromiter((i for run in runs for i in run), dtype=np.uint32, count=end - self.used)
        begin = self.used + np.cumsum(size) - size
        self.used = end
        return begin, size

    def _add(self, key: np.ndarray, check: np.ndarray, strings: list[bytes]) -> None:
        for low in range(0, len(strings), 10_000):
            begin, size = self._runs(strings[low:low + 10_000])
            now = key[low:low + 10_000]
            at = np.searchsorted(self.key, now)
            self.key = np.insert(self.key, at, now)
            self.check = np.insert(self.check, at, check[low:low + 10_000])
            self.begin = np.insert(self.begin, at, begin)
            self.size = np.insert(self.size, at, size)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(begin, size) in the pool of the ids of each span of data."""
        if len(self.key) > self.limit or self.used > self.most:
            self.clear()
        first, second = wide_hashes(data, starts, ends)
        key, where, back = np.unique(first, return_index=True, return_inverse=True)
        check = second[where]
        new = self._missing(key)
        if new.any():
            i = where[new]
            self._add(key[new], check[new], [data[s:e].tobytes() for s, e in zip(starts[i].tolist(), ends[i].tolist(), strict=True)])
        at = np.searchsorted(self.key, key)
        begin, size = self.begin[at][back], self.size[at][back]
        other = np.flatnonzero(self.check[at][back] != second)  # another string has the first half of the hash
        if len(other):
            begin[other], size[other] = self._runs([data[starts[i]:ends[i]].tobytes() for i in other.tolist()])
        return begin, size

    def _missing(self, key: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.key, key), max(0, len(self.key) - 1))
        return self.key[at] != key if len(self.key) else np.ones(len(key), dtype=bool)
