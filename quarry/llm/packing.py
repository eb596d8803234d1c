"""Best-fit packing of tokenised documents into sequences of a fixed length.

Tokens: the ids of a `tokenizers` file, then one end id for each document. A document longer than a
sequence is cut into full pieces and a shorter last one. Pieces are dealt to shards by a hash, each
shard of about `shard_size` pieces is packed by one task: best fit, longest first, then a local
search over the underfull bins. A move, a one-for-one or a two-for-one exchange between two bins is
made if it raises the sum of squared fills; bins that become empty are dropped.

Scale: texts are read once and never shuffled; what is shuffled is one small row per piece. A shard
costs at most about one sequence more than packing everything at once would.

Defined cases: a null text is an empty document (its end id alone); repeated rows are packed one by
one; an empty table gives an empty table; other columns are left out. (key, piece) should be unique,
else equal rows share a place in the same shard but still get places of their own.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.shared import held, in_arrow, write_shared
from quarry.llm.words import RunCache, slices, spans, take_runs, text_buffers

_PIECES = 200_000  # a worker remembers the ids of so many pieces
#: The splitting pattern of the word-level file, as in its pre-tokenizer (fixed value).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _byte_letters() -> dict[int, str]:
    """The public byte-level alphabet: printable bytes stand for themselves, the others for letters from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


class WordIds:
    """Ids of words by a tokenizer whose pieces never span white space. Words are remembered by hash.

    Words of Latin letters, digits and signs are lower-cased and split here and each distinct piece
    goes to the tokenizer's model; any other word goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_file(path)
        # words with the text of a special token go through the whole tokenizer, which finds it
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.model = self.whole.model
        self.split = regex.compile(SPLIT + r"|\n").findall
        self.safe = regex.compile(r"[\x21-\x7E\xA1-ɏ]+").fullmatch
        self.letters = _byte_letters()
        self.pieces: dict[str, list[int]] = {}
        self.cache = RunCache(lambda words: self._encode([w.decode() for w in words]), limit=1_500_000, most=12_000_000)

    def _piece(self, piece: str) -> list[int]:
        ids = self.pieces.get(piece)
        if ids is None:
            if len(self.pieces) >= _PIECES:
                self.pieces.clear()
            letters = piece.encode().decode("latin-1").translate(self.letters)
            ids = self.pieces[piece] = [t.id for t in self.model.tokenize(letters)]
        return ids

    def _encode(self, words: list[str]) -> list[list[int]]:
        out: list[list[int]] = []
        piece, safe = self._piece, self.safe
        plain = [w if safe(w) and not any(t in w for t in self.special) else "" for w in words]
        found = self.split("\n".join(plain).lower())
        now: list[int] = []
        for p in found:
            if p == "\n":
                out.append(now)
                now = []
            else:
                now = now + piece(p) if now else piece(p)
        out.append(now)
        for i, w in enumerate(plain):
            if not w:
                out[i] = self.whole.encode(words[i], add_special_tokens=False).ids
        return out

    def documents(self, data: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows in turn, each row's followed by `end`; where each row begins)."""
        starts, ends, first = spans(data, offsets)
        begin, size = self.cache(data, starts, ends)
        rows = len(offsets) - 1
        ids = take_runs(self.cache.pool, begin, size)
        upto = np.concatenate([[0], np.cumsum(size)])[first]  # ids before each row
        out = np.empty(len(ids) + rows, dtype=np.uint32)
        place = upto + np.arange(rows + 1)
        is_end = np.zeros(len(out), dtype=bool)
        is_end[place[1:] - 1] = True
        out[is_end] = end
        out[~is_end] = ids
        return out, place


def pieces(docs: DataFrame, path: str, length: int = 2048, end: int = 0, key: str = "doc_id", text: str = "text",
           with_ids: bool = False) -> DataFrame:
    """(key, piece, start, length, ids_crc32[, ids]): the tokenised documents, cut at `length`."""
    docs = docs.select(F.col(key).alias("k"), F.col(text).alias("text"))
    fields = [("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType())]
    schema = T.StructType([docs.schema["k"], *(T.StructField(n, t) for n, t in fields)])
    if with_ids:
        schema.add("ids", T.ArrayType(T.LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = held(name, lambda: WordIds(path))
        for batch in batches:
            for part in slices(batch):
                flat, place = reader.documents(*text_buffers(part.column("text")), end)
                size = np.diff(place)
                count = -(-size // length)
                row = np.repeat(np.arange(len(size)), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * length
                many = np.minimum(length, size[row] - start)
                low = place[row] + start
                crc = [zlib.crc32(flat[a:a + n]) for a, n in zip(low, many, strict=True)]
                columns = [pc.take(part.column("k"), pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                           pa.array(many, pa.int64()), pa.array(crc, pa.int64())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(low, len(flat)), pa.int32()), pa.array(flat, pa.int64())))
                yield pa.record_batch(columns, schema.names)

    name = f"word ids {path}"
    return docs.transform(in_arrow, run, schema, name).withColumnRenamed("k", key)


class Bins:
    """Bins of one shard: best fit in falling order of length, then the local search."""

    def __init__(self, sizes: np.ndarray, length: int):
        self.length = length
        self.size = sizes.tolist()
        self.items: list[list[int]] = []
        self.fill: list[int] = []
        gaps: list[list[int]] = [[] for _ in range(length + 1)]  # bins by free space
        mask = 0  # bit g: gaps[g] holds a bin
        for i in np.argsort(-sizes, kind="stable").tolist():
            s = self.size[i]
            fit = mask >> s
            if fit:
                g = s + ((fit & -fit).bit_length() - 1)  # the tightest gap
                b = gaps[g].pop()
                if not gaps[g]:
                    mask &= ~(1 << g)
                self.items[b].append(i)
                self.fill[b] += s
                g -= s
            else:
                b, g = len(self.items), length - s
                self.items.append([i])
                self.fill.append(s)
            if g:
                gaps[g].append(b)
                mask |= 1 << g

    def search(self) -> Bins:
        """Local search until a pass changes nothing; every change raises the squared fill."""
        while self._pass():
            pass
        return self

    def _pass(self) -> int:
        size, fill, items, length = self.size, self.fill, self.items, self.length
        order = sorted((b for b in range(len(items)) if 0 < fill[b] < length), key=fill.__getitem__)
        one: list[list[tuple[int, int]]] = [[] for _ in range(length + 1)]  # by size: (bin, item), emptiest bin last
        two: list[list[tuple[int, int, int]]] = [[] for _ in range(length + 1)]
        for b in reversed(order):
            held: dict[int, list[int]] = {}  # by size; two items of a size are enough for all its pairs
            for i in items[b]:
                one[size[i]].append((b, i))
                held.setdefault(size[i], []).append(i)
            sizes = list(held)
            for n, s in enumerate(sizes):
                if len(held[s]) > 1:
                    two[2 * s].append((b, held[s][0], held[s][1]))
                for t in sizes[n + 1:]:
                    two[s + t].append((b, held[s][0], held[t][0]))
        mask = [sum(1 << s for s, held in enumerate(held_by) if held) for held_by in (one, two)]
        where = {i: b for b in order for i in items[b]}
        changed = 0

        def offer(kind: int, low: int, high: int, taker: int):
            """The largest exchange of a size above low, up to high, from a bin emptier than the taker."""
            held_by = (one, two)[kind]
            span = (mask[kind] >> (low + 1)) & ((1 << max(0, high - low)) - 1)
            while span:
                s = low + span.bit_length()
                held = held_by[s]
                own = []  # the taker's are passed over
                while held:
                    b, *its = held[-1]
                    if b == taker and where.get(its[0]) == b:
                        own.append(held.pop())
                    elif all(where.get(i) == b for i in its):
                        break
                    else:
                        held.pop()  # out of date
                got = held[-1] if held else None
                held.extend(reversed(own))
                if not held:
                    mask[kind] &= ~(1 << s)
                elif got is not None and fill[got[0]] <= fill[taker]:
                    return s, got
                span &= ~(1 << (s - low - 1))
            return None

        def put(i: int, b: int) -> None:
            items[where[i]].remove(i)
            fill[where[i]] -= size[i]
            for j in {size[j]: j for j in items[b]}.values():  # its pairs there
                if size[i] + size[j] <= length:
                    two[size[i] + size[j]].append((b, i, j))
                    mask[1] |= 1 << (size[i] + size[j])
            items[b].append(i)
            fill[b] += size[i]
            where[i] = b
            one[size[i]].append((b, i))
            mask[0] |= 1 << size[i]

        for a in reversed(order):  # the fullest first
            while 0 < fill[a] < length:
                gap, best = length - fill[a], None
                for x in (-1, *items[a]):  # -1: a move; else x is given for something larger
                    s = size[x] if x >= 0 else 0
                    for kind in (0, 1):
                        got = offer(kind, s, s + gap, a)
                        if got and (best is None or got[0] - s > best[0]):
                            best = (got[0] - s, x, got[1])
                    if best and best[0] == gap:
                        break
                if best is None:
                    break
                _, x, (b, *its) = best
                if x >= 0:
                    put(x, b)
                for i in its:
                    put(i, a)
                changed += 1
        return changed

    def places(self) -> tuple[np.ndarray, np.ndarray]:
        """(bin, offset) of each piece; bins are numbered without gaps."""
        b_of, offset, n = np.zeros(len(self.size), np.int64), np.zeros(len(self.size), np.int64), 0
        for held in self.items:
            at = 0
            for i in held:
                b_of[i], offset[i] = n, at
                at += self.size[i]
            n += bool(held)
        return b_of, offset


def pack(cut: DataFrame, length: int = 2048, shard_size: int = 50_000) -> DataFrame:
    """The pieces with (sequence_id, offset): their sequence and place there. Columns: those of `cut`,
    which must have `length` (1 to the given length) and are otherwise carried along."""
    cut = write_shared(cut.drop("sequence_id", "offset"), "pieces")
    shards = max(1, math.ceil(cut.count() / shard_size))
    # by place in the written table, so that equal rows are spread too
    by = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards))
    schema = T.StructType([*cut.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.drop_columns("shard")
        b, offset = Bins(rows["length"].to_numpy(), length).search().places()
        return rows.append_column("sequence_id", pa.array(b + (key[0].as_py() << 32))).append_column("offset", pa.array(offset))

    return cut.withColumn("shard", by).groupBy("shard").applyInArrow(run, schema)
