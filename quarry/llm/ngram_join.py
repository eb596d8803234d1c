"""N-gram Jaccard join: documents whose sets of word n-grams overlap by a threshold, as components.

Method: the n-grams of a document are hashed into groups; its counts by group are a point. Points of
a block are indexed in a packed R-tree. Two sets share at most the sum of the coordinate minima of
their points, so a subtree whose corner of maxima gives less than the threshold needs is skipped,
and a pair whose points give less is dropped. Pairs that are left are verified on the whole sets.

How the join is dealt out: a count vector says little about unrelated texts of one length, so one
tree over everything would be searched almost whole. Points are therefore blocked first, exactly:
sets with Jaccard t or more share one of their first n - ceil(t n) + 1 n-grams in any common order
(here: n-grams seen in many documents last, then by hash), so each of these is a block, and links
can only be within blocks. A pair must moreover share so many block keys that the rest can differ
by the threshold at most; pairs that share fewer are dropped before verification.

Skew: equal sets are one node from the start. Blocks of up to `small` nodes emit their surviving
pairs. In a larger block all nodes are first paired with one pivot, which is linear. What links this
verifies is contracted, and only pairs between different components of a block remain; they are
found by R-trees over bounded cells of the block. So a group of near copies costs a star, not all
its pairs, and still no link between components is lost.

Defined cases: a null text or one without words has an empty set and is linked with nothing; a text
of fewer than n words has its whole sequence as one n-gram; repeated rows are one node; texts of any
length are used whole; an empty table gives an empty table; other columns are left out. N-grams and
sets are compared by 64-bit hash until verification, which compares sets of 64-bit n-gram hashes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.shared import components, from_key, in_arrow, key_filter, to_key, write_shared
from quarry.llm.words import hashes, mix, ngrams, signed, slices, spans, text_buffers, unsigned

GROUPS = 16
_TOP = 65_535  # of a coordinate; where both have it, the minimum is not known and the bound is open
HEAD = 8  # block keys of a node that tell which block reports a pair
_HOT = 100_000  # n-grams put last in the order, at most


def _need(a, b, percent: int):
    """Least overlap of two sets of a and b n-grams at the threshold: 100 o >= percent (a + b - o)."""
    return -((-percent * (a + b)) // (100 + percent))


def gram_sets(part: pa.RecordBatch, text: str, n: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each row's text."""
    data, offsets = text_buffers(part.column(text))
    starts, ends, first = spans(data, offsets)
    word = hashes(data, starts, ends, lower=True)
    gram = ngrams(word, n)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(gram[a:b - n + 1]))
        else:
            out.append(mix(ngrams(word[a:b], b - a) + np.uint64(b - a)) if b > a else gram[:0])
    return out


def _node(grams: np.ndarray) -> int:
    """Identity of a set: a sum of mixed hashes, finished with its size."""
    return int(mix(mix(grams).sum(dtype=np.uint64).reshape(1) + np.uint64(len(grams)) * np.uint64(0x9E3779B97F4A7C15))[0])


def _point(grams: np.ndarray) -> bytes:
    return np.minimum(np.bincount((grams % np.uint64(GROUPS)).astype(np.int64), minlength=GROUPS), _TOP).astype(np.uint16).tobytes()


def _bound(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Most that sets with these points can share."""
    low = np.minimum(a, b)
    return low.sum(axis=-1) + np.where((low == _TOP).any(axis=-1), 1 << 40, 0)


def _bounded(percent: int):
    """Keeps the pairs (a, b) of rows whose points (n, point and pn, pp) may share enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint16).reshape(-1, GROUPS).astype(np.int64) for c in ("point", "pp"))
            good = _bound(x, y) >= _need(batch.column("n").to_numpy(), batch.column("pn").to_numpy(), percent)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    return run


def _enough(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray, need: np.ndarray, step: int = 1 << 15) -> np.ndarray:
    """Whether the points a[i] and b[j] may share what is needed; some thousand pairs at a time."""
    out = np.empty(len(i), dtype=bool)
    for low in range(0, len(i), step):
        k = slice(low, low + step)
        out[k] = _bound(a[i[k]], b[j[k]]) >= need[k]
    return out


class Tree:
    """Packed R-tree of count vectors: pages of neighbours by size and by their widest coordinate; each
    page, and each page of pages, has its corner of maxima and its smallest and largest set size."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, page: int = 16):
        widest = points[:, points.var(axis=0).argmax()]
        strip = max(page, int(np.sqrt(len(points) / page)) * page)
        by_size = np.argsort(sizes, kind="stable")
        self.order = np.concatenate([by_size[i:i + strip][np.argsort(widest[by_size[i:i + strip]], kind="stable")]
                                     for i in range(0, len(by_size), strip)])
        self.page = page
        level = (points[self.order], sizes[self.order], sizes[self.order])
        self.levels = [level]
        while len(level[0]) > page:
            cut = np.arange(0, len(level[0]), page)
            level = (np.maximum.reduceat(level[0], cut), np.minimum.reduceat(level[1], cut), np.maximum.reduceat(level[2], cut))
            self.levels.append(level)

    def pairs(self, points: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, indexed point) of all pairs that the bound lets through."""
        top = self.levels[-1]
        q, c = (x.ravel() for x in np.indices((len(points), len(top[0]))))
        for depth in range(len(self.levels) - 1, -1, -1):
            corner, low, high = self.levels[depth]
            good = (100 * high[c] >= percent * sizes[q]) & (percent * low[c] <= 100 * sizes[q])
            q, c = q[good], c[good]
            good = _enough(points, q, corner, c, _need(sizes[q], np.maximum(low[c], -(-percent * sizes[q] // 100)), percent))
            q, c = q[good], c[good]
            if depth:
                below = len(self.levels[depth - 1][0])
                q, c = np.repeat(q, self.page), (c[:, None] * self.page + np.arange(self.page)).ravel()
                q, c = q[c < below], c[c < below]
        return q, self.order[c]


def _cell_pairs(points, sizes, percent: int, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs (i < j) within each run [start, end) that the bound lets through. Short runs are one
    page of a tree each and are done together; longer ones get a tree of their own."""
    left, right = [], []
    length = end - start
    for m in np.unique(length[(length > 1) & (length <= 16)]).tolist():
        i, j = np.triu_indices(m, 1)
        at = start[length == m]
        a, b = (at[:, None] + i).ravel(), (at[:, None] + j).ravel()
        good = _enough(points, a, points, b, _need(sizes[a], sizes[b], percent))
        left.append(a[good])
        right.append(b[good])
    for a, b in zip(start[length > 16].tolist(), end[length > 16].tolist(), strict=True):
        q, c = Tree(points[a:b], sizes[a:b]).pairs(points[a:b], sizes[a:b], percent)
        left.append(a + q[q < c])
        right.append(a + c[q < c])
    return (np.concatenate(left), np.concatenate(right)) if left else (np.empty(0, np.int64), np.empty(0, np.int64))


def _fine_pairs(fine: list[bytes], sizes: np.ndarray, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Which of the pairs their fine points let through; pairs are taken by the shorter point's length."""
    fine = [zlib.decompress(p) for p in fine]
    length = np.fromiter(map(len, fine), dtype=np.int64, count=len(fine))
    full = np.fromiter((255 in p for p in fine), dtype=bool, count=len(fine))
    shorter = np.minimum(length[i], length[j])
    good = full[i] | full[j]
    for m in np.unique(shorter).tolist():
        own = np.flatnonzero((length >= m) & ~full)
        place = np.full(len(fine), -1)
        place[own] = np.arange(len(own))
        points = np.stack([np.frombuffer(fine[k], np.uint8).reshape(-1, m).sum(axis=0, dtype=np.uint16) for k in own.tolist()]) if len(own) else None
        at = np.flatnonzero((shorter == m) & ~good)
        step = max(1, (1 << 22) // m)
        for low in range(0, len(at), step):
            k = at[low:low + step]
            a, b = i[k], j[k]
            good[k] = np.minimum(points[place[a]], points[place[b]]).sum(axis=1, dtype=np.int64) >= _need(sizes[a], sizes[b], percent)
    return good


def _first_shared(firsts: np.ndarray, key: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs a block should report: those whose least shared block key it is, as far as the nodes'
    least keys tell. If two sorted lists share a key, their least shared one is in both lists' heads
    whenever the heads share any; a pair whose heads share none is reported by every block."""
    out = np.empty(len(i), dtype=bool)
    none = np.iinfo(np.int64).max
    for low in range(0, len(i), 1 << 16):
        a, b = firsts[i[low:low + (1 << 16)]], firsts[j[low:low + (1 << 16)]]
        shared = (a[:, :, None] == b[:, None, :]).any(axis=2) & (a != none)
        least = np.where(shared, a, none).min(axis=1)
        out[low:low + len(a)] = (least == none) | (least == key[i[low:low + (1 << 16)]])
    return out


def _in_cells(rows: DataFrame, percent: int, schema: str, cell: list[str], keep=None) -> DataFrame:
    """Pairs within each cell of rows (cell columns, node, n, point, ...): a partition holds whole, bounded
    cells in order, so batches are cut at cell borders and no cell is held but the present one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(t: pa.Table) -> pa.RecordBatch:
            at = np.column_stack([t[c].to_numpy() for c in cell])
            edge = np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1
            start, end = np.concatenate([[0], edge]), np.concatenate([edge, [len(at)]])
            points = np.frombuffer(b"".join(t["point"].to_pylist()), dtype=np.uint16).reshape(-1, GROUPS).astype(np.int64)
            sizes, node = t["n"].to_numpy().astype(np.int64), t["node"].to_numpy()
            i, j = _cell_pairs(points, sizes, percent, start, end)
            good = node[i] != node[j]
            if keep is not None:
                good &= keep(t, i, j)
            i, j = i[good], j[good]
            if "fine" in t.schema.names:
                good = _fine_pairs(t["fine"].to_pylist(), sizes, i, j, percent)
                i, j = i[good], j[good]
                firsts = np.array([(*f, *[np.iinfo(np.int64).max] * (HEAD - len(f))) for f in t["firsts"].to_pylist()], dtype=np.int64)
                good = _first_shared(firsts.reshape(-1, HEAD), t["key"].to_numpy(), i, j)
                i, j = i[good], j[good]
            swap = node[i] > node[j]
            a, b = np.where(swap, j, i), np.where(swap, i, j)
            return pa.record_batch([pa.array(node[a]), pa.array(node[b]), pa.array(sizes[a]), pa.array(sizes[b])], ["a", "b", "na", "nb"])

        rest = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            now = now if rest is None else pa.concat_tables([rest, now])
            if not now.num_rows:
                continue
            at = np.column_stack([now[c].to_numpy() for c in cell])
            edge = np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1  # where cells begin, but for the first
            low = 0
            while low < (edge[-1] if len(edge) else 0):  # whole cells, some hundred rows or one cell at a time
                to = int(edge[max(np.searchsorted(edge, low, "right"), np.searchsorted(edge, low + 512, "right") - 1)])
                yield done(now.slice(low, to - low))
                low = to
            rest = now.slice(low)
        if rest is not None and rest.num_rows:
            yield done(rest)

    return rows.repartition(*cell).sortWithinPartitions(*cell).transform(in_arrow, run, schema)


def _fine(grams: np.ndarray) -> bytes:
    """A point with about one coordinate for each n-gram (a power of two, 1024 at least), a byte each, compressed:
    small counts take some two bits. In sets of a few hundred n-grams few share a coordinate, so the bound is close."""
    groups = max(1024, 1 << max(0, len(grams).bit_length() - 1))
    return zlib.compress(np.minimum(np.bincount((grams % np.uint64(groups)).astype(np.int64), minlength=groups), 255).astype(np.uint8).tobytes(), 1)


def _fine_bound(a: bytes, b: bytes) -> int:
    """Most that two sets with these fine points can share; the longer point is folded to the shorter's groups."""
    x, y = (np.frombuffer(zlib.decompress(p), dtype=np.uint8) for p in (a, b))
    if x.max() == 255 or y.max() == 255:  # a count that did not fit
        return 1 << 40
    m = min(len(x), len(y))
    return int(np.minimum(x.reshape(-1, m).sum(axis=0, dtype=np.int64), y.reshape(-1, m).sum(axis=0, dtype=np.int64)).sum())


#: n-grams of a part of a set, about
PART = 2048


def _level(n: int) -> int:
    """A set of n n-grams is cut into 2**level parts, by the top bits of their hashes."""
    return max(0, (max(1, n) - 1).bit_length() - (PART - 1).bit_length())


def _set_parts(sets: list[np.ndarray], nodes: list[int], percent: int) -> tuple[list, list, list, list]:
    """(node, level, part, n-grams) of the sets, cut at their level and at those of smaller partners."""
    out: tuple[list, list, list, list] = ([], [], [], [])
    for node, grams in zip(nodes, sets, strict=True):
        top = _level(len(grams))
        for level in range(_level(-(-percent * len(grams) // 100)), top + 1):
            # at each level the parts are those of the finest one: sums over them are the same
            edge = np.searchsorted(grams, np.arange(1, 1 << top, dtype=np.uint64) << np.uint64(64 - top)) if top else []
            for r, part in enumerate(np.split(grams, edge)):
                if len(part):
                    for to, x in zip(out, (node, level, r >> (top - level), signed(part)), strict=True):
                        to.append(x)
    return out


def _verified(pairs: DataFrame, points: DataFrame, parts_of, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets meet the threshold. Fine points, some twentieth of the sets' bytes,
    travel first; sets are made for the nodes of the pairs that these let through, in parts of bounded size
    whose overlaps are summed. parts_of: (node, level, r, grams) of the nodes that a key filter passes."""
    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [batch.column(c).to_pylist() for c in ("fa", "fb", "na", "nb")]
            good = [_fine_bound(a, b) >= _need(m, n, percent) for a, b, m, n in zip(*x, strict=True)]
            yield batch.select(["a", "b", "na", "nb"]).filter(pa.array(good, pa.bool_()))

    both = (pairs.select("a", "b").join(points.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("fine").alias("fb")), "b")
            .join(points.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("fine").alias("fa")), "a"))
    pairs = write_shared(both.transform(in_arrow, likely, "a long, b long, na long, nb long"), "likely")
    parts = parts_of(key_filter(pairs.select(F.xxhash64("a").alias("h")).union(pairs.select(F.xxhash64("b").alias("h"))), "h"))
    level = lambda n: F.greatest(F.lit(0), F.length(F.bin(F.col(n) - 1)) - (PART - 1).bit_length())
    # of linked sets the smaller one's level is among those of the larger one
    pairs = pairs.withColumn("level", F.least(level("na"), level("nb")))
    pairs = pairs.withColumn("r", F.explode(F.sequence(F.lit(0).cast("long"), F.call_function("shiftleft", F.lit(1).cast("long"), F.col("level")) - 1)))
    # both sides on the same columns, so that the parts are shuffled once
    side = lambda x: parts.select(F.col("node").alias(x), "level", "r", F.col("grams").alias(f"g{x}"))
    both = pairs.join(side("a"), ["a", "level", "r"]).join(side("b"), ["b", "level", "r"])
    shared = both.groupBy("a", "b", "na", "nb").agg(F.sum(F.size(F.array_intersect("ga", "gb"))).alias("shared"))
    return shared.where(100 * F.col("shared") >= percent * (F.col("na") + F.col("nb") - F.col("shared"))).select("a", "b")


def join(docs: DataFrame, n: int = 4, percent: int = 85, key: str = "doc_id", text: str = "text", small: int = 64,
         cell: int = 1024) -> DataFrame:
    """(key, n_shingles, component_id): each document's set size and the smallest key of its component.

    key: an integer column; rows of one key (or without one) are grouped each by their own text. Two
    documents link when 100 * |A & B| >= percent * |A | B|.
    """
    known = _grouped(docs, n, percent, key, text, small, cell)
    smallest = known.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return (known.join(smallest, "component", "left")
            .select(from_key("doc_id").alias(key), F.col("n").alias("n_shingles"),
                    F.nullif(F.coalesce("component_id", "doc_id"), F.lit(2**63 - 1)).alias("component_id")))


def firsts(docs: DataFrame, n: int = 4, percent: int = 85, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` less near duplicates: one row of each component, that of the smallest key, and
    of the smallest text digest within the key; rows without n-grams stay."""
    known = _grouped(docs, n, percent, key, text)
    copies = known.where("component is not null").groupBy("component", "doc_id", "t").agg(F.count("*").alias("copies"))
    stay = (copies.groupBy("component").agg(F.min(F.struct("doc_id", "t", "copies")).alias("s")).select("s.*")
            .union(known.where("component is null").select("doc_id", "t", F.lit(1).cast("long")).distinct())
            .select(F.col("doc_id").alias("stay_id"), F.col("t").alias("stay_t"), "copies"))
    kept = docs.join(stay, (to_key(key) == F.col("stay_id")) & (F.xxhash64(text) == F.col("stay_t")))
    one = kept.where("copies > 1").groupBy("stay_id", "stay_t").agg(F.first(F.struct(*[docs[c] for c in docs.columns])).alias("row"))
    return kept.where("copies = 1").select(*[docs[c] for c in docs.columns]).union(one.select("row.*"))


def _grouped(docs: DataFrame, n: int, percent: int, key: str, text: str, small: int = 64, cell: int = 1024) -> DataFrame:
    """(doc_id, t, node, n, component) of each row: t is its text's digest; the component is null without n-grams."""
    docs = docs.select(to_key(key).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("t"))

    # 1. every document's node, and n-grams that are in many documents of some slice
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets = gram_sets(part, "text", n)
                size = pa.array([len(s) for s in sets], pa.int64())
                node = pa.array(np.array([_node(s) for s in sets], dtype=np.uint64).view(np.int64))
                none = pa.nulls(len(sets), pa.int64())
                yield pa.record_batch([part.column("doc_id"), part.column("t"), node, size, none, none], names)
                gram, df = np.unique(np.concatenate(sets), return_counts=True)
                often = df >= max(4, len(sets) // 200)
                gram, df = signed(gram[often]), df[often]
                none = pa.nulls(len(gram), pa.int64())
                yield pa.record_batch([none, none, none, none, pa.array(gram), pa.array(df.astype(np.int64))], names)

    names = ["doc_id", "t", "node", "n", "gram", "df"]
    found = write_shared(docs.transform(in_arrow, scan, "doc_id long, t long, node long, n long, gram long, df long"), "scan")
    members = found.where("doc_id is not null").select("doc_id", "t", "node", "n")
    often = (found.where("gram is not null").groupBy("gram").agg(F.sum("df").alias("df")).where(f"df >= {small}")
             .orderBy(F.desc("df"), "gram").limit(_HOT).toArrow())  # a bounded list; any order of n-grams is exact
    sc = docs.sparkSession.sparkContext
    hot = sc.broadcast(np.sort(unsigned(often["gram"].to_numpy())))

    # 2. one document stands for each node; its point and block keys
    reps = members.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("rep"), F.min("n").alias("n"))
    is_rep = key_filter(reps.select(F.xxhash64("rep").alias("h")), "h")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late = hot.value
        for batch in batches:
            batch = batch.filter(pa.array(is_rep(unsigned(batch.column("h").to_numpy()))))
            for part in slices(batch):
                columns: list[list] = [[], [], [], [], []]
                for grams in gram_sets(part, "text", n):
                    size = len(grams)
                    if not size:
                        continue
                    at = np.minimum(np.searchsorted(late, grams), max(0, len(late) - 1))
                    last = late[at] == grams if len(late) else np.zeros(size, bool)
                    order = np.concatenate([grams[~last], grams[last]])[:size - -(-percent * size // 100) + 1]
                    for column, value in zip(columns, (_node(grams) - (1 << 64) * (_node(grams) >> 63), size, _point(grams), signed(order), _fine(grams)), strict=True):
                        column.append(value)
                yield pa.record_batch([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary()),
                                       pa.array(columns[3], pa.list_(pa.int64())), pa.array(columns[4], pa.binary())], ["node", "n", "point", "keys", "fine"])

    hashed = docs.withColumn("h", F.xxhash64("doc_id"))
    nodes = write_shared(hashed.transform(in_arrow, blocks, "node long, n long, point binary, keys array<long>, fine binary"), "nodes")

    # 3. blocks (key, m) of two rows or more, then their rows (a node may have two, which pair with each other nowhere)
    counts = write_shared(nodes.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("m")).where("m > 1"), "blocks")
    is_shared = key_filter(counts, "key")

    def survivors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("keys")
            size = np.diff(keys.offsets.to_numpy())
            row, flat = np.repeat(np.arange(len(size)), size), keys.flatten().to_numpy()
            good = is_shared(unsigned(flat))
            row = pa.array(row[good])
            yield pa.record_batch([pa.array(flat[good]), *(batch.column(c).take(row) for c in ("node", "n", "point"))], ["key", "node", "n", "point"])

    rows = write_shared(nodes.transform(in_arrow, survivors, "key long, node long, n long, point binary"), "survivors")
    # 4. candidates: pairs of small blocks that share enough keys, and the star of each large block
    pair = "a long, b long, na long, nb long"
    least = F.ceil(percent * (F.col("na") + F.col("nb")) / (100 + percent))
    keys_of = lambda c: c - F.ceil(percent * c / 100) + 1
    enough = F.least(keys_of(F.col("na")) - F.col("na") + least, keys_of(F.col("nb")) - F.col("nb") + least) - 1e-6
    near = (_in_cells(rows.join(counts.where(f"m <= {small}"), "key").select("key", "node", "n", "point"), percent, pair, ["key"])
            .groupBy("a", "b", "na", "nb").agg(F.count("*").alias("c")))
    many = counts.where(f"m > {small}")
    large = _filtered(rows, key_filter(many, "key"), "key").join(many, "key")  # few rows travel, and those of a hot key by AQE's splits
    large = write_shared(large, "large")
    # keys of large blocks count for both nodes: a pair with some of them may be short of small ones and
    # is found in its large blocks
    near = near.where(F.col("c") >= enough).select("a", "b")
    pivots = (large.groupBy("key").agg(F.min(F.struct("node", "n", "point")).alias("p"))
              .select("key", F.col("p.node").alias("pivot"), F.col("p.n").alias("pn"), F.col("p.point").alias("pp")))
    stars = (large.join(pivots, "key").where("node != pivot")
             .select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"), "n", "point", "pn", "pp")
             .transform(in_arrow, _bounded(percent), "a long, b long"))
    pairs = write_shared(near.union(stars).distinct(), "pairs")
    wanted = key_filter(pairs.select(F.xxhash64("a").alias("h")).union(pairs.select(F.xxhash64("b").alias("h")))
                        .union(large.select(F.xxhash64("node").alias("h"))).distinct(), "h")

    points = write_shared(_filtered(nodes.select("node", "n", "fine").withColumn("h", F.xxhash64("node")), wanted)
                          .groupBy("node", "n").agg(F.first("fine").alias("fine")), "points")

    def parted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                node, level, r, grams = _set_parts(gram_sets(part, "text", n), part.column("node").to_pylist(), percent)
                yield pa.record_batch([pa.array(node, pa.int64()), pa.array(level, pa.int32()), pa.array(r, pa.int64()),
                                       pa.array(grams, pa.list_(pa.int64()))], ["node", "level", "r", "grams"])

    rep_node = reps.select(F.col("rep").alias("doc_id"), "node").withColumn("h", F.xxhash64("node"))

    def parts_of(asked) -> DataFrame:
        """Set parts of the asked nodes, from their texts: a filter of documents first, so that few texts meet the nodes."""
        chosen = _filtered(rep_node, asked).drop("h")
        need_docs = key_filter(chosen.select(F.xxhash64("doc_id").alias("d")), "d")
        # a node's text is a row of its document that has the node itself: a key may have other rows
        rows_of = members.join(chosen, ["doc_id", "node"]).groupBy("doc_id", "node").agg(F.min("t").alias("t"))
        texts = (_filtered(hashed, need_docs).drop("h").join(rows_of, ["doc_id", "t"])
                 .groupBy("doc_id", "t", "node").agg(F.first("text").alias("text")).select("node", "text"))
        return write_shared(texts, "texts").transform(in_arrow, parted, "node long, level int, r long, grams array<long>")

    links = write_shared(_verified(pairs, points, parts_of, percent), "links")
    labels = write_shared(components(links), "labels")

    # 5. what large blocks still hold of different components
    left = large.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = left.groupBy("key").agg(F.min("component").alias("c1"), F.max("component").alias("c2")).where("c1 != c2").select("key")
    left = left.join(mixed, "key")
    heads = left.groupBy("node").agg(F.slice(F.array_sort(F.collect_set("key")), 1, HEAD).alias("firsts"))
    left = left.join(heads, "node").join(points.select("node", "fine"), "node")
    cells = F.ceil(F.col("m") / cell).cast("int")
    left = left.withColumn("own", F.pmod(F.xxhash64("node"), cells).cast("int"))
    left = left.withColumn("other", F.explode(F.sequence(F.lit(0), cells - 1)))
    left = left.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "n", "point", "fine", "firsts", "component")

    def apart(t: pa.Table, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        c, own, diagonal = t["component"].to_numpy(), t["own"].to_numpy(), t["i"].to_numpy() == t["j"].to_numpy()
        return (c[i] != c[j]) & (diagonal[i] | (own[i] != own[j]))

    more = _in_cells(left, percent, pair, ["key", "i", "j"], apart).select("a", "b").distinct().join(pairs, ["a", "b"], "left_anti")
    extra = write_shared(_verified(more, points, parts_of, percent), "more-links")
    if extra.limit(1).count():
        labels = write_shared(components(links.union(extra)), "all-labels")

    # 6. nodes to rows
    return members.join(labels, "node", "left").withColumn("component", F.when(F.col("n") > 0, F.coalesce("component", "node")))


def _filtered(df: DataFrame, passes, column: str = "h") -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(passes(unsigned(batch.column(column).to_numpy()))))
    return df.transform(in_arrow, run, df.schema)

