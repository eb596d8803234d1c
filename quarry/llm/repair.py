"""Conversation structure repair: the cheapest edits that give a conversation alternating turns.

A repaired conversation has the role initials `(s?(ua)+)?`. Edits are Keep (0), Rerole to user or
assistant (2), Delete (3; the only one for blank and duplicate turns) and Insert of an empty user or
assistant turn (2); a truncated turn that stays costs 1 more. Of equally cheap edits the one whose
initials are least in ASCII is taken.

Method. One integer orders edit sequences: its high digits are the cost, its low digits (three bits
each, a fixed number of them, padded with zeros at the end) the initials in order, so the smaller of
two integers is the cheaper sequence, and of equal costs the first in ASCII. A node of the DAG is
(turn, state of the automaton of allowed initials); an edge is up to two inserts and one edit of the
turn; the minimum over the edges, from the last turn to the first, decides everything. From a given
state an insert or a rerole has only one role that fits, so the initials say all about the edits.

Scale. Turns are reduced to facts of some 40 bytes (initial, fault, a 128-bit digest of role and
text), range-partitioned by (conv_id, turn, digest) and read in order. At most `block` turns of one
conversation make one row: the least integer from each state to each state (inserts belong to the
turn that follows, so no sequence of a block is a prefix of another one, and least parts make a least
whole), with counts. So a conversation of any length is spread over tasks, and its blocks meet as
small rows. Whether a turn was seen earlier comes from an aggregate by digest. The texts move once,
to be edited and hashed in order as a stream; SHA-256 over one conversation's text can only be taken
by one task, which holds one batch of turns and the initials of the edits.

Defined cases: a null conv_id is a conversation of its own; null turns come first; turns of equal
number are ordered by the digest of role and text; a null role or text is one space; repeated rows
are duplicates; a role's initial is its first character, and other initials than s, u and a cannot be
kept; other columns are left out; an empty table gives an empty result; conversations of `ids`
without rows have zeros, no edits and the hash of the empty string.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.shared import in_arrow

SOLID = r"[^\x20\x09-\x0D]"
ENDED = r"[.!?][\x20\x09-\x0D]*\z"
LEGAL = {"su", "ua", "au"}
NAMES = {"u": "user", "a": "assistant"}

#: States of the automaton: 0 nothing yet, 1 after s, 2 after u, 3 after a. 0 and 3 may be the end.
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
FITS = {0: "u", 1: "u", 2: "a", 3: "u"}
ENDS = {0: (0, ""), 1: (4, "II"), 2: (2, "I"), 3: (0, "")}

_BITS = 3
_TO_DIGIT = str.maketrans("DIKR", "1234")
_TO_LETTER = str.maketrans("1234", "DIKR")

COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def damage(rows: DataFrame) -> DataFrame:
    """Rows with the faults that crc32('conv_id:turn') % 20 names: 0 drops the row, 1 empties its
    text, 2 removes its `.`, `!` and `?`, 3 repeats it, 4 makes it the user's. Nulls count as one space."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    out = rows.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), fault.alias("fault")).where("fault != 0")
    return out.select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def _digest() -> Column:
    """128 bits of the SHA-256 of (role, text); the role's length keeps the two apart."""
    both = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return F.substring(F.unhex(F.sha2(both.cast("binary"), 256)), 1, 16)


def _turns(rows: DataFrame) -> DataFrame:
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), space("role"), space("text"))
    return rows.withColumn("digest", _digest())


def plan(rows: DataFrame, ids: DataFrame | None = None, block: int = 256) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of each conversation of the
    rows, and of those of `ids` (conv_id) that have none."""
    turns = _turns(rows)
    facts = turns.select("conv_id", "turn", "digest", F.substring("role", 1, 1).alias("initial"),
                         (~F.col("text").rlike(SOLID)).alias("blank"), (~F.col("text").rlike(ENDED)).alias("cut"))
    first = (facts.where("not blank").groupBy("conv_id", "digest")
             .agg(F.count("*").alias("n"), F.min(F.struct(F.col("turn").isNotNull().alias("some"), "turn")).alias("first"))
             .where("n > 1").select(F.col("conv_id").alias("c"), F.col("digest").alias("d"), F.col("first.turn").alias("first"), F.lit(True).alias("again")))
    facts = facts.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")), "left").select(
        "conv_id", "turn", "digest", "initial", "blank", "cut",
        (F.coalesce(F.col("again"), F.lit(False)) & ~F.col("turn").eqNullSafe(F.col("first"))).alias("later"))
    if ids is not None:
        marks = ids.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
        facts = facts.unionByName(marks, allowMissingColumns=True)
    order = ["conv_id", "turn", "digest"]
    blocks = (facts.repartitionByRange(*order).sortWithinPartitions(*order)
              .transform(in_arrow, _summaries(block), "conv_id long, place long, n long, blank long, duplicate long, truncated long, illegal long, "
                          "first string, last string, low long, high long, distinct long, parts array<struct<s:int,t:int,cost:long,audit:string>>"))
    return (blocks.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("place"))
            .transform(in_arrow, _composed, "conv_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string"))


@lru_cache(None)
def _edges(kind: str) -> list[list[tuple[int, int, int, int]]]:
    """For each state: the best (next state, cost, initials as digits, number of them) to each next
    state over a turn. kind: '-' must go, else its initial, in upper case if truncated."""
    out = []
    for s in range(4):
        best: dict[int, tuple[int, str]] = {}
        for inserts in range(3):
            at = s
            for _ in range(inserts):
                at = STEP[at, FITS[at]]
            ways = [(at, 3, "D")]
            if kind != "-":
                extra = int(kind.isupper())
                ways.append((STEP[at, FITS[at]], 2 + extra, "R"))
                if (at, kind.lower()) in STEP:
                    ways.append((STEP[at, kind.lower()], extra, "K"))
            for to, cost, letter in ways:
                way = (2 * inserts + cost, "I" * inserts + letter)
                best[to] = min(best.get(to, way), way)
        out.append([(to, cost, int(a.translate(_TO_DIGIT), 8), len(a)) for to, (cost, a) in best.items()])
    return out


@lru_cache(2048)
def _least(kinds: str) -> list[dict]:
    """The least integer from each state to each state over a block of turns, as (s, t, cost, audit)."""
    width = 3 * len(kinds)
    low = _BITS * width
    mask = (1 << low) - 1
    parts = []
    for t in range(4):
        now: list[int | None] = [0 if s == t else None for s in range(4)]
        for kind in reversed(kinds):
            edges = _edges(kind)
            now = [min((((now[to] >> low) + cost << low) | letters << low - _BITS * n | (now[to] & mask) >> _BITS * n
                        for to, cost, letters, n in edges[s] if now[to] is not None), default=None) for s in range(4)]
        parts += [{"s": s, "t": t, "cost": v >> low, "audit": _letters(v & mask, width)} for s, v in enumerate(now) if v is not None]
    return parts


def _letters(digits: int, width: int) -> str:
    return f"{digits:o}".zfill(width).rstrip("0").translate(_TO_LETTER) if digits else ""


class _Block:
    """Up to `size` consecutive turns of one conversation."""

    def __init__(self, conv):
        self.conv, self.kinds, self.first, self.last, self.low, self.high = conv, [], None, None, None, None
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0

    def add(self, turn, initial: str, blank: bool, cut: bool, again: bool) -> None:
        if self.kinds:
            self.illegal += self.last + initial not in LEGAL
        else:
            self.first = initial
        self.last = initial
        self.blank += blank
        self.duplicate += again and not blank
        self.truncated += cut and not again and not blank
        known = initial if initial in ("s", "u", "a") else "o"
        self.kinds.append("-" if blank or again else known.upper() if cut else known)
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.distinct += 1

    def row(self, place: int) -> dict:
        return {"conv_id": self.conv, "place": place, "n": len(self.kinds), "blank": self.blank, "duplicate": self.duplicate,
                "truncated": self.truncated, "illegal": self.illegal, "first": self.first, "last": self.last, "low": self.low,
                "high": self.high, "distinct": self.distinct, "parts": _least("".join(self.kinds))}


_PART = pa.list_(pa.struct([("s", pa.int32()), ("t", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
_SUMMARY = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), *((c, pa.int64()) for c in ("n", "blank", "duplicate", "truncated", "illegal")),
                      ("first", pa.string()), ("last", pa.string()), ("low", pa.int64()), ("high", pa.int64()), ("distinct", pa.int64()), ("parts", _PART)])
_PLAN = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("audit", pa.string())])
_NONE = object()


def _batched(rows: Iterator[dict], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            yield from batch.slice(at, 1024).to_pylist()


def _summaries(size: int) -> Callable:
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        place, held, before = TaskContext.get().partitionId() << 40, None, _NONE
        for r in _records(batches):
            if held is None or r["conv_id"] != held.conv or len(held.kinds) == size:
                if held is not None:
                    yield held.row(place)
                    place += 1
                held = _Block(r["conv_id"])
            if r["digest"] is None:  # stands for its conversation only
                continue
            # rows that are alike in all of these are never in two partitions
            now = (r["conv_id"], r["turn"], r["digest"])
            held.add(r["turn"], r["initial"], r["blank"], r["cut"], r["later"] or now == before)
            before = now
        if held is not None:
            yield held.row(place)

    return lambda batches: _batched(blocks(batches), _SUMMARY)


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A conversation's blocks come from the last to the first; the least integers grow by a block each."""
    def done(conv, now: dict, least: list[int], width: int) -> dict:
        v = least[0]
        low = _BITS * width
        return {"conv_id": conv, "gaps": 0 if now["low"] is None else now["high"] - now["low"] + 1 - now["distinct"],
                **{c: now[c] for c in ("blank", "duplicate", "truncated", "illegal")},
                "cost": v >> low, "audit": _letters(v & (1 << low) - 1, width)}

    def plans() -> Iterator[dict]:
        conv, now, least, width = _NONE, {}, [], 0
        for r in _records(batches):
            if r["conv_id"] != conv:
                if conv is not _NONE:
                    yield done(conv, now, least, width)
                conv, width = r["conv_id"], 2
                now = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "distinct"), 0) | {"low": None, "high": None, "first": None}
                least = [cost << _BITS * width | int((a.translate(_TO_DIGIT) or "0").ljust(width, "0"), 8) for cost, a in ENDS.values()]
            low, more = _BITS * width, 3 * r["n"]
            mask = (1 << low) - 1
            best: list[int | None] = [None] * 4
            for p in r["parts"]:
                tail, n = least[p["t"]], len(p["audit"])
                v = (p["cost"] + (tail >> low) << low + _BITS * more
                     | int(p["audit"].translate(_TO_DIGIT) or "0", 8) << low + _BITS * (more - n) | (tail & mask) << _BITS * (more - n))
                best[p["s"]] = v if best[p["s"]] is None else min(v, best[p["s"]])
            least, width = best, width + more
            if r["n"] and now["first"] is not None:
                now["illegal"] += r["last"] + now["first"] not in LEGAL
            now["first"] = r["first"] if r["n"] else now["first"]
            for c in ("blank", "duplicate", "truncated", "illegal"):
                now[c] += r[c]
            if r["low"] is not None:
                now["distinct"] += r["distinct"] - (r["high"] == now["low"])
                now["high"] = r["high"] if now["high"] is None else now["high"]
                now["low"] = r["low"]
        if conv is not _NONE:
            yield done(conv, now, least, width)

    return _batched(plans(), _PLAN, 256)


def _in_order(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """Each conversation's plan, then its turns in order, in one partition."""
    turns = _turns(rows).withColumn("is_turn", F.lit(True))
    both = turns.unionByName(plans.withColumn("is_turn", F.lit(False)), allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "is_turn", "turn", "digest")


def _edited(records: Iterator[dict]) -> Iterator[tuple[dict, str, str, str]]:
    """(plan, edit, role, text) of each turn that stays or is put in; (plan, '', '', '') opens a conversation."""
    now, at, state = None, 0, 0

    def inserts(stop: int) -> Iterator[tuple[dict, str, str, str]]:
        nonlocal state
        for _ in range(stop):
            fit = FITS[state]
            state = STEP[state, fit]
            yield now, "I", NAMES[fit], ""

    for r in records:
        if not r["is_turn"]:
            if now is not None:
                yield from inserts(len(now["audit"]) - at)
            now, at, state = r, 0, 0
            yield now, "", "", ""
            continue
        to = at
        while now["audit"][to] == "I":
            to += 1
        yield from inserts(to - at)
        edit, at = now["audit"][to], to + 1
        if edit == "K":
            state = STEP[state, r["role"][0]]
            yield now, edit, r["role"], r["text"]
        elif edit == "R":
            fit = FITS[state]
            state = STEP[state, fit]
            yield now, edit, NAMES[fit], r["text"]
    if now is not None:
        yield from inserts(len(now["audit"]) - at)


def repaired(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """(conv_id, position, edit, role, text): the turns of the repaired conversations."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def turns() -> Iterator[dict]:
            position = 0
            for now, edit, role, text in _edited(_records(batches)):
                position = position + 1 if edit else 0
                if edit:
                    yield {"conv_id": now["conv_id"], "position": position - 1, "edit": edit, "role": role, "text": text}

        schema = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), *((c, pa.string()) for c in ("edit", "role", "text"))])
        return _batched(turns(), schema, 512)

    return _in_order(rows, plans).transform(in_arrow, run, "conv_id long, position long, edit string, role string, text string")


def repair(rows: DataFrame, ids: DataFrame | None = None, block: int = 256) -> DataFrame:
    """The plan of each conversation with repaired_sha256, the hash of its repaired turns (`role:text`,
    joined by newlines)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def hashed() -> Iterator[dict]:
            held, hasher, some = None, None, False
            for now, edit, role, text in _edited(_records(batches)):
                if not edit:
                    if held is not None:
                        yield {c: held[c] for c in _PLAN.names} | {"repaired_sha256": hasher.hexdigest()}
                    held, hasher, some = now, hashlib.sha256(), False
                    continue
                hasher.update(f"{chr(10) if some else ''}{role}:{text}".encode())
                some = True
            if held is not None:
                yield {c: held[c] for c in _PLAN.names} | {"repaired_sha256": hasher.hexdigest()}

        return _batched(hashed(), _PLAN.append(pa.field("repaired_sha256", pa.string())), 256)

    schema = "conv_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string"
    return _in_order(rows, plan(rows, ids, block)).transform(in_arrow, run, schema)
