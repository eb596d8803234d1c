"""Conversation repair and the prefix trie against brute force."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

SCHEMA = "conv_id long, turn long, role string, text string, audit string, digest int, place string"
SF = "/root/testdata/sf0.01"
MAX = 2**63


def conversations(n=60, seed=3):
    """Conversations with null, blank, repeated and truncated turns, other roles, ties and repeated rows."""
    rnd = random.Random(seed)
    texts = ["Hello there.", "Yes!", "no end", "", None, " \n", "What? ", "Same.", "tail.\x85", "é ü."]
    rows = []
    for c in range(n):
        conv = None if c == 7 else c
        for t in range(rnd.choice([0, 1, 2, 3, 5, 9, 14])):
            turn = None if rnd.random() < 0.05 else t * rnd.choice([1, 1, 2])
            row = (conv, turn, rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""]), rnd.choice(texts), "x", 1, "y")
            rows += [row] * (2 if rnd.random() < 0.1 else 1)
    rows += [(100, None, None, None, "x", 1, "y"), (101, 5, "system", "only.", "x", 1, "y")]
    rows += [(c, 0, "user", "dropped.", "x", 1, "y") for c in range(200, 260) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    return rows


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def token(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def ordered(rows):
    """By turn, nulls first; ties by the digest that the operators use."""
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, token(r[1], r[2])))


def damaged(rows):
    out = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        out[conv] += [] if fault == 0 else [(turn, "user" if fault == 4 else role,
                                             "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text)] * (2 if fault == 3 else 1)
    return {c: ordered(r) for c, r in out.items()}


def cheapest(turns):
    """Dijkstra over (turn, initials matched so far) with (cost, audit) as the key; inserts anywhere, more than needed."""
    allowed = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    seen, heap = set(), [(0, "", 0, "", ())]
    while heap:
        cost, audit, i, state, out = heapq.heappop(heap)
        if i == len(turns) and state in ("", "a"):
            return cost, audit, out
        if (i, state) in seen:
            continue
        seen.add((i, state))
        go = []
        for name in ("user", "assistant"):
            if name[0] in allowed[state]:
                go.append((2, "I", i, name[0], (*out, (name, ""))))
        if i < len(turns):
            fault, role, text = turns[i]
            extra = int(fault == "truncated")
            go.append((3, "D", i + 1, state, out))
            if fault not in ("blank", "duplicate"):
                if role[:1] in allowed[state] and role:
                    go.append((extra, "K", i + 1, role[0], (*out, (role, text))))
                for name in ("user", "assistant"):
                    if name[0] in allowed[state]:
                        go.append((2 + extra, "R", i + 1, name[0], (*out, (name, text))))
        for c, letter, j, s, o in go:
            heapq.heappush(heap, (cost + c, audit + letter, j, s, o))
    raise AssertionError


def exhaustive(turns):
    """Least (cost, audit) over all edit sequences with up to three inserts in a row; for short conversations."""
    best = (10**9, "")
    fine = re.compile("(s?(ua)+)?")

    def go(i, run, cost, audit, initials):
        nonlocal best
        if (cost, audit) > best and cost >= best[0]:
            return
        if i == len(turns) and fine.fullmatch(initials):
            best = min(best, (cost, audit))
        if run < 3:
            for x in "ua":
                go(i, run + 1, cost + 2, audit + "I", initials + x)
        if i < len(turns):
            fault, role, _ = turns[i]
            extra = int(fault == "truncated")
            go(i + 1, 0, cost + 3, audit + "D", initials)
            if fault not in ("blank", "duplicate"):
                go(i + 1, 0, cost + extra, audit + "K", initials + (role[:1] or "?"))
                for x in "ua":
                    go(i + 1, 0, cost + 2 + extra, audit + "R", initials + x)

    go(0, 0, 0, "", "")
    return best


def faults(turns):
    seen, out = set(), []
    for _, role, text in turns:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append(("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "", role, text))
        seen.add((role, text))
    return out


def repaired(turns):
    marked = faults(turns)
    known = [t for t, _, _ in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
    cost, audit, out = cheapest(marked)
    if len(turns) <= 3:
        assert exhaustive(marked) == (cost, audit)
    count = lambda f: sum(m[0] == f for m in marked)
    return (gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, sha("\n".join(f"{r}:{t}" for r, t in out)))


def got_repairs(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


@pytest.mark.parametrize("block", [2, 256])
def test_repair(spark, block):
    from quarry.llm.repair import damage, repair
    rows = conversations()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = {c: repaired(damaged(rows).get(c, [])) for c in {r[0] for r in rows}}
    assert got_repairs(repair(damage(df), df, block)) == want
    assert any(v[-2] == "" for v in want.values()) and any("R" in v[-2] for v in want.values())
    assert repair(df.limit(0), df.limit(0)).collect() == []


def test_repair_long_conversation_over_partitions(spark):
    """One conversation with most of the rows: its blocks come from several tasks."""
    from quarry.llm.repair import repair
    rnd = random.Random(5)
    rows = [(1, t, rnd.choice(["user", "assistant", "system"]), rnd.choice([f"text {t}.", f"text {t}", "Same."]), "", 1, "") for t in range(600)]
    rows += [(c, 0, "user", "Hi.", "", 1, "") for c in range(2, 40)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r[1:4])
    assert got_repairs(repair(df, block=32)) == {c: repaired(ordered(t)) for c, t in by.items()}


def test_repaired_turns(spark):
    from quarry.llm.repair import plan
    from quarry.llm.repair import repaired as turns_of
    rows = conversations(30, seed=9)
    df = spark.createDataFrame(rows, SCHEMA)
    out = defaultdict(list)
    for r in turns_of(df, plan(df)).orderBy("position").collect():
        out[r.conv_id].append(r)
    for conv, turns in out.items():
        initials = "".join(r.role[0] for r in turns)
        assert re.fullmatch("s?(ua)+", initials), (conv, initials)
        assert [r.position for r in turns] == list(range(len(turns)))


def test_repair_query(spark):
    from quarry.llm.queries import QUERIES
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    by = damaged(rows)
    assert got_repairs(QUERIES["op11_conversation_repair"](spark, SF)) == {c: repaired(by.get(c, [])) for c in {r[0] for r in rows}}


def trie(rows):
    """{prefix: its row}, from every conversation's every prefix."""
    by = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            by[conv].append((turn, role or "", text or ""))
    by = {c: [(r, t) for _, r, t in ordered(v)] for c, v in by.items()}
    full = {}
    for c, own in by.items():
        h = zlib.crc32(str(c).encode()) % 9
        full[c] = (*by.get(c - c % 5, [])[:h], *own[h:])
    members = defaultdict(list)
    for c, s in sorted(full.items()):
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    children = defaultdict(set)
    for k in members:
        if k:
            children[k[:-1]].add(k)
    leaves, saved = defaultdict(int), defaultdict(int)
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
    return [(m[0], len(k), members[k[:-1]][0] if k else None, len(m), len(children[k]), leaves[k], saved[k],
             sha(",".join(str(c) for c in m if len(full[c]) == len(k)))) for k, m in members.items()]


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=str)


@pytest.mark.parametrize(("block", "share"), [(1, 1000), (7, 2), (100_000, 1000)])
def test_trie(spark, block, share):
    from quarry.llm.prefix_trie import prefix_trie
    rnd = random.Random(11)
    rows = [r for r in conversations(40, seed=13) if (r[0] or 0) < 100]
    shared = [("user", "Hi."), ("assistant", "Hello."), ("user", "Ünd?")]
    rows += [(c, t, *shared[t], "x", 1, "y") for c in range(40, 90) for t in range(rnd.randrange(1, 4))]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert in_order(prefix_trie(df, block, share).collect()) == in_order(trie(rows))
    assert prefix_trie(df.limit(0)).collect() == []


def test_trie_of_turnless_conversations(spark):
    """All conversations are empty or alike: one node, or one path."""
    from quarry.llm.prefix_trie import prefix_trie
    rows = [(c, 0, None, None, "x", 1, "y") for c in range(1, 200, 5)]  # no base, so those with h > 0 are empty
    assert in_order(prefix_trie(spark.createDataFrame(rows, SCHEMA)).collect()) == in_order(trie(rows))


def test_trie_query_and_sql(spark):
    import os
    import sys
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from oracle_compare import duck, rows_of

    from quarry.llm.oracle import ORACLE
    from quarry.llm.queries import QUERIES
    got = QUERIES["op12_prefix_trie"](spark, SF)
    want = duck(SF).execute(ORACLE["op12_prefix_trie"])
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of([c[0] for c in want.description], want.fetchall())
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert in_order(got.collect()) == in_order(trie(rows))
