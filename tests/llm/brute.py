"""Brute-force versions that the operators' results are held against, and awkward documents."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h string, node long, starts string, k int, row string"


def awkward_docs():
    """Null, empty, short, long, repeated and near-equal texts; null keys and hosts; clashing column names."""
    rnd = random.Random(7)
    vocab = [f"w{i}" for i in range(300)] + ["Été", "straße", "don't", "3.14", "a\x1cb", "x y"]
    words = lambda n: [rnd.choice(vocab) for _ in range(n)]
    base, passage = words(120), words(40)
    near = [*base[:60], "changed", *base[61:]]
    texts = [None, "", " \t\n", "one", "two words", "Two WORDS", " ".join(base), " ".join(base), " ".join(base).upper(), " ".join(near),
             " ".join(words(60) + passage + words(60)), "\n".join([*words(50), *passage]), " ".join(passage), "same line\n" * 40,
             " ".join(words(5000)), "z" * 5000, " ".join(["again"] * 70), "a  b\n\nc 　 d", "#$% " * 60, "12 " * 30]
    texts += [" ".join(words(rnd.randrange(1, 90))) for _ in range(20)]
    rows = [(i * 3, t, "en", None if i % 5 == 0 else f"host{i % 3}", None, "h", 1, "s", 2, "r") for i, t in enumerate(texts)]
    rows.append((None, " ".join(base), "en", "host1", 4, "h", 1, "s", 2, "r"))
    return rows


def words_of(text, lower=False):
    data = (text or "").encode()
    return (data.lower() if lower else data).split()


def components(rows, n, percent):
    """{key: (set size, smallest key)}; a null key counts as the largest one."""
    key = lambda k: 2**63 - 1 if k is None else k
    sets = {}
    for r in rows:
        w = words_of(r[1], lower=True)
        sets[key(r[0])] = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    parent = {k: k for k in sets}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    back = lambda k: None if k == 2**63 - 1 else k
    return {back(k): (len(sets[k]), back(find(k))) for k in keys}


def without_repeats(rows, window):
    """{key: (words, removed, kept words)}."""
    key = lambda k: 2**63 - 1 if k is None else k
    low = {}
    for r in rows:
        w = words_of(r[1])
        for i in range(len(w) - window + 1):
            s = tuple(w[i:i + window])
            low[s] = min(low.get(s, key(r[0])), key(r[0]))
    out = {}
    for r in rows:
        w = words_of(r[1])
        gone = set()
        for i in range(len(w) - window + 1):
            if low[tuple(w[i:i + window])] < key(r[0]):
                gone.update(range(i, i + window))
        out[r[0]] = (len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode())
    return out


def katz(rows, train, discounts):
    """{key: (tokens, known, base score, score)}, and the model's sums over the vocabulary by context."""
    texts = {r[0]: [*words_of(r[1], lower=True), 0] for r in rows}
    count, pair = Counter(), defaultdict(Counter)
    for k, t in texts.items():
        if train(k):
            count.update(t)
            h = 1
            for w in t:
                pair[h][w] += 1
                h = w
    n, v = sum(count.values()), len(count)
    tallies = lambda values: (lambda c: discounts([float(c[r]) for r in range(1, 8)]))(Counter(values))
    du, db = tallies(count.values()), tallies(c for x in pair.values() for c in x.values())
    star = lambda c, d: c * (d[0][c - 1] if c <= 5 else d[1])
    rest = 1 - sum(star(c, du) for c in count.values()) / n
    p = lambda w: star(count[w], du) / n if w in count else rest
    alpha = {h: (1 - sum(star(c, db) for c in x.values()) / sum(x.values())) / (1 - sum(p(w) for w in x)) for h, x in pair.items()}
    prob = lambda h, w: star(pair[h][w], db) / sum(pair[h].values()) if h in pair and w in pair[h] else alpha.get(h, 1) * p(w)
    out = {}
    for k, t in texts.items():
        base = sum(math.log10((count.get(w, 0) + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        out[k] = (len(t), sum(w in count for w in t), base, sum(math.log10(prob(h, w)) for h, w in zip([1, *t], t, strict=False)))
    totals = [sum(prob(h, w) for w in count) + prob(h, None) for h in list(pair)[:5]]
    return out, n, totals


def good_turing(counts, k=5):
    """Katz's discount factor for a count, from the counts of counts; where they are degenerate, absolute
    discounting by one half, and beyond k the ratio of the next two, held between 0.9 and 0.999."""
    n = Counter(counts)

    def factor(r):
        if r > k:
            return min(0.999, max(0.9, (k + 2) * n[k + 2] / ((k + 1) * n[k + 1]))) if n[k + 1] else 0.999
        whole = (k + 1) * n[k + 1] / n[1] if n[1] else 1.0
        d = ((r + 1) * n[r + 1] / (r * n[r]) - whole) / (1 - whole) if n[r] and whole < 1 else 0.0
        return d if 0 < d < 1 else (r - 0.5) / r

    return factor


def katz_rows(rows, train):
    """[(tokens, known, base score, score)] of (key, text) rows, each by itself, N, and sums of P by context."""
    texts = [[*words_of(t, lower=True), 0] for _, t in rows]
    count, pair = Counter(), defaultdict(Counter)
    for (k, _), t in zip(rows, texts, strict=True):
        if train(k):
            count.update(t)
            for h, w in zip([1, *t], t, strict=False):
                pair[h][w] += 1
    n, v = sum(count.values()), len(count)
    du, db = good_turing(count.values()), good_turing(c for x in pair.values() for c in x.values())
    left = 1 - sum(c * du(c) for c in count.values()) / n
    p = lambda w: count[w] * du(count[w]) / n if count[w] else left
    alpha = {h: (1 - sum(c * db(c) for c in x.values()) / sum(x.values())) / (1 - sum(map(p, x))) for h, x in pair.items()}
    prob = lambda h, w: pair[h][w] * db(pair[h][w]) / sum(pair[h].values()) if h in pair and pair[h][w] else alpha.get(h, 1.0) * p(w)
    out = [(len(t), sum(count[w] > 0 for w in t), sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t),
            sum(math.log10(prob(h, w)) for h, w in zip([1, *t], t, strict=False))) for t in texts]
    return out, n, [sum(prob(h, w) for w in count) + prob(h, None) for h in list(pair)]


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def fold(key):
    return zlib.crc32(str(key).encode()) % 5
