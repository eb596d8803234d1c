"""The training-data operators against brute force, on small tables with awkward rows."""

import base64
import math
import os
import re
import sys

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

ROWS = brute.awkward_docs()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, brute.SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], brute.SCHEMA)


def by_key(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def test_ngram_join(docs, none):
    from quarry.llm.ngram_join import join
    for n, percent in ((4, 85), (5, 80)):
        got = {k: (r.n_shingles, r.component_id) for k, r in by_key(join(docs, n, percent, small=4, cell=4)).items()}
        assert got == brute.components(ROWS, n, percent)
    assert join(none).collect() == []


def test_ngram_join_large_block(spark):
    """A group of near copies larger than a block: some pairs only link through others."""
    from quarry.llm.ngram_join import join
    rows = []
    for i in range(60):
        words = [f"c{j}" for j in range(40)] + [f"u{i}_{j}" for j in range(i % 7)]
        rows.append((i, " ".join(words), "en", "s", 0, "h", 1, "s", 2, "r"))
    got = {k: (r.n_shingles, r.component_id) for k, r in by_key(join(spark.createDataFrame(rows, brute.SCHEMA), small=8, cell=16)).items()}
    assert got == brute.components(rows, 4, 85)


def test_substring_dedup(docs, none):
    from quarry.llm.substring import dedup
    got = {k: (r.n_words, r.n_removed, r.kept) for k, r in by_key(dedup(docs, keep=("lang", "h"))).items()}
    assert got == brute.without_repeats(ROWS, 13)
    same = by_key(dedup(docs, as_is=True))
    text = {r[0]: r[1] for r in ROWS}
    assert all(r.kept == text[k] for k, r in same.items() if not r.n_removed)
    assert dedup(none).collect() == []


def shared_ids():
    """Rows without an id and rows of one id, with copies, near copies and unlike texts among them."""
    text = lambda c, n=40: " ".join(f"{c}{i}" for i in range(n))
    copy, passage, twice = text("c"), text("p", 15), text("n")
    rows = [(5, copy), (None, copy), (None, text("u")), (None, "x y " + passage), (None, twice), (None, twice), (2, passage),
            (7, copy), (7, text("v")), (7, text("w") + " " + passage), (7, text("v")), (9, copy + " more"), (None, None), (None, None), (8, "")]
    return [(k, t, "en", "s", 0, "h", 1, "s", 2, "r") for k, t in rows]


def test_substring_dedup_shared_ids(spark):
    """Rows of one id, or without one, are cut by their own text only."""
    from quarry.llm.substring import dedup
    rows = shared_ids()
    want = [(r[0], *brute.without_repeats([*[x for x in rows if x[0] != r[0]], r], 13)[r[0]]) for r in rows]
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in dedup(spark.createDataFrame(rows, brute.SCHEMA).repartition(3)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_near_duplicates_shared_ids(spark):
    """One row of each group stays, whatever ids its rows have; a node's text is its own row's."""
    import corpus_pipeline

    from quarry.llm.ngram_join import join
    rows = shared_ids()
    docs = spark.createDataFrame(rows, brute.SCHEMA).repartition(3)
    numbered = [(i, *r[1:]) for i, r in enumerate(sorted(rows, key=lambda r: 2**63 if r[0] is None else r[0]))]
    alone = brute.components(numbered, 5, 80)
    want = [numbered[i][1] for i, (_, c) in alone.items() if c == i]
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns and sorted(map(str, want)) == sorted(str(r.text) for r in kept.collect())
    assert all(r.doc_id == 5 for r in kept.collect() if r.text == rows[0][1])
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in join(docs, 5, 80).collect()}
    assert {(5, 36, 5), (None, 36, 5), (7, 36, 5), (None, 36, None), (7, 36, 7), (9, 37, 5)} <= got


def test_katz(docs, none):
    from quarry.llm.katz import discounts, score
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    keyed = docs.where("doc_id is not null")
    rows = [r for r in ROWS if r[0] is not None]
    want, total, sums = brute.katz(rows, lambda k: brute.fold(k) != 1, discounts)
    assert np.allclose(sums, 1)
    for size in (4_000_000, 2_000):  # one bucket; several, with words spread over them
        got = by_key(score(keyed, fold != 1, bucket_tokens=size))
        assert set(got) == set(want)
        for k, (n, known, base, s) in want.items():
            r = got[k]
            assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (n, known, total, brute.fold(k) == 1)
            assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isclose(r.score, s, rel_tol=1e-9)
    assert score(none, F.lit(True)).collect() == []
    nothing = by_key(score(docs.limit(3), F.lit(False)))
    assert all(r.train_tokens == 0 and r.score == 0 for r in nothing.values())


def test_packing(docs, none):
    from tokenizers import Tokenizer

    from quarry.llm.packing import pack, pieces
    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    rows = pack(pieces(docs, path, length=256, with_ids=True), length=256).collect()
    text = {r[0]: r[1] for r in ROWS}
    for key in text:
        own = sorted((r for r in rows if r.doc_id == key), key=lambda r: r.piece)
        assert [i for r in own for i in r.ids] == [*whole.encode(text[key] or "", add_special_tokens=False).ids, 0]
        assert [r.start for r in own] == [256 * i for i in range(len(own))] and all(len(r.ids) == r.length for r in own)
    by = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == by.get(r.sequence_id, 0)
        by[r.sequence_id] = r.offset + r.length
    assert max(by.values()) <= 256 and len(by) <= math.ceil(sum(by.values()) / 256) + 1
    assert pack(pieces(none, path)).collect() == []


def test_local_search_empties_bins():
    """Best fit alone leaves [6,3], [5], ... ; exchanges raise the squared fill and never break a bin."""
    from quarry.llm.packing import Bins
    rng = np.random.default_rng(1)
    for _ in range(30):
        sizes = rng.integers(1, 60, size=80)
        first = Bins(sizes, 100)
        before, n = sum(f * f for f in first.fill), sum(map(bool, first.items))
        bins, offset = first.search().places()
        fills = np.bincount(bins, sizes)
        assert fills.max() <= 100 and sum(f * f for f in first.fill) >= before and len(fills) <= n
        for b in range(len(fills)):
            own = np.argsort(offset[bins == b])
            assert (np.concatenate([[0], np.cumsum(sizes[bins == b][own])[:-1]]) == offset[bins == b][own]).all()


def test_bpe(docs, none):
    import tiktoken

    from quarry.llm.bpe import decode, encode
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    want = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = by_key(decode(encode(docs, path, public_tokenizers.PATTERN), path))
    for r in ROWS:
        assert got[r[0]].ids == want.encode_ordinary(r[1] or "") and bytes(got[r[0]].decoded) == (r[1] or "").encode()
    assert decode(encode(none, path, public_tokenizers.PATTERN), path).collect() == []


def test_bpe_units():
    """White space of all kinds, long runs and texts of one letter, in one slice."""
    import pyarrow as pa
    import tiktoken

    from quarry.llm.bpe import Codec, read_ranks
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    codec = Codec(read_ranks(path), public_tokenizers.PATTERN)
    want = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(path), special_tokens={})
    texts = ["", "  a", "a  ", "a \n b", "\n\n", "x  y", " z 　", "ab\x1c cd", "aaaa" * 300, "abab" * 100, "don't  stop", " 12 ab12!?", "日本語 テキスト", "é" * 99, " ", "a\tb\r\nc"]
    flat, first = codec.encode(pa.array(texts))
    assert [flat[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)] == [want.encode_ordinary(t) for t in texts]


def test_url_filter(spark):
    from quarry.llm.queries import URL_RULES
    from quarry.llm.url_filter import judge
    urls = [None, "", "no scheme", "http://example.com/en/1", "https://www.Example.COM/en/?q", "http://a.www.example.com/en/x#t", "ftp://x.net/es/",
            "http://x.net/es", "http://net/fr/a/b", "http://example.com", "http://example.com?x=/en/", "http://notexample.com/en/", "://com/", "http:///en/",
            "http://example.com/en/1", "http://com.org/", "http://b.org/en/fo", "http://b.org/en/foo/x"]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    rules = [*URL_RULES, ("b.org", "/en/foo", "block"), ("b.org", "/en/foo", "allow"), ("B.org", None, "allow"), (None, "/", "block")]
    got = by_key(judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string")), "page_id")

    def want(url):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        fits = [(-len(h + (p or "")), v != "block", h.lower() + (p or ""), v) for h, p, v in rules if h and host
                and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p or "")]
        best = min(fits, default=None)
        return host, path, best and best[2], best[3] if best else "allow"

    assert {k: (r.host, r.path, r.rule, r.verdict) for k, r in got.items()} == {i: want(u) for i, u in enumerate(urls)}
    nothing = judge(pages, spark.createDataFrame([], "host string, path string, verdict string"))
    assert {r.verdict for r in nothing.collect()} == {"allow"}


def test_html(spark):
    from quarry.llm.html_text import extract, main_text
    page = ("<html><head><title>T</title><script>var t='</p>';</script></head><body><header>Site</header><nav><a href=x>Home</a></nav>"
            "<div class='cookie-notice'>We use cookies</div><article><h1>Head &amp; line</h1><p>First  <b>bold</b>\n text.<p>Second &eacute;"
            "<script>x()</script></p><div class=\"ad\">Buy</div><p>Third, which is rather longer than the other two.</p><form><input>Send</form>"
            "<section id=comments><p>Nice post!</p></section></article><aside>Other</aside><footer>&copy; me</footer></body></html>")
    want = "Head & line\nFirst bold text.\nSecond é\nThird, which is rather longer than the other two."
    plain = ("<body><div class=menu><a>a</a><a>b</a></div><div><p>" + "long text " * 30 + "</p><p>short</p><p>" + "more text " * 30 + "</p></div></body>")
    cut = "<article><p>Some words &am"
    rows = [(1, "u", page), (2, "u", None), (3, None, ""), (4, "u", plain), (5, "u", cut), (6, "u", "just text"), (6, "u", "just text"), (7, "u", "<p>a<")]
    got = main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    text = {r.page_id: r.text for r in got}
    assert len(got) == len(rows) and text[1] == want and text[2] == "" and text[3] == ""
    assert text[4].split("\n") == [("long text " * 30).strip(), "short", ("more text " * 30).strip()]
    assert text[5] == "Some words &am" and text[6] == "just text" and extract("<p>" * 2000 + "x") == "x"
    assert all(r.n_chars == len(r.text) for r in got)


def test_html_whole_region():
    """One very long paragraph, short closing lines and linked paragraphs cost no other text; lists of links go."""
    from quarry.llm.html_text import extract
    lines = [f"Paragraph {i} " + "has some words " * 9 for i in range(40)]
    lines[20] = "very long text " * 350
    lines = [x.strip() for x in [*lines, "Read the whole source of it here", "The end."]]
    blocks = [f"<p>{x}</p>" for x in lines]
    blocks[-2] = f"<p><a href=s>{lines[-2]}</a></p>"
    menu = "<ul>" + "<li><a href=x>Some other page</a></li>" * 8 + "</ul>"
    for inside in ("".join(blocks), "".join(f"<div>{x}</div>" for x in blocks)):
        assert extract(f"<body><div>{menu}</div><div>{inside}</div></body>").split("\n") == lines
    listed = "".join(blocks) + f"<p>{lines[0]}</p>" + menu + f"<p>{lines[0]}</p>"
    got = extract(f"<main><h1>Head</h1><article>{listed}</article></main>").split("\n")
    assert got[0] == "Head" and [x for x in got[1:] if x != "Some other page"] == [*lines, lines[0], lines[0]]
    assert got.count("Some other page") <= 4  # those next to text may be a part of it


def test_html_marked_wrappers():
    """A class word like "sidebar" on a wrapper, headline or section costs no text; marked blocks still go."""
    from quarry.llm.html_text import extract
    paragraphs = [f"Paragraph {i} " + "has some words " * 9 + "here." for i in range(6)]
    text = "".join(f"<p>{x}</p>" for x in paragraphs)
    inside = ('<div class="entry-header"><h1>Head</h1></div>' + text + '<section class="social-policy"><h2>Social policy</h2>' + text + "</section>")
    want = ["Head", *paragraphs, "Social policy", *paragraphs]
    rest = ('<div class="ad">Buy this</div><p class="share-links"><a href=x>Share</a></p>'
            '<section id="comments"><article class="comment"><p>Nice post, and a rather long opinion of its reader.</p></article></section>')
    for name in ("no-sidebar", "has-sidebar", "page-with-menu", "with-banner", "sidebar", "plain"):
        assert extract(f'<body><div class="{name}"><article>{inside}{rest}</article></div></body>').split("\n") == want
        assert extract(f'<body><div class="{name}"><div class="ad">Buy this</div><div>{text}</div></div></body>').split("\n") == paragraphs
        assert extract(f'<body><span class="{name}">{text}</span></body>').split("\n") == paragraphs
    assert extract(f"<body><form><main>{text}</main><p>Send it</p></form></body>").split("\n") == paragraphs
    assert extract(f'<article>{text}<p>Some <span class="ad">buy </span>words</p></article>').split("\n") == [*paragraphs, "Some words"]
    nested = '<div class="ad">' * 3000 + "x" + "</div>" * 3000
    assert extract(f"<article>{text}{nested}</article>").split("\n") == paragraphs


def test_segments():
    """All maximal-scoring segments, against the definition by recursion."""
    from quarry.llm.toxicity import maximal_segments

    def want(score, low, high):
        best = max(((sum(score[a:b + 1]), -(b - a), -a) for a in range(low, high) for b in range(a, high)), default=None)
        if best is None or best[0] <= 0:
            return []
        a = -best[2]
        b = a - best[1]
        return [*want(score, low, a), (a, b), *want(score, b + 1, high)]

    rng = np.random.default_rng(3)
    for _ in range(60):
        score = np.where(rng.random(25) < 0.4, rng.integers(1, 900, 25) / 7, -3.0)
        place = np.flatnonzero(score > 0)
        got = [(a, b) for a, b, _ in maximal_segments(place.tolist(), score[place].tolist(), 3.0)]
        assert got == want(score.tolist(), 0, 25)


def test_toxicity(spark, none):
    from quarry.llm.toxicity import clean, fit, score
    rng = np.random.default_rng(5)
    vocab = [f"w{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(400):
        words = rng.choice(vocab, 80).tolist()
        toxic = i % 5 == 0
        if toxic:
            at = int(rng.integers(0, 70))
            words[at:at + 4] = rng.choice(["vile", "awful", "nasty", "vileness"], 4).tolist()
        rows.append((i, " ".join(words), "en", "s", 0, "h", 1, "s", 2, "r"))
        labels.append((i, 1, int(toxic)))
    rows += [(1000, None, "en", "s", 0, "h", 1, "s", 2, "r"), (1001, "", "en", "s", 0, "h", 1, "s", 2, "r")]
    labels += [(1000, 1, None), (5000, 1, 1)]
    docs = spark.createDataFrame(rows, brute.SCHEMA)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    train = F.col("doc_id") % 4 != 0
    model = fit(docs, marks, train)
    got = by_key(score(docs, model))
    held = [i for i in range(400) if i % 4 == 0]
    assert sum((got[i].score >= 0.5) == (i % 5 == 0) for i in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values()) and got[1000].score == got[1001].score < 0.5
    hit = got[20].passages
    words = rows[20][1].split()
    assert hit and all(w in words[hit[0]["first"]:hit[0]["last"] + 1] for w in words if w in ("vile", "awful", "nasty", "vileness"))
    kept = clean(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {k for k, r in got.items() if r.score < 0.5}
    assert score(none, model).collect() == []
    single = fit(docs, marks.where("toxic = 0"), F.lit(True))
    assert {r.score for r in score(docs, single).collect()} == {0.0}


def test_toxicity_rarer_words(spark):
    """Toxic texts of many rarer terms, each in about 7 training documents, are found; clean ones are left."""
    from quarry.llm.toxicity import fit, score
    rng = np.random.default_rng(8)
    vocab, bad = [f"w{i}" for i in range(400)], [f"{a}{b}ish" for a in "bdfgklm" for b in "aeiou"][:30]
    rows, labels = [], []
    for i in range(700):
        words = rng.choice(vocab, 80).tolist()
        toxic = i % 10 == 0
        if toxic:
            words[20:24] = rng.choice(bad, 4, replace=False).tolist()
        rows.append((i, " ".join(words), "en", "s", 0, "h", 1, "s", 2, "r"))
        labels.append((i, 1, int(toxic)))
    docs, marks = spark.createDataFrame(rows, brute.SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = by_key(score(docs, fit(docs, marks, F.col("doc_id") % 4 != 0)))
    held = range(0, 700, 4)
    assert sum(got[i].score < 0.5 for i in held if i % 10 == 0) <= 3  # of 35
    assert sum(got[i].score >= 0.5 for i in held if i % 10) <= 3  # of 140


def test_toxicity_common_words(spark):
    """Words that are merely somewhat more frequent in (longer) toxic texts score nothing, and a few clean texts of very
    much evidence do not flatten the curve for toxic texts of two toxic words."""
    from quarry.llm.toxicity import Model, _curve, _models
    count = spark.createDataFrame([(1, 700, 0), (2, 1420, 9600), (3, 5, 2500)], "word long, t long, c long")
    for model in _models(count, {0: 14_750, 1: 1730}, 500.0, ((1.0, 4.0, 0.0), (0.1, 2.0, 1.0)), 100, 0.05):
        assert 1 in model.word and 2 not in model.word and 3 in model.word
        assert model.score[model.word == 1] > 3 and model.score[model.word == 3] < -0.5
    y = np.repeat([1.0, 0.0], [100, 900])
    x = np.concatenate([np.linspace(8, 60, 100), np.zeros(896), np.linspace(100, 4000, 4)])
    _curve(model := Model(np.empty(0, np.uint64), np.empty(0), 0.05), x, y)
    assert model.probability(np.array([12.0]))[0] > 0.5 > 0.05 > model.probability(np.array([0.0]))[0]


def test_quality(docs, none):
    from quarry.llm.quality import clean, judge
    got = by_key(judge(docs))

    def want(text):
        t = text or ""
        w = words = re.findall(r"[^\x20\x09-\x0D]+", t)
        seen = {}
        for i in range(len(w) - 2):
            seen.setdefault(tuple(w[i:i + 3]), []).append(i)
        covered = {j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + 3)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)

    for r in ROWS:
        g = got[r[0]]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == want(r[1])
        assert g.base_failed == (g.n_words < 50 or 100 * g.n_repeat_words > 50 * g.n_words)
        assert not (g.kept and g.base_failed) and (g.kept or g.base_failed or g.n_soft > 0)
    kept = clean(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(str(k) for k, g in got.items() if g.kept)
    assert judge(none).collect() == [] and clean(none).collect() == []


def test_quality_host_verdict(spark):
    """A host where most documents fail is strict: one that fails a soft rule only goes, clean ones stay."""
    from quarry.llm.quality import judge
    good = " ".join(f"word{i}" for i in range(60))
    noisy = " ".join(f"word{i}##" for i in range(60))
    rows = [(i, "short", "bad") for i in range(50)] + [(100, noisy, "bad"), (101, good, "bad"), (102, noisy, "good")]
    rows += [(200 + i, good + f" {i}", "good") for i in range(50)]
    got = by_key(judge(spark.createDataFrame(rows, "doc_id long, text string, source string")))
    assert not got[100].kept and got[101].kept and got[102].kept and got[100].host_rate > 0.5 > got[102].host_rate


def test_hamming(spark):
    from quarry.llm.hamming import top_k
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 70))
    x[50:90] = x[10]  # many rows of one code
    rows = [(int(i), v.tolist(), "e") for i, v in enumerate(x)] + [(900, None, "e"), (901, [1.0], "e")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, code string")
    asked = [0, 10, 55, 200, 901]
    got = top_k(table, table.where(F.col("vec_id").isin(asked)), k=7, dims=70, segments=6, block_rows=64, chunk=2).collect()
    code = x > 0
    for q in asked[:-1]:
        d = (code != code[q]).sum(axis=1)
        order = np.lexsort((np.arange(300), d))[:7]
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [(r.neighbour_id, r.distance) for r in own] == [(int(i), int(d[i])) for i in order]
    assert {r.query_id for r in got} == set(asked[:-1])
    assert top_k(table.limit(0), table.limit(0), dims=70).collect() == []
    assert len(top_k(table.where("vec_id < 3"), table.where("vec_id = 1"), k=7, dims=70).collect()) == 3


def test_html_large_notices_comments_and_forms():
    """On a page without article or main, what is longer than the article does not come in for its size."""
    from quarry.llm.html_text import extract
    paragraph = "Some ordinary sentence of the article that goes on for a while, as they do. " * 3
    article = "<h1>Head</h1>" + f"<p>{paragraph}</p>" * 4
    want = "\n".join(["Head", *[paragraph.strip()] * 4])
    long = f"<p>{'A remark that is longer than all of the article and that nobody asked for. ' * 6}</p>" * 6
    for block in ('<div id="comments">{}</div>', '<div class="cookie-notice">{}</div>', "<form>{}</form>", '<div class="sidebar">{}</div>',
                  '<div class="newsletter signup">{}</div>', '<div class="site-comments">{}</div>', '<div class="big-cookie-box">{}</div>'):
        for page in (f"<div>{article}</div>{block.format(long)}", f"{block.format(long)}<div>{article}</div>"):
            assert extract(f"<html><body>{page}</body></html>") == want, block
    # a form around the whole page, headline included, is a wrapper
    assert extract(f'<body><form id="all"><div>{article}</div></form></body>') == want


def thue_morse(n, a="a", b="b"):
    word = a
    while len(word) < n:
        word += word.translate(str.maketrans(a + b, b + a))
    return word


def test_words_that_polynomials_confuse(spark):
    """A Thue-Morse word of 1,024 letters and its complement hash alike under any polynomial modulo 2**64."""
    from quarry.llm.bpe import decode, encode
    from quarry.llm.ngram_join import join
    from quarry.llm.packing import pieces
    from quarry.llm.substring import dedup
    from quarry.llm.words import hashes, spans, text_buffers
    import pyarrow as pa
    one, two = thue_morse(1024), thue_morse(1024, "b", "a")
    data, offsets = text_buffers(pa.array([f"{one} {two}"]))
    starts, ends, _ = spans(data, offsets)
    assert len(set(hashes(data, starts, ends, False).tolist())) == 2
    rest = " ".join(f"w{i}" for i in range(20))
    df = spark.createDataFrame([(1, f"{one} {rest}"), (2, f"{two} {rest}"), (3, one), (4, two)], "doc_id long, text string").coalesce(1)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    out = by_key(decode(encode(df, path, public_tokenizers.PATTERN), path))
    assert bytes(out[3].decoded).decode() == one and bytes(out[4].decoded).decode() == two
    crc = {k: r.ids_crc32 for k, r in by_key(pieces(df, public_tokenizers.path("word_bpe_49k.json"))).items()}
    assert crc[3] != crc[4]
    assert {r.component_id for r in join(df.where("doc_id > 2")).collect()} == {3, 4}
    assert by_key(dedup(df))[2].n_removed == 20


def test_cache_tells_strings_of_one_key_apart(monkeypatch):
    """Half of the hash may be equal: the other half is compared."""
    from quarry.llm import words
    from quarry.llm.words import RunCache, spans, text_buffers
    import pyarrow as pa
    real = words.wide_hashes
    monkeypatch.setattr(words, "wide_hashes", lambda d, s, e: (real(d, s, e)[0] & np.uint64(1), real(d, s, e)[1]))
    cache = RunCache(lambda strings: [list(s) for s in strings])
    for _ in range(2):
        data, offsets = text_buffers(pa.array(["ab c ab dd e ff g ab", "c"]))
        starts, ends, _ = spans(data, offsets)
        begin, size = cache(data, starts, ends)
        assert [bytes(cache.pool[a:a + n].astype(np.uint8)) for a, n in zip(begin, size, strict=True)] == b"ab c ab dd e ff g ab c".split()


def test_special_tokens_as_text(spark):
    """What looks like a special token is one, as in the tokenizer's own call."""
    from tokenizers import Tokenizer

    from quarry.llm.packing import pieces
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["see <|endoftext|> here", "a<|startoftext|>b", "<|endoftext|", "plain"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: list(r.ids) for r in pieces(df, path, with_ids=True).collect()}
    assert got == {i: [*Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}


def test_equal_rows_are_spread_over_shards(spark):
    from quarry.llm.packing import pack, pieces
    df = spark.createDataFrame([(None, "")] * 3000, "doc_id long, text string").repartition(4)
    out = pack(pieces(df, public_tokenizers.path("word_bpe_49k.json")), shard_size=300)
    sizes = [r["count"] for r in out.groupBy(F.shiftright("sequence_id", 32).alias("shard")).count().collect()]
    assert len(sizes) == 10 and max(sizes) < 450


def test_url_filter_deep_paths(spark):
    """Long paths and hosts are expanded no deeper than the rules go, with the same verdicts."""
    from quarry.llm.url_filter import judge
    rules = spark.createDataFrame([("example.com", "/a/b/c", "block"), ("É.net", "/", "block"), ("com", "/", "allow")], "host string, path string, verdict string")
    urls = ["http://example.com/a/b/cd/" + "x/" * 3000, "http://" + "s." * 500 + "example.com/a/b/c", "http://example.com/a/b", "http://É.net/q", "http://é.net/q"]
    got = by_key(judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules), "page_id")
    assert [got[i].rule for i in range(5)] == ["example.com/a/b/c", "example.com/a/b/c", "com/", "É.net/", None]
    none = spark.createDataFrame([], "page_id long, url string")
    assert judge(none, rules).collect() == []


@pytest.mark.parametrize(("bucket", "at_once"), [(4_000_000, 500_000), (300, 40)])
def test_katz_rows_of_one_id(spark, bucket, at_once):
    """Each row is scored by its own text, repeated and null ids included; discounts are the test's own."""
    from quarry.llm import katz
    rows = [(k, t) for k, t, *_ in brute.awkward_docs() if t is None or len(t) < 3000]
    rows += [(1, "a b c"), (1, "a b c"), (1, "c b a d"), (None, "x"), (None, "y z w q"), (None, "x"), (2, None), (2, ""), (2, None)]
    keeps = lambda k: k is not None and brute.fold(k) != 1
    want, n, totals = brute.katz_rows(rows, keeps)
    assert all(abs(t - 1) < 1e-9 for t in totals)
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    got = katz.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), fold != 1, bucket_tokens=bucket, at_once=at_once).collect()
    assert {r.train_tokens for r in got} == {n}
    asked = lambda x: (str(x[0]), x[1], x[2], x[3], round(x[4], 6), round(x[5], 6))
    assert sorted(map(asked, [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.base_score, r.score) for r in got])) == sorted(
        map(asked, [(k, not keeps(k), *w) for (k, _), w in zip(rows, want, strict=True)]))


def test_ngram_join_of_long_texts(spark, monkeypatch):
    """Sets that are verified in parts, of the same and of neighbouring levels."""
    from quarry.llm.ngram_join import PART, _level, join
    base = [f"w{i}" for i in range(5000)]
    texts = [base, base[:4600], [*base[:2500], "x", *base[2501:]], base[:4000], base[:2060], base[:2040], base[:1700], [f"v{i}" for i in range(4200)]]
    assert {_level(len(t) - 3) for t in texts} == {0, 1, 2} and _level(PART) == 0 and _level(PART + 1) == 1
    rows = [(i, " ".join(t), "en", "s", 0, "h", 1, "s", 2, "r") for i, t in enumerate(texts)]
    for percent in (85, 80):
        got = {k: (r.n_shingles, r.component_id) for k, r in by_key(join(spark.createDataFrame(rows, brute.SCHEMA), percent=percent)).items()}
        assert got == brute.components(rows, 4, percent)
