"""The quality classifier: statistics against a plain version, densities against the formula, held-out accuracy."""

import math
import os
import re
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

SF = "/root/testdata/sf0.01"


def plain(text):
    """The statistics of one text, byte by byte."""
    data = (text or "").encode()
    words = data.split()
    if not words:
        return [0.0] * 18
    kinds = {"lower": rb"[a-z]", "upper": rb"[A-Z]", "digit": rb"[0-9]", "stop": rb"[.,;:'\"()-]", "mark": rb"[!?]",
             "symbol": rb"[#$%&*+/<=>@\[\\\]^_`{|}~]", "high": rb"[\x80-\xff]"}
    count = {k: len(re.findall(p, data)) for k, p in kinds.items()}
    solid = len(re.sub(rb"[ \t\n\x0b\x0c\r]", b"", data))
    other = solid - sum(count.values())
    folded = [w.lower() for w in words]
    triples = list(zip(folded, folded[1:], folded[2:], strict=False))
    lines = [x for x in data.split(b"\n") if x]
    share = lambda x, of: math.asin(math.sqrt(min(1, x / max(1, of))))
    n = len(words)
    ends = lambda p: sum(bool(re.match(p, w[-1:])) for w in words)
    return [math.log1p(n), math.log(solid / n), math.log1p(len(lines)), share(count["upper"], count["upper"] + count["lower"]),
            share(count["digit"], solid), share(count["stop"], solid), share(count["mark"], solid), share(count["symbol"], solid),
            share(other, solid), share(count["high"], solid), math.log1p(len(set(folded))) / math.log1p(n),
            share(max(map(folded.count, set(folded))), n), share(sum(a == b for a, b in zip(folded, folded[1:], strict=False)), n),
            share(len(triples) - len(set(triples)), len(triples)), share(len(lines) - len(set(lines)), len(lines)),
            share(sum(bool(re.match(rb"[A-Z]", w)) for w in words), n), share(ends(kinds["symbol"]), n),
            share(ends(kinds["stop"]) + ends(kinds["mark"]), n)]


def test_statistics():
    from quarry.llm.quality_model import statistics
    texts = [r[1] for r in brute.awkward_docs()] + ["one\n\n\none\n", "\n\nx", "a\x01b!? A|B", "x" * 70_000 + " y"]
    for part in (texts, texts[3:9], texts[:1], []):
        got = statistics(pa.array(part, pa.string()))
        np.testing.assert_allclose(got, np.array([plain(t) for t in part]).reshape(len(part), 18), atol=1e-12)


def test_densities():
    from quarry.llm.quality_model import _bounded, _model, train
    rnd = np.random.default_rng(5)
    x = np.concatenate([rnd.normal(0, 1, (300, 4)) @ rnd.normal(0, 1, (4, 4)), rnd.normal(1, 2, (200, 4))])
    y = np.repeat([0, 1], [300, 200])
    for pool, shrink in ((0.0, 0.003), (0.3, 0.1), (1.0, 0.3)):
        m = _model(x, y, pool, shrink)
        z = (x - x.mean(0)) / x.std(0)
        cov = [np.cov(z[y == c].T, bias=True) for c in (0, 1)]
        pooled = (300 * cov[0] + 200 * cov[1]) / 500
        log = []
        for c in (0, 1):
            s = (1 - shrink) * ((1 - pool) * cov[c] + pool * pooled) + shrink * np.eye(4)
            d = z - z[y == c].mean(0)
            log.append(-0.5 * (np.einsum("ij,jk,ik->i", d, np.linalg.inv(s), d) + np.log(np.linalg.det(s))))
        np.testing.assert_allclose(m.difference(x), log[1] - log[0])
    model = train(x, y, np.arange(500) % 4)
    assert ((model.probability(x) >= 0.5) == y).mean() > 0.8
    p = model.probability(x)
    assert abs(p.mean() - 0.4) < 0.03  # calibrated
    assert _bounded(np.array([-1.0, 0.0])).tolist() == [-math.log(2), 0.0]


def test_few_labels():
    from quarry.llm.quality_model import train
    x = np.array([[0.0, 1.0], [1.0, 0.0], [5.0, 5.0]])
    assert np.allclose(train(x, np.array([1, 1, 1]), np.arange(3)).probability(x), 0.8)
    assert np.allclose(train(x[:0], np.zeros(0), np.zeros(0)).probability(x), 0.5)
    p = train(x, np.array([1, 1, 0]), np.arange(3)).probability(x)
    assert p[2] < p[0] and np.isfinite(p).all()


@pytest.fixture(scope="module")
def result(spark):
    from quarry.llm.queries import QUERIES
    return {r.doc_id: r for r in QUERIES["op13_quality_model"](spark, SF).collect()}


def test_held_out_accuracy(spark, result):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(result) == docs.count()
    for k, r in result.items():
        assert r.held_out == (zlib.crc32(str(k).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(labels[k], r.predicted) for k, r in result.items() if r.held_out and k in labels]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    bad = [p for a, p in held if not a]
    assert len(bad) > 5 and bad.count(0) >= 0.8 * len(bad)


def test_labels_of_the_held_out_rows_are_not_used(spark, result):
    from pyspark.sql import functions as F
    from quarry.llm.quality_model import fit, score
    from quarry.llm.queries import fold
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn("quality", F.when(fold() == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    got = {r.doc_id: r.score for r in score(docs, fit(docs, turned, fold() != 0)).collect()}
    assert all(abs(got[k] - r.score) < 1e-9 for k, r in result.items())


def test_awkward_rows(spark):
    from pyspark.sql import functions as F
    from quarry.llm.quality_model import fit, score
    rows = brute.awkward_docs() * 2
    docs = spark.createDataFrame(rows, brute.SCHEMA).repartition(3)
    labels = spark.createDataFrame([(r[0], i % 3 and 1, 0, "q") for i, r in enumerate(rows[:30])] + [(3, None, 0, "q"), (None, 1, 0, "q"), (6, 7, 1, "q")],
                                   "doc_id long, quality int, toxic int, text string")
    model = fit(docs, labels, F.lit(True))
    got = score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add(r.score)
    assert all(len(v) == 1 for k, v in by.items())  # repeated rows score alike
    assert score(docs.limit(0), model).collect() == []
    assert {r.score for r in score(docs, fit(docs.limit(0), labels, F.lit(True))).collect()} == {0.5}
