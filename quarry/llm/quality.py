"""Quality rules with host-level verdicts, in DataFrame functions only.

Each document is measured within its own row (no shuffle of texts). Rules on the measures are of two
kinds: base rules, which reject a document by themselves, and soft rules, which alone do not. Rule
failures are summed by host; a host's failure rate is shrunk towards the corpus's by a beta prior
whose two parameters are estimated from all hosts (method of moments). A host whose shrunken rate is
over `host_limit` gets the verdict "strict", and it is joined back to the documents: in a strict host a
document that fails a soft rule is rejected too. A clean document is kept whatever its host.

Scale: per-host sums are partial aggregates, so a host with a third of all rows is one row per task.
The verdicts are joined by host as a unique side that AQE may broadcast when small, and whose skewed
other side it may split.

Defined cases: a null text is empty (no words: base_failed); a null host is a host of its own (the
empty string); repeated rows are judged each; with an empty table the result is empty; columns other
than key, text and host are left out of the verdicts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.shared import write_shared

#: Symbols that count for n_symbols (fixed value).
SYMBOLS = r"[^#*$%&|<>]"
SPACE = r"[\x20\x09-\x0D]+"


def _measured(docs: DataFrame, text: str, host: str) -> DataFrame:
    """The rows with the measures in columns beside them.

    Repeated 3-word windows are found by 64-bit hash within the row: a distinct count tells whether
    there are any; only then windows are sorted with their positions, equal neighbours are marked, and
    the marked positions in order give the length of the stretches they cover.
    """
    d = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(host), F.lit("")).alias("host"),
                    F.coalesce(F.col(text), F.lit("")).alias("t"))
    d = d.withColumn("w", F.filter(F.split("t", SPACE), lambda x: x != ""))
    d = d.withColumn("lines", F.filter(F.split("t", "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]"))))
    d = d.select("row", "host", F.size("w").cast("long").alias("n_words"),
                 F.length(F.regexp_replace("t", SPACE, "")).cast("long").alias("word_chars"),
                 F.length(F.regexp_replace("t", SYMBOLS, "")).cast("long").alias("n_symbols"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                 F.when(F.size("w") > 3, F.transform(
                     F.sequence(F.lit(2), F.greatest(F.size("w") - 1, F.lit(2))),
                     lambda i: F.xxhash64(F.get("w", i - 2), F.get("w", i - 1), F.get("w", i)))).alias("h"))
    d = d.withColumn("same", F.size(F.array_distinct("h")) == F.size("h"))
    # (hash, position) in order; a window is repeated if a neighbour has its hash
    d = d.withColumn("s", F.when(~F.col("same"), F.array_sort(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    marked = F.filter(F.transform("s", lambda x, i: F.when(
        (F.get("s", i - 1)["h"] == x["h"]) | (F.get("s", i + 1)["h"] == x["h"]), x["i"])), lambda p: p.isNotNull())
    d = d.withColumn("p", F.array_sort(marked))
    covered = F.aggregate(F.transform("p", lambda x, i: F.least(F.lit(3), F.coalesce(F.get("p", i + 1) - x, F.lit(3)))),
                          F.lit(0).cast("long"), lambda a, x: a + x)
    return d.select("row", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"))


def measures(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """(key, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    m = _measured(docs.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(host).alias("h")), "t", "h")
    return m.select(F.col("row.k").alias(key), *[c for c in m.columns if c != "row"])


def rules(m: DataFrame) -> DataFrame:
    """The measures with base_failed and n_soft: soft rules failed (symbols, repeated lines and windows, word length)."""
    base = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"
    soft = ["10 * n_symbols > 3 * n_words", "100 * n_repeat_words > 30 * n_words", "n_dup_lines >= 3",
            "word_chars < 2 * n_words or word_chars > 15 * n_words"]
    return m.withColumn("base_failed", F.expr(base)).withColumn(
        "n_soft", sum((F.expr(f"cast({s} as int)") for s in soft), F.lit(0)))


def host_verdicts(m: DataFrame, host_limit: float = 0.5) -> DataFrame:
    """(host, n, failed, rate, strict) from measures with rules. The prior's mean and weight come from
    the hosts' rates by moments; with fewer than two hosts, or rates less spread than chance gives, the
    weight is 1e6 (all hosts have the corpus's rate)."""
    by = m.groupBy("host").agg(F.count("*").alias("n"), F.sum((F.col("base_failed") | (F.col("n_soft") > 0)).cast("long")).alias("failed"))
    # weighted moments: mu, the spread between hosts, and what binomial chance alone would give
    f = F.col("failed") / F.col("n")
    total = by.agg(F.sum("failed").alias("sf"), F.sum("n").alias("sn"), F.count("*").alias("h"),
                   F.sum(F.col("n") * f * f).alias("sq"), F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"))
    mu = F.col("sf") / F.col("sn")
    spread = F.col("sq") - F.col("sn") * mu * mu
    freedom = F.col("sn") - F.col("nn") / F.col("sn")
    variance = (spread - (F.col("h") - 1) * mu * (1 - mu)) / freedom
    weight = F.when((F.col("h") > 1) & (freedom > 0) & (variance > 0), F.least(F.lit(1e6), F.greatest(F.lit(0.01), mu * (1 - mu) / variance - 1))).otherwise(F.lit(1e6))
    prior = total.select(mu.alias("mu"), weight.alias("weight")).first()  # one row: two numbers
    if prior["mu"] is None:  # no rows at all
        return by.select("host", "n", "failed", F.lit(None).cast("double").alias("rate"), F.lit(False).alias("strict"))
    rate = (F.col("failed") + prior["weight"] * prior["mu"]) / (F.col("n") + prior["weight"])
    return by.select("host", "n", "failed", rate.alias("rate"), (rate > host_limit).alias("strict"))


def _rejected():
    """A base rule failed, or a soft one in a strict host."""
    return F.col("base_failed") | (F.coalesce("strict", F.lit(False)) & (F.col("n_soft") > 0))


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", host_limit: float = 0.5) -> DataFrame:
    """Measures, base_failed, n_soft, host_rate and kept of each document."""
    m = rules(write_shared(measures(docs, key, text, host), "measures"))  # texts are measured once
    hosts = host_verdicts(m, host_limit).select(F.col("host").alias("h"), F.col("rate").alias("host_rate"), "strict")
    return m.join(hosts, F.col("host") == F.col("h"), "left").withColumn("kept", ~_rejected()).drop("h", "strict")


def clean(docs: DataFrame, text: str = "text", host: str = "source", host_limit: float = 0.5) -> DataFrame:
    """The documents that are kept, with all their columns. Measures stay in the document's row; texts
    meet the hosts' verdicts only, and are measured a second time rather than shuffled for it."""
    m = rules(_measured(docs, text, host))
    hosts = write_shared(host_verdicts(m.drop("row"), host_limit), "hosts").select(F.col("host").alias("h"), "strict")
    # one condition over both sides: a part of it that went below the join would repeat the measures' expressions there
    bad = F.when(F.coalesce("strict", F.lit(False)), F.col("base_failed") | (F.col("n_soft") > 0)).otherwise(F.col("base_failed"))
    return m.join(hosts, F.col("host") == F.col("h"), "left").where(bad == F.lit(False)).select("row.*")
