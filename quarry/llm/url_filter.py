"""URL filters: host-suffix and path-prefix rules, found by an equi-join on short hash prefixes.

A rule is a host and a path; it fits a URL if the URL's host is the rule's host or a subdomain of
it and the URL's path starts with the rule's path. Each URL is expanded into expressions: every
host suffix (on label borders) with every path prefix that ends in "/", and with the empty path.
A rule is filed under its host and its path up to the last "/". URL expressions and rules meet on
the first 32 bits of the expression's SHA-256; the full digest and the rest of the rule's path are
confirmed after the join. The longest rule wins; of equally long ones block before allow, then the
smaller rule string.

Scale: expanding is a generator inside one stage, and goes no deeper than the longest rule (two numbers
that the driver gets), so a URL with thousands of segments costs no more than another. Only the expressions go to the join, never the
URL's other columns, and rules are unique per expression but for path ends, so a popular host makes
a skewed stream side only, which AQE splits. The rules are broadcast by Spark only while their
measured size is below the session's broadcast threshold.

Defined cases: a null URL or one without "://" has an empty host and path and fits no rule; repeated
URLs are judged one by one; repeated rules count once; null rule hosts are ignored and a null rule
path is the empty path; with no rules every verdict is the default; other columns are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PREFIX = 8  # hex digits of the digest that the join uses: 32 bits


def split_url(url):
    """(host, path) columns of a URL column."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return _folded(host), path


def _folded(host):
    """A-Z to a-z, and nothing else."""
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _stem(path):
    """A path up to its last "/"."""
    return F.regexp_extract(path, r"(?s)^(.*/)?", 1)


def rule_table(rules: DataFrame) -> DataFrame:
    """Distinct rules with their digest: host, path, verdict, rule, digest, prefix."""
    r = rules.select(_folded(F.col("host")).alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"), "verdict")
    r = r.where("rule_host is not null and verdict in ('allow', 'block')").distinct()
    r = r.withColumn("rule", F.concat("rule_host", "rule_path"))
    r = r.withColumn("digest", F.sha2(F.concat("rule_host", F.lit("\n"), _stem(F.col("rule_path"))), 256))
    return r.withColumn("short", F.substring("digest", 1, PREFIX))


def judge(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """(key, host, path, rule, verdict) of each row; rule is null and the verdict `default` where none fits.

    `key` should be unique: rows with the same key and URL get the same verdict.
    """
    host, path = split_url(F.col(url))
    u = pages.select(F.col(key).alias("k"), host.alias("host"), path.alias("path"))
    # one row per distinct address to judge: repeated addresses are expanded and joined once
    address = u.select("host", "path").where("host != ''").distinct()
    r = rule_table(rules)
    # no deeper than the rules go: a suffix has at most as many labels, a prefix as many parts, as any rule
    deep = r.agg(F.max(F.size(F.split("rule_host", r"\."))).alias("labels"), F.max(F.size(F.split(_stem(F.col("rule_path")), "/"))).alias("parts")).first()
    most = F.lit(deep["labels"] or 1)
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.greatest(F.lit(1), F.size(labels) - most + 1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    parts = F.split(_stem(F.col("path")), "/", (deep["parts"] or 1) + 1)  # "/a/b/" has parts "", a, b, "": the prefixes "", "/", "/a/", "/a/b/"
    prefixes = F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(deep["parts"] or 1))),
                           lambda i: F.when(i == 1, F.lit("")).otherwise(
                               F.concat(F.array_join(F.slice(parts, F.lit(1), i - 1), "/"), F.lit("/"))))
    expression = (address.withColumn("suffix", F.explode(suffixes)).withColumn("prefix", F.explode(prefixes))
                  .withColumn("digest", F.sha2(F.concat("suffix", F.lit("\n"), "prefix"), 256))
                  .select("host", "path", "digest", F.substring("digest", 1, PREFIX).alias("short")))
    r = r.alias("r")
    fits = (expression.alias("e").join(r, F.col("e.short") == F.col("r.short"))
            .where((F.col("e.digest") == F.col("r.digest")) & F.expr("startswith(e.path, r.rule_path)"))
            .select("e.host", "e.path", F.struct(  # the least is the longest rule, then block, then the smaller string
                (-F.length("rule")).alias("len"), (F.col("verdict") == "allow").alias("allow"), "rule", "verdict").alias("best")))
    found = fits.groupBy("host", "path").agg(F.min("best").alias("won"))
    return (u.join(found, ["host", "path"], "left")
            .select(F.col("k").alias(key), "host", "path", F.col("won.rule").alias("rule"),
                    F.coalesce("won.verdict", F.lit(default)).alias("verdict")))
