"""Lookups on the catalogue and the index (L1-L4): filters that reach the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def docs_by_category(docs: DataFrame, category: str, col: str = "categories") -> DataFrame:
    """L1: documents whose category string contains ``category`` (substring test)."""
    return docs.where(F.col(col).contains(category))


def url_by_name(docs: DataFrame, name: str, name_col: str = "name", url_col: str = "url") -> DataFrame:
    """L2: url(s) of the documents named exactly ``name``."""
    return docs.where(F.col(name_col) == name).select(url_col)


def doc_by_name(docs: DataFrame, name: str, name_col: str = "name") -> DataFrame:
    """L3: documents named exactly ``name``."""
    return docs.where(F.col(name_col) == name)


def term_lookup(postings: DataFrame, stats: DataFrame, term: str) -> DataFrame:
    """L4: statistics and postings of one word, (term, df, cf, doc_id, tf).

    Both sides are filtered on ``term`` before the join, so with stored
    postings sorted by term the scan skips row groups of other terms."""
    p = postings.where(F.col("term") == term)
    s = stats.where(F.col("term") == term).select("term", "df", "cf")
    return p.join(s, "term").select("term", "df", "cf", "doc_id", "tf")
