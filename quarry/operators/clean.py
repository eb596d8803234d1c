"""Catalogue cleaning: keep-last dedup, null drop, null-safe merge.

"Last" always means the largest value of an explicit order column (file
order in the reference), which no two rows share.  Keep-last is a hash
aggregate of that column alone, partial before the shuffle, so a key holding
a large share of the rows costs one partial row per task; the rows are
fetched by it at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.plans.ordering import dense_index


def _digests(df: DataFrame, keys: list[str]) -> list[Column]:
    """The keys with strings as 128 bits of their SHA-256, so long texts are no keys (null stays null)."""
    kinds = dict(df.dtypes)
    return [(F.substring(F.unhex(F.sha2(F.col(k).cast("binary"), 256)), 1, 16) if kinds[k] == "string" else F.col(k)).alias(f"__k{i}")
            for i, k in enumerate(keys)]


def keep_last(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per key (null keys form one group), the one with the
    largest ``order`` (a column without repeats)."""
    return keep_last_chained(df, [keys], order)


def keep_last_chained(df: DataFrame, key_sets: list[list[str]], order: str) -> DataFrame:
    """Keep-last on each key set in turn (never one combined key).

    Only the order column and key digests go through the aggregates; the
    rows that are left are fetched by their order at the end."""
    slim = df.select(F.col(order).alias("__order"), *[c.alias(f"__s{i}{j}") for i, keys in enumerate(key_sets) for j, c in enumerate(_digests(df, keys))])
    for i, keys in enumerate(key_sets):
        last = slim.groupBy(*[f"__s{i}{j}" for j in range(len(keys))]).agg(F.max("__order").alias("__order")).select("__order")
        slim = _among(slim, last, "__order") if i + 1 < len(key_sets) else last
    return _among(df.withColumn("__order", F.col(order)), slim, "__order").drop("__order")


def _among(df: DataFrame, orders: DataFrame, order: str) -> DataFrame:
    """The rows whose order is listed; a hash join, which sorts no rows."""
    return df.join(orders.hint("shuffle_hash"), order, "left_semi")


def drop_null(df: DataFrame, subset: list[str]) -> DataFrame:
    """Drop rows with a null in any of ``subset``."""
    return df.na.drop(subset=subset)


def merge_on(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner equi-merge where a null key matches a null key."""
    r = right.withColumnRenamed(key, "__rkey")
    return left.join(r, left[key].eqNullSafe(r["__rkey"]), "inner").drop("__rkey")


CATALOG_COLS = ["url", "name", "categories", "developer", "publisher"]


def clean_catalog(catalog: DataFrame, descriptions: DataFrame, order: str = "row_seq",
                  key: str = "url") -> DataFrame:
    """The whole cleaning flow.

    catalogue: keep last per url, then drop rows without a name;
    descriptions: keep last per url, then keep last per desc, then drop rows
    without full_desc; project; inner merge on url (null matches null).
    ``doc_id`` is the 0-based position in catalogue order.  Both sides are
    unique on url after their dedup, so the post-merge dedup (C6) has
    nothing left to remove.
    """
    left = drop_null(keep_last(catalog, [key], order), ["name"])
    left = left.select(*CATALOG_COLS, F.col(order).alias("__lorder"))
    right = keep_last_chained(descriptions, [[key], ["desc"]], order)
    right = drop_null(right, ["full_desc"]).select(key, "desc")
    merged = merge_on(left, right, key)
    return dense_index(merged, ["__lorder"], "doc_id").select("doc_id", *CATALOG_COLS, "desc")
