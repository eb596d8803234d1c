"""Registered queries of the training-data operators: thin wrappers that derive the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

#: The rules of op1 (fixed values): host, path, verdict.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op1_url_filter")
def op1_url_filter(spark, d):
    from quarry.llm.url_filter import judge
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge(table(spark, d, "pages"), rules)


@register("op2_ngram_join")
def op2_ngram_join(spark, d):
    from quarry.llm.ngram_join import join
    return join(table(spark, d, "documents"), n=4, percent=85)


def fold(column: str = "doc_id"):
    """crc32 of the id as text, modulo 5."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % 5


@register("op3_katz_lm")
def op3_katz_lm(spark, d):
    from quarry.llm.katz import score
    return score(table(spark, d, "documents"), fold() != 1)


@register("op4_substring_dedup")
def op4_substring_dedup(spark, d):
    from quarry.llm.substring import dedup
    return dedup(table(spark, d, "documents"), window=13).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@register("op5_packing")
def op5_packing(spark, d):
    from quarry.llm.packing import pack, pieces
    return pack(pieces(table(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json")))


@register("op6_byte_bpe")
def op6_byte_bpe(spark, d):
    from quarry.llm.bpe import decode, encode
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    both = decode(encode(table(spark, d, "documents"), path, public_tokenizers.PATTERN), path)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op7_html_text")
def op7_html_text(spark, d):
    from quarry.llm.html_text import main_text
    return main_text(table(spark, d, "pages"))


@register("op8_toxicity")
def op8_toxicity(spark, d):
    from quarry.llm.toxicity import fit, score
    docs = table(spark, d, "documents")
    model = fit(docs, table(spark, d, "labels"), fold() != 0)
    scored = score(docs, model)
    return scored.select("doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@register("op9_quality")
def op9_quality(spark, d):
    from quarry.llm.quality import judge
    return judge(table(spark, d, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@register("op10_hamming_topk")
def op10_hamming_topk(spark, d):
    from quarry.llm.hamming import top_k
    rows = table(spark, d, "embeddings")
    return top_k(rows, rows.where("vec_id % 50 = 0"), k=10, dims=64)


@register("op11_conversation_repair")
def op11_conversation_repair(spark, d):
    from quarry.llm.repair import damage, repair
    rows = table(spark, d, "conversations")
    return repair(damage(rows), rows)


@register("op12_prefix_trie")
def op12_prefix_trie(spark, d):
    from quarry.llm.prefix_trie import prefix_trie
    return prefix_trie(table(spark, d, "conversations"))


@register("op13_quality_model")
def op13_quality_model(spark, d):
    from quarry.llm.quality_model import fit, score
    docs = table(spark, d, "documents")
    scored = score(docs, fit(docs, table(spark, d, "labels"), fold() != 0))
    return scored.select("doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
