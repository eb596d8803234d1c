"""Persist and load the index tables (S5, S6): snapshots of parquet tables with a manifest.

A version of the index is a folder ``<path>/v<number>-<unique>`` with the tables

* ``blocks``: blocked postings (``operators.blocks``), hashed by block of documents into shards, one
  file each, sorted by word.  It is declared as a table bucketed by block, so a search sums the
  scores of a document inside the task that reads it; row-group statistics skip other words;
* ``term_stats``, range-partitioned and sorted by word; ``doc_norms``; ``docs`` (ids and attributes).

``<path>/manifest/<number>.json`` names the folder, with row counts, sizes and what reading needs.
It is written last, to another name, and renamed: that one step is the switch.  Readers take the
largest number.  A write that fails leaves a folder that no manifest names; saving never changes files
that an open index reads, so an index may be saved onto the path it was loaded from.  Two writers of
one number: the rename of the second fails.  Loading lists no partitions.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.blocks import BLOCKS_DDL, posting_rows
from quarry.operators.index import Index

SHARD_BYTES = 1 << 30
#: a small index has as many shards as the cluster has cores, but none below this size
LEAST_SHARD_BYTES = 2 << 20
STATS_DDL = "term STRING, df BIGINT, cf BIGINT, idf DOUBLE"
NORMS_DDL = "doc_id BIGINT, norm DOUBLE"


class _Files:
    """The few file operations of a manifest, by the file system of the path."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.root = self.path(path)
        self.fs = self.root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, text: str):
        return self.jvm.org.apache.hadoop.fs.Path(text)

    def names(self, folder: str) -> list[str]:
        at = self.path(folder)
        return [x.getPath().getName() for x in self.fs.listStatus(at)] if self.fs.exists(at) else []

    def size(self, folder: str) -> tuple[int, int]:
        """Bytes and number of the parquet files of a table."""
        files = [x for x in self.fs.listStatus(self.path(folder)) if x.getPath().getName().endswith(".parquet")]
        return sum(x.getLen() for x in files), len(files)

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def commit(self, name: str, text: str) -> None:
        """The file appears whole, or not at all; it is an error if it is there."""
        part = self.path(f"{name}.{uuid.uuid4().hex}.tmp")
        stream = self.fs.create(part, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self.fs.exists(self.path(name)) or not self.fs.rename(part, self.path(name)):
            self.fs.delete(part, False)
            raise FileExistsError(f"{name} was written by another job")

    def delete(self, folder: str) -> None:
        self.fs.delete(self.path(folder), True)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions that were written whole, ascending."""
    names = _Files(spark, path).names(f"{path}/manifest")
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def read_manifest(spark: SparkSession, path: str, version: int | None = None) -> dict:
    known = versions(spark, path)
    if not known or (version is not None and version not in known):
        raise FileNotFoundError(f"no index version {'' if version is None else version} at {path}")
    return json.loads(_Files(spark, path).read(f"{path}/manifest/{known[-1] if version is None else version}.json"))


def save_index(index: Index, path: str, shards: int | None = None) -> dict:
    """Write a new version of docs (ids and attributes), blocks, term_stats and doc_norms; returns its
    manifest. ``shards`` defaults to the size of the postings over SHARD_BYTES, and for a small index
    to the number of cores."""
    spark = index.docs.sparkSession
    files = _Files(spark, path)
    number = max(versions(spark, path), default=0) + 1
    folder = f"{path}/v{number}-{uuid.uuid4().hex[:12]}"
    stats = index.term_stats.select("term", "df", "cf", "idf")
    (stats.repartitionByRange("term").sortWithinPartitions("term").write.parquet(f"{folder}/term_stats"))
    written = spark.read.schema(STATS_DDL).parquet(f"{folder}/term_stats")
    terms, postings = written.agg(F.count("*"), F.coalesce(F.sum("df"), F.lit(0))).first()
    if shards is None:
        size = postings * 24  # about the bytes of an entry
        shards = max(1, size // SHARD_BYTES, min(spark.sparkContext.defaultParallelism, size // LEAST_SHARD_BYTES))
    name = _table(folder)
    # one shard per task (the same hash as the bucketing), so each task writes one file
    (index.blocks.repartition(shards, "blk").write.bucketBy(shards, "blk").sortBy("term")
        .option("path", f"{folder}/blocks").saveAsTable(name))
    index.doc_norms.write.parquet(f"{folder}/doc_norms")
    # ids and attributes only: the text is not copied into the index
    docs = index.docs.drop(index.text_col)
    docs.write.parquet(f"{folder}/docs")
    tables = {}
    for t in ("blocks", "term_stats", "doc_norms", "docs"):
        n_bytes, n_files = files.size(f"{folder}/{t}")
        tables[t] = {"bytes": n_bytes, "files": n_files}
    n_docs = spark.read.schema(NORMS_DDL).parquet(f"{folder}/doc_norms").count()
    manifest = {"version": number, "folder": folder.rsplit("/", 1)[1], "shards": shards, "bits": index.bits, "docs": n_docs,
                "terms": terms, "postings": postings, "tables": tables, "docs_schema": json.loads(docs.schema.json())}
    files.commit(f"{path}/manifest/{number}.json", json.dumps(manifest, indent=1))
    return manifest


def drop_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete all but the last ``keep`` versions: their manifests first, then every folder without one."""
    files = _Files(spark, path)
    known = versions(spark, path)
    for number in known[:-keep] if keep else known:
        files.delete(f"{path}/manifest/{number}.json")
    named = {read_manifest(spark, path, n)["folder"] for n in versions(spark, path)}
    for folder in files.names(path):
        if folder.startswith("v") and folder not in named:
            files.delete(f"{path}/{folder}")


def _table(folder: str) -> str:
    return "quarry_blocks_" + hashlib.sha1(folder.encode()).hexdigest()[:16]


def load_index(spark: SparkSession, path: str, version: int | None = None) -> Index:
    """The last version (or a given one) of a stored index."""
    from pyspark.sql.types import StructType
    meta = read_manifest(spark, path, version)
    folder = f"{path}/{meta['folder']}"
    name = _table(folder)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({BLOCKS_DDL}) USING parquet "
              f"CLUSTERED BY (blk) SORTED BY (term) INTO {meta['shards']} BUCKETS LOCATION '{folder}/blocks'")
    blocks: DataFrame = spark.table(name)
    rows = posting_rows(blocks, meta["bits"])
    table = lambda t, schema: spark.read.schema(schema).parquet(f"{folder}/{t}")
    return Index(table("docs", StructType.fromJson(meta["docs_schema"])), rows.select("term", "doc_id", "tf"), table("term_stats", STATS_DDL),
                 rows, table("doc_norms", NORMS_DDL), blocks, meta["bits"], stored=True)
