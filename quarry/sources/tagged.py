"""Tagged-record collections (SMART layout: ``.I n`` opens a record, lines
``.T .W .A .N .B .K .X`` open sections).

The text source splits the file on the record separator itself
(``lineSep``), so every record is one row, records spanning input splits
are handled by the line reader, and the file is read in parallel.  Section
fields come from regular expressions on the record text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import record_text
from quarry.plans.ordering import dense_index

RECORD_SEP = "\n.I "


def _records(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("lineSep", RECORD_SEP).option("wholetext", False).text(path)
    # the first record still carries its ".I " prefix
    rec = F.regexp_replace(F.col("value"), r"^\.I ", "")
    return raw.select(
        F.regexp_extract(rec, r"^\s*([0-9]+)", 1).cast("long").alias("rid"),
        F.regexp_replace(rec, r"^\s*[0-9]+[^\n]*\n?", "").alias("body"),
        # place of the record: its file, the split of the file, and its turn within the task
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("turn"),
    ).where(F.col("rid").isNotNull())


def section(body: Column, marker: str) -> Column:
    """Text of a section: the lines after a ``marker`` line up to the next
    marker line (NULL when the record has no such section)."""
    m = marker.lstrip(".")
    pat = rf"(?s)(?:^|\n)\.{m}[ \t]*\n(.*?)(?=\n\.[A-Z][ \t]*(?:\n|$)|$)"
    found = F.regexp_extract(body, pat, 1)
    has = F.regexp_like(body, F.lit(rf"(?:^|\n)\.{m}[ \t]*(?:\n|$)"))
    return F.when(has, found)


def query_fields(recs: DataFrame) -> DataFrame:
    """(query_id, text, authors, note) of records (rid, body)."""
    body = F.col("body")
    return recs.select(F.col("rid").alias("query_id"), section(body, ".W").alias("text"),
                       section(body, ".A").alias("authors"), section(body, ".N").alias("note"))


def doc_fields(recs: DataFrame, keep_markers: bool = False) -> DataFrame:
    """(doc_id, title, text) of the records (rid, body) that have a title."""
    body = F.col("body")
    from_t = F.regexp_extract(body, r"(?s)((?:^|\n)\.T[ \t]*\n.*)", 1)
    upto_x = F.regexp_replace(from_t, r"(?s)\n\.X[ \t]*(\n.*)?$", "\n")
    title = F.regexp_extract(body, r"(?:^|\n)\.T[ \t]*\n([^\n]*)", 1)
    text = record_text(F.regexp_replace(upto_x, r"^\n", ""), keep_markers)
    return recs.where(F.regexp_like(body, F.lit(r"(?:^|\n)\.T[ \t]*\n"))).select(
        F.col("rid").alias("doc_id"), title.alias("title"), text.alias("text"))


def read_tagged_queries(spark: SparkSession, path: str, odd_only: bool = False) -> DataFrame:
    """(query_id, text, authors, note).

    Default: every record, its own ``.I`` id, text = the ``.W`` section.
    ``odd_only=True`` reproduces the reference's reader: every second record
    (1st, 3rd, ...) and only when a later record follows it, renumbered
    1, 2, ...; the text is the whole record body, markers and note included.
    Records are counted in file order (several files: in order of their paths), whatever their ids.
    """
    recs = _records(spark, path)
    if not odd_only:
        return query_fields(recs)
    numbered = dense_index(recs, ["file", "split", "turn"], "ordinal")
    last = recs.select(F.count(F.lit(1))).scalar() - 1
    kept = numbered.where((F.col("ordinal") % 2 == 0) & (F.col("ordinal") < last))
    return kept.select(
        (F.col("ordinal") / 2 + 1).cast("long").alias("query_id"), F.col("body").alias("text"),
        section(F.col("body"), ".A").alias("authors"), section(F.col("body"), ".N").alias("note"))


def read_tagged_docs(spark: SparkSession, path: str, keep_markers: bool = False) -> DataFrame:
    """S3 + T7: (doc_id, title, text) — title is the line after ``.T``; text
    runs from ``.T`` up to ``.X`` (or the record end); marker lines are
    dropped unless ``keep_markers``; ids are the 1-based record ids."""
    return doc_fields(_records(spark, path), keep_markers)
