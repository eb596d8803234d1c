"""Catalogue and description CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CATALOG_COLUMNS = ["url", "name", "categories", "developer", "publisher"]
DESCRIPTION_COLUMNS = ["url", "desc", "full_desc"]
# The words that the usual data-frame CSV reader takes for a missing value.
NULL_WORDS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
              "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def read_csv(spark: SparkSession, path: str, columns: list[str], order_col: str = "row_seq") -> DataFrame:
    """The named columns of a quoted, multi-line CSV with a header, as strings.

    Columns are found by their names in the header, wherever they stand and whatever other columns
    the file has; a missing name is an error. Nothing is inferred. The null words are nulls (quoted or
    not). ``row_seq`` follows the row order inside a file (keep-last needs an order); with several
    files give the order in the data instead, as the files of one read have no defined order.
    """
    df = (spark.read.option("header", True).option("multiLine", True).option("inferSchema", False)
          .option("enforceSchema", False).option("escape", '"').option("mode", "PERMISSIVE").csv(path))
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)} in its header ({', '.join(df.columns)})")
    found = [F.when(~F.col(f"`{c}`").isin(NULL_WORDS), F.col(f"`{c}`")).alias(c) for c in columns]
    return df.select(*found, F.monotonically_increasing_id().alias(order_col))


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Url, name, categories, developer, publisher, row_seq."""
    return read_csv(spark, path, CATALOG_COLUMNS)


def read_descriptions(spark: SparkSession, path: str) -> DataFrame:
    """Url, desc, full_desc, row_seq."""
    return read_csv(spark, path, DESCRIPTION_COLUMNS)
