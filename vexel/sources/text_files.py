"""Whole files and text tables as documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_text_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per file: (path, text, ...partition columns).

    Paths may be folders or globs.  Invalid UTF-8 becomes U+FFFD; everything
    else, line ends included, is kept.  A missing path is an error.  Spark skips
    files of length 0, which hold no text to embed.
    """
    wanted = [paths] if isinstance(paths, str) else list(paths)
    cleaned = [p.strip() for p in wanted]
    if not cleaned or not all(cleaned):
        raise ValueError("file path cannot be empty")
    files = spark.read.text(cleaned, wholetext=True)
    rest = [c for c in files.columns if c != "value"]
    return files.select(
        F.col("_metadata.file_path").alias("path"),
        F.make_valid_utf8("value").alias("text"),
        *rest,
    )


def from_text_table(df: DataFrame, text_col: str, *id_cols: str) -> DataFrame:
    """Any table with a text column, reduced to its ids and ``text``."""
    return df.select(*id_cols, F.col(text_col).cast("string").alias("text"))
