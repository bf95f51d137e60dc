"""Cutting texts into chunks: one document row becomes n chunk rows."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vexel.functions.text import trim_space

# A chunker maps a text column to an ARRAY<STRING> column.
Chunker = Callable[[Column], Column]

DEFAULT_DELIMITER = "."

_REGEX_SPECIALS = set(r".$|()[{^?*+\}]")


def chunk_delimiter(delimiter: str = DEFAULT_DELIMITER) -> Chunker:
    """Split on one literal byte; empty pieces and spaces are kept.

    An empty delimiter passes the text through as a single chunk.
    """
    if delimiter == "":
        return lambda text: F.array(text)
    if len(delimiter.encode("utf-8")) != 1:
        raise ValueError("delimiter must be a single character")
    # One character, or a backslash and one character: java.lang.String.split
    # takes both without compiling a regular expression per row.
    pattern = "\\" + delimiter if delimiter in _REGEX_SPECIALS else delimiter
    no_chunks = F.array().cast("array<string>")
    return lambda text: F.when(text == "", no_chunks).otherwise(
        F.split(text, pattern, -1)
    )


def chunk_fixed(size: int) -> Chunker:
    """Runs of ``size`` code points, the last may be shorter; size <= 0 passes."""
    if size <= 0:
        return lambda text: F.array(text)
    pattern = F.lit("(?s).{1,%d}" % size)
    return lambda text: F.regexp_extract_all(text, pattern, F.lit(0))


def arrow_chunker(fn: Callable[[pa.Array], pa.ListArray]) -> Chunker:
    """A custom chunker on Arrow batches: an array of texts in, their lists out.

    ``fn`` sees whole batches of strings, never null ones, and gives a list of strings
    for each text, in order, so a chunker of Arrow functions makes no Python object per
    row.
    """

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def run(texts: pa.Array) -> pa.Array:
        lists = fn(texts.fill_null(""))
        if len(lists) != len(texts):
            raise ValueError("the chunker must return one list per text")
        return lists

    return lambda text: run(text)


def filter_lists(lists: pa.ListArray, keep: pa.Array) -> pa.ListArray:
    """Each list with only the values for which ``keep``, one per value, is true."""
    kept = np.asarray(keep.fill_null(False).to_numpy(zero_copy_only=False), bool)
    first = lists.offsets.to_numpy()
    before = np.concatenate([[0], np.cumsum(kept)])
    ends = before[first - first[0]].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), lists.flatten().filter(keep))


def _checked_chunks(chunks: Column) -> Column:
    message = F.lit("chunker produced no chunks")
    return F.when(F.size(chunks) > 0, chunks).otherwise(
        F.raise_error(message).cast("array<string>")
    )


def require_chunks(
    df: DataFrame, col: str = "chunks", *, strict: bool = False
) -> DataFrame:
    """Drop rows whose chunk list is empty, or fail on the first one if strict."""
    if strict:
        return df.withColumn(col, _checked_chunks(F.col(col)))
    return df.filter(F.size(col) > 0)


def explode_chunks(
    df: DataFrame, col: str = "chunks", *, drop_empty: bool = False
) -> DataFrame:
    """One row per chunk with its 0-based position; other columns are repeated."""
    rest = [c for c in df.columns if c != col]
    rows = df.select(*rest, F.posexplode(col).alias("pos", "chunk"))
    return rows.filter(F.col("chunk") != "") if drop_empty else rows


def chunk_documents(
    docs: DataFrame,
    chunker: Chunker | None = None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    strict: bool = False,
    drop_empty: bool = False,
) -> DataFrame:
    """(id, text) to (id, pos, chunk): trim, reject empty, chunk, explode.

    Only the id and text columns are read.  Empty texts and empty chunk lists
    explode to no rows, or fail if ``strict``.  There is no filter on them, and the
    list is no column of its own: the optimiser would push such a condition to the
    scan and trim and cut every text once more there.
    """
    cut = chunker or chunk_delimiter()
    text = F.col("text")
    texts = docs.select(id_col, trim_space(text_col).alias("text"))
    chunks = F.when(text != "", cut(text))
    if strict:
        no_text = F.raise_error(F.lit("no text provided to embed"))
        chunks = chunks.otherwise(no_text.cast("array<string>"))
        # Bound as a lambda variable, to cut once.
        chunks = F.get(F.transform(F.array(chunks), _checked_chunks), F.lit(0))
    rows = texts.select(id_col, F.posexplode(chunks).alias("pos", "chunk"))
    return rows.filter(F.col("chunk") != "") if drop_empty else rows
