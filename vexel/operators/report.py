"""Ingest and search reports, and rendered hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ingest_report(chunks: DataFrame, dim: int, *by: str) -> DataFrame:
    """Chunk count and shortest / longest vector, in total or per document.

    A model gives every chunk a vector of its own ``dim`` or fails, so the chunks tell
    it all: no model runs for the report.
    """
    length = F.lit(dim)
    n = F.count(F.lit(1))
    return chunks.groupBy(*by).agg(
        n.alias("n_chunks"),
        F.min(length).alias("min_len"),
        F.max(length).alias("max_len"),
    )


def chunk_lines(dim: int, pos: str = "pos") -> Column:
    """Report line of a chunk row, numbered from 1."""
    return F.format_string(
        "Chunk %d embedding length: %d", F.col(pos) + 1, F.lit(dim)
    )


def summary_lines(
    n_chunks: int,
    embed_seconds: float,
    store_seconds: float,
    source: str | None = None,
) -> list[str]:
    """Report lines of a finished ingest: time in the model over all tasks, and the
    time the job took that embeds and stores."""
    lines = [] if source is None else [f"Source file: {source}"]
    return lines + [
        f"Embedded {n_chunks} chunks in {embed_seconds:.3f}s",
        f"Stored {n_chunks} chunks in {store_seconds:.3f}s",
    ]


#: Signs that a quoted text writes with a letter.
_ESCAPES = {
    "\\": "\\\\", '"': '\\"', "\x07": "\\a", "\b": "\\b", "\f": "\\f", "\n": "\\n",
    "\r": "\\r", "\t": "\\t", "\v": "\\v",
}


def _quoted(text: Column) -> Column:
    """Double-quoted; backslash, quote and control characters are escaped."""
    for raw, escaped in _ESCAPES.items():
        text = F.replace(text, F.lit(raw), F.lit(escaped))
    for code in [*range(0x20), 0x7F]:
        if chr(code) not in _ESCAPES:
            text = F.replace(text, F.lit(chr(code)), F.lit(f"\\x{code:02x}"))
    return F.concat(F.lit('"'), text, F.lit('"'))


def search_report(hits: DataFrame, queries: DataFrame) -> DataFrame:
    """Real hits per query, and the line that says so.

    ``queries`` is (query_id, query).  Padding rows have no position and are not
    counted; a query without hits reports 0.
    """
    counts = hits.groupBy("query_id").agg(F.count("pos").alias("n_hits"))
    n = F.coalesce("n_hits", F.lit(0)).cast("bigint")
    line = F.format_string("Retrieved %d results for query %s", n, _quoted(F.col("query")))
    return queries.join(counts, "query_id", "left").select(
        "query_id", n.alias("n_hits"), line.alias("line")
    )


def render_hits(hits: DataFrame) -> DataFrame:
    """Add ``line``: rank and score to four digits."""
    line = F.format_string("%d) cos=%.4f", F.col("rank"), F.col("score"))
    return hits.withColumn("line", line)
