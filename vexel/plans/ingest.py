"""Texts to stored vectors in one Spark job."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark import Accumulator
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from vexel.operators.chunking import Chunker, chunk_documents
from vexel.operators.embedding import embed
from vexel.operators.models import EmbeddingModel
from vexel.operators.numbering import in_key_order
from vexel.operators.report import summary_lines
from vexel.session import spread_if_narrow
from vexel.sources.store import append_store


@dataclass(frozen=True)
class IngestResult:
    """What one ingest stored; ``appended`` is False if it was there already."""

    appended: bool
    n_chunks: int
    min_len: int | None
    max_len: int | None
    #: Seconds in the model, added up over the tasks, and of the whole job.
    embed_seconds: float
    store_seconds: float

    def lines(self, source: str | None = None) -> list[str]:
        return summary_lines(
            self.n_chunks, self.embed_seconds, self.store_seconds, source
        )


def document_chunks(
    docs: DataFrame,
    chunker: Chunker | None = None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    strict: bool = False,
    drop_empty: bool = False,
    spread: bool = True,
) -> DataFrame:
    """(doc_id, pos, chunk): trimmed, checked and cut."""
    docs = docs.select(id_col, text_col)
    if spread:
        docs = spread_if_narrow(docs, id_col, text_col)
    return chunk_documents(
        docs,
        chunker,
        id_col=id_col,
        text_col=text_col,
        strict=strict,
        drop_empty=drop_empty,
    )


def embedded_chunks(
    docs: DataFrame,
    model: EmbeddingModel,
    chunker: Chunker | None = None,
    *,
    timer: Accumulator | None = None,
    **options,
) -> DataFrame:
    """(doc_id, pos, chunk, embedding) with unit vectors; see :func:`document_chunks`."""
    return embed(document_chunks(docs, chunker, **options), model, unit=True, timer=timer)


def ingest(
    docs: DataFrame,
    store_path: str,
    model: EmbeddingModel,
    chunker: Chunker | None = None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    strict: bool = False,
    drop_empty: bool = False,
    ingest_id: str | None = None,
) -> IngestResult:
    """Trim, chunk, embed, normalise and append ``docs`` to the store.

    Either all chunks become visible or none.  Chunks are stored in the order of
    document id (then text, if an id repeats) and place in the document, so their
    positions, and equal scores in a search, depend on the data alone.  The model
    runs once per chunk.
    """
    ordered = in_key_order(docs.select(id_col, text_col), id_col, text_col)
    timer = docs.sparkSession.sparkContext.accumulator(0.0)
    rows = embedded_chunks(
        ordered,
        model,
        chunker,
        timer=timer,
        id_col=id_col,
        text_col=text_col,
        strict=strict,
        drop_empty=drop_empty,
        spread=False,
    ).select(
        F.col(id_col).alias("doc_id"),
        F.col("pos").alias("chunk_pos"),
        F.col("chunk").alias("text"),
        "embedding",
    )
    seen = Observation()
    started = time.perf_counter()
    appended = append_store(
        rows, store_path, model.dim, unit=True, ingest_id=ingest_id, observation=seen
    )
    seconds = time.perf_counter() - started
    metrics = seen.get if appended else {}
    return IngestResult(
        appended,
        metrics.get("n_chunks", 0),
        metrics.get("min_len"),
        metrics.get("max_len"),
        timer.value,
        seconds,
    )
