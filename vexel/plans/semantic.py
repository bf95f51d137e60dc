"""Searching texts that are not in a store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vexel.functions.text import strip_space
from vexel.operators.chunking import Chunker, chunk_documents
from vexel.operators.embedding import embed_score
from vexel.operators.models import EmbeddingModel
from vexel.operators.search import top_k, unit_vector
from vexel.schema import DEFAULT_K
from vexel.session import spread_if_narrow


def search_documents(
    docs: DataFrame,
    query: str,
    model: EmbeddingModel,
    k: int = DEFAULT_K,
    chunker: Chunker | None = None,
    *,
    score_digits: int | None = None,
) -> DataFrame:
    """Chunk, embed and score ``docs (doc_id, text)`` against one query text.

    Returns (rank, score, doc_id, pos, chunk).  With ``score_digits`` hits rank by
    the rounded score.  No vector leaves the Python worker and no chunk is
    shuffled: each task keeps its k best.
    """
    query = strip_space(query)
    if not query:
        raise ValueError("query cannot be empty")
    vector = unit_vector(model, query)
    texts = spread_if_narrow(docs.select("doc_id", "text"), "doc_id", "text")
    chunks = chunk_documents(texts, chunker)
    scored = embed_score(chunks, model, vector)
    if score_digits is not None:
        scored = scored.withColumn("score", F.round("score", score_digits))
    best = top_k(scored, k, ties=("doc_id", "pos"))
    return best.select("rank", "score", "doc_id", "pos", "chunk")
