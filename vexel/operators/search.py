"""Exact top-k cosine search.

Scores are never materialised as all (query, row) pairs.  The queries travel to
every task in size-checked blocks; a task streams its rows past all of them in slabs
and lets go of everything but its k best per query.  A bounded sample of the store
first gives each query a score that k rows are known to reach; tasks keep nothing below
it, so what they send does not grow with their number.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vexel.functions.text import require_text
from vexel.functions.vectors import has_nan
from vexel.operators.embedding import embed
from vexel.operators.kernels import TopK, to_matrix, unit_rows
from vexel.operators.models import EmbeddingModel
from vexel.operators.numbering import assign_offsets
from vexel.schema import DEFAULT_K, FLOAT_BYTES
from vexel.session import work_dir
from vexel.sources.store import Store

# Largest query matrix sent to every task as one; more queries go in more blocks.
MAX_QUERY_BYTES = 64 << 20
# Largest sum of such blocks in one pass over the store.
MAX_SHARED_BYTES = 1 << 30
# Vectors that a task holds while all blocks go past them.
SLAB_BYTES = 64 << 20
# Rows of the store that give every query its first lower bound.
SAMPLE_ROWS = 4_096
# Parts in which the hits of one query are merged before they meet.
MERGE_PARTS = 64


def top_k(
    scored: DataFrame,
    k: int = DEFAULT_K,
    *,
    score: str = "score",
    ties: Sequence[str] = ("pos",),
    by: Sequence[str] = (),
) -> DataFrame:
    """The k best rows (per ``by`` group), best first, with ``rank`` from 1.

    Equal scores rank by ``ties``.  NULL and NaN scores are never hits.
    """
    if k < 0:
        raise ValueError("k must not be negative")
    # NaN and NULL sort last and are dropped after the cut.  A filter before it
    # would be pushed below a scoring UDF's projection and call the UDF twice.
    real = F.when(~F.isnan(score), F.col(score))
    order = [F.desc_nulls_last(real), *(F.asc(t) for t in ties)]
    if by:
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        best = scored.withColumn("rank", rank).filter(F.col("rank") <= k)
    else:
        # Per-task top k, then a merge of the survivors; the window sees k rows.
        best = scored.orderBy(*order).limit(k)
        best = best.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    return best.filter(F.col(score).isNotNull() & ~F.isnan(score))


def _scored_schema(id_field: T.StructField) -> T.StructType:
    return T.StructType(
        [
            T.StructField("query_id", id_field.dataType),
            T.StructField("pos", T.LongType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("part", T.IntegerType()),
        ]
    )


def _vectors(store: DataFrame) -> DataFrame:
    return store.select(F.col("pos").cast("long").alias("pos"), "embedding")


def _slabs(batches, dim: int):
    """(matrix, positions) of about ``SLAB_BYTES``."""
    vectors, pos, size = [], [], 0
    for batch in batches:
        vectors.append(to_matrix(batch.column("embedding"), dim))
        pos.append(batch.column("pos").to_numpy())
        size += vectors[-1].nbytes
        if size >= SLAB_BYTES:
            yield np.concatenate(vectors), np.concatenate(pos)
            vectors, pos, size = [], [], 0
    if vectors:
        yield np.concatenate(vectors), np.concatenate(pos)


class _Block:
    """Queries that are sent together, and a score that k rows reach for each."""

    def __init__(self, ids: pa.Array, matrix: np.ndarray, floor: np.ndarray) -> None:
        self.ids, self.matrix, self.floor = ids, matrix, floor

    def score(self, x: np.ndarray, pos: np.ndarray, k: int, part: int) -> pa.RecordBatch:
        best = TopK(self.matrix, k, self.floor)
        step = max(1, (4 << 20) // max(1, x.shape[1]))
        for lo in range(0, len(x), step):
            best.update(x[lo : lo + step], pos[lo : lo + step])
        # The next slab of the task must beat this one.
        self.floor = best.kth()
        return pa.RecordBatch.from_arrays(
            [
                self.ids.take(pa.array(best.query)),
                pa.array(best.pos, pa.int64()),
                pa.array(best.score, pa.float64()),
                pa.array(np.full(len(best.pos), part, np.int32)),
            ],
            names=["query_id", "pos", "score", "part"],
        )


def score_partitions(
    store: DataFrame, blocks: list, dim: int, k: int, id_field: T.StructField
) -> DataFrame:
    """(query_id, pos, score, part): the hits of every task that may be in a top k.

    ``blocks`` are broadcast :class:`_Block`; all of them go past each slab, so the
    store is read once however many there are.
    """

    def run(batches):
        part = TaskContext.get().partitionId() % MERGE_PARTS
        floors = {}
        for x, pos in _slabs(batches, dim):
            for number, sent in enumerate(blocks):
                block = sent.value
                mine = _Block(block.ids, block.matrix, floors.get(number, block.floor))
                yield mine.score(x, pos, k, part)
                floors[number] = mine.floor

    return _vectors(store).mapInArrow(run, _scored_schema(id_field))


def _query_matrix(queries: DataFrame, dim: int) -> tuple[pa.Array, np.ndarray]:
    table = queries.toArrow().combine_chunks()
    ids = table.column("query_id").combine_chunks()
    vectors = table.column("embedding").combine_chunks()
    if not len(ids):
        return ids, np.zeros((0, dim), np.float32)
    return ids, to_matrix(vectors, dim)


def _merge(partial: DataFrame, k: int) -> DataFrame:
    """The k best of each query: in parts of the tasks first, then over the parts."""
    first = top_k(partial, k, by=("query_id", "part")).drop("rank")
    return top_k(first, k, by=("query_id",)).select("query_id", "rank", "score", "pos")


def search_vector(
    store: DataFrame, vector: Sequence[float], k: int = DEFAULT_K
) -> DataFrame:
    """Top k of ``store (pos, embedding)`` for one unit vector: (rank, score, pos)."""
    matrix = np.array([vector], np.float32)
    dim = matrix.shape[1]

    def run(batches):
        best = TopK(matrix, k)
        for batch in batches:
            best.update(
                to_matrix(batch.column("embedding"), dim),
                batch.column("pos").to_numpy(),
            )
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.pos, pa.int64()), pa.array(best.score, pa.float64())],
            names=["pos", "score"],
        )

    partial = _vectors(store).mapInArrow(run, "pos bigint, score double")
    # One query needs no grouping: per-task top k and a single merge.
    return top_k(partial, k).select("rank", "score", "pos")


def search_batch(
    store: DataFrame,
    queries: DataFrame,
    dim: int,
    k: int = DEFAULT_K,
    *,
    max_query_bytes: int = MAX_QUERY_BYTES,
    max_shared_bytes: int = MAX_SHARED_BYTES,
) -> DataFrame:
    """Top k of ``store (pos, embedding)`` for each of ``queries (query_id, embedding)``.

    Both sides must hold unit vectors for the score to be a cosine.  Returns
    (query_id, rank, score, pos).  A query id that repeats is an error.
    """
    partial = scored_queries(
        store, queries, dim, k,
        max_query_bytes=max_query_bytes, max_shared_bytes=max_shared_bytes,
    )
    return _merge(partial, k)


def scored_queries(
    store: DataFrame,
    queries: DataFrame,
    dim: int,
    k: int,
    *,
    max_query_bytes: int = MAX_QUERY_BYTES,
    max_shared_bytes: int = MAX_SHARED_BYTES,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """What the tasks of :func:`search_batch` send, before it is merged.

    The queries are written and fetched block by block; the driver holds one block at a
    time, with the sample.  Blocks of up to ``max_shared_bytes`` share one pass over
    the store; queries beyond that take another branch of the same plan.
    """
    if k < 0:
        raise ValueError("k must not be negative")
    spark = store.sparkSession
    queries = queries.select("query_id", "embedding")
    id_field = queries.schema["query_id"]
    fits = max(1, max_query_bytes // (dim * FLOAT_BYTES))
    sample = _vectors(store).limit(sample_rows).toArrow().combine_chunks()
    rows = to_matrix(sample.column("embedding").combine_chunks(), dim) if len(sample) else None
    places = sample.column("pos").to_numpy()

    def block(found: DataFrame) -> _Block:
        ids, matrix = _query_matrix(found, dim)
        best = TopK(matrix, k)
        if rows is not None:
            best.update(rows, places)
        return _Block(ids, matrix, best.kth())

    only = block(queries.limit(fits + 1))
    if len(only.ids) <= fits:
        # All there are: no need to write them.
        if len(only.ids.unique()) != len(only.ids):
            raise ValueError("query ids must not repeat")
        sent = [spark.sparkContext.broadcast(only)]
        return score_partitions(store, sent, dim, k, id_field)

    blocked = work_dir(spark, "query-blocks")
    numbered = assign_offsets(queries, dim)
    numbered.withColumn("block", F.expr(f"pos div {fits}")).drop("pos", "offset").write.partitionBy(
        "block"
    ).parquet(blocked)
    queries = spark.read.parquet(blocked)
    if queries.groupBy("query_id").count().where("count > 1").limit(1).count():
        raise ValueError("query ids must not repeat")
    number = -(-queries.count() // fits)
    sent = []
    for b in range(number):
        mine = queries.filter(F.col("block") == b).select("query_id", "embedding")
        sent.append(spark.sparkContext.broadcast(block(mine)))
    share = max(1, max_shared_bytes // (fits * dim * FLOAT_BYTES))
    passes = [
        score_partitions(store, sent[at : at + share], dim, k, id_field)
        for at in range(0, len(sent), share)
    ]
    partial = passes[0]
    for more in passes[1:]:
        partial = partial.unionByName(more)
    return partial


def attach_text(
    hits: DataFrame, texts: DataFrame | Store, *, text_col: str = "text"
) -> DataFrame:
    """Look up the text of each hit in ``texts (pos, text)``; none gives ``""``.

    Of several texts at one position the lowest counts, so a hit stays one row.  Hits
    are written first.  Of a :class:`Store` only the files that hold a wanted position
    are read; any other table is joined by position.
    """
    spark = hits.sparkSession
    kept = work_dir(spark, "hits")
    hits.write.parquet(kept)
    hits = spark.read.schema(hits.schema).parquet(kept)
    if isinstance(texts, Store):
        found = texts.at(hits)
    else:
        wanted = hits.select("pos").distinct()
        found = (
            texts.select("pos", F.col(text_col).alias("text"))
            .join(wanted, "pos", "left_semi")
            .groupBy("pos")
            .agg(F.min("text").alias("text"))
        )
    joined = hits.join(found, "pos", "left")
    return joined.withColumn("text", F.coalesce("text", F.lit("")))


def pad_hits(hits: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Exactly k rows per query: missing ranks get score 0 and empty text."""
    ranks = F.sequence(F.lit(1), F.lit(k)) if k else F.array().cast("array<int>")
    wanted = queries.select("query_id", F.explode(ranks).alias("rank"))
    return (
        wanted.join(hits, ["query_id", "rank"], "left")
        .withColumn("score", F.coalesce("score", F.lit(0.0)))
        .withColumn("text", F.coalesce("text", F.lit("")))
    )


def embed_queries(
    queries: DataFrame, model: EmbeddingModel, *, strict: bool = True
) -> DataFrame:
    """(query_id, query) to (query_id, embedding): trim, reject empty, embed."""
    texts = require_text(
        queries.select("query_id", "query"),
        "query",
        strict=strict,
        message="query cannot be empty",
    )
    vectors = embed(texts, model, "query", unit=True)
    return vectors.select("query_id", "embedding")


def search(
    store: DataFrame | Store,
    queries: DataFrame,
    model: EmbeddingModel,
    k: int = DEFAULT_K,
    *,
    pad_to_k: bool = False,
    strict: bool = True,
    max_query_bytes: int = MAX_QUERY_BYTES,
) -> DataFrame:
    """Top k of a store, or of any table (pos, embedding, text), for each text query.

    ``queries`` is (query_id, query).  Returns (query_id, rank, score, pos, text).
    Scoring reads positions and vectors only; texts are fetched for the hits.  The
    scoring runs at once, since the scan for texts depends on the hits.
    """
    vectors = embed_queries(queries, model, strict=strict)
    rows = store.rows() if isinstance(store, Store) else store
    hits = search_batch(rows, vectors, model.dim, k, max_query_bytes=max_query_bytes)
    result = attach_text(hits, store)
    if pad_to_k:
        result = pad_hits(result, vectors, k)
    return result.select("query_id", "rank", "score", "pos", "text")


def unit_vector(model: EmbeddingModel, text: str) -> list[float]:
    """The unit vector of one text, computed on the driver."""
    vector = model.make_predict_fn()(np.array([text], object))
    return unit_rows(np.asarray(vector, np.float32))[0].tolist()


def nan_vectors() -> Column:
    """Aggregate: vectors with a NaN element, which no search can return."""
    return F.count_if(has_nan("embedding"))
