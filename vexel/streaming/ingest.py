"""Ingesting the text files of a landing folder as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vexel.operators.chunking import Chunker
from vexel.operators.models import EmbeddingModel
from vexel.plans.ingest import ingest


def ingest_new_files(
    spark: SparkSession,
    landing: str,
    store_path: str,
    model: EmbeddingModel,
    checkpoint: str,
    *,
    stream_id: str,
    chunker: Chunker | None = None,
    max_files: int = 10_000,
) -> StreamingQuery:
    """Append every file not seen before, ``max_files`` per batch, then stop.

    The document id is a hash of the file's path.  A batch that is delivered
    again after a failure carries the same ingest id and is not stored twice.
    """
    files = (
        spark.readStream.format("text")
        .option("wholetext", True)
        .option("maxFilesPerTrigger", max_files)
        .load(landing)
    )
    docs = files.select(
        F.xxhash64("_metadata.file_path").alias("doc_id"),
        F.make_valid_utf8("value").alias("text"),
    )

    def store_batch(batch: DataFrame, batch_id: int) -> None:
        ingest(
            batch,
            store_path,
            model,
            chunker,
            ingest_id=f"{stream_id}:{batch_id}",
        )

    return (
        docs.writeStream.foreachBatch(store_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
