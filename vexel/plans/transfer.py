"""Moving a store to and from its two-file form: packed vectors and a journal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vexel import schema
from vexel.sources import paths
from vexel.sources.pair import append_pair, pair_records, read_pair, read_plain_pair
from vexel.sources.store import Store, append_store


def export_store(spark: SparkSession, store_path: str, pair_path: str) -> int:
    """Append to the pair what the store has beyond it; returns the rows added.

    The first export writes all rows, a later one the files that came since.  Nothing
    is shuffled: every task writes the runs of positions it reads.
    """
    store = Store(spark, store_path)
    records = pair_records(spark, pair_path)
    done = sum(r["rows"] for r in records)
    files = [f for f in store.files if f[1] + f[2] > done]
    if not files:
        return 0
    dim = store.records[0]["dim"]
    rows = store.rows(files).where(F.col("pos") >= done)
    return append_pair(
        rows.select("pos", "embedding", "text"), pair_path, dim, in_runs=True
    )


def _store_of(rows: DataFrame, store_path: str, dim: int, n_bytes: int) -> None:
    spark = rows.sparkSession
    if paths.exists(spark, store_path):
        raise FileExistsError(store_path)
    ordered = rows.select(
        "pos",
        F.lit(None).cast("bigint").alias("doc_id"),
        F.lit(None).cast("int").alias("chunk_pos"),
        "text",
        "embedding",
    )
    number = 2 * max(spark.sparkContext.defaultParallelism, n_bytes // (128 << 20))
    ordered = ordered.repartitionByRange(number, "pos").sortWithinPartitions("pos")
    append_store(ordered.drop("pos"), store_path, dim, unit=True)


def import_pair(spark: SparkSession, pair_path: str, store_path: str, dim: int) -> None:
    """Make a new store of a pair, whose vectors must be unit.  Positions are kept."""
    n_bytes = sum(r["rows"] for r in pair_records(spark, pair_path))
    n_bytes *= schema.record_bytes(dim)
    _store_of(read_pair(spark, pair_path, dim), store_path, dim, n_bytes)


def import_store(
    spark: SparkSession,
    vector_path: str,
    journal_path: str,
    store_path: str,
    dim: int,
) -> None:
    """Make a new store of a packed file of unit vectors and its journal.

    Vector i has the text of line i.  A vector whose journal line is missing or broken
    gets empty text; the document columns are NULL.
    """
    n_bytes = paths.size(spark, vector_path)
    _store_of(read_plain_pair(spark, vector_path, journal_path, dim), store_path, dim, n_bytes)
