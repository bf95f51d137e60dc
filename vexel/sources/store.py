"""The vector store: append-only Parquet folders and a commit log.

Vector and text share a row, and an append becomes visible by its commit record alone
(see :mod:`vexel.sources.commits`): all of it or nothing.  The record names the files of
the append, in order, with the first position and the number of rows of each, so

* rows are written once, where they lie: a row's position is its file's first position
  plus its place in the file, both known without reading anything;
* an append finds the end of the store, and whether its ingest id was there before, in
  the log and scans no data;
* a text is looked up in exactly the files that hold the wanted positions.

Writers may work at the same time: positions are given by the record, and of two
records with one number the later is made anew behind the other.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vexel import schema
from vexel.functions.vectors import normalise, validate_vector
from vexel.sources import paths
from vexel.sources.commits import CLEAR, CommitLog

APPEND = "append"
#: Files whose index rows are broadcast at once (about 100 bytes each); a store of more
#: files is read as a union of such parts.
INDEX_FILES = 100_000

_FILE = "substring_index(_metadata.file_path, '/', -2)"


class Store:
    """One committed state of a store: what its log said when it was opened."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        log = CommitLog(spark, path)
        if not log.exists():
            raise FileNotFoundError(f"no store at {path}")
        self.spark, self.path = spark, path
        self.records = [r for r in log.records() if r["kind"] == APPEND]
        self.files = [
            (f"{r['folder']}/{name}", first, rows, r["ingest_id"])
            for r in self.records
            for name, first, rows in r["files"]
        ]

    def last_offset(self) -> int:
        """End of the last record, as the log has it; 0 if the store is empty."""
        return last_offset(self.records)

    def rows(self, files: list[tuple] | None = None) -> DataFrame:
        """All rows (or those of some files); ``pos`` is the append order."""
        files = self.files if files is None else files
        if not files:
            return self.spark.createDataFrame([], schema.STORE)
        dim = self.records[0]["dim"]
        parts = [
            self._read(files[at : at + INDEX_FILES], dim)
            for at in range(0, len(files), INDEX_FILES)
        ]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part)
        return whole

    def _read(self, files: list[tuple], dim: int) -> DataFrame:
        table = pa.table(
            {
                "__file": [f[0] for f in files],
                "__first": pa.array([f[1] for f in files], pa.int64()),
                "ingest_id": pa.array([f[3] for f in files], pa.string()),
            }
        )
        index = self.spark.createDataFrame(table)
        every = len(files) == len(self.files)
        # A whole store is read by folders, a part of it file by file.
        names = {f[0].split("/")[0] for f in files} if every else [f[0] for f in files]
        rows = (
            self.spark.read.schema(schema.STORED)
            .parquet(*(f"{self.path}/{name}" for name in sorted(names)))
            .select("*", F.expr(_FILE).alias("__file"), F.col("_metadata.row_index").alias("__row"))
        )
        pos = F.col("__first") + F.col("__row")
        return (
            rows.join(F.broadcast(index), "__file")
            .withColumn("pos", pos)
            .withColumn("offset", (F.col("pos") + 1) * schema.record_bytes(dim))
            .select(*(f.name for f in schema.STORE))
        )

    def files_of(self, positions: DataFrame) -> list[tuple]:
        """The files that hold the positions of ``positions (pos)``; no data is read."""
        spark = self.spark
        firsts = np.array([f[1] for f in self.files], np.int64)
        ends = firsts + np.array([f[2] for f in self.files], np.int64)
        sent = spark.sparkContext.broadcast((firsts, ends))

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: set[int] = set()
            for batch in batches:
                wanted = batch.column(0).drop_null().to_numpy()
                at = np.searchsorted(sent.value[0], wanted, "right") - 1
                # A file without rows shares its first position with the next one.
                inside = (at >= 0) & (wanted < sent.value[1][np.maximum(at, 0)])
                found.update(np.unique(at[inside]).tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(sorted(found), pa.int64())], names=["file"]
            )

        # One row per file at most.
        numbers = positions.select("pos").mapInArrow(place, "file bigint").distinct()
        return [self.files[n] for n in sorted(r["file"] for r in numbers.collect())]

    def at(self, positions: DataFrame) -> DataFrame:
        """(pos, text) of the rows at ``positions (pos)``, from their files alone."""
        wanted = positions.select("pos").distinct()
        found = self.rows(self.files_of(positions)).select("pos", "text")
        return found.join(wanted, "pos", "left_semi")


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """All stored rows; ``pos`` is the append order.  A missing store is an error."""
    return Store(spark, path).rows()


def last_offset(records: list[dict]) -> int:
    """Where the next record's predecessor ends, by the live commit records."""
    if not records:
        return 0
    last = records[-1]
    return (last["first"] + last["rows"]) * schema.record_bytes(last["dim"])


def _files(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """The files of a finished job in task order, with their rows, from the footers."""
    found = (
        spark.read.schema("text string")
        .parquet(folder)
        .groupBy(F.col("_metadata.file_name").alias("name"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return sorted((r["name"], r["n"]) for r in found.collect())


def append_store(
    rows: DataFrame,
    path: str,
    dim: int,
    *,
    unit: bool = False,
    ingest_id: str | None = None,
    observation: Observation | None = None,
) -> bool:
    """Append ``rows (doc_id, chunk_pos, text, embedding)``, all of them or none.

    Vectors must have length ``dim`` and are normalised, unless ``unit`` says
    that they already are.  With an ``ingest_id``, an append that was already
    committed under that id is skipped, so a whole ingest can be retried; returns
    False in that case.

    Positions follow the order of ``rows``, which is evaluated and written once.
    """
    spark = rows.sparkSession
    log = CommitLog(spark, path)

    def known(live: list[dict]) -> bool:
        mine = [r for r in live if r["kind"] == APPEND]
        if mine and mine[0]["dim"] != dim:
            raise ValueError(f"store holds vectors of length {mine[0]['dim']}, not {dim}")
        return ingest_id is not None and any(r["ingest_id"] == ingest_id for r in mine)

    schema.record_bytes(dim)
    if known(log.records()):
        return False
    checked = validate_vector(rows, dim)
    if not unit:
        checked = checked.withColumn("embedding", normalise("embedding"))
    if observation is not None:
        checked = checked.observe(
            observation,
            F.count(F.lit(1)).alias("n_chunks"),
            F.min(F.size("embedding")).alias("min_len"),
            F.max(F.size("embedding")).alias("max_len"),
        )
    folder = f"append-{uuid.uuid4().hex}"
    try:
        write_rows(checked, f"{path}/{folder}")
        files = _files(spark, f"{path}/{folder}")
        added = log.add(
            lambda live: None if known(live) else _record(live, ingest_id, dim, folder, files)
        )
    except BaseException:
        # Nothing names the folder: this only saves space.
        paths.delete(spark, f"{path}/{folder}")
        raise
    if added is None:
        paths.delete(spark, f"{path}/{folder}")
    return added is not None


def _record(
    live: list[dict], ingest_id: str | None, dim: int, folder: str, files: list
) -> dict:
    first = sum(r["rows"] for r in live if r["kind"] == APPEND)
    placed, at = [], first
    for name, n in files:
        placed.append([name, at, n])
        at += n
    return {
        "kind": APPEND, "ingest_id": ingest_id, "dim": dim, "folder": folder,
        "first": first, "rows": at - first, "files": placed,
    }


def write_rows(rows: DataFrame, folder: str) -> None:
    """Write the stored columns of ``rows`` to a new folder, a file a task."""
    table = rows.select(*(F.col(f.name).cast(f.dataType) for f in schema.STORED))
    (
        table.write
        # Files appear only when the whole job commits.
        .option("mapreduce.fileoutputcommitter.algorithm.version", "1")
        # A task is one file, whatever the session says: positions count on it.
        .option("maxRecordsPerFile", 0)
        # Float vectors hardly repeat: a dictionary only costs time.
        .option("parquet.enable.dictionary#embedding.list.element", "false")
        .parquet(folder)
    )


def clear_store(spark: SparkSession, path: str) -> None:
    """Remove every row but keep the store; a missing store is an error.

    One record: a reader sees all rows or none.  :func:`vacuum_store` frees the space.
    """
    log = CommitLog(spark, path)
    if not log.exists():
        raise FileNotFoundError(f"failed to clear data file {path}")
    log.add(lambda live: {"kind": CLEAR})


def vacuum_store(spark: SparkSession, path: str) -> list[str]:
    """Delete folders that no live record names: failed appends and cleared rows.

    Run it when no append and no reader of an older state is under way.
    """
    live = {r["folder"] for r in Store(spark, path).records}
    gone = [n for n in paths.names(spark, path) if n not in live]
    for name in gone:
        paths.delete(spark, f"{path}/{name}")
    return sorted(gone)
