"""The two-file form of a store, appended in generations.

A generation is a folder of packed vectors and journal lines, a line per vector, written
by one job (:mod:`vexel.sources.packed`).  The pair's commit log names the generations
in order: a generation that stopped half way, with vectors but no journal or the other
way round, is in no record, and the pair reads as it was before it.  The next append
starts at the last committed offset, which is read from the log.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vexel import schema
from vexel.sources import paths
from vexel.sources.commits import CommitLog
from vexel.sources.journal import read_journal_lines
from vexel.sources.packed import read_manifest, read_packed_vectors, write_packed_vectors
from vexel.sources.store import last_offset

PAIR = "pair"


def pair_records(spark: SparkSession, path: str) -> list[dict]:
    """The committed generations in order; none if there is no pair yet."""
    return [r for r in CommitLog(spark, path).records() if r["kind"] == PAIR]


def pair_end(spark: SparkSession, path: str) -> int:
    """Offset at which the last complete generation ends; 0 without one."""
    return last_offset(pair_records(spark, path))


def append_pair(
    rows: DataFrame, path: str, dim: int, *, in_runs: bool = False
) -> int:
    """Append ``rows (pos, embedding, text)`` as one generation; returns its rows.

    ``pos`` goes on from the end of the pair.  Of two writers at a time the slower one
    fails and leaves no trace.
    """
    spark = rows.sparkSession
    known = pair_records(spark, path)
    if known and known[0]["dim"] != dim:
        raise ValueError(f"pair holds vectors of length {known[0]['dim']}, not {dim}")
    first = last_offset(known) // schema.record_bytes(dim)
    folder = f"generation-{uuid.uuid4().hex}"
    write_packed_vectors(rows, f"{path}/{folder}", dim, first=first, in_runs=in_runs)
    added = sum(r["rows"] for r in read_manifest(f"{path}/{folder}"))

    def record(live: list[dict]) -> dict | None:
        if [r["folder"] for r in live] != [r["folder"] for r in known]:
            paths.delete(spark, f"{path}/{folder}")
            raise RuntimeError(f"another writer has appended to {path} meanwhile")
        return {"kind": PAIR, "dim": dim, "folder": folder, "first": first, "rows": added}

    CommitLog(spark, path).add(record)
    return added


def read_pair(spark: SparkSession, path: str, dim: int) -> DataFrame:
    """(pos, offset, text, embedding) of all committed generations."""
    records = pair_records(spark, path)
    if not records:
        raise FileNotFoundError(f"no pair at {path}")
    whole = None
    for record in records:
        folder = f"{path}/{record['folder']}"
        vectors = read_packed_vectors(spark, folder, dim)
        journals = [f"{folder}/{r['journal']}" for r in read_manifest(folder, dim)]
        if not journals:
            continue
        lines = read_journal_lines(spark, *journals)
        lines = lines.withColumn("pos", F.col("pos") + record["first"])
        part = join_lines(vectors, lines, dim)
        whole = part if whole is None else whole.unionByName(part)
    if whole is None:
        return spark.createDataFrame([], schema.PAIR)
    return whole


def join_lines(vectors: DataFrame, lines: DataFrame, dim: int) -> DataFrame:
    """Vector i with line i; a vector without a line gets empty text."""
    return vectors.join(lines.select("pos", "text"), "pos", "left").select(
        "pos",
        ((F.col("pos") + 1) * schema.record_bytes(dim)).alias("offset"),
        F.coalesce("text", F.lit("")).alias("text"),
        "embedding",
    )


def read_plain_pair(
    spark: SparkSession, vector_path: str, journal_path: str, dim: int
) -> DataFrame:
    """(pos, offset, text, embedding) of a packed file and its journal, by line."""
    vectors = read_packed_vectors(spark, vector_path, dim)
    return join_lines(vectors, read_journal_lines(spark, journal_path), dim)
