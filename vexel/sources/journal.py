"""JSON Lines journals: ``{"Offset": ..., "Text": ...}`` per stored vector.

A journal is read by its offsets (:func:`read_journal`) or, as its vectors are, by
line: line i belongs to vector i, whatever the line says (:func:`read_journal_lines`).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vexel import schema
from vexel.session import range_count, work_dir
from vexel.sources import paths


def read_journal(spark: SparkSession, path: str, dim: int) -> DataFrame:
    """(pos, offset, text).  A missing journal is created empty.

    The position comes from the offset.  A line that does not parse has no offset and
    no row here; :func:`vexel.operators.search.attach_text` gives its vector
    empty text.  An offset between two records is an error.
    """
    if not paths.exists(spark, path):
        paths.create_empty(spark, path)
    width = schema.record_bytes(dim)
    lines = spark.read.schema(schema.JOURNAL).json(path)
    place = F.when(
        F.col("Offset") % width == 0, F.expr(f"Offset div {width} - 1")
    ).otherwise(
        F.raise_error(
            F.concat(F.lit(f"not a multiple of {width}: journal offset "), "Offset")
        ).cast("bigint")
    )
    return lines.filter(F.col("Offset").isNotNull()).select(
        place.alias("pos"),
        F.col("Offset").alias("offset"),
        F.coalesce("Text", F.lit("")).alias("text"),
    )


def read_journal_lines(spark: SparkSession, *files: str) -> DataFrame:
    """(pos, offset, text) by line number, over one file or several in name order.

    Blank lines before the first entry do not count, later ones do.  A line that does
    not parse keeps its number, with no offset and empty text.

    Lines are counted per split of the files; a running sum over the splits gives the
    first number of each, and a second pass numbers the lines inside them.  Both read
    the lines where they lie; only the counts meet.
    """
    if len(files) == 1 and not paths.exists(spark, files[0]):
        paths.create_empty(spark, files[0])
    lines = spark.read.option("lineSep", "\n").text(list(files))
    split = [
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    ]
    # One row per split, written so that the lines are counted once.
    kept = work_dir(spark, "line-counts")
    lines.select(*split, _filled().alias("filled")).groupBy("file", "block").agg(
        F.count(F.lit(1)).alias("n"), F.bool_or("filled").alias("any")
    ).write.parquet(kept)
    counts = spark.read.parquet(kept)
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, seen = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            file = batch.column("file").dictionary_encode()
            block = batch.column("block").to_numpy()
            codes = file.indices.to_numpy()
            cuts = np.flatnonzero((np.diff(codes) != 0) | (np.diff(block) != 0)) + 1
            inside = np.empty(batch.num_rows, np.int64)
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                here = (file[a].as_py(), int(block[a]))
                if here != place:
                    place, seen = here, 0
                inside[a:b] = np.arange(seen, seen + b - a)
                seen += b - a
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(inside)], names=["value", "file", "block", "inside"]
            )

    numbered = lines.select("value", *split).mapInArrow(
        number, "value string, file string, block bigint, inside bigint"
    )
    # A split that was not counted has no start: numbers must not shift silently.
    start = F.when(F.col("start").isNotNull(), F.col("start")).otherwise(
        F.raise_error(F.lit("the journal's splits changed while it was read")).cast("bigint")
    )
    placed = numbered.join(F.broadcast(starts), ["file", "block"], "left").select(
        "file", "block", (start + F.col("inside")).alias("line"), "value"
    )
    skipped = 0
    head = counts.where("any").orderBy("file", "block").select("file", "block").first()
    if head is not None:  # only the split of the first entry is read
        here = (F.col("file") == head["file"]) & (F.col("block") == head["block"])
        skipped = placed.where(here & _filled()).agg(F.min("line")).first()[0]
    entry = F.from_json("value", schema.JOURNAL)
    return placed.where(F.col("line") >= skipped).select(
        (F.col("line") - skipped).alias("pos"),
        entry["Offset"].alias("offset"),
        F.coalesce(entry["Text"], F.lit("")).alias("text"),
    )


def _filled() -> Column:
    return ~F.col("value").rlike(r"^\s*$")


def write_journal(rows: DataFrame, path: str) -> None:
    """Write ``rows (offset, text)`` as part files whose names follow the offsets."""
    lines = rows.select(
        F.col("offset").cast("long").alias("Offset"),
        F.coalesce("text", F.lit("")).alias("Text"),
    )
    size = lines.agg(F.sum(F.octet_length("Text"))).first()[0] or 0
    ordered = lines.repartitionByRange(range_count(rows.sparkSession, size), "Offset")
    ordered.sortWithinPartitions("Offset").write.json(path)
