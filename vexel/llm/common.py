"""Shared helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vexel.session import work_dir
from vexel.sources import paths

#: Words are runs of anything but these bytes, in every operator that counts words.
WHITESPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Input bytes that one numpy step works on; bounds the memory of a task.
STEP_BYTES = 8 << 20
#: Folders that this process has written and not swept.
_staged: list[str] = []


def id_text_crc(key: str) -> Column:
    """crc32 of the id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))


def held_out(key: str, folds: int = 5) -> Column:
    """True for the rows no label may be learned from."""
    return id_text_crc(key) % folds == 0


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` below the shared work folder and read it back.

    Cuts the lineage: a lost executor costs the tasks it ran, not the whole plan.
    """
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    _staged.append(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._vexel_path = path
    return back


def staged_so_far() -> int:
    """A mark for :func:`sweep`."""
    return len(_staged)


def sweep(spark: SparkSession, mark: int, keep: DataFrame) -> None:
    """Delete what :func:`stage` wrote since the mark, but for ``keep``.

    To be called when ``keep`` is written: until then it may need the rest.
    """
    kept = getattr(keep, "_vexel_path", None)
    for path in _staged[mark:]:
        if path != kept:
            paths.delete(spark, path)
    del _staged[mark:]
    if kept:
        _staged.append(kept)


def drop_stage(*frames: DataFrame | None) -> None:
    """Delete what :func:`stage` wrote, once nothing needs it any more."""
    for frame in frames:
        path = getattr(frame, "_vexel_path", None)
        if path:
            paths.delete(frame.sparkSession, path)


@contextmanager
def conf(spark: SparkSession, **settings: str) -> Iterator[None]:
    """Session settings for the plans that are started inside the block."""
    names = {k.replace("__", "."): v for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def ranges(spark: SparkSession, rows: int, each: int = 1_000_000) -> int:
    """Ranges to sort narrow ``rows`` in: the session's number, more for many rows."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // each))


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """The texts of a batch; null counts as empty."""
    column = batch.column(name)
    return pc.fill_null(column, "") if column.null_count else column


def steps(texts: pa.Array, limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes of text; a longer text stands alone."""
    offsets = value_offsets(texts)
    start = 0
    while start < len(texts):
        stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        stop = min(max(stop, start + 1), len(texts))
        yield start, stop
        start = stop


def value_offsets(array: pa.Array) -> np.ndarray:
    """Offsets of a string or list array, also of a slice."""
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_list(array.type)
    raw = np.frombuffer(array.buffers()[1], np.int64 if wide else np.int32)
    return raw[array.offset : array.offset + len(array) + 1].astype(np.int64)


def segment_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values[offsets[i]:offsets[i + 1]]``; 0 for an empty range."""
    out = np.zeros((len(offsets) - 1, *values.shape[1:]), values.dtype)
    full = np.flatnonzero(np.diff(offsets) > 0)
    if len(full):
        out[full] = np.add.reduceat(values[: offsets[-1]], offsets[full], axis=0)
    return out


def sample_share(counts: dict, bound: int) -> dict:
    """For each group, the share of rows that keeps about ``bound`` of them."""
    return {k: min(1.0, bound / n) for k, n in counts.items() if n}


def hashed_below(key: str, share: Column) -> Column:
    """A fixed pseudo-random choice of ``share`` of the rows, by id alone."""
    return F.pmod(F.xxhash64(F.col(key)), F.lit(1_000_000)) < share * 1_000_000
