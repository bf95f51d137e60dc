"""Packed float32 vectors, and beside them, if wanted, a journal of their texts.

A packed file is headerless little-endian records of ``dim * 4`` bytes; record i is the
vector of position i.  An export is a folder: every task writes the rows it has, a file
for each run of consecutive positions, and the manifest, written last, puts the files in
order.  So rows that already lie in order, as a store's do, are written without a
shuffle, whichever task has them.  A folder without its manifest is not finished and
cannot be read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

from vexel import schema
from vexel.operators.kernels import from_matrix, to_matrix
from vexel.session import range_count

FORMAT = "packed_vectors"
MANIFEST = "manifest.json"
DEFAULT_SPLIT_BYTES = 64 << 20
_BATCH_BYTES = 4 << 20
# More data than this many splits gets larger ones: the driver lists them all.
_MAX_SPLITS = 50_000


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    # Spark's name for the object store that Arrow calls s3.
    return pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


@dataclass
class _Range(InputPartition):
    file: str
    first_byte: int
    records: int
    first_pos: int


class _PackedReader(DataSourceReader):
    def __init__(self, path: str, dim: int, split_bytes: int) -> None:
        self.path = path
        self.dim = dim
        self.split_bytes = split_bytes

    def _files(self) -> list[tuple[str, int, int]]:
        """(path, first position, records) of the file, or of an export's files."""
        filesystem, root = _open(self.path)
        info = filesystem.get_file_info(root)
        if info.type == pafs.FileType.NotFound:
            raise FileNotFoundError(root)
        if info.type == pafs.FileType.File:
            # Only the end of a plain file may be torn; it is dropped.
            return [(info.path, 0, info.size // schema.record_bytes(self.dim))]
        runs = read_manifest(self.path, self.dim)
        return [(f"{root}/{r['vectors']}", r["first"], r["rows"]) for r in runs]

    def partitions(self) -> list[InputPartition]:
        width = schema.record_bytes(self.dim)
        files = self._files()
        total = sum(n for _, _, n in files) * width
        per_split = max(1, max(self.split_bytes, total // _MAX_SPLITS) // width)
        ranges: list[InputPartition] = [
            _Range(path, lo * width, min(per_split, records - lo), first + lo)
            for path, first, records in files
            for lo in range(0, records, per_split)
        ]
        return ranges or [_Range("", 0, 0, 0)]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        if not partition.records:
            return
        width = schema.record_bytes(self.dim)
        step = max(1, _BATCH_BYTES // width)
        filesystem, _ = _open(self.path)
        with filesystem.open_input_file(partition.file) as stream:
            for lo in range(0, partition.records, step):
                n = min(step, partition.records - lo)
                raw = stream.read_at(n * width, partition.first_byte + lo * width)
                if len(raw) != n * width:
                    raise ValueError(f"{partition.file} is shorter than its manifest says")
                yield _packed_batch(raw, partition.first_pos + lo, self.dim)


def _packed_batch(raw: bytes, first_pos: int, dim: int) -> pa.RecordBatch:
    values = np.frombuffer(raw, "<f4").astype(np.float32, copy=False)
    vectors = from_matrix(values.reshape(-1, dim))
    pos = pa.array(np.arange(first_pos, first_pos + len(vectors), dtype=np.int64))
    return pa.RecordBatch.from_arrays([pos, vectors], names=["pos", "embedding"])


def read_manifest(path: str, dim: int | None = None) -> list[dict]:
    """The runs of a finished export in order; an unfinished one is an error."""
    filesystem, root = _open(path)
    name = f"{root}/{MANIFEST}"
    if filesystem.get_file_info(name).type == pafs.FileType.NotFound:
        raise FileNotFoundError(f"{path} is no finished export: it has no {MANIFEST}")
    with filesystem.open_input_stream(name) as stream:
        found = json.loads(stream.read())
    if dim is not None and found["dim"] != dim:
        raise ValueError(f"{path} holds vectors of length {found['dim']}, not {dim}")
    return found["runs"]


@dataclass
class _Written(WriterCommitMessage):
    runs: list


class _Run:
    """The files of consecutive positions that one task has open."""

    def __init__(self, filesystem, root: str, first: int, journal: bool) -> None:
        name = f"{first:020d}-{uuid.uuid4().hex}"
        self.entry = {"first": first, "rows": 0, "vectors": f"vectors-{name}.bin"}
        self.vectors = filesystem.open_output_stream(f"{root}/{self.entry['vectors']}")
        self.journal = None
        if journal:
            self.entry["journal"] = f"journal-{name}.jsonl"
            self.journal = filesystem.open_output_stream(f"{root}/{self.entry['journal']}")

    def add(self, vectors: np.ndarray, lines: pa.Array | None) -> None:
        self.vectors.write(vectors.astype("<f4", copy=False).tobytes())
        if self.journal is not None and len(lines):
            ended = pc.binary_join_element_wise(lines, "", "\n")
            self.journal.write(ended.buffers()[2])
        self.entry["rows"] += len(vectors)

    def close(self) -> dict:
        self.vectors.close()
        if self.journal is not None:
            self.journal.close()
        return self.entry


class _PackedWriter(DataSourceArrowWriter):
    """Tasks write runs under names of their own; the driver publishes them at once."""

    def __init__(self, path: str, dim: int, first: int, journal: bool) -> None:
        self.path, self.dim, self.first, self.journal = path, dim, first, journal

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        filesystem, root = _open(self.path)
        runs: list[dict] = []
        run, following = None, None
        for batch in iterator:
            pos = batch.column("pos").to_numpy()
            vectors = to_matrix(batch.column("embedding"), self.dim)
            lines = batch.column("line") if self.journal else None
            cuts = np.flatnonzero(np.diff(pos) != 1) + 1
            for a, b in zip([0, *cuts], [*cuts, len(pos)], strict=True):
                if a == b:
                    continue
                if run is None or pos[a] != following:
                    if run is not None:
                        runs.append(run.close())
                    run = _Run(filesystem, root, int(pos[a]), self.journal)
                run.add(vectors[a:b], lines.slice(a, b - a) if self.journal else None)
                following = int(pos[b - 1]) + 1
        if run is not None:
            runs.append(run.close())
        return _Written(runs)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        runs = [r for m in messages if m is not None for r in m.runs]
        runs.sort(key=lambda r: r["first"])
        following = self.first
        for run in runs:
            if run["first"] != following:
                raise ValueError(
                    f"positions must follow each other from {self.first}: "
                    f"{run['first']} stands where {following} is due"
                )
            following += run["rows"]
        filesystem, root = _open(self.path)
        with filesystem.open_output_stream(f"{root}/{MANIFEST}") as stream:
            stream.write(json.dumps({"dim": self.dim, "runs": runs}).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """Without a manifest there is no export; the files only take space."""
        filesystem, root = _open(self.path)
        if filesystem.get_file_info(root).type == pafs.FileType.Directory:
            filesystem.delete_dir(root)


class PackedVectors(DataSource):
    """``spark.read/write.format("packed_vectors")`` with option ``dim``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        return schema.PACKED

    def _dim(self) -> int:
        return int(self.options.get("dim", schema.DEFAULT_DIM))

    def reader(self, schema) -> DataSourceReader:
        split = int(self.options.get("splitBytes", DEFAULT_SPLIT_BYTES))
        return _PackedReader(self.options["path"], self._dim(), split)

    def writer(self, schema, overwrite) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("packed_vectors writes to a new folder only")
        filesystem, root = _open(self.options["path"])
        if filesystem.get_file_info(root).type != pafs.FileType.NotFound:
            raise FileExistsError(root)
        filesystem.create_dir(root, recursive=True)
        return _PackedWriter(
            self.options["path"], self._dim(), int(self.options.get("first", 0)),
            "line" in schema.names,
        )


def read_packed_vectors(
    spark: SparkSession,
    path: str,
    dim: int = schema.DEFAULT_DIM,
    *,
    split_bytes: int = DEFAULT_SPLIT_BYTES,
) -> DataFrame:
    """(pos, embedding) of a packed file, or of a finished export.

    Splits are whole records, so one large file is read by many tasks.  Trailing
    bytes of a plain file that do not fill a record are dropped.
    """
    spark.dataSource.register(PackedVectors)
    reader = spark.read.format(FORMAT).option("dim", dim)
    return reader.option("splitBytes", split_bytes).load(path)


def write_packed_vectors(
    rows: DataFrame,
    path: str,
    dim: int = schema.DEFAULT_DIM,
    *,
    first: int = 0,
    in_runs: bool = False,
) -> None:
    """Write ``rows (pos, embedding)`` to a new folder; with a ``text``, a journal too.

    Positions must follow each other from ``first``.  Rows are sorted in ranges sized
    by their bytes, unless ``in_runs`` says that every task has few runs of positions,
    as the rows of a store do.
    """
    rows.sparkSession.dataSource.register(PackedVectors)
    columns = [F.col("pos").cast("bigint").alias("pos"), "embedding"]
    if "text" in rows.columns:
        offset = (F.col("pos") + 1) * schema.record_bytes(dim)
        entry = F.struct(
            offset.cast("bigint").alias("Offset"),
            F.coalesce("text", F.lit("")).alias("Text"),
        )
        columns.append(F.to_json(entry).alias("line"))
    table = rows.select(*columns)
    if not in_runs:
        count = range_count(rows.sparkSession, rows.count() * schema.record_bytes(dim))
        table = table.repartitionByRange(count, "pos").sortWithinPartitions("pos")
    writer = table.write.format(FORMAT).mode("append").option("dim", dim)
    writer.option("first", first).save(path)
