"""Token-id files with directly addressable codes.

An id is split into chunks of ``WIDTH`` bits.  Level 0 holds the low chunk of every
id; a continuation bitmap says which ids go on, and the next level holds the next
chunk of just those.  The rank directory (ones before each block of the bitmap) tells
where in the next level an id goes on, so any token is read with one chunk and one
rank per level and nothing is decoded around it.

A dataset is a folder of shard files in ascending document order plus a manifest,
written last, that names the shards and the ids before each.  Tasks write under names
of their own attempt; what no manifest names does not count.  Shards are written and
read by tasks; the driver sees one manifest entry per shard.

Shard layout, little-endian: ``HEADER`` (magic, documents, tokens, levels), document
keys (int64), key validity (uint8), token starts (int64, one more than documents),
then per level its size (uint64), chunks, bitmap bytes and rank directory (uint32).

Defined cases: a null text is empty and has the end id alone; documents with a null
id come first; repeated ids are written each, in the order of their texts; an empty
table gives a manifest without shards; other columns are not read.  Ids are BIGINT in
the files: an id that is no whole number is an error.
"""

from __future__ import annotations

import json
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

from vexel.llm.common import conf, steps, text_column
from vexel.llm.packing import vocabulary_path
from vexel.llm.word_tokens import ENCODE_BYTES, encoder
from vexel.session import work_dir

FORMAT = "token_codes"
WIDTH = 8
_BLOCK_BYTES = 64
_MAGIC = b"VXTC"
HEADER = "<4sQQI"
_MANIFEST = "manifest.json"
#: Ids of one shard, about; a longer document stands alone.
SHARD_TOKENS = 2 << 20
END_ID = 2
#: Rows given to a task's Python worker at once: both sides hold a batch whole.
BATCH_ROWS = 2_000
_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)


class Codes:
    """One sequence of ids; every level is (chunks, bitmap, ranks)."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.levels = levels

    @classmethod
    def of(cls, ids: np.ndarray) -> Codes:
        levels, rest = [], ids.astype(np.uint32)
        while True:
            chunk = (rest & ((1 << WIDTH) - 1)).astype(np.uint8)
            rest = rest >> WIDTH
            more = rest > 0
            bitmap = np.packbits(more, bitorder="little")
            pad = -len(bitmap) % _BLOCK_BYTES
            bitmap = np.concatenate([bitmap, np.zeros(pad, np.uint8)])
            ones = _ONES[bitmap].reshape(-1, _BLOCK_BYTES).sum(1, np.int64)
            ranks = (np.cumsum(ones) - ones).astype(np.uint32)
            levels.append((chunk, bitmap, ranks))
            rest = rest[more]
            if not len(rest):
                return cls(levels)

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def get(self, at: np.ndarray) -> np.ndarray:
        """The ids at any places, in any order."""
        at = np.asarray(at, np.int64)
        out = np.zeros(len(at), np.uint32)
        live = np.arange(len(at))
        for number, (chunk, bitmap, ranks) in enumerate(self.levels):
            out[live] |= chunk[at].astype(np.uint32) << np.uint32(WIDTH * number)
            more = (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
            live, at = live[more], at[more]
            if not len(at):
                break
            at = _rank(bitmap, ranks, at)
        return out

    def between(self, start: int, stop: int) -> np.ndarray:
        """A run of ids: contiguous in every level."""
        out = np.zeros(stop - start, np.uint32)
        live = np.arange(stop - start)
        for number, (chunk, bitmap, ranks) in enumerate(self.levels):
            if start >= stop:
                break
            out[live] |= chunk[start:stop].astype(np.uint32) << np.uint32(
                WIDTH * number
            )
            first = start >> 3
            bits = np.unpackbits(bitmap[first : (stop + 7) >> 3], bitorder="little")
            more = bits[start - 8 * first : stop - 8 * first] > 0
            live = live[more]
            if not len(live):
                break
            start = int(_rank(bitmap, ranks, np.array([start]))[0])
            stop = start + len(live)
        return out

    def to_bytes(self) -> bytes:
        parts = []
        for chunk, bitmap, ranks in self.levels:
            parts += [
                struct.pack("<Q", len(chunk)),
                chunk.tobytes(),
                bitmap.tobytes(),
                ranks.astype("<u4").tobytes(),
            ]
        return b"".join(parts)

    @classmethod
    def from_bytes(cls, raw: bytes, levels: int, at: int = 0) -> Codes:
        found = []
        for _ in range(levels):
            (size,) = struct.unpack_from("<Q", raw, at)
            at += 8
            blocks = -(-size // (8 * _BLOCK_BYTES))
            chunk = np.frombuffer(raw, np.uint8, size, at)
            at += size
            bitmap = np.frombuffer(raw, np.uint8, blocks * _BLOCK_BYTES, at)
            at += blocks * _BLOCK_BYTES
            found.append((chunk, bitmap, np.frombuffer(raw, "<u4", blocks, at)))
            at += 4 * blocks
        return cls(found)


def _rank(bitmap: np.ndarray, ranks: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Ones of the bitmap before each place."""
    block = at // (8 * _BLOCK_BYTES)
    out = ranks[block].astype(np.int64)
    byte = at >> 3
    inside = bitmap[block[:, None] * _BLOCK_BYTES + np.arange(_BLOCK_BYTES)]
    before = np.arange(_BLOCK_BYTES) < (byte - block * _BLOCK_BYTES)[:, None]
    out += (_ONES[inside] * before).sum(1, np.int64)
    low = (bitmap[byte] & ((1 << (at & 7)) - 1)).astype(np.uint8)
    return out + _ONES[low]


@dataclass
class Shard:
    keys: np.ndarray
    valid: np.ndarray
    starts: np.ndarray
    codes: Codes

    def to_bytes(self) -> bytes:
        head = struct.pack(
            HEADER, 
            _MAGIC, len(self.keys), int(self.starts[-1]), len(self.codes.levels)
        )
        return b"".join(
            [
                head,
                self.keys.astype("<i8").tobytes(),
                self.valid.astype(np.uint8).tobytes(),
                self.starts.astype("<i8").tobytes(),
                self.codes.to_bytes(),
            ]
        )

    @classmethod
    def from_bytes(cls, raw: bytes) -> Shard:
        magic, n, tokens, levels = struct.unpack_from(HEADER, raw)
        if magic != _MAGIC:
            raise ValueError("not a token-code shard")
        at = struct.calcsize(HEADER)
        keys = np.frombuffer(raw, "<i8", n, at)
        valid = np.frombuffer(raw, np.uint8, n, at + 8 * n)
        starts = np.frombuffer(raw, "<i8", n + 1, at + 9 * n)
        at += 9 * n + 8 * (n + 1)
        if starts[-1] != tokens:
            raise ValueError("a token-code shard is broken")
        return cls(keys, valid, starts, Codes.from_bytes(raw, levels, at))


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    # Spark's name for the object store that Arrow calls s3.
    return pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


@dataclass
class _Written(WriterCommitMessage):
    task: int
    shards: list


class _Writer(DataSourceArrowWriter):
    """Encodes rows (key, text) in their order; one Python worker per task."""

    def __init__(
        self, path: str, vocabulary: str, end_id: int, shard_tokens: int
    ) -> None:
        self.path, self.vocabulary = path, vocabulary
        self.end_id, self.shard_tokens = end_id, shard_tokens

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        from pyspark import TaskContext

        filesystem, root = _open(self.path)
        task = TaskContext.get().partitionId()
        attempt = uuid.uuid4().hex
        words = encoder(self.vocabulary)
        shards: list[dict] = []
        keys: list[pa.Array] = []
        ids: list[np.ndarray] = []
        sizes: list[np.ndarray] = []

        def put() -> None:
            if not keys:
                return
            key = pa.concat_arrays(keys)
            ends = np.cumsum(np.concatenate(sizes))
            shard = Shard(
                key.fill_null(0).to_numpy(),
                key.is_valid().to_numpy(zero_copy_only=False),
                np.concatenate([[0], ends]),
                Codes.of(np.concatenate(ids)),
            )
            name = f"part-{task:07d}-{len(shards):05d}-{attempt}.tok"
            with filesystem.open_output_stream(f"{root}/{name}") as stream:
                stream.write(shard.to_bytes())
            shards.append(
                {"name": name, "documents": len(key), "tokens": int(ends[-1])}
            )
            keys.clear(), ids.clear(), sizes.clear()
            pa.default_memory_pool().release_unused()

        for batch in iterator:
            texts = text_column(batch, "text")
            for a, b in steps(texts, ENCODE_BYTES):
                found, at = words.encode(texts.slice(a, b - a))
                # The end id goes behind each text's last.
                ids.append(np.insert(found, at[1:], self.end_id))
                sizes.append(np.diff(at) + 1)
                keys.append(batch.column("key").slice(a, b - a))
                if sum(map(len, ids)) >= self.shard_tokens:
                    put()
        put()
        return _Written(task, shards)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        filesystem, root = _open(self.path)
        found, before = [], 0
        for message in sorted((m for m in messages if m), key=lambda m: m.task):
            for shard in message.shards:
                found.append(shard | {"before": before})
                before += shard["tokens"]
        with filesystem.open_output_stream(f"{root}/{_MANIFEST}") as stream:
            stream.write(json.dumps({"width": WIDTH, "shards": found}).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """Nothing to undo: without a manifest there is no dataset."""


class _Part(InputPartition):
    def __init__(self, name: str, before: int) -> None:
        self.name, self.before = name, before


class _Reader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path = path

    def partitions(self) -> list[InputPartition]:
        filesystem, root = _open(self.path)
        with filesystem.open_input_stream(f"{root}/{_MANIFEST}") as stream:
            shards = json.loads(stream.read())["shards"]
        return [_Part(s["name"], s["before"]) for s in shards] or [_Part("", 0)]

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        filesystem, root = _open(self.path)
        with filesystem.open_input_file(f"{root}/{partition.name}") as stream:
            shard = Shard.from_bytes(stream.read())
        for a in range(0, len(shard.keys), 256):
            b = min(a + 256, len(shard.keys))
            at = shard.starts[a : b + 1]
            ids = shard.codes.between(int(at[0]), int(at[-1])).astype("<u4").tobytes()
            offsets = 4 * (at - at[0])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shard.keys[a:b], mask=shard.valid[a:b] == 0),
                    pa.array(at[:-1] + partition.before),
                    pa.array(np.diff(at)),
                    pa.array(
                        [
                            ids[x:y]
                            for x, y in zip(offsets, offsets[1:], strict=False)
                        ],
                        pa.binary(),
                    ),
                ],
                names=["key", "start", "n_tokens", "ids"],
            )


class TokenCodes(DataSource):
    """``spark.read/write.format("token_codes")``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        return "key bigint, start bigint, n_tokens bigint, ids binary"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"])

    def writer(self, schema, overwrite) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("token_codes writes to a new folder only")
        filesystem, root = _open(self.options["path"])
        if filesystem.get_file_info(root).type != pafs.FileType.NotFound:
            raise FileExistsError(root)
        filesystem.create_dir(root, recursive=True)
        return _Writer(
            self.options["path"],
            self.options["vocabulary"],
            int(self.options["endId"]),
            int(self.options.get("shardTokens", SHARD_TOKENS)),
        )


def write_token_codes(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    end_id: int = END_ID,
    key: str = "doc_id",
    text: str = "text",
    shard_tokens: int = SHARD_TOKENS,
) -> None:
    """Encode ``docs`` in ascending key order into a new folder."""
    docs.sparkSession.dataSource.register(TokenCodes)
    ordered = (
        docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
        .repartitionByRange("key")
        .sortWithinPartitions("key", "text")
    )
    writer = ordered.write.format(FORMAT).mode("append")
    writer = writer.option("vocabulary", vocabulary).option("endId", end_id)
    writer = writer.option("shardTokens", shard_tokens)
    rows = {"spark__sql__execution__arrow__maxRecordsPerBatch": str(BATCH_ROWS)}
    with conf(docs.sparkSession, **rows):
        writer.save(path)


def read_token_codes(spark: SparkSession, path: str) -> DataFrame:
    """(key, start, n_tokens, ids), one row per document."""
    spark.dataSource.register(TokenCodes)
    return spark.read.format(FORMAT).load(path)


def op10_token_codes(spark, sf_dir: str) -> DataFrame:
    """Contract rows of op10, from the files."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = work_dir(spark, "token-codes")
    write_token_codes(docs, path, vocabulary_path())
    return read_token_codes(spark, path).select(
        F.col("key").alias("doc_id"),
        "start",
        "n_tokens",
        F.crc32("ids").alias("ids_crc32"),
    )
