"""Vector bin packing of token sequences under several limits at once.

A sequence (bin) has a capacity in tokens, in segments and in loss-bearing tokens; a
segment (item) demands some of each.  The dot-product heuristic fills one bin at a
time: of the waiting items that fit, the one whose demand has the largest dot product
with what is left of the bin goes in, all in shares of the capacity, so a bin short of
one resource takes items that are light on it.  What no waiting item fills is filled
by cutting one, where cutting is allowed.

Each task packs the rows it scans, in their order, with a buffer of ``WAITING`` items:
nothing is shuffled, a hot source is spread like any other, and a repeated task gives
the same bins.  A task's last bins are cut at powers of two, which need no padding.

Defined cases: a null or empty text is its end id alone; a text longer than a bin is
cut into whole bins and a rest; repeated rows are packed each; an empty table gives no
piece; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vexel.llm.common import steps, text_column
from vexel.llm.word_tokens import ENCODE_BYTES, encoder

#: Items that wait for a bin in each task.
WAITING = 1_024
END_ID = 1


@dataclass(frozen=True)
class Limits:
    tokens: int = 2_048
    segments: int = 128
    loss_tokens: int = 2_048

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.segments, self.loss_tokens], float)


@dataclass
class Piece:
    """Ids ``start`` to ``start + length`` of an item; loss counts from loss_from."""

    item: int
    start: int
    length: int
    loss_from: int

    def loss(self) -> int:
        return max(0, self.start + self.length - max(self.start, self.loss_from))

    def cut(self, size: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.item, self.start, size, self.loss_from),
            Piece(self.item, self.start + size, self.length - size, self.loss_from),
        )


class Packer:
    """Gives bins, each a list of pieces, as items are added."""

    def __init__(self, limits: Limits, cut: bool = True, waiting: int = WAITING):
        self.limits = limits
        self.capacity = limits.vector()
        self.may_cut = cut
        self.waiting = waiting
        self.pieces: list[Piece] = []
        self.demand = np.zeros((2 * waiting + 2, 3))
        self.used = 0

    def add(self, item: int, length: int, loss_from: int = 0) -> Iterator[list[Piece]]:
        rest = Piece(item, 0, length, loss_from)
        if not self.may_cut and (
            length > self.limits.tokens or rest.loss() > self.limits.loss_tokens
        ):
            raise ValueError(f"an item of {length} tokens fits no bin")
        # A whole bin needs no company, if the other limits allow it alone.
        whole = min(self.limits.tokens, self.limits.loss_tokens)
        while rest.length >= self.limits.tokens and self.may_cut:
            head, rest = rest.cut(self.limits.tokens)
            if head.loss() <= self.limits.loss_tokens:
                yield [head]
            else:
                while head.length:
                    part, head = head.cut(min(whole, head.length))
                    self._wait(part)
        if rest.length:
            while self.may_cut and rest.loss() > self.limits.loss_tokens:
                part, rest = rest.cut(whole)
                self._wait(part)
            self._wait(rest)
        while self.used > self.waiting:
            yield self._bin()

    def finish(self) -> Iterator[list[Piece]]:
        while self.used:
            pieces = self._bin()
            total = sum(p.length for p in pieces)
            if total == self.limits.tokens or not self.may_cut:
                yield pieces
            else:
                yield from _powers_of_two(pieces, total)

    def _wait(self, piece: Piece) -> None:
        if self.used == len(self.demand):
            self.demand = np.concatenate([self.demand, np.zeros_like(self.demand)])
        self.demand[self.used] = (piece.length, 1, piece.loss())
        self.pieces.append(piece)
        self.used += 1

    def _take(self, place: int) -> Piece:
        """Remove one waiting item; the last takes its place."""
        piece = self.pieces[place]
        self.used -= 1
        self.pieces[place] = self.pieces[self.used]
        self.pieces.pop()
        self.demand[place] = self.demand[self.used]
        return piece

    def _bin(self) -> list[Piece]:
        pieces: list[Piece] = []
        left = self.capacity.copy()
        while self.used and left[0] > 0 and left[1] > 0:
            demand = self.demand[: self.used]
            fits = (demand <= left).all(axis=1)
            if fits.any():
                value = demand @ (left / self.capacity**2)
                place = int(np.where(fits, value, -1.0).argmax())
                piece = self._take(place)
            elif self.may_cut:
                place = int(demand[:, 0].argmax())
                size = int(left[0])
                head = self.pieces[place].cut(size)[0]
                if head.loss() > left[2]:
                    size -= int(head.loss() - left[2])
                if size <= 0:
                    break
                piece, rest = self._take(place).cut(size)
                self._wait(rest)
            else:
                break
            pieces.append(piece)
            left -= (piece.length, 1, piece.loss())
        return pieces


def _powers_of_two(pieces: list[Piece], total: int) -> Iterator[list[Piece]]:
    """The same pieces in order, as sequences whose lengths are powers of two."""
    waiting = pieces[::-1]
    for bit in reversed(range(total.bit_length())):
        if not total >> bit & 1:
            continue
        room, part = 1 << bit, []
        while room:
            piece = waiting.pop()
            if piece.length > room:
                piece, rest = piece.cut(room)
                waiting.append(rest)
            part.append(piece)
            room -= piece.length
        yield part


class _Rows:
    """Packs one task's items and makes the result rows."""

    SCHEMA = (
        "start bigint, length bigint, doc_tokens bigint, sequence_id bigint, "
        "offset bigint, ids binary"
    )

    def __init__(self, key: str, key_type: pa.DataType, packer: Packer, task: int):
        self.key, self.key_type, self.packer = key, key_type, packer
        self.items: dict[int, list] = {}
        self.number = 0
        self.sequence = task << 32
        self.rows: list[tuple] = []

    def add(self, key, ids: np.ndarray, loss_from: int) -> None:
        self.items[self.number] = [key, ids, 0]
        bins = self.packer.add(self.number, len(ids), loss_from)
        self.number += 1
        for pieces in bins:
            self._emit(pieces)

    def finish(self) -> None:
        for pieces in self.packer.finish():
            self._emit(pieces)

    def _emit(self, pieces: list[Piece]) -> None:
        offset = 0
        for piece in pieces:
            item = self.items[piece.item]
            key, ids, done = item
            part = ids[piece.start : piece.start + piece.length].astype("<u4")
            self.rows.append(
                (key, piece.start, piece.length, len(ids), self.sequence, offset,
                 part.tobytes())
            )
            offset += piece.length
            item[2] = done + piece.length
            if item[2] == len(ids):
                del self.items[piece.item]
        self.sequence += 1

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [()] * 7
        self.rows = []
        kinds = [self.key_type] + [pa.int64()] * 5 + [pa.binary()]
        names = [self.key, "start", "length", "doc_tokens", "sequence_id", "offset"]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=[*names, "ids"],
        )


def pack_texts(
    docs: DataFrame,
    vocabulary: str,
    end_id: int = END_ID,
    limits: Limits = Limits(),
    cut: bool = True,
    key: str = "doc_id",
    text: str = "text",
    prompt: str | None = None,
) -> DataFrame:
    """Pieces of all texts, each with its place in a sequence and its ids.

    ``ids`` are little-endian unsigned 32-bit ids.  ``prompt`` names a column with the
    part before the text that bears no loss; its ids come first.
    """
    columns = [F.col(key).alias(key), F.col(text).alias("__text")]
    if prompt:
        columns.append(F.col(prompt).alias("__prompt"))
    rows = docs.select(*columns)
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(vocabulary)
        out = None
        for batch in batches:
            if out is None:
                packer = Packer(limits, cut)
                key_type = batch.schema.field(key).type
                out = _Rows(key, key_type, packer, TaskContext.get().partitionId())
            texts = text_column(batch, "__text")
            keys = batch.column(key).to_pylist()
            for a, b in steps(texts, ENCODE_BYTES):
                ids, at = words.encode(texts.slice(a, b - a))
                if prompt:
                    head, head_at = words.encode(
                        text_column(batch, "__prompt").slice(a, b - a)
                    )
                for i in range(b - a):
                    parts = [ids[at[i] : at[i + 1]], np.array([end_id], np.uint32)]
                    loss_from = 0
                    if prompt:
                        parts.insert(0, head[head_at[i] : head_at[i + 1]])
                        loss_from = len(parts[0])
                    out.add(keys[a + i], np.concatenate(parts), loss_from)
                    if len(out.rows) >= 1_024:
                        yield out.batch()
        if out is not None:
            out.finish()
            yield out.batch()

    return rows.mapInArrow(run, f"`{key}` {kind}, {_Rows.SCHEMA}")


def vocabulary_path() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def packing_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: packed pieces with their ids."""
    return pack_texts(docs, vocabulary_path())


def op1_packing(spark, sf_dir: str) -> DataFrame:
    """Contract rows of op1."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack_texts(docs, vocabulary_path()).select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


#: Limits of the instruction example: a sequence is full of answers before it is full
#: of tokens.
INSTRUCTION = Limits(tokens=1_024, segments=32, loss_tokens=256)


def conversation_packing(spark, sf_dir: str) -> DataFrame:
    """Turns packed as instruction data: only what the assistant says bears loss.

    A turn is an item of its own, so a conversation of any length is never collected.
    """
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    answer = F.col("role") == "assistant"
    items = turns.select(
        F.struct("conv_id", "turn").alias("item"),
        F.when(answer, "").otherwise(F.col("text")).alias("asked"),
        F.when(answer, F.col("text")).otherwise("").alias("answered"),
    )
    return pack_texts(
        items, vocabulary_path(), limits=INSTRUCTION, key="item", text="answered",
        prompt="asked",
    ).select(
        "item.conv_id", "item.turn", "start", "length", "doc_tokens", "sequence_id",
        "offset", F.crc32("ids").alias("ids_crc32"),
    )
