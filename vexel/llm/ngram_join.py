"""Jaccard join of documents on word n-grams, rare n-grams first.

A document is the set of its distinct ``width``-word shingles; two documents link when
``100 * intersection >= percent * union``.  All sets are ordered by one global order,
rare shingles first.  Two linked sets then share a shingle among the first few of each
(prefix filter), so sets meet only on those; a meeting counts only if the sizes allow a
link (length filter), if enough shingles follow on both sides (positional filter) and
if the sizes of the sets' parts, told apart by hash, add up to the overlap needed
(suffix filter, first with few parts of every set that meets another, then with parts of
one or two shingles of the sets whose pairs are left).  Each pair that is left is compared
once, on whole sets.

Rarity is the number of documents with a shingle of the same hash class
(``2 ** CLASS_BITS`` classes, counted over all documents): any total order gives the
same links, this one only decides how few candidates there are, and its table has a
fixed size.  Shingles with equal counts are ordered by hash.

Equal sets are one node, so a group of copies costs one comparison.  Of a group of near
copies only as many links are made as hold it together: on each shingle the node with
the fewest rarer shingles before it, which the positional bound favours most, is
compared with all others of about its size; the links found are contracted to groups,
and then the pairs of different groups are compared, all of them.  Pairs that already
hang together are left out, no others.  :func:`similar_pairs` leaves out none.

Defined cases: null texts and texts without words have no shingles and link with
nothing, not even each other; fewer words than ``width`` make one shingle; repeated ids
are told apart by row, and a component's id is its smallest id; a null id takes part
but is no component's id, unless no member has another; an empty table gives an empty
result; only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from vexel.llm.common import (
    WHITESPACE,
    conf,
    drop_stage,
    stage,
    steps,
    text_column,
    value_offsets,
)
from vexel.llm.components import connected_components

WIDTH = 5
PERCENT = 80
#: Classes of shingles by hash whose documents are counted: 4 MB of counters.
CLASS_BITS = 20
_COUNTERS_A_ROW = 1 << 12
#: Parts of a set for the suffix filter.
PARTS = 16
#: Shingles a small part of a set has at most on average; a half byte counts them.
_PART_MEMBERS = 2
#: Bits of the maps that keep what meets nothing out of a shuffle: 8 MB each.
_MAP_BITS = 26
#: Bits of a shingle that are compared when it is asked which ones meet at all.
_KEY_BITS = 40
#: Pairs of sets that a task's Python worker is given at once.
BATCH_PAIRS = 500
_STEP_BYTES = 2 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_BASE = 0xD6E8FEB86659FD93
_SEED = 42


# --- sets -----------------------------------------------------------------------


def _scramble(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX
    return h ^ (h >> np.uint64(31))


def _byte_signs() -> np.ndarray:
    """A number per byte; a capital letter has that of its small one."""
    byte = np.arange(256)
    small = np.where((byte >= ord("A")) & (byte <= ord("Z")), byte + 32, byte)
    return _scramble((small.astype(np.uint64) + np.uint64(1)) * _ODD)


_SIGNS_OF_BYTES = _byte_signs()
_SPACES = np.isin(np.arange(256), list(WHITESPACE))


def _chained(words: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    """One hash for the ``count`` words from each start."""
    h = np.full(len(starts), count, np.uint64)
    for k in range(count):
        h = _scramble((h + words[starts + k]) * _ODD)
    return h


_known_powers: dict[int, np.ndarray] = {}


def _powers(base: int, count: int) -> np.ndarray:
    known = _known_powers.get(base)
    if known is None or len(known) < count:
        known = np.full(max(count, _STEP_BYTES), base, np.uint64)
        known[:1] = 1
        known = np.multiply.accumulate(known)
        if len(known) == _STEP_BYTES:  # those of a very long word are not kept
            _known_powers[base] = known
    return known[:count]


def _word_hashes(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash per word of the texts ``raw[at[i]:at[i + 1]]``, and where each text's start.

    A word's hash is a polynomial of its bytes, taken from running sums over all bytes
    and moved to the word's start, so there is no step per word.
    """
    filled = ~_SPACES[raw]
    begin, stop = filled.copy(), filled.copy()
    begin[1:] &= ~filled[:-1]
    stop[:-1] &= ~filled[1:]
    full = np.diff(at) > 0
    first, last = at[:-1][full], at[1:][full] - 1
    begin[first], stop[last] = filled[first], filled[last]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    out = np.empty(len(starts), np.uint64)
    done = 0
    while done < len(starts):
        # Some words of about a megabyte, so that the sums stay small.
        low = starts[done]
        stop_at = max(done + 1, int(np.searchsorted(ends, low + _STEP_BYTES // 2, "right")))
        high = ends[stop_at - 1]
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(_SIGNS_OF_BYTES[raw[low:high]] * _powers(_BASE, high - low), out=sums[1:])
        a, b = starts[done:stop_at] - low, ends[done:stop_at] - low
        moved = (sums[b] - sums[a]) * _powers(pow(_BASE, -1, 1 << 64), high - low)[a]
        out[done:stop_at] = _scramble(moved + (b - a).astype(np.uint64) * _ODD)
        done = stop_at
    return out, np.searchsorted(starts, at)


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and where each text's start."""
    offsets = value_offsets(texts)
    buffer = texts.buffers()[2]
    raw = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    words, ends = _word_hashes(raw[offsets[0] : offsets[-1]], offsets - offsets[0])
    sizes = np.diff(ends)
    hashes, owners = [], []
    for count in range(1, width + 1):
        if count < width:
            docs = np.flatnonzero(sizes == count)
            starts = ends[docs]
        else:
            # Every place with a whole shingle of one text behind it.
            runs = np.maximum(sizes - width + 1, 0)
            docs = np.repeat(np.arange(len(sizes)), runs)
            first = np.cumsum(runs) - runs
            starts = ends[docs] + np.arange(len(docs)) - first[docs]
        hashes.append(_chained(words, starts, count))
        owners.append(docs)
    # A short text has one shingle and stands in one of the lists alone.
    amounts = np.where(sizes < width, np.minimum(sizes, 1), sizes - width + 1)
    at = np.concatenate([[0], np.cumsum(amounts)])
    h = np.empty(at[-1], np.uint64)
    for found, docs in zip(hashes[:-1], owners[:-1], strict=True):
        h[at[docs]] = found
    docs = owners[-1]
    h[at[docs] + np.arange(len(docs)) - (np.cumsum(runs) - runs)[docs]] = hashes[-1]
    cuts = at.tolist()
    for a, b in zip(cuts, cuts[1:], strict=False):
        h[a:b].sort()
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    new[at[:-1][amounts > 0]] = True
    return h[new], np.concatenate([[0], np.cumsum(new)])[at]


def _each_set(docs: DataFrame, text: str, width: int, columns: list[Column], schema: str, make):
    """``docs`` through ``make(batch rows, hashes, offsets)`` in bounded steps."""
    rows = docs.select(*columns, F.col(text).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = make()
        for batch in batches:
            texts = text_column(batch, "__text")
            for a, b in steps(texts, _STEP_BYTES):
                h, at = shingle_sets(texts.slice(a, b - a), width)
                found = state.step(batch.slice(a, b - a), h, at)
                if found is not None:
                    yield found
        yield from state.finish()

    return rows.mapInArrow(run, schema)


class _Sets:
    """What is done with a step of sets; subclasses give rows."""

    def step(self, rows: pa.RecordBatch, h: np.ndarray, at: np.ndarray):
        raise NotImplementedError

    def finish(self) -> Iterator[pa.RecordBatch]:
        return iter(())


def _digests(h: np.ndarray, at: np.ndarray) -> list[tuple[int, int]]:
    """A 128-bit digest of each set, as two signed numbers; (0, 0) if it is empty."""
    out = []
    raw = memoryview(h.view(np.uint8))
    cuts = (8 * at).tolist()
    for a, b in zip(cuts, cuts[1:], strict=False):
        d = xxhash.xxh3_128_digest(raw[a:b], _SEED) if b > a else bytes(16)
        out.append((int.from_bytes(d[:8], "little", signed=True),
                    int.from_bytes(d[8:], "little", signed=True)))
    return out


def _parts(h: np.ndarray, at: np.ndarray) -> pa.Array:
    """How many members of each set are in each of ``PARTS`` hash classes."""
    rows = len(at) - 1
    place = np.repeat(np.arange(rows) * PARTS, np.diff(at))
    place += (h & np.uint64(PARTS - 1)).astype(np.int64)
    sizes = np.bincount(place, minlength=rows * PARTS).astype(np.int32)
    ends = np.arange(0, rows * PARTS + 1, PARTS, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(sizes))


def _small_parts(h: np.ndarray) -> bytes | None:
    """How many members of a set are in each of its small parts, a half byte each.

    Their number is a power of two that follows the set's size, so those of a longer set
    add up to those of a shorter one.  None if a count does not fit.
    """
    size = PARTS
    while size * _PART_MEMBERS < len(h):
        size *= 2
    counts = np.bincount((h & np.uint64(size - 1)).astype(np.int64), minlength=size)
    if counts.max() > 15:
        return None
    return (counts[0::2] | counts[1::2] << 4).astype(np.uint8).tobytes()


def _part_sizes(raw: bytes) -> np.ndarray:
    packed = np.frombuffer(raw, np.uint8)
    return np.stack([packed & 15, packed >> 4], axis=1).ravel().astype(np.int64)


def most_common(a: bytes, b: bytes) -> int:
    """The most members that two sets with these small parts can share."""
    x, y = _part_sizes(a), _part_sizes(b)
    size = min(len(x), len(y))
    x, y = (z.reshape(-1, size).sum(axis=0) for z in (x, y))
    return int(np.minimum(x, y).sum())


_SIGNS = (
    "key {kind}, node bigint, other bigint, n bigint, parts array<int>, small binary, "
    "part bigint, counts binary"
)


def marks(docs: DataFrame, key: str, text: str, width: int = WIDTH) -> DataFrame:
    """(key, node, other, n, parts, small) of each row: its set's digest in two halves,
    its size, and the sizes of its parts and small parts by hash.

    At its end a task also gives its counters of shingle classes, in rows with ``part``
    and ``counts``, so that the texts are read once for both.
    """
    kind = docs.select(key).schema[0].dataType

    class Marks(_Sets):
        def __init__(self) -> None:
            self.counts = np.zeros(1 << CLASS_BITS, np.uint32)
            self.key_type = to_arrow_type(kind)

        def rows(self, key, node, other, n, parts, small, part, counts):
            return pa.RecordBatch.from_arrays(
                [key, *(pa.array(c, pa.int64()) for c in (node, other, n)), parts,
                 pa.array(small, pa.binary()), pa.array(part, pa.int64()),
                 pa.array(counts, pa.binary())],
                names=["key", "node", "other", "n", "parts", "small", "part", "counts"],
            )

        def step(self, rows, h, at):
            np.add.at(self.counts, (h >> np.uint64(64 - CLASS_BITS)).astype(np.int64), 1)
            digests = _digests(h, at)
            none = [None] * len(digests)
            cuts = at.tolist()
            small = [_small_parts(h[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
            return self.rows(
                rows.column(0), [d[0] for d in digests], [d[1] for d in digests],
                np.diff(at), _parts(h, at), small, none, none,
            )

        def finish(self):
            counters = self.counts.reshape(-1, _COUNTERS_A_ROW)
            used = np.flatnonzero(counters.any(axis=1))
            for a in range(0, len(used), 64):
                some = used[a : a + 64]
                none = [None] * len(some)
                yield self.rows(
                    pa.nulls(len(some), self.key_type), none, none, none,
                    pa.nulls(len(some), pa.list_(pa.int32())), none, some,
                    [counters[i].tobytes() for i in some],
                )

    schema = _SIGNS.format(kind=kind.simpleString())
    return _each_set(docs, text, width, [F.col(key).alias("key")], schema, Marks)


# --- rare first -----------------------------------------------------------------


def class_counts(marked: DataFrame) -> np.ndarray:
    """Documents per hash class of shingles: a table of fixed size, added up by tasks."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One running array per part, however many tasks counted.
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                mine = np.frombuffer(raw, np.uint32)
                if part in total:
                    total[part] += mine
                else:
                    total[part] = mine.astype(np.uint64)
        for part, counts in total.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int64()),
                    pa.array([np.minimum(counts, 0xFFFFFFFF).astype(np.uint32).tobytes()]),
                ],
                names=["part", "counts"],
            )

    found = marked.where("part IS NOT NULL").select("part", "counts").repartition("part")
    out = np.zeros(1 << CLASS_BITS, np.uint32)
    for row in found.mapInArrow(add, "part bigint, counts binary").toLocalIterator():
        at = row["part"] * _COUNTERS_A_ROW
        out[at : at + _COUNTERS_A_ROW] = np.frombuffer(row["counts"], np.uint32)
    return out


def needed(x: Column, y: Column, percent: int) -> Column:
    """The least overlap that links sets of these sizes."""
    both = x.cast("bigint") + y.cast("bigint")
    return F.floor((both * percent + (99 + percent)) / (100 + percent))


def prefix_sizes(n: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """How many shingles a set looks up among shorter sets, and how many it is found by.

    The longer set of a link shares at least ``percent`` of its own size, the shorter
    one the overlap that two sets of its size would need.
    """
    probe = n - -(-n * percent // 100) + 1
    index = n - -(-2 * n * percent // (100 + percent)) + 1
    return probe, index


class _Bits:
    """A set of 64-bit numbers by their low bits; may say yes too often, never no."""

    def __init__(self, numbers: DataFrame) -> None:
        spark = numbers.sparkSession
        bit = F.col(numbers.columns[0]).bitwiseAND(F.lit((1 << _MAP_BITS) - 1))
        rows = (
            numbers.select(bit.alias("bit"))
            .groupBy(F.shiftright("bit", 15).alias("part"))
            .agg(F.bitmap_construct_agg(F.col("bit") % (1 << 15)).alias("bits"))
        )
        held = np.zeros(1 << (_MAP_BITS - 3), np.uint8)
        for row in rows.toLocalIterator():
            at = row["part"] << 12
            held[at : at + 4096] = np.frombuffer(row["bits"], np.uint8)
        self._sent = spark.sparkContext.broadcast(held)

    def have(self, numbers: np.ndarray) -> np.ndarray:
        bit = (numbers.view(np.uint64) & np.uint64((1 << _MAP_BITS) - 1)).astype(np.int64)
        return (self._sent.value[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 > 0


def prefixes(
    docs: DataFrame, text: str, counts, width: int, percent: int, shared: _Bits | None = None
) -> DataFrame:
    """(shingle, node, n, pos, found) of the first shingles of each set.

    A task gives the copies of a set once; of shingles that are not ``shared``, none.
    """

    class Prefixes(_Sets):
        def __init__(self) -> None:
            self.seen: set[int] = set()

        def step(self, rows, h, at):
            n = np.diff(at)
            nodes = np.array([d[0] for d in _digests(h, at)], np.int64)
            rarity = counts.value[(h >> np.uint64(64 - CLASS_BITS)).astype(np.int64)]
            probe, index = prefix_sizes(n, percent)
            taken, docs = [], []
            cuts = at.tolist()
            for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                node = int(nodes[i])
                if a == b or node in self.seen:
                    continue
                self.seen.add(node)
                # The hashes ascend, so equal counts stay in their order.
                taken.append(a + rarity[a:b].argsort(kind="stable")[: probe[i]])
                docs.append(i)
            if not docs:
                return None
            doc = np.repeat(docs, [len(t) for t in taken])
            pos = np.concatenate([np.arange(len(t)) for t in taken])
            key = h[np.concatenate(taken)]
            if shared is not None:
                keep = shared.have(key >> np.uint64(64 - _KEY_BITS))
                doc, pos, key = doc[keep], pos[keep], key[keep]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(key.view(np.int64)),
                    pa.array(nodes[doc]),
                    pa.array(n[doc].astype(np.int32)),
                    pa.array(pos.astype(np.int32)),
                    pa.array((pos < index[doc]).astype(np.int32)),
                ],
                names=["shingle", "node", "n", "pos", "found"],
            )

    schema = "shingle bigint, node bigint, n int, pos int, found int"
    return _each_set(docs, text, width, [], schema, Prefixes)


def _meetings(docs: DataFrame, text: str, counts, width: int, percent: int) -> DataFrame:
    """The entries on whose shingle two sets can meet, each once.

    Most shingles occur in one text.  So a first shuffle moves nothing but a part of
    each shingle's hash and how often it stands there; a map of those that stand there
    twice keeps nearly all others out of the second, which moves whole entries.
    """
    entries = prefixes(docs, text, counts, width, percent)
    key = F.shiftrightunsigned("shingle", 64 - _KEY_BITS)
    # The count and, above it, how many can be found by it, in one number.
    seen = entries.select(
        key.alias("key"), (F.lit(1) + F.col("found") * F.lit(1 << 32)).alias("one")
    )
    often = seen.groupBy("key").agg(F.sum("one").alias("many"))
    often = often.where(((F.col("many") % (1 << 32)) > 1) & (F.col("many") >= 1 << 32))
    shared = _Bits(often.select("key"))
    raw = stage(prefixes(docs, text, counts, width, percent, shared), "entries")
    once = raw.groupBy("shingle", "node").agg(
        F.min("n").alias("n"), F.min("pos").alias("pos"), F.max("found").alias("found")
    )
    once = stage(once, "entries")
    meet = (
        once.groupBy("shingle")
        .agg(
            F.min("node").alias("a"), F.max("node").alias("b"), F.max("found").alias("f")
        )
        .where("a <> b and f = 1")
        .select("shingle")
    )
    out = stage(once.join(meet, "shingle"), "meetings")
    drop_stage(raw, once)
    return out


def _whole_sets(docs: DataFrame, text: str, width: int, wanted: DataFrame) -> DataFrame:
    """(node, members) of the ``wanted`` nodes.

    A map of them keeps most other sets out of the shuffle; the join then keeps the
    right ones.  They are not written: joins by node take them from that one shuffle.
    """
    mapped = _Bits(wanted)

    class Members(_Sets):
        def __init__(self) -> None:
            self.seen: set[int] = set()

        def step(self, rows, h, at):
            nodes = np.array([d[0] for d in _digests(h, at)], np.int64)
            likely = mapped.have(nodes) & (np.diff(at) > 0)
            found, members = [], []
            for i in np.flatnonzero(likely).tolist():
                node = int(nodes[i])
                if node not in self.seen:
                    self.seen.add(node)
                    found.append(node)
                    members.append(h[at[i] : at[i + 1]].tobytes())
            if not found:
                return None
            return pa.RecordBatch.from_arrays(
                [pa.array(found, pa.int64()), pa.array(members, pa.binary())],
                names=["node", "members"],
            )

    found = _each_set(docs, text, width, [], "node bigint, members binary", Members)
    return found.join(wanted, "node", "left_semi").dropDuplicates(["node"])


def _small_parts_of(marked: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, small) of the ``wanted`` nodes, as :func:`_whole_sets`."""
    mapped = _Bits(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # a task gives the copies of a set once
        for batch in batches:
            nodes = batch.column("node").to_numpy()
            found = []
            for i in np.flatnonzero(mapped.have(nodes)).tolist():
                if nodes[i] not in seen:
                    seen.add(nodes[i])
                    found.append(i)
            yield batch.take(pa.array(found, pa.int64()))

    found = marked.where("n > 0").select("node", "small")
    found = found.mapInArrow(run, "node bigint, small binary")
    return found.join(wanted, "node", "left_semi").dropDuplicates(["node"])


# --- pairs ----------------------------------------------------------------------


def _nodes(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()


def _joined(pairs: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
    """``pairs (u, v)`` with columns of both nodes."""
    for name in ("v", "u"):
        side = table.select(
            F.col("node").alias(name), *(F.col(c).alias(f"{name}_{c}") for c in columns)
        )
        pairs = pairs.join(side, name)
    return pairs


def _closer(pairs: DataFrame, ready: _Prepared) -> DataFrame:
    """Those of ``pairs (u, v, least)`` whose small parts allow the overlap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v, least = (batch.column(c).to_pylist() for c in ("u_small", "v_small", "least"))
            keep = [
                a is None or b is None or most_common(a, b) >= n
                for a, b, n in zip(u, v, least, strict=True)
            ]
            yield batch.select(["u", "v", "least"]).filter(pa.array(keep, pa.bool_()))

    both = _joined(pairs, _small_parts_of(ready.marked, _nodes(pairs)), "small")
    small = {"spark__sql__execution__arrow__maxRecordsPerBatch": str(BATCH_PAIRS)}
    with conf(ready.docs.sparkSession, **small):
        return stage(both.mapInArrow(run, "u bigint, v bigint, least bigint"), "closer")


def _compare(pairs: DataFrame, ready: _Prepared, percent: int) -> DataFrame:
    """(u, v, overlap) of the linked among ``pairs (u, v)``, each compared once."""
    sized = _joined(pairs, ready.sizes, "n", "parts")
    most = F.aggregate(
        F.zip_with("u_parts", "v_parts", lambda a, b: F.least(a, b)),
        F.lit(0), lambda a, b: a + b,
    )
    # The suffix filter, with parts that are few and then with small ones.
    likely = stage(
        sized.withColumn("least", needed(F.col("u_n"), F.col("v_n"), percent))
        .where(most >= F.col("least"))
        .select("u", "v", "least"),
        "likely",
    )
    closer = _closer(likely, ready)
    # Only the sets that are left to compare are made again and shuffled.
    whole = _joined(closer, ready.sets_of(_nodes(closer)), "members")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, overlap = [], []
            u, v = batch.column("u_members"), batch.column("v_members")
            for i, least in enumerate(batch.column("least").to_pylist()):
                a = np.frombuffer(u[i].as_buffer(), np.uint64)
                b = np.frombuffer(v[i].as_buffer(), np.uint64)
                both = np.sort(np.concatenate([a, b]))
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                if common >= least:
                    keep.append(i)
                    overlap.append(common)
            some = batch.select(["u", "v"]).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*some.columns, pa.array(overlap, pa.int64())], names=["u", "v", "overlap"]
            )

    # Two whole sets a row: fewer rows at a time than usual.
    small = {"spark__sql__execution__arrow__maxRecordsPerBatch": str(BATCH_PAIRS)}
    with conf(pairs.sparkSession, **small):
        links = stage(
            whole.mapInArrow(run, "u bigint, v bigint, overlap bigint"), "links"
        )
    drop_stage(likely, closer)
    return links


def _size_class(percent: int) -> Column:
    """Sets whose sizes allow a link are in one class or in neighbouring ones."""
    return F.floor(F.log(F.col("n")) / F.log(F.lit(100.0 / percent)) + 1e-9)


def _can_link(percent: int) -> Column:
    """Length and positional filter of a longer set x and a shorter or equal one y."""
    follow = F.least(F.col("x_n") - F.col("x_pos"), F.col("y_n") - F.col("y_pos"))
    return (F.col("y_n") * 100 >= F.col("x_n") * percent) & (
        follow >= needed(F.col("x_n"), F.col("y_n"), percent)
    )


def _ordered(percent: int) -> Column:
    """x is longer than y, or of the same size and behind it."""
    return F.struct(F.col("x_n"), F.col("x")) > F.struct(F.col("y_n"), F.col("y"))


def _renamed(entries: DataFrame, name: str, *keys: str) -> DataFrame:
    return entries.select(
        *keys, F.col("node").alias(name), F.col("n").alias(f"{name}_n"),
        F.col("pos").alias(f"{name}_pos"),
    )


def _star_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """On each shingle and size class, the node that is best placed with all others."""
    sized = entries.withColumn("size", _size_class(percent))
    best = (
        sized.groupBy("shingle", "size")
        .agg(F.min(F.struct("pos", "n", "node")).alias("best"))
        .select(
            "shingle", "size", F.col("best.node").alias("c"),
            F.col("best.n").alias("c_n"), F.col("best.pos").alias("c_pos"),
        )
    )
    met = sized.join(best, ["shingle", "size"]).where("node <> c")
    follow = F.least(F.col("n") - F.col("pos"), F.col("c_n") - F.col("c_pos"))
    met = met.where(follow >= needed(F.col("n"), F.col("c_n"), percent))
    return met.select(
        F.least("node", "c").alias("u"), F.greatest("node", "c").alias("v")
    ).distinct()


def _cross_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """All candidate pairs (u, v) of different groups ``g``, each once.

    Groups meet first, so that the members of one group are never paired.
    """
    sized = entries.withColumn("size", _size_class(percent))
    keys = ["shingle", "g", "size"]
    longer = sized.groupBy(*keys).agg(F.min("pos").alias("first"))
    shorter = sized.where("found = 1").groupBy(*keys).agg(F.min("pos").alias("first"))
    near = longer.alias("a").join(shorter.alias("b"), "shingle").where(
        "a.g <> b.g and a.size - b.size between 0 and 1"
    )
    near = near.select(
        "shingle",
        F.col("a.g").alias("xg"), F.col("a.size").alias("xs"),
        F.col("b.g").alias("yg"), F.col("b.size").alias("ys"),
    )
    x = _renamed(sized, "x", "shingle", F.col("g").alias("xg"), F.col("size").alias("xs"))
    y = _renamed(
        sized.where("found = 1"), "y", "shingle",
        F.col("g").alias("yg"), F.col("size").alias("ys"),
    )
    met = near.join(x, ["shingle", "xg", "xs"]).join(y, ["shingle", "yg", "ys"])
    return (
        met.where(_ordered(percent) & _can_link(percent))
        .select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v"))
        .distinct()
    )


class _Prepared:
    """Counted, ordered and indexed documents."""

    def __init__(
        self, docs: DataFrame, marked: DataFrame, text: str, width: int, percent: int
    ) -> None:
        counts = docs.sparkSession.sparkContext.broadcast(class_counts(marked))
        self.docs, self.marked, self.text, self.width = docs, marked, text, width
        self.entries = _meetings(docs, text, counts, width, percent)
        wanted = self.entries.select("node").distinct()
        self.sizes = stage(
            marked.join(wanted, "node", "left_semi")
            .groupBy("node")
            .agg(F.first("n").alias("n"), F.first("parts").alias("parts")),
            "sizes",
        )

    def sets_of(self, nodes: DataFrame) -> DataFrame:
        return _whole_sets(self.docs, self.text, self.width, nodes)

    def drop(self) -> None:
        drop_stage(self.entries, self.sizes)


def _marked(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """:func:`marks`, written; two sets with one ``node`` are an error."""
    marked = stage(marks(docs, key, text, width), "marks")
    other = marked.where("n > 0").groupBy("node").agg(
        F.min("other").alias("a"), F.max("other").alias("b")
    )
    if other.where("a <> b").limit(1).count():
        raise ValueError("two different sets share 64 bits of their digest")
    return marked


def similar_pairs(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
) -> DataFrame:
    """Every linked pair of different sets: (u, v, overlap) by node, see :func:`marks`."""
    marked = _marked(docs, key, text, width)
    ready = _Prepared(docs, marked, text, width, percent)
    alone = ready.entries.withColumn("g", F.col("node"))
    links = _compare(_cross_pairs(alone, percent), ready, percent)
    ready.drop()
    drop_stage(marked)
    return links


def _groups(ready: _Prepared, percent: int) -> DataFrame:
    """(node, root) of the nodes that link with others."""
    first = _compare(_star_pairs(ready.entries, percent), ready, percent)
    near = connected_components(first)
    grouped = stage(
        ready.entries.join(near, "node", "left").withColumn("g", F.coalesce("root", "node")),
        "grouped",
    )
    mixed = (
        grouped.groupBy("shingle")
        .agg(F.min("g").alias("a"), F.max("g").alias("b"))
        .where("a <> b")
        .select("shingle")
    )
    rest = stage(grouped.join(mixed, "shingle"), "rest")
    more = _compare(_cross_pairs(rest, percent), ready, percent)
    every = connected_components(first.select("u", "v").union(more.select("u", "v")))
    drop_stage(first, near, grouped, rest, more)
    return every


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
) -> DataFrame:
    """(key, n_shingles, node, component) for every row of ``docs``."""
    marked = _marked(docs, key, text, width)
    nodes = stage(
        marked.where("n > 0").groupBy("node").agg(F.min("key").alias("first")), "nodes"
    )
    ready = _Prepared(docs, marked, text, width, percent)
    roots = _groups(ready, percent)
    joined = nodes.join(roots, "node", "left").select(
        "node", "first", F.coalesce("root", "node").alias("root")
    )
    lowest = joined.groupBy("root").agg(F.min("first").alias("component"))
    named = stage(
        joined.join(lowest, "root").select("node", "component"), "components"
    )
    ready.drop()
    drop_stage(nodes, roots)
    full = marked.where("n > 0").join(named, "node")
    empty = marked.where("n = 0").withColumn("component", F.col("key"))
    return full.unionByName(empty, allowMissingColumns=True).select(
        F.col("key").alias(key),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("node")).alias("node"),
        "component",
    )


def op13_ngram_join(spark, sf_dir: str) -> DataFrame:
    """Contract rows of op13."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select(
        "doc_id", "n_shingles", F.col("component").alias("component_id")
    )


OP13_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []::VARCHAR[]
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3),
      lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM texts
), each AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM each a JOIN each b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 180 * count(*) >= 80 * (a.n + b.n)
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM sets
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y
)
SELECT doc_id, len(any_value(s))::BIGINT AS n_shingles, min(y) AS component_id
FROM sets JOIN reach ON x = doc_id
GROUP BY doc_id
"""
