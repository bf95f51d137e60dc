"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into ``m`` segments.  Two fingerprints that differ in at most
``d`` bits differ in at most ``d // m`` bits of some segment, so each fingerprint
looks up, per segment, the small Hamming ball of that radius round its own value in
the table of all segment values, and whole distances are verified in the join.  Of two
different values only the smaller looks up the larger.

Documents meet by fingerprint only: equal fingerprints are one node, so a group of
copies of any size is one row here.  Verified links that already hang together are
not joined again: first the nodes within two bits are contracted through shared
neighbours (a row per node and bit, summed up by a minimum), then only pairs from
different groups leave the join.

Defined cases: a null text is empty; a text without words has fingerprint 0 and links
like any other; fewer words than a shingle make one shingle; documents with a null id
take part and get the component of their fingerprint; repeated ids are told apart by
row, and the component is the smallest id reachable.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vexel.llm.common import drop_stage, ranges, stage, text_column
from vexel.llm.components import connected_components

BITS = 64
SHINGLE = 4
MAX_DISTANCE = 4
_SEED = 42
#: Nodes of a task, which makes tens to a thousand probes of each.
_NODES_A_TASK = 10_000


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Majority bits of the XXH64 of all word shingles; unsigned."""
    words = text.encode("utf-8", "replace").lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= shingle:
        return xxhash.xxh64_intdigest(joined, _SEED)
    sizes = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [
            digest(joined[a:b], _SEED)
            for a, b in zip(
                starts[: n - shingle + 1].tolist(),
                ends[shingle - 1 :].tolist(),
                strict=True,
            )
        ],
        "<u8",
    )
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """(key, fp) with the fingerprint as a signed BIGINT, for every row."""
    rows = docs.select(F.col(key).alias(key), F.col(text).alias("__text"))
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_column(batch, "__text")
            found = np.array(
                [fingerprint(t.as_py(), shingle) for t in texts], np.uint64
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(found.view(np.int64))], names=[key, "fp"]
            )

    return rows.mapInArrow(run, f"`{key}` {kind}, fp bigint")


def _segments(count: int) -> list[tuple[int, int]]:
    """(first bit, width) of each segment."""
    edges = [BITS * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _lookups(segments: int, radius: int):
    """An array literal with one entry per segment and point of its ball."""
    return F.array(
        *(
            F.struct(
                F.lit(number).cast("bigint").alias("segment"),
                F.lit(first).alias("first"),
                F.lit((1 << width) - 1).cast("bigint").alias("low"),
                F.lit(_signed(sum(1 << (first + b) for b in flips)))
                .cast("bigint")
                .alias("flip"),
            )
            for number, (first, width) in enumerate(_segments(segments))
            for size in range(radius + 1)
            for flips in combinations(range(width), size)
        )
    )


def _keyed(nodes: DataFrame, name: str, segments: int, radius: int) -> DataFrame:
    """(key, name, group): the table for radius 0, the probes for a larger one.

    Of two values the smaller one probes for the larger, so half of a ball is sent.
    """
    each = nodes.select("fp", "g", F.explode(_lookups(segments, radius)).alias("s"))
    value = F.expr("shiftrightunsigned(fp ^ s.flip, s.first) & s.low")
    own = F.expr("shiftrightunsigned(fp, s.first) & s.low")
    return each.where(value >= own).select(
        (value + F.col("s.segment") * F.lit(1 << 40)).alias("key"),
        F.col("fp").alias(name),
        F.col("g").alias(f"{name}_g"),
    )


def _near_groups(nodes: DataFrame) -> DataFrame:
    """(node, root) of the links within two bits.

    Two such fingerprints share one within one bit of both.  Each node names itself
    and its 64 neighbours; a neighbour named twice links its namers to the smallest.
    """
    ball = F.array(
        F.lit(0).cast("bigint"),
        *(F.lit(_signed(1 << b)).cast("bigint") for b in range(BITS)),
    )
    named = nodes.select("fp", F.explode(ball).alias("flip")).select(
        F.expr("fp ^ flip").alias("near"), "fp"
    )
    low = named.groupBy("near").agg(
        F.min("fp").alias("m"), F.max("fp").alias("x")
    ).where("m <> x")
    shared = stage(low.select("near", "m"), "near")
    links = named.join(shared, "near").select(
        F.col("fp").alias("u"), F.col("m").alias("v")
    )
    found = connected_components(links)
    drop_stage(shared)
    return found


def best_segments(count: int, max_distance: int = MAX_DISTANCE) -> int:
    """The number of segments with the least probes and expected table matches.

    Fewer segments mean larger balls but longer, more telling keys: the more
    fingerprints there are, the fewer.
    """
    def cost(segments: int) -> float:
        radius = max_distance // segments
        return sum(
            sum(comb(width, r) for r in range(radius + 1)) * (1 + count / 2**width)
            for _, width in _segments(segments)
        )

    return min(range(2, max(3, max_distance + 2)), key=cost)


def near_links(
    nodes: DataFrame, segments: int, max_distance: int = MAX_DISTANCE
) -> DataFrame:
    """Links (u, v), u < v, between ``nodes (fp, g)`` of different groups ``g``.

    Every pair of different groups within ``max_distance`` bits is found; it may come
    once per segment.
    """
    table = _keyed(nodes, "v", segments, 0)
    probes = _keyed(nodes, "u", segments, max_distance // segments)
    differing = F.col("u").bitwiseXOR(F.col("v"))
    number = F.shiftright(table["key"], 40)
    # Equal values of the segment meet from both sides.
    moved = F.lit(False)
    for at, (first, width) in enumerate(_segments(segments)):
        part = F.shiftrightunsigned(differing, first).bitwiseAND(F.lit((1 << width) - 1))
        moved = moved | ((number == at) & (part != 0))
    near = (
        (F.col("u_g") != F.col("v_g"))
        & (F.bit_count(differing) <= max_distance)
        & ((F.col("u") < F.col("v")) | moved)
    )
    met = probes.join(table, (probes["key"] == table["key"]) & near)
    ordered = F.col("u") < F.col("v")
    return met.select(
        F.least("u", "v").alias("u"),
        F.greatest("u", "v").alias("v"),
        F.when(ordered, F.col("u_g")).otherwise(F.col("v_g")).alias("u_g"),
        F.when(ordered, F.col("v_g")).otherwise(F.col("u_g")).alias("v_g"),
    )


def _components(
    marked: DataFrame, lowest_of: str, max_distance: int, segments: int | None
) -> DataFrame:
    """(fp, component): for every fingerprint of ``marked`` the least ``lowest_of`` of
    its component; nulls count only where there is nothing else."""
    nodes = stage(marked.groupBy("fp").agg(F.min(lowest_of).alias("first")), "nodes")
    count = nodes.count()
    segments = segments or best_segments(count, max_distance)
    # Few rows, but many probes of each.
    spread = nodes.repartition(ranges(marked.sparkSession, count, _NODES_A_TASK), "fp")
    grouped = spread.select("fp", F.col("fp").alias("g"))
    near = None
    if max_distance >= 2:
        near = _near_groups(spread)
        grouped = stage(
            spread.join(near, F.col("fp") == F.col("node"), "left").select(
                "fp", F.coalesce("root", "fp").alias("g")
            ),
            "groups",
        )
    links = stage(near_links(grouped, segments, max_distance), "links")
    roots = connected_components(links.select(F.col("u_g").alias("u"), F.col("v_g").alias("v")))
    joined = (
        nodes.join(grouped, "fp")
        .join(roots, F.col("g") == F.col("node"), "left")
        .select("fp", "first", F.coalesce("root", "g").alias("root"))
    )
    lowest = joined.groupBy("root").agg(F.min("first").alias("component"))
    named = stage(joined.join(lowest, "root").select("fp", "component"), "components")
    drop_stage(nodes, near, links, roots)
    if near is not None:
        drop_stage(grouped)
    return named


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    max_distance: int = MAX_DISTANCE,
    segments: int | None = None,
) -> DataFrame:
    """(key, fp, component) for every row of ``docs``."""
    marked = stage(fingerprints(docs, key, text, shingle), "fingerprints")
    named = _components(
        marked.withColumnRenamed(key, "__key"), "__key", max_distance, segments
    )
    return marked.join(named, "fp").select(key, "fp", "component")


def fp_hex(column: str = "fp"):
    return F.lower(F.lpad(F.hex(column), BITS // 4, "0"))


def op3_simhash(spark, sf_dir: str) -> DataFrame:
    """Contract rows of op3."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select(
        "doc_id",
        fp_hex().alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def simhash_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component one document stays, that with the smallest id.

    Of several rows with that id one stays; a row with a null id stays only where its
    component has no other.  Rows are told apart by themselves, not by their ids.
    """
    @F.arrow_udf("bigint")
    def fp(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [fingerprint(t.as_py()) for t in texts.fill_null("")]
            yield pa.array(np.array(found, np.uint64).view(np.int64))

    # Written with the rows, so that their numbers stay as they are.
    held = stage(
        docs.withColumn("__fp", fp.asNondeterministic()(F.col("text"))).withColumn(
            "__row", F.monotonically_increasing_id()
        ),
        "fingerprints",
    )
    rank = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("__row").alias("row"))
    marked = held.select(F.col("__fp").alias("fp"), rank.alias("rank"))
    named = _components(marked, "rank", MAX_DISTANCE, None)
    gone = (
        marked.join(named, "fp")
        .where("rank.row <> component.row")
        .select(F.col("rank.row").alias("__gone"))
    )
    kept = held.join(gone, F.col("__row") == F.col("__gone"), "left_anti")
    return kept.select(*docs.columns)
