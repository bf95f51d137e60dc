"""Merkle manifest of a dataset, in van Emde Boas layout.

Rows are leaves; the leaves of one group (a language) ascend by id and form a binary
tree, whose root is a leaf of the tree over all groups.  A tree is cut into aligned
blocks of ``HEIGHT`` levels.  A block is one row of the manifest: its digests lie in van
Emde Boas order, that is, the upper half of its levels first and then each lower half
subtree whole, recursively, so a walk between leaf and root touches few cache lines
whatever their size.  Where a node lies follows from (levels, depth, index) alone
(:func:`address`): building and finding siblings use the same arithmetic and no index.
The roots of the blocks are the leaves of the next level of blocks, up to one block a
tree.

A group may hold any share of the rows: ids are sorted by ranges, positions come from
the row counts of the ranges, and blocks are dealt out by (group, block), so no task
sees more than one block at a time.  Only numbers of rows reach the driver.

A node's digest is the lowercase hex SHA-256 of its children's hex digests in order; an
only child is hashed alone, as long as its tree has other nodes on that level.

Defined cases: a null field counts as ``-``; rows with a null group are a group of
their own, before all others; null ids come first; rows with equal ids are ordered by
digest and are leaves each; an empty table has no blocks and no rows; other columns do
not count, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vexel.llm.common import drop_stage, id_text_crc, ranges, stage

#: Levels of nodes above the leaves of a block; a full block has 2 ** HEIGHT leaves.
HEIGHT = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
DIGEST = 32
_BLOCKS = (
    "tree string, n bigint, block bigint, height int, size int, nodes binary"
)
_ROW_BITS = 33
_STEP = re.compile("-|[LR][0-9a-f]{64}")


# --- the layout -----------------------------------------------------------------


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Places of the nodes ``index`` of one ``depth`` in a tree of ``levels`` levels.

    The tree is split at half height until one level is left: a node of the upper half
    is looked for there, one of the lower half behind the upper half and the subtrees
    to its left.
    """
    index = np.asarray(index, np.int64)
    place = np.zeros(len(index), np.int64)
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        levels -= top
        depth -= top
        subtree = index >> depth
        place += (1 << top) - 1 + subtree * ((1 << levels) - 1)
        index = index & ((1 << depth) - 1)
    return place


def _hash(*hexes: str) -> str:
    return hashlib.sha256("".join(hexes).encode()).hexdigest()


def build_block(leaves: list[bytes], height: int) -> bytes:
    """The digests of a block in van Emde Boas order; places without a node are zero."""
    out = np.zeros(((1 << (height + 1)) - 1, DIGEST), np.uint8)
    level = leaves
    for depth in range(height, -1, -1):
        where = address(height + 1, depth, np.arange(len(level)))
        out[where] = np.frombuffer(b"".join(level), np.uint8).reshape(-1, DIGEST)
        hexes = [d.hex() for d in level]
        level = [
            hashlib.sha256("".join(hexes[i : i + 2]).encode()).digest()
            for i in range(0, len(hexes), 2)
        ]
    return out.tobytes()


class Block:
    """Reads one stored block."""

    def __init__(self, nodes: bytes, height: int, size: int) -> None:
        self.nodes, self.height, self.size = nodes, height, size

    def node(self, depth: int, index: int) -> str:
        at = DIGEST * int(address(self.height + 1, depth, np.array([index]))[0])
        return self.nodes[at : at + DIGEST].hex()

    def level(self, depth: int) -> list[str]:
        """The hex digests of one level, left to right."""
        size = -(-self.size // (1 << (self.height - depth)))
        where = DIGEST * address(self.height + 1, depth, np.arange(size))
        return [self.nodes[at : at + DIGEST].hex() for at in where.tolist()]

    def paths(self) -> list[str]:
        """For every leaf its siblings up to the block's root.

        A step is ``L`` or ``R`` (the sibling's side) with the sibling's digest, or
        ``-`` where there is none.
        """
        found = [""] * self.size
        for depth in range(self.height, 0, -1):
            level = self.level(depth)
            steps = []
            for i in range(len(level)):
                if i & 1:
                    steps.append("L" + level[i - 1])
                else:
                    steps.append("R" + level[i + 1] if i + 1 < len(level) else "-")
            shift = self.height - depth
            found = [path + steps[i >> shift] for i, path in enumerate(found)]
        return found


def fold(digest: str, path: str) -> str:
    """The root that a digest and its siblings lead to."""
    for step in _STEP.findall(path):
        if step[0] == "L":
            digest = _hash(step[1:], digest)
        elif step[0] == "R":
            digest = _hash(digest, step[1:])
        else:
            digest = _hash(digest)
    return digest


def proof_digest(path: str) -> str:
    """Digest of the siblings of a path, in order."""
    return _hash(*(s[1:] for s in _STEP.findall(path) if s != "-"))


# --- leaves and positions -------------------------------------------------------


def field_digest(columns: list[Column]) -> Column:
    """SHA-256 of the values, each ``-`` if null, else its UTF-8 bytes, ``:``, itself."""
    parts = []
    for column in columns:
        text = column.cast("string")
        size = F.octet_length(text).cast("string")
        parts.append(F.coalesce(F.concat(size, F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def group_key(column: str) -> Column:
    """A group as text that is never null and sorts like it: null first, then bytes."""
    text = F.col(column).cast("string")
    return F.coalesce(F.concat(F.lit("="), text), F.lit(""))


def positions(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, 0-based in each ``tree`` by ``order``, and the tree's ``n``.

    One range sort; the positions come from the counts of each range, of which a tree
    has no more than there are ranges.
    """
    keys = ["tree", *order]
    number = ranges(rows.sparkSession, rows.count())
    dealt = stage(
        rows.repartitionByRange(number, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("__row", F.monotonically_increasing_id())
        .withColumn("__range", F.shiftrightunsigned("__row", _ROW_BITS)),
        "ordered",
    )
    counts = dealt.groupBy("tree", "__range").agg(
        F.count(F.lit(1)).alias("__here"), F.min("__row").alias("__first")
    )
    tree = Window.partitionBy("tree")
    before = tree.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "tree",
        "__range",
        (F.coalesce(F.sum("__here").over(before), F.lit(0)) - F.col("__first")).alias(
            "__shift"
        ),
        F.sum("__here").over(tree).alias("n"),
    )
    placed = (
        dealt.join(starts, ["tree", "__range"])
        .withColumn("pos", F.col("__row") + F.col("__shift"))
        .drop("__row", "__range", "__shift")
    )
    placed._vexel_path = dealt._vexel_path
    return placed


# --- the manifest ---------------------------------------------------------------


def _build(elements: DataFrame, height: int) -> DataFrame:
    """Blocks of ``elements (tree, n, pos, digest hex)``."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        n = table["n"][0].as_py()
        # A tree of one block is only as high as it must be.
        levels = height if n > 1 << height else max(n - 1, 0).bit_length()
        leaves = [bytes.fromhex(d) for d in table["digest"].to_pylist()]
        return pa.table(
            {
                "tree": pa.array([key[0].as_py()], pa.string()),
                "n": pa.array([n], pa.int64()),
                "block": pa.array([key[1].as_py()], pa.int64()),
                "height": pa.array([levels], pa.int32()),
                "size": pa.array([len(leaves)], pa.int32()),
                "nodes": pa.array([build_block(leaves, levels)], pa.binary()),
            }
        )

    keyed = elements.select(
        "tree", "n", "pos", "digest", F.shiftright("pos", height).alias("block")
    )
    return keyed.groupBy("tree", "block").applyInArrow(run, _BLOCKS)


def root_of(nodes: str = "nodes") -> Column:
    """The first digest of a block is its root's."""
    return F.lower(F.hex(F.substring(nodes, 1, DIGEST)))


class Forest:
    """The stored blocks of all trees: one table a level, leaves' blocks first."""

    def __init__(self, elements: DataFrame, height: int) -> None:
        self.height = height
        self.levels: list[DataFrame] = []
        many = F.col("n") > (1 << height)
        while True:
            blocks = stage(_build(elements, height), "blocks")
            self.levels.append(blocks)
            if not blocks.where(many).limit(1).count():
                break
            elements = blocks.where(many).select(
                "tree",
                F.shiftright(F.col("n") + ((1 << height) - 1), height).alias("n"),
                F.col("block").alias("pos"),
                root_of().alias("digest"),
            )

    def roots(self) -> DataFrame:
        """(tree, digest) of every tree."""
        found = None
        for blocks in self.levels:
            part = blocks.where(F.col("n") <= (1 << self.height)).select(
                "tree", root_of().alias("digest")
            )
            found = part if found is None else found.union(part)
        return found

    def anchored(self, above: DataFrame, level: int = 0) -> DataFrame:
        """The blocks of a level with ``path``: the siblings from its root upwards.

        ``above (tree, path)`` has the siblings from each tree's root upwards, and may
        have more columns about the tree.
        """
        blocks = self.levels[level]
        if level == len(self.levels) - 1:
            return blocks.join(above, "tree")
        upper = self.anchored(above, level + 1).select(
            "tree", "block", "height", "size", "nodes", "path"
        )
        each = upper.mapInArrow(
            _expand(self.height), "tree string, pos bigint, path string"
        ).select("tree", F.col("pos").alias("block"), F.col("path").alias("upwards"))
        # A tree of one block has no upper one.
        return (
            blocks.join(above, "tree")
            .join(each, ["tree", "block"], "left")
            .withColumn("path", F.coalesce("upwards", "path"))
            .drop("upwards")
        )

    def drop(self) -> None:
        drop_stage(*self.levels)


def _expand(height: int):
    """From upper blocks with their paths, the whole path of each of their leaves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                paths = Block(row["nodes"], row["height"], row["size"]).paths()
                first = row["block"] << height
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["tree"]] * len(paths), pa.string()),
                        pa.array(range(first, first + len(paths)), pa.int64()),
                        pa.array([p + row["path"] for p in paths], pa.string()),
                    ],
                    names=["tree", "pos", "path"],
                )

    return run


def build_manifest(leaves: DataFrame, height: int | None = None):
    """The forest of groups and the tree above them.

    ``leaves`` are (tree, n, pos, digest).  Returns both forests and a table
    (tree, subroot, root, path) with the siblings of each subroot.
    """
    height = HEIGHT if height is None else height
    groups = Forest(leaves, height)
    subroots = groups.roots().select(
        F.lit("").alias("tree"), F.col("tree").alias("group"), "digest"
    )
    ordered = positions(subroots, ["group"])
    top = Forest(ordered, height)
    root = top.roots().select("tree", F.col("digest").alias("root"))
    start = root.withColumn("path", F.lit(""))
    names = ordered.select(
        F.col("group").alias("__group"), F.col("digest").alias("subroot"), "pos"
    )
    blocks = top.anchored(start).select("tree", "block", "height", "size", "nodes", "path")
    each = blocks.mapInArrow(
        _expand(height), "tree string, pos bigint, path string"
    ).join(root, "tree")
    above = stage(
        names.join(each, "pos").select(
            F.col("__group").alias("tree"), "subroot", "root", "path"
        ),
        "subroots",
    )
    drop_stage(ordered)
    return groups, top, above


_PROOFS = (
    "subroot string, root string, leaf string, proof_sha256 string, "
    "folded_root string, verified boolean"
)


def verify(
    presented: DataFrame, groups: Forest, above: DataFrame, key: str = "doc_id"
) -> DataFrame:
    """Inclusion proofs of ``presented (tree, pos, key, digest)`` against the manifest.

    Siblings come from the stored blocks; the presented digest is folded with them.
    """
    height = groups.height
    blocks = groups.anchored(above)
    kind = presented.schema[key].dataType.simpleString()
    rows = presented.select(
        "tree", F.shiftright("pos", height).alias("block"), "pos", "digest", key
    )

    def run(_: tuple, mine: pa.Table, stored: pa.Table) -> pa.Table:
        out: dict[str, list] = {name: [] for name in names}
        if mine.num_rows and not stored.num_rows:
            raise ValueError("a row has a position that the manifest does not have")
        if mine.num_rows:
            (block,) = stored.to_pylist()
            read = Block(block["nodes"], block["height"], block["size"])
            paths, leaves = read.paths(), read.level(block["height"])
            for pos, digest in zip(
                mine["pos"].to_pylist(), mine["digest"].to_pylist(), strict=True
            ):
                at = pos & ((1 << height) - 1)
                path = paths[at] + block["path"]
                folded = fold(digest, path)
                out["subroot"].append(block["subroot"])
                out["root"].append(block["root"])
                out["leaf"].append(leaves[at])
                out["proof_sha256"].append(proof_digest(path))
                out["folded_root"].append(folded)
                out["verified"].append(folded == block["root"])
        columns = [mine[key].combine_chunks()]
        columns += [
            pa.array(out[n], pa.bool_() if n == "verified" else pa.string()) for n in names
        ]
        return pa.table(columns, names=[key, *names])

    names = [part.split()[0] for part in _PROOFS.split(", ")]
    return (
        rows.groupBy("tree", "block")
        .cogroup(blocks.groupBy("tree", "block"))
        .applyInArrow(run, f"`{key}` {kind}, {_PROOFS}")
    )


def op12_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """Contract rows of op12."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tampered = id_text_crc("doc_id") % 7 == 0
    changed = [
        F.col(f) + 1 if f == "n_chars" else F.col(f) for f in FIELDS
    ]
    leaves = stage(
        docs.select(
            group_key("lang").alias("tree"),
            "doc_id",
            field_digest([F.col(f) for f in FIELDS]).alias("digest"),
            F.when(tampered, field_digest(changed)).alias("changed"),
        ),
        "leaves",
    )
    placed = positions(leaves, ["doc_id", "digest"])
    groups, _, above = build_manifest(placed)
    shown = placed.withColumn("digest", F.coalesce("changed", "digest"))
    return verify(shown, groups, above).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


OP12_SQL = r"""
WITH RECURSIVE bytes AS (
  SELECT range AS b FROM range(256)
), crc_table AS (
  SELECT b, list_reduce([b::BIGINT] || list_transform(range(8), lambda i: 0::BIGINT),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
  FROM bytes
), crc_list AS (
  SELECT list(v ORDER BY b) AS t FROM crc_table
), fields AS (
  SELECT doc_id, lang, n_chars,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
      || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail,
    xor(list_reduce([4294967295] || list_transform(
        list_filter(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda c: c <> ''), lambda c: ord(c)::BIGINT),
      lambda c, d: xor(c >> 8, t[(xor(c, d) & 255) + 1])), 4294967295) % 7 = 0 AS bad
  FROM documents, crc_list
), hashed AS (
  SELECT doc_id, lang,
    sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail)
      AS leaf,
    CASE WHEN bad THEN sha256(head
      || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || tail)
    END AS changed
  FROM fields
), leaves AS (
  SELECT *, coalesce('=' || lang, '') AS tree, row_number() OVER (
    PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM hashed
), nodes AS (
  SELECT tree, 0 AS lvl, pos, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM leaves
  UNION ALL
  SELECT tree, any_value(lvl) + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)),
    (any_value(n) + 1) // 2
  FROM nodes WHERE n > 1 GROUP BY tree, pos // 2
), subroots AS (
  SELECT tree, h AS subroot, max(lvl) OVER () AS top,
    row_number() OVER (ORDER BY encode(tree)) - 1 AS place
  FROM nodes WHERE n = 1
), upper AS (
  SELECT 0 AS lvl, place AS pos, subroot AS h, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT any_value(lvl) + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)),
    (any_value(n) + 1) // 2
  FROM upper WHERE n > 1 GROUP BY pos // 2
), folds AS (
  SELECT tree, pos AS leaf_pos, 0 AS lvl, pos, count(*) OVER (PARTITION BY tree) AS n,
    coalesce(changed, leaf) AS h, '' AS proof
  FROM leaves
  UNION ALL
  SELECT f.tree, f.leaf_pos, f.lvl + 1, f.pos // 2, (f.n + 1) // 2,
    sha256(CASE WHEN f.pos % 2 = 1 THEN s.h || f.h ELSE f.h || coalesce(s.h, '') END),
    f.proof || coalesce(s.h, '')
  FROM folds f LEFT JOIN nodes s
    ON s.tree = f.tree AND s.lvl = f.lvl AND s.pos = xor(f.pos, 1)
  WHERE f.n > 1
), climbs AS (
  SELECT tree, leaf_pos, 0 AS lvl, place AS pos, (SELECT count(*) FROM subroots) AS n,
    h, proof
  FROM folds JOIN subroots USING (tree) WHERE n = 1
  UNION ALL
  SELECT c.tree, c.leaf_pos, c.lvl + 1, c.pos // 2, (c.n + 1) // 2,
    sha256(CASE WHEN c.pos % 2 = 1 THEN s.h || c.h ELSE c.h || coalesce(s.h, '') END),
    c.proof || coalesce(s.h, '')
  FROM climbs c LEFT JOIN upper s ON s.lvl = c.lvl AND s.pos = xor(c.pos, 1)
  WHERE c.n > 1
)
SELECT doc_id, leaf, subroot, root.h AS root, sha256(proof) AS proof_sha256,
  c.h AS folded_root, c.h = root.h AS verified
FROM leaves l JOIN climbs c ON c.tree = l.tree AND c.leaf_pos = l.pos AND c.n = 1
JOIN subroots r ON r.tree = l.tree, (SELECT h FROM upper WHERE n = 1) root
"""
