"""Merkle manifest against a plain tree, and its layout."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vexel.llm import merkle


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, more=0):
    out = []
    for name in merkle.FIELDS:
        value = row[name]
        if value is None:
            out.append("-")
            continue
        text = str(value + more if name == "n_chars" else value)
        out.append(f"{len(text.encode())}:{text}")
    return sha(*out)


def climb(level):
    """Root of a list of digests, and each one's siblings with their side."""
    paths = [[] for _ in level]
    below = [[i] for i in range(len(level))]
    while len(level) > 1:
        following, holds = [], []
        for i in range(0, len(level), 2):
            run = level[i : i + 2]
            for k, _ in enumerate(run):
                for at in below[i + k]:
                    paths[at].append((k, [d for j, d in enumerate(run) if j != k]))
            following.append(sha(*run))
            holds.append([at for k in range(len(run)) for at in below[i + k]])
        level, below = following, holds
    return level[0], paths


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for name in names:
        mine = sorted(
            groups[name], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r))
        )
        trees[name] = (mine, *climb([leaf_of(r) for r in mine]))
    root, above = climb([trees[n][1] for n in names])
    out = []
    for name, upper in zip(names, above, strict=True):
        mine, subroot, paths = trees[name]
        for row, path in zip(mine, paths, strict=True):
            whole = path + upper
            text = "" if row["doc_id"] is None else str(row["doc_id"])
            bad = zlib.crc32(text.encode()) % 7 == 0 and row["n_chars"] is not None
            folded = leaf_of(row, int(bad))
            for side, others in whole:
                folded = sha(*others, folded) if side else sha(folded, *others)
            proof = sha(*(d for _, others in whole for d in others))
            out.append(
                (row["doc_id"], leaf_of(row), subroot, root, proof, folded, folded == root)
            )
    return sorted(out, key=str)


@pytest.mark.parametrize("levels", range(1, 12))
def test_layout_is_a_permutation_with_aligned_subtrees(levels):
    places = [merkle.address(levels, d, np.arange(1 << d)) for d in range(levels)]
    assert sorted(np.concatenate(places).tolist()) == list(range((1 << levels) - 1))
    if levels > 1:
        top = levels // 2
        upper = np.concatenate(places[:top])
        assert sorted(upper.tolist()) == list(range((1 << top) - 1))
        size = (1 << (levels - top)) - 1
        for tree in range(1 << top):
            mine = np.concatenate(
                [
                    places[d][tree << (d - top) : (tree + 1) << (d - top)]
                    for d in range(top, levels)
                ]
            )
            first = (1 << top) - 1 + tree * size
            assert sorted(mine.tolist()) == list(range(first, first + size))


SCHEMA = "doc_id bigint, source string, lang string, n_chars int, text string, pos int, n string"


def rows_of(count):
    langs = ["en", None, "de", "é", "z", "en", "en"]
    return [
        (i * 3 % 1_000, "s" if i % 4 else None, langs[i % 7], i if i % 5 else None,
         f"text ü {i}" if i % 6 else None, 1, "x")
        for i in range(count)
    ]


@pytest.mark.parametrize(("count", "height"), [(90, 2), (90, 10), (1, 2), (7, 1)])
def test_manifest_is_brute_force(spark, monkeypatch, tmp_path, count, height):
    rows = rows_of(count)
    if count == 90:
        rows += rows[:5] + [(None, "s", "en", 3, "no id", 1, "x")] * 2
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(merkle, "HEIGHT", height)
    got = merkle.op12_merkle_manifest(spark, str(tmp_path))
    assert got.dtypes == [
        ("doc_id", "bigint"), ("leaf", "string"), ("subroot", "string"), ("root", "string"),
        ("proof_sha256", "string"), ("folded_root", "string"), ("verified", "boolean")]
    want = brute([r.asDict() for r in docs.collect()])
    assert sorted((tuple(r) for r in got.collect()), key=str) == want


def test_long_text_and_empty_table(spark, tmp_path):
    long = "x" * 1_000_000
    docs = spark.createDataFrame([(1, "s", "en", 2, long, 1, "x")], SCHEMA)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    (row,) = merkle.op12_merkle_manifest(spark, str(tmp_path)).collect()
    assert row["leaf"] == row["subroot"] == row["root"] == leaf_of(docs.first())
    assert row["proof_sha256"] == sha()
    none = tmp_path / "none"
    docs.where("false").write.parquet(str(none / "documents.parquet"))
    assert merkle.op12_merkle_manifest(spark, str(none)).count() == 0


def test_positions_do_not_depend_on_partitions(spark):
    rows = spark.range(500).select(
        F.when(F.col("id") % 3 > 0, "=a").otherwise("=b").alias("tree"), F.col("id").alias("k")
    )
    found = {
        tuple(sorted((r["tree"], r["k"], r["pos"], r["n"])
                     for r in merkle.positions(rows.repartition(p), ["k"]).collect()))
        for p in (1, 7)
    }
    assert len(found) == 1
    (one,) = found
    assert [p for t, _, p, _ in one if t == "=a"] == list(range(333))
