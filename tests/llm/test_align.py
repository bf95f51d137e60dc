"""Alignment of two tokenizers against a plain loop."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vexel.llm import align

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")
LONG = " ".join(random.Random(1).choice(["alpha", "Beta's", "12345", "żółć", "日本語", "\n\n x"]) for _ in range(3_000))
TEXTS = [
    None, "", "Hello world, it's 2024!", "  two  spaces ", "a▁b", "<|endoftext|> <s>x</s> <0x41>",
    "\n\ttab\x00nul", "日本語 テスト 😀 naïve", LONG, "y" * 700, "same text here", "same text here", " ", "x",
]
SCHEMA = "doc_id bigint, text string, uid string, pairs int, start int, __x int"


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def plain(text, tokenizers):
    """Groups of one text, each (A ids, B ids), by walking over both token lists."""
    if not text:
        return []
    a, b = tokenizers
    letters = align._byte_alphabet()
    names = {i: t for t, i in a.get_vocab().items()}
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    bytes_a = [bytes(letters[c] for c in names[i]) for i in ids_a]
    bytes_b = [
        bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
        else b.id_to_piece(i).replace("▁", " ").encode()
        for i in ids_b
    ]
    whole = (" " + text).encode()
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return []
    out, i, j, end_a, end_b = [([], [])], 0, 0, 0, 0
    while i < len(ids_a) or j < len(ids_b):
        if end_a <= end_b and i < len(ids_a):
            end_a += len(bytes_a[i])
            out[-1][0].append(ids_a[i])
            i += 1
        else:
            end_b += len(bytes_b[j])
            out[-1][1].append(ids_b[j])
            j += 1
        if end_a == end_b:
            out.append(([], []))
    return out[:-1]


def written(groups):
    return ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)


@pytest.mark.parametrize("chunk", [align.CHUNK_BYTES, 64, 7])
def test_alignment_is_a_plain_walk(spark, tokenizers, chunk):
    rows = [(i % 9 if i else None, t, "u", 1, 2, 3) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, SCHEMA)
    aligned = align.align_texts(docs, A, B, chunk=chunk)
    aligned = align.stage(aligned.withColumn("uid", F.monotonically_increasing_id()), "aligned")
    counts = align.link_counts(aligned)
    want = [plain(t, tokenizers) for t in TEXTS]
    linked = Counter((x[-1], y[-1]) for groups in want for x, y in groups)
    most = Counter()
    for (_, y), n in linked.items():
        most[y] = max(most[y], n)
    got_counts = {(r["pair"] >> 32, r["pair"] & 0xFFFFFFFF): r for r in counts.collect()}
    assert {k: r["count"] for k, r in got_counts.items()} == dict(linked)
    assert all(r["best"] == (r["count"] == most[k[1]]) for k, r in got_counts.items())
    for frequent in (align.FREQUENT, 20, 1):
        sums = align.link_sums(aligned, counts, frequent)
        got = sorted(
            (r["doc_id"] or -1, r["n_a"], r["n_b"], r["n_groups"], r["groups"], r["n_best"], r["count_sum"])
            for r in sums.collect()
        )
        assert got == sorted(
            (
                doc if doc else -1,
                sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups),
                written(groups),
                sum(linked[x[-1], y[-1]] == most[y[-1]] for x, y in groups),
                sum(linked[x[-1], y[-1]] for x, y in groups),
            )
            for (doc, *_), groups in zip(rows, want, strict=True)
        )


def test_fragments_compose_in_any_order(tokenizers):
    both = align.aligner(A, B)
    text = TEXTS[2] + LONG[:2_000] + "z" * 50
    whole = " " + text
    parts = []
    for piece in align.cut_places(text, 300):
        first = sum(len(p.encode()) for p, _ in parts)
        parts.append((piece, first))
    assert "".join(p for p, _ in parts) == whole and len(parts) > 3
    found = [f for p, at in parts for _, f in align.fragments_of(both, p, at, 13)]
    assert any(not f.cut for f in found) and any(len(f.suf_a) + len(f.suf_b) for f in found)
    want = written(plain(text, tokenizers)).encode()
    g = random.Random(3)
    for _ in range(5):
        line = [align.Fragment(), *found, align.Fragment()]
        while len(line) > 1:
            at = g.randrange(len(line) - 1)
            line[at : at + 2] = [line[at] + line[at + 1]]
        assert line[0].groups() == want
        assert line[0].times.sum() == line[0].n_groups == want.count(b";") + 1


def test_query_columns_and_empty_table(spark, tmp_path, tokenizers):
    docs = spark.createDataFrame([(7, "one two", "", 0, 0, 0), (8, None, "", 0, 0, 0)], SCHEMA)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = align.op11_token_alignment(spark, str(tmp_path))
    assert got.dtypes == [
        ("doc_id", "bigint"), ("n_a", "bigint"), ("n_b", "bigint"), ("n_groups", "bigint"),
        ("n_links", "bigint"), ("n_best", "bigint"), ("count_sum", "bigint"),
        ("groups_sha256", "string")]
    rows = {r["doc_id"]: r for r in got.collect()}
    text = written(plain("one two", tokenizers))
    assert rows[7]["groups_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert tuple(rows[8]) == (8, 0, 0, 0, 0, 0, 0, "")
    docs.where("false").write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert align.op11_token_alignment(spark, str(tmp_path / "none")).count() == 0


def test_a_very_long_run_without_spaces(spark):
    docs = spark.createDataFrame([(1, "ab" * 300_000, "", 0, 0, 0)], SCHEMA)
    (row,) = align.align_texts(docs, A, B).select("n_a", "n_b", "n_groups").collect()
    assert row["n_groups"] > 0 and np.isfinite(row["n_a"])
