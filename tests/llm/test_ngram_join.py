"""N-gram Jaccard join against all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from vexel.llm import ngram_join

WORD = re.compile("[^\x20\x09-\x0d]+")


def shingles(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows, percent=80):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    pairs = set()
    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                if x != y:
                    pairs.add((frozenset((x, y)), len(x & y)))
                root[find(i)] = find(j)
    lowest = {}
    for i, (doc, _) in enumerate(rows):
        k = find(i)
        known = lowest.get(k)
        lowest[k] = known if doc is None else doc if known is None else min(known, doc)
    return sorted(
        ((d, len(s), lowest[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))),
        key=str,
    ), pairs


def corpus(seed):
    """Independent texts, chains of near copies, a cluster round one text, short texts."""
    g = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(g.choice(words) for _ in range(g.randint(0, 70))) for _ in range(25)]
    base = [g.choice(words) for _ in range(60)]
    for _ in range(30):  # one word changed each: near the base, often not each other
        own = list(base)
        own[g.randrange(60)] = f"x{g.randrange(1_000)}"
        texts.append(" ".join(own))
    if seed % 2:
        texts.append(" ".join(base).upper().replace("W", "w"))
    chain = [g.choice(words) for _ in range(80)]
    for _ in range(15):
        at = g.randrange(len(chain))
        chain[at : at + 1] = [f"y{g.randrange(50)}"]
        texts.append("\t" + "  ".join(chain) + "\n")
    common = " ".join(g.choice(words) for _ in range(30))
    texts += [common + " " + " ".join(g.choice(words) for _ in range(g.randint(0, 12))) for _ in range(25)]
    texts += ["a b", "A  B", "a b c", "a b c d e", "a b c d e f", None, "", " \n", "É é", "é É"]
    texts += texts[20:40]
    g.shuffle(texts)
    rows = [(i * 7 % 1_009, t) for i, t in enumerate(texts)]
    return rows + [(None, texts[3]), (rows[0][0], "other words under a known id here")]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_are_all_pairs(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = ngram_join.near_duplicates(docs).select("doc_id", "n_shingles", "component")
    got = sorted((tuple(r) for r in found.collect()), key=str)
    assert got == brute(rows)[0]


@pytest.mark.parametrize("percent", [50, 80, 95])
def test_pairs_are_all_pairs(spark, percent):
    rows = corpus(7)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = ngram_join.similar_pairs(docs, percent=percent).collect()
    assert len({(r["u"], r["v"]) for r in got}) == len(got)
    want = brute(rows, percent)[1]
    assert sorted(r["overlap"] for r in got) == sorted(n for _, n in want)


def test_sets_are_sets():
    texts = ["The the THE the the the the", "a b c d", " ", "x " * 9, "ß ÀB c\x0bd\x0ce f"]
    h, at = ngram_join.shingle_sets(pa.array(texts))
    assert np.diff(at).tolist() == [len(shingles(t)) for t in texts]
    assert all((np.diff(h[a:b].astype(object)) > 0).all() for a, b in zip(at, at[1:], strict=False))
    a, _ = ngram_join.shingle_sets(pa.array(["p q r s t u"]))
    b, _ = ngram_join.shingle_sets(pa.array(["z", "P Q R S T U v"]).slice(1))
    assert set(a) < set(b)


def test_prefixes_never_miss():
    for percent in (50, 80, 95):
        n = np.arange(1, 400)
        probe, index = ngram_join.prefix_sizes(n, percent)
        assert ((1 <= index) & (index <= probe) & (probe <= n)).all()
        # n - size + 1 shingles behind the prefix are too few for any link.
        assert (100 * (n - probe) < percent * n).all()
        assert ((n - index) * (100 + percent) < 2 * n * percent).all()


@pytest.mark.parametrize("sizes", [(1, 1), (40, 40), (90, 100), (500, 530), (3_000, 3_600)])
def test_small_parts_never_miss_and_rule_out(sizes):
    g = np.random.default_rng(5)
    for shared in (0, sizes[0] // 2, sizes[0]):
        drawn = g.integers(0, 1 << 64, sum(sizes), np.uint64, endpoint=False)
        a, b = drawn[: sizes[0]], drawn[sizes[0] - shared : sum(sizes) - shared]
        most = ngram_join.most_common(*(ngram_join._small_parts(x) for x in (a, b)))
        assert shared <= most <= sizes[0]
        if sizes[0] >= 500 and shared < sizes[0]:
            assert most < 0.85 * sizes[0]
    # Too many in one part: nothing is told, and the pair is compared.
    assert ngram_join._small_parts(np.arange(16, dtype=np.uint64) << np.uint64(32)) is None


def test_whole_sets_only_of_pairs_that_may_link(spark, monkeypatch):
    g = random.Random(3)
    same, one, other = ([f"v{g.random()}" for _ in range(n)] for n in (820, 180, 180))
    # What the first two do not share is in long texts too, so what they share is rarest.
    texts = [" ".join(same + one), " ".join(same + other)]
    texts += [texts[0] + " more", texts[0]]
    for _ in range(3):
        texts.append(" ".join(one + other + [f"v{g.random()}" for _ in range(4_000)]))
    wanted, written = [], []

    def whole(docs, text, width, nodes, fetch=ngram_join._whole_sets):
        wanted.append(nodes.count())
        return fetch(docs, text, width, nodes)

    def stage(df, purpose, write=ngram_join.stage):
        written.append(purpose)
        return write(df, purpose)

    monkeypatch.setattr(ngram_join, "_whole_sets", whole)
    monkeypatch.setattr(ngram_join, "stage", stage)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = ngram_join.near_duplicates(docs).select("doc_id", "component").collect()
    assert dict(map(tuple, found)) == {0: 0, 1: 1, 2: 0, 3: 0, 4: 4, 5: 5, 6: 6}
    assert max(wanted) == 2 and "sets" not in written


def test_odd_tables(spark):
    rows = [(1, "x" * 1_000_000), (2, "word " * 200_000), (2, "word " * 200_000), (3, None)]
    docs = spark.createDataFrame(
        [(i, t, "n", 1, 2, 3) for i, t in rows],
        "doc_id bigint, text string, node string, n int, key int, shingle int",
    )
    got = sorted(tuple(r)[:2] for r in ngram_join.near_duplicates(docs).drop("node").collect())
    assert got == [(1, 1), (2, 1), (2, 1), (3, 0)]
    assert ngram_join.near_duplicates(docs.where("false")).count() == 0


def test_query_columns(spark, sf_dir):
    got = ngram_join.op13_ngram_join(spark, sf_dir)
    assert got.dtypes == [("doc_id", "bigint"), ("n_shingles", "bigint"), ("component_id", "bigint")]
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs)[0]
