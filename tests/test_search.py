import math

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import plan_of, vectors_df
from vexel.functions import vectors as vec
from vexel.operators import search as srch
from vexel.operators.kernels import TopK, drop_excess_copies, ordered_dot
from vexel.operators.models import ConstantModel
from vexel.operators.report import render_hits, search_report
from vexel.sources.store import Store, append_store

NAN = float("nan")


def scored(spark, scores):
    return spark.createDataFrame(list(enumerate(scores)), "pos bigint, score double")


def positions(df):
    return [r.pos for r in df.orderBy("rank").collect()]


def test_top_three_of_six(spark):
    hits = srch.top_k(scored(spark, [0.1, 0.8, 0.3, 0.9, 0.5, 0.7]), 3).orderBy("rank")
    assert [(r.rank, r.score) for r in hits.collect()] == [(1, 0.9), (2, 0.8), (3, 0.7)]


def test_ties_go_to_the_lower_position(spark):
    assert positions(srch.top_k(scored(spark, [0.5, 0.5, 0.9]), 2)) == [2, 0]


def test_nan_is_never_a_hit(spark):
    df = scored(spark, [NAN, 0.2, None, 0.1])
    assert positions(srch.top_k(df, 2)) == [1, 3]
    assert positions(srch.top_k(df, 4)) == [1, 3]
    grouped = df.withColumn("g", F.lit(1))
    assert positions(srch.top_k(grouped, 4, by=["g"])) == [1, 3]


def test_small_and_large_k(spark):
    df = scored(spark, [0.2, 0.1])
    assert positions(srch.top_k(df, 0)) == []
    assert positions(srch.top_k(df, 5)) == [0, 1]
    with pytest.raises(ValueError):
        srch.top_k(df, -1)


def brute(x, queries, pos, k):
    """Every pair, scored in index order in double."""
    out = []
    for q in queries:
        rows = []
        for p, v in zip(pos, x):
            s = 0.0
            for a, b in zip(v.astype(float), q.astype(float)):
                s += a * b
            if not math.isnan(s):
                rows.append((-s, int(p)))
        out.append([(p, -s) for s, p in sorted(rows)[:k]])
    return out


def kernel(x, queries, pos, k, batch):
    top = TopK(queries, k)
    with np.errstate(all="ignore"):
        for lo in range(0, len(x), batch):
            top.update(x[lo : lo + batch], pos[lo : lo + batch])
    return [
        [(int(p), float(s)) for p, s in zip(top.pos[top.query == i], top.score[top.query == i])]
        for i in range(len(queries))
    ]


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_kernel_against_brute_force(data):
    dim = data.draw(st.integers(1, 6))
    # Few distinct values, so that copies and ties are common.
    value = st.sampled_from([0.0, 1.0, -1.0, 0.1, 0.3, -0.7, 1e-30, 3e20, NAN, math.inf])
    row = st.lists(value, min_size=dim, max_size=dim)
    x = np.array(data.draw(st.lists(row, min_size=1, max_size=40)), np.float32)
    queries = np.array(data.draw(st.lists(row, min_size=1, max_size=4)), np.float32)
    pos = np.array(data.draw(st.permutations(range(len(x)))), np.int64)
    k = data.draw(st.integers(0, 6))
    batch = data.draw(st.integers(1, 40))
    assert kernel(x, queries, pos, k, batch) == brute(x, queries, pos, k)


def test_kernel_with_a_third_of_copies():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 16)).astype(np.float32)
    x[::3] = x[0]
    pos = rng.permutation(len(x)).astype(np.int64)
    queries = np.concatenate([x[:1], rng.normal(size=(3, 16)).astype(np.float32)])
    assert kernel(x, queries, pos, 7, 1000) == brute(x, queries, pos, 7)


def test_kernel_with_zero_queries():
    x = np.array([[1.0, 2.0], [NAN, 1.0], [0.0, 0.0], [3.0, 4.0]], np.float32)
    queries = np.zeros((2, 2), np.float32)
    queries[1] = [1.0, 0.0]
    pos = np.array([7, 1, 5, 3], np.int64)
    for batch in (1, 2, 4):
        assert kernel(x, queries, pos, 2, batch) == brute(x, queries, pos, 2)


def test_copies_are_cut_to_the_lowest_positions():
    x = np.array([[1.0], [2.0], [1.0], [1.0]], np.float32)
    left = drop_excess_copies(x, np.array([9, 5, 3, 4]), 2)
    assert sorted(left.tolist()) == [1, 2, 3]


def test_equal_rows_get_equal_scores():
    rng = np.random.default_rng(2)
    row = rng.normal(size=37).astype(np.float32)
    x, q = np.tile(row, (101, 1)), np.tile(rng.normal(size=37), (101, 1))
    assert len(set(ordered_dot(x, q).tolist())) == 1


def random_store(spark, n=200, dim=8, parts=7):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x.astype(np.float32))]
    return vectors_df(spark, rows).repartition(parts), rows


def test_batch_equals_column_functions(spark):
    store, rows = random_store(spark)
    queries = vectors_df(spark, rows[:20], "query_id")
    batch = srch.search_batch(store, queries, 8, 5)
    pairs = store.crossJoin(queries.withColumnRenamed("embedding", "q"))
    scores = pairs.select(
        "query_id", "pos", vec.cosine_normed("embedding", "q").alias("score")
    )
    want = srch.top_k(scores, 5, by=["query_id"]).select(*batch.columns)
    assert batch.count() == 100
    assert batch.exceptAll(want).count() == 0 and want.exceptAll(batch).count() == 0


def test_blocks_of_queries_give_the_same_hits(spark):
    store, rows = random_store(spark)
    queries = vectors_df(spark, rows[:11], "query_id").repartition(3)
    whole = srch.search_batch(store, queries, 8, 4)
    blocks = srch.search_batch(store, queries, 8, 4, max_query_bytes=3 * 8 * 4)
    assert blocks.count() == 44
    assert blocks.exceptAll(whole).count() == 0


def test_single_vector(spark):
    store, rows = random_store(spark)
    hits = srch.search_vector(store, rows[17][1], 3).orderBy("rank").collect()
    assert hits[0].pos == 17 and hits[0].score == pytest.approx(1, abs=1e-6)
    assert [h.rank for h in hits] == [1, 2, 3]


def test_wrong_length_is_an_error(spark):
    store = vectors_df(spark, [(0, [1.0, 0.0]), (1, [1.0])])
    with pytest.raises(PySparkException, match="of length 2"):
        srch.search_vector(store, [1.0, 0.0]).collect()


def test_no_queries_and_no_rows(spark):
    store, rows = random_store(spark)
    none = vectors_df(spark, [], "query_id")
    assert srch.search_batch(store, none, 8).count() == 0
    some = vectors_df(spark, rows[:2], "query_id")
    assert srch.search_batch(store.limit(0), some, 8).count() == 0


def basis(i, dim=384, value=1.0):
    v = [0.0] * dim
    v[i] = value
    return v


def three_docs(spark):
    names = ["doc-one", "doc-two", "doc-three"]
    rows = [(i, basis(i), name) for i, name in enumerate(names)]
    return spark.createDataFrame(rows, "pos bigint, embedding array<float>, text string")


def half_and_one():
    v = basis(1)
    v[0] = 0.5
    return ConstantModel(v)


def query_of(spark, text="q"):
    return spark.createDataFrame([(1, text)], "query_id bigint, query string")


def test_end_to_end_with_a_fake_model(spark):
    hits = srch.search(three_docs(spark), query_of(spark), half_and_one(), 2)
    got = [(r.rank, round(r.score, 4), r.text) for r in hits.orderBy("rank").collect()]
    assert got == [(1, 0.8944, "doc-two"), (2, 0.4472, "doc-one")]


def test_padding(spark):
    hits = srch.search(three_docs(spark), query_of(spark), half_and_one(), 5, pad_to_k=True)
    got = [(r.rank, r.score, r.text) for r in hits.orderBy("rank").collect()]
    assert [g[0] for g in got] == [1, 2, 3, 4, 5]
    assert got[3:] == [(4, 0.0, ""), (5, 0.0, "")]
    none = srch.search(three_docs(spark), query_of(spark), half_and_one(), 0, pad_to_k=True)
    assert none.count() == 0


def test_empty_query(spark):
    store, blank = three_docs(spark), query_of(spark, " 　")
    with pytest.raises(PySparkException, match="query cannot be empty"):
        srch.search(store, blank, half_and_one())
    assert srch.search(store, blank, half_and_one(), strict=False).count() == 0


def test_text_lookup(spark):
    store, _ = random_store(spark)
    texts = store.filter("pos % 4 > 0").select("pos", F.concat(F.lit("t"), "pos").alias("text"))
    hits = store.select((F.col("pos") % 50).alias("pos"))
    want = sorted((p % 50, f"t{p % 50}" if p % 50 % 4 else "") for p in range(200))
    got = srch.attach_text(hits, texts)
    assert sorted((r.pos, r.text) for r in got.collect()) == want


def test_text_lookup_reads_only_the_files_of_the_hits(spark, tmp_path):
    store, rows = random_store(spark, parts=1)
    path = str(tmp_path / "store")
    table = store.orderBy("pos").select(
        F.col("pos").alias("doc_id"), F.lit(0).alias("chunk_pos"),
        F.concat(F.lit("t"), "pos").alias("text"), "embedding",
    )
    for at in range(0, 200, 50):
        some = table.filter(F.col("doc_id").between(at, at + 49))
        append_store(some.repartitionByRange(5, "doc_id"), path, 8, unit=True)
    held = Store(spark, path)
    assert sum(f[2] for f in held.files) == 200
    hits = spark.createDataFrame([(3,), (3,), (120,), (500,), (None,)], "pos bigint")
    files = held.files_of(hits)
    assert [any(f[1] <= p < f[1] + f[2] for p in (3, 120)) for f in files] == [True, True]
    assert len(held.at(hits).inputFiles()) == 2
    got = srch.attach_text(hits, held).collect()
    assert sorted((r.pos or -1, r.text) for r in got) == [
        (-1, ""), (3, "t3"), (3, "t3"), (120, "t120"), (500, "")]
    found = srch.search_batch(held.rows(), vectors_df(spark, rows[:30], "query_id"), 8, 1)
    # The appended order is the order of positions, so each vector finds itself.
    assert sorted((r.query_id, r.pos) for r in found.collect()) == [(i, i) for i in range(30)]


def test_tasks_send_only_what_may_win(spark):
    """Every vector as a query, over many tasks: far fewer rows than tasks x queries x k."""
    store, rows = random_store(spark, n=2_000, parts=40)
    queries = vectors_df(spark, rows, "query_id")
    sent = srch.scored_queries(store, queries, 8, 10, sample_rows=1_000).count()
    every = 40 * 2_000 * 10
    assert 2_000 * 10 <= sent < every / 10
    hits = srch.search_batch(store, queries, 8, 10)
    x = np.array([r[1] for r in rows], np.float32)
    scores = np.add.reduce([np.multiply.outer(x[:, d].astype(float), x[:, d]) for d in range(8)])
    order = np.lexsort((np.arange(2_000) + np.zeros((2_000, 1), int), -scores), axis=1)[:, :10]
    got = {}
    for r in hits.collect():
        got.setdefault(r.query_id, {})[r["rank"]] = r.pos
    assert all([got[q][i + 1] for i in range(10)] == order[q].tolist() for q in range(2_000))


def test_all_blocks_share_one_scan(spark, tmp_path):
    store, rows = random_store(spark, n=300)
    path = str(tmp_path / "store")
    store.write.parquet(path)
    queries = vectors_df(spark, rows[:100], "query_id")
    one = dict(max_query_bytes=8 * 8 * 4)
    held = spark.read.parquet(path)
    plan = plan_of(srch.search_batch(held, queries, 8, 3, **one))
    assert plan.count("FileScan parquet") == 1
    more = srch.search_batch(held, queries, 8, 3, max_shared_bytes=3 * 8 * 8 * 4, **one)
    whole = srch.search_batch(held, queries, 8, 3)
    assert more.count() == 300 and more.exceptAll(whole).count() == 0


@pytest.mark.parametrize("room", [1 << 20, 8 * 4])
def test_a_repeated_query_id_is_an_error(spark, room):
    store, rows = random_store(spark)
    twice = vectors_df(spark, [rows[0], rows[0]], "query_id")
    with pytest.raises(ValueError, match="repeat"):
        srch.search_batch(store, twice, 8, 2, max_query_bytes=room)


def test_plans(spark, tmp_path):
    path = str(tmp_path / "store")
    three_docs(spark).write.parquet(path)
    store = spark.read.parquet(path)
    single = plan_of(srch.search_vector(store, basis(1), 2))
    assert "TakeOrderedAndProject" in single and "Exchange" not in single
    assert "ReadSchema: struct<pos:bigint,embedding:array<float>>" in single
    queries = vectors_df(spark, [(0, basis(0)), (1, basis(1))], "query_id")
    batch = plan_of(srch.search_batch(store, queries, 384, 2))
    assert "WindowGroupLimit" in batch
    assert "CartesianProduct" not in batch and "NestedLoop" not in batch


def test_reports(spark):
    hits = srch.search(three_docs(spark), query_of(spark), half_and_one(), 2)
    lines = [r.line for r in render_hits(hits).orderBy("rank").collect()]
    assert lines == ["1) cos=0.8944", "2) cos=0.4472"]
    queries = spark.createDataFrame(
        [(1, 'say "hi"\n'), (2, "b"), (3, "\\\x01\x7f\t")], "query_id bigint, query string"
    )
    report = search_report(hits, queries).orderBy("query_id").collect()
    assert [(r.n_hits, r.line) for r in report] == [
        (2, 'Retrieved 2 results for query "say \\"hi\\"\\n"'),
        (0, 'Retrieved 0 results for query "b"'),
        (0, 'Retrieved 0 results for query "\\\\\\x01\\x7f\\t"'),
    ]


def test_nan_vectors_are_counted(spark):
    store = vectors_df(spark, [(0, [NAN, 1.0]), (1, [1.0, 0.0])])
    assert store.agg(srch.nan_vectors()).first()[0] == 1
    assert positions(srch.search_vector(store, [1.0, 0.0], 2)) == [1]


def test_query_ids_keep_their_type(spark):
    store, rows = random_store(spark)
    queries = spark.createDataFrame(
        [("a", rows[0][1]), ("b", rows[1][1])], "query_id string, embedding array<float>"
    )
    hits = srch.search_batch(store, queries, 8, 1).collect()
    assert sorted((h.query_id, h.pos) for h in hits) == [("a", 0), ("b", 1)]
    assert pa.types.is_string(srch.search_batch(store, queries, 8, 1).toArrow()["query_id"].type)
