import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from vexel.functions import vectors as vec

floats = st.floats(-100, 100, width=32)


def one(spark, expr, **arrays):
    cols = ", ".join(f"{k} array<float>" for k in arrays)
    return spark.createDataFrame([tuple(arrays.values())], cols).select(expr).first()[0]


def test_length_check(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],)], "embedding array<float>")
    assert vec.validate_vector(df, 3).count() == 1
    with pytest.raises(PySparkException, match="of length 4"):
        vec.validate_vector(df, 4).collect()
    empty = spark.createDataFrame([([],), (None,)], "embedding array<float>")
    for row in empty.collect():
        alone = spark.createDataFrame([row], "embedding array<float>")
        with pytest.raises(PySparkException, match="of length 0"):
            vec.validate_vector(alone, 0).collect()
    assert vec.validate_vector(empty, 0, strict=False).count() == 0


def test_dot(spark):
    assert one(spark, vec.dot("v", "u"), v=[1.0, 2.0, 3.0], u=[4.0, 5.0, 6.0]) == 32
    with pytest.raises(PySparkException, match="not of same size"):
        one(spark, vec.dot("v", "u"), v=[1.0, 2.0], u=[3.0])


def test_dot_accumulates_in_double(spark):
    assert one(spark, vec.dot("v", "u"), v=[1e8, 1.0, -1e8], u=[1.0, 1.0, 1.0]) == 1


def test_magnitude_and_normalise(spark):
    assert one(spark, vec.magnitude("v"), v=[3.0, 4.0]) == 5
    unit = one(spark, vec.normalise("v"), v=[3.0, 4.0])
    assert unit == pytest.approx([0.6, 0.8], abs=1e-6)
    assert one(spark, vec.normalise("v"), v=[0.0, 0.0]) == [0, 0]
    assert one(spark, vec.normalise("v"), v=[]) == []


def test_cosine_of_unit_vectors(spark):
    assert one(spark, vec.cosine_normed("v", "u"), v=[1.0, 0.0], u=[1.0, 0.0]) == 1
    assert one(spark, vec.cosine_normed("v", "u"), v=[1.0, 0.0], u=[0.0, 1.0]) == 0


@settings(max_examples=5, deadline=None)
@given(st.lists(floats, min_size=1, max_size=12))
def test_normalise_has_length_one(spark, values):
    length = one(spark, vec.magnitude(vec.normalise("v")), v=values)
    # Below the smallest double square, a vector counts as zero.
    zero = math.fsum(x * x for x in values) == 0
    assert length == pytest.approx(0 if zero else 1, abs=1e-5)


def test_nan_is_found(spark):
    assert one(spark, vec.has_nan("v"), v=[1.0, float("nan")]) is True
    assert one(spark, vec.has_nan("v"), v=[1.0]) is False


def pooled(spark, hidden, mask):
    df = spark.createDataFrame(
        [(hidden, mask)], "h array<array<float>>, m array<bigint>"
    )
    return df.select(vec.mean_pool("h", "m")).first()[0]


def test_mean_pool(spark):
    rows = [[1.0, 2.0, 3.0], [4.0, 5.0, 6.0], [7.0, 8.0, 9.0], [10.0, 11.0, 12.0]]
    assert pooled(spark, rows, [1, 1, 0, 0]) == [2.5, 3.5, 4.5]
    assert pooled(spark, [[1.0] * 2, [2.0] * 2, [3.0] * 2], [1, 0, 1]) == [2, 2]
    assert pooled(spark, [[4.0] * 2, [5.0] * 2, [6.0] * 2], [0, 1, 1]) == [5.5, 5.5]
    assert pooled(spark, rows, [0, 0, 0, 0]) == [None, None, None]


def test_mean_pool_rows_combines_before_the_shuffle(spark):
    rows = [(1, [1.0, 2.0], 1), (1, [3.0, 6.0], 1), (1, [9.0, 9.0], 0), (2, [1.0, 1.0], 0)]
    df = spark.createDataFrame(rows, "k int, embedding array<float>, mask int")
    out = vec.mean_pool_rows(df, ["k"])
    got = {r.k: r.pooled for r in out.collect()}
    assert got[1] == pytest.approx([2, 4]) and got[2] == [None, None]
    plan = out._jdf.queryExecution().executedPlan().toString()
    # Whole vectors are added up before the shuffle; no row is taken apart.
    assert "partial_" in plan and "Generate" not in plan


def test_normalise_binds_the_magnitude_once(spark):
    df = spark.createDataFrame([([3.0, 4.0],)], "v array<float>").repartition(1)
    plan = df.select(vec.normalise(F.col("v")).alias("u"))._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("aggregate(") == 1
