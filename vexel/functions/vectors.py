"""Column functions on ``ARRAY<FLOAT>`` vectors.

Storage is FLOAT, accumulation is DOUBLE in index order.  These stay in the JVM;
the bulk scoring of :mod:`vexel.operators.search` adds up in the same order and
returns the same doubles.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dot(v: Column | str, u: Column | str) -> Column:
    """Dot product; vectors of unequal length are an error."""
    v, u = _col(v), _col(u)
    products = F.zip_with(v, u, lambda x, y: x.cast("double") * y.cast("double"))
    total = F.aggregate(products, F.lit(0.0), lambda acc, p: acc + p)
    return F.when(
        F.size(v) != F.size(u),
        F.raise_error(F.lit("dot: vectors are not of same size")).cast("double"),
    ).otherwise(total)


def cosine_normed(v: Column | str, u: Column | str) -> Column:
    """Cosine of two unit vectors: their dot product, without dividing by norms."""
    return dot(v, u)


def magnitude(v: Column | str) -> Column:
    """Euclidean length."""
    squares = F.aggregate(
        _col(v),
        F.lit(0.0),
        lambda acc, x: acc + x.cast("double") * x.cast("double"),
    )
    return F.sqrt(squares)


def normalise(v: Column | str) -> Column:
    """Scale to unit length; a zero vector stays as it is.

    The magnitude is bound once per row as a lambda variable.  Written straight
    into the inner lambda it would be added up again for every element.
    """
    v = _col(v)
    scaled = F.transform(
        F.array(magnitude(v)),
        lambda mag: F.when(mag == 0, v).otherwise(
            F.transform(v, lambda x: (x.cast("double") / mag).cast("float"))
        ),
    )
    return F.get(scaled, F.lit(0))


def is_valid_vector(v: Column | str, dim: int) -> Column:
    """True for a non-empty vector of length ``dim``."""
    return F.coalesce(
        (F.size(_col(v)) == F.lit(dim)) & F.lit(dim > 0), F.lit(False)
    )


def checked_vector(v: Column | str, dim: int) -> Column:
    """The vector itself, or an error if its length is 0 or not ``dim``."""
    v = _col(v)
    message = F.lit(f"embedding vector must be of length {dim}")
    return F.when(is_valid_vector(v, dim), v).otherwise(
        F.raise_error(message).cast("array<float>")
    )


def validate_vector(
    df: DataFrame, dim: int, col: str = "embedding", *, strict: bool = True
) -> DataFrame:
    """Fail on a wrong length (strict), or drop such rows."""
    if strict:
        return df.withColumn(col, checked_vector(col, dim))
    return df.filter(is_valid_vector(col, dim))


def has_nan(v: Column | str) -> Column:
    """True if any element is NaN: such a vector can never be a hit."""
    return F.exists(_col(v), lambda x: F.isnan(x))


def mean_pool(hidden: Column | str, mask: Column | str) -> Column:
    """Per-dimension mean over the token rows whose mask is 1.

    ``hidden`` is ``ARRAY<ARRAY<FLOAT>>`` (token, dimension).  With no unmasked
    token every element is NULL, where plain division would give NaN.
    """
    hidden, mask = _col(hidden), _col(mask)
    kept = F.filter(hidden, lambda _, i: F.get(mask, i) == 1)
    zeros = F.transform(F.get(hidden, F.lit(0)), lambda _: F.lit(0.0))
    sums = F.aggregate(
        kept,
        zeros,
        lambda acc, row: F.zip_with(acc, row, lambda a, x: a + x.cast("double")),
    )
    return F.transform(
        F.array(F.struct(sums.alias("s"), F.size(kept).alias("n"))),
        lambda t: F.transform(
            t["s"], lambda x: (x / F.nullif(t["n"], F.lit(0))).cast("float")
        ),
    )[0]


def mean_pool_rows(
    df: DataFrame, keys: list[str], hidden: str = "embedding", mask: str = "mask"
) -> DataFrame:
    """(keys, pooled): masked mean where every token is a row of its own.

    A vector aggregate: tasks add up whole vectors, and one partial sum per key and task
    is shuffled, whatever share of the rows a key holds.  No row is taken apart.  A key
    with no unmasked token has NULL elements.
    """
    kept = F.col(mask) == 1
    masked = F.when(kept, F.col(hidden)).otherwise(
        F.transform(hidden, lambda _: F.lit(0.0).cast("float"))
    )
    rows = df.select(
        *keys, array_to_vector(masked).alias("__v"), kept.cast("int").alias("__kept")
    )
    sums = rows.groupBy(*keys).agg(
        vector_to_array(Summarizer.sum(F.col("__v"))).alias("__sum"),
        F.sum("__kept").alias("__n"),
    )
    n = F.nullif("__n", F.lit(0))
    return sums.select(*keys, F.transform("__sum", lambda x: x / n).alias("pooled"))
