"""Running a model over a text column."""

from __future__ import annotations

import hashlib
import sys
import time
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Accumulator, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vexel.operators.kernels import from_matrix, ordered_dot, unit_rows
from vexel.operators.models import EmbeddingModel, PredictFn
from vexel.schema import VECTOR

#: Pickled bytes of the models that a Python worker keeps loaded, about.
KEPT_BYTES = 1 << 30


def _registry() -> dict:
    """The worker's loaded models: key to (function, bytes), the last used at the end.

    Functions sent to a worker by value get fresh globals in every task, so the
    registry is a module of the interpreter.
    """
    module = sys.modules.setdefault(
        "vexel_loaded_models", types.ModuleType("vexel_loaded_models")
    )
    return module.__dict__.setdefault("loaded", {})


def model_key(model: EmbeddingModel) -> tuple[str, int]:
    """A digest of the model's content, the same in every query and session, and its
    pickled size."""
    raw = cloudpickle.dumps(model)
    return hashlib.sha256(raw).hexdigest(), len(raw)


def loaded(model: EmbeddingModel, key: str, size: int) -> PredictFn:
    """The model's function, made once per Python worker and model content.

    Models that would take the worker over ``KEPT_BYTES`` push out those unused longest.
    """
    known = _registry()
    if key in known:
        known[key] = known.pop(key)
    else:
        while known and sum(n for _, n in known.values()) + size > KEPT_BYTES:
            known.pop(next(iter(known)))
        known[key] = (model.make_predict_fn(), size)
    return known[key][0]


def _predict(run: PredictFn, model: EmbeddingModel, texts: np.ndarray) -> np.ndarray:
    if not len(texts):
        return np.zeros((0, model.dim), np.float32)
    parts = [
        np.asarray(run(texts[lo : lo + model.batch_size]), np.float32)
        for lo in range(0, len(texts), model.batch_size)
    ]
    if any(p.ndim != 2 or p.shape[1] != model.dim for p in parts):
        raise ValueError(f"embedding vector must be of length {model.dim}")
    vectors = np.concatenate(parts)
    if len(vectors) != len(texts) or model.dim == 0:
        raise ValueError("the model must return one vector per text")
    return vectors


def _apply(
    df: DataFrame,
    model: EmbeddingModel,
    finish: Callable[[np.ndarray], np.ndarray],
    kind: T.DataType,
    input_col: str,
    output_col: str,
    timer: Accumulator | None = None,
) -> DataFrame:
    """Add ``finish(vectors)``; the model sees each distinct text of a batch once."""
    key, size = model_key(model)

    @F.arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        started = time.perf_counter()
        predict = loaded(model, key, size)
        spent = time.perf_counter() - started
        for texts in batches:
            started = time.perf_counter()
            coded = texts.fill_null("").dictionary_encode()
            distinct = coded.dictionary.to_numpy(zero_copy_only=False)
            out = finish(_predict(predict, model, distinct))
            out = out[coded.indices.to_numpy()]
            found = from_matrix(out) if out.ndim == 2 else pa.array(out)
            spent += time.perf_counter() - started
            yield found
        if timer is not None:
            timer.add(spent)

    # Marked so that no later filter or projection is merged with it and runs the
    # model a second time; an unused column is still pruned.
    return df.withColumn(output_col, run.asNondeterministic()(F.col(input_col)))


def embed(
    df: DataFrame,
    model: EmbeddingModel,
    input_col: str = "chunk",
    output_col: str = "embedding",
    *,
    unit: bool = False,
    timer: Accumulator | None = None,
) -> DataFrame:
    """Add the model's vector for each text; ``unit`` also normalises it.

    The vector is a column of the same row, so a chunk and its embedding cannot
    drift apart.  Tasks add the seconds they spend in the model to ``timer``.
    """
    finish = unit_rows if unit else (lambda vectors: vectors)
    return _apply(df, model, finish, VECTOR, input_col, output_col, timer)


def embed_score(
    df: DataFrame,
    model: EmbeddingModel,
    query_vector: list[float],
    input_col: str = "chunk",
    output_col: str = "score",
) -> DataFrame:
    """Add the cosine of each text with a unit query vector.

    Embeds, normalises and scores in one Python step, so that no vector goes back
    to the JVM.  For searching texts that are not stored.
    """
    if len(query_vector) != model.dim:
        raise ValueError("dot: vectors are not of same size")
    query = np.array(query_vector, np.float32)

    def finish(vectors: np.ndarray) -> np.ndarray:
        return ordered_dot(unit_rows(vectors), np.broadcast_to(query, vectors.shape))

    return _apply(df, model, finish, T.DoubleType(), input_col, output_col)
