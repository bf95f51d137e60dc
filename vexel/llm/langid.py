"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased; n-grams of 1 to 4 characters (code points) are hashed into
``DIM`` bins.  The model is a matrix of log-probabilities (bins x languages) and the log
share of each language among the labelled rows, broadcast.  A batch is scored as the
non-zero entries of its matrix of counts times that matrix, added up in double.

Fit: at most about ``DOCS_PER_LANGUAGE`` labelled rows per language, chosen by a hash
of the id; this bound is a parameter.  Scoring reads every whole text.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; a letter is any
sign of Unicode category L; equal scores go to the language first in order; rows with null language are not learned
from; without any label every text is ``und``; repeated rows are scored each on its
own; only the named columns are read and returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vexel.llm.common import (
    hashed_below,
    held_out,
    sample_share,
    segment_sums,
    steps,
    text_column,
)

BITS = 15
DIM = 1 << BITS
ORDERS = (1, 2, 3, 4)
#: Bound of the rows the model is fitted on, per language.
DOCS_PER_LANGUAGE = 4_000
SMOOTHING = 0.5
UNKNOWN = "und"
_FIT_TASKS = 8
#: Texts are joined with as many of these as keep any n-gram from spanning two.
_GAP = "\0" * (max(ORDERS) - 1)
_LETTER = r"\p{L}"
#: Texts whose counts are held as one dense block.
_BLOCK = 64


def _features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all texts, in text order, and where each text's begin."""
    lowered = [t.lower().replace("\0", " ") for t in texts]
    joined = (_GAP.join(lowered) + _GAP).encode("utf-32-le", "replace")
    code = np.frombuffer(joined, np.uint32).astype(np.uint64)
    sizes = np.array([len(t) for t in lowered], np.int64)
    starts = np.cumsum(sizes + len(_GAP)) - (sizes + len(_GAP))
    n = len(code) - len(_GAP)
    grams = np.empty((n, len(ORDERS)), np.uint32)
    mixed = np.zeros(n, np.uint64)
    valid = np.ones(n, bool)
    for place, order in enumerate(ORDERS):
        part = code[order - 1 : order - 1 + n]
        mixed = mixed * np.uint64(0x100000001B3) + part
        valid &= part != 0
        # The order goes in, so that n-grams of two orders differ.
        scattered = (mixed + np.uint64(order)) * np.uint64(0x9E3779B97F4A7C15)
        # Bin DIM stands for "no n-gram here" and weighs nothing.
        grams[:, place] = np.where(valid, scattered >> np.uint64(64 - BITS), DIM)
    bounds = np.append(starts, n) * len(ORDERS)
    return grams.ravel(), np.minimum(bounds, grams.size)


def counts_of(grams: np.ndarray, bounds: np.ndarray):
    """The non-zero counts of some texts: (text, bin, count)."""
    texts = len(bounds) - 1
    owner = np.repeat(np.arange(texts), np.diff(bounds)) * (DIM + 1)
    dense = np.bincount(owner + grams[bounds[0] : bounds[-1]], minlength=texts * (DIM + 1))
    place = np.flatnonzero(dense)
    text, gram = np.divmod(place, DIM + 1)
    real = gram < DIM
    return text[real], gram[real], dense[place[real]]


def _count(languages: list[str]):
    place = {language: i for i, language in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), DIM + 1), np.int64)
        for batch in batches:
            texts = text_column(batch, "text")
            labels = batch.column("label").to_pylist()
            for a, b in steps(texts, 2 << 20):
                rows = texts.slice(a, b - a).to_pylist()
                grams, bounds = _features(rows)
                for i, label in enumerate(labels[a:b]):
                    part = grams[bounds[i] : bounds[i + 1]]
                    total[place[label]] += np.bincount(part, minlength=DIM + 1)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(len(languages)), pa.int32()),
                pa.array([row[:DIM].tobytes() for row in total], pa.binary()),
            ],
            names=["language", "counts"],
        )

    return run


class Model:
    """``log_prob[DIM x languages]`` and ``prior[languages]``, in double."""

    def __init__(self, languages: list[str], log_prob: np.ndarray, prior: np.ndarray) -> None:
        self.languages = languages
        self.log_prob = log_prob
        self.prior = prior

    def log_scores(self, texts: list[str]) -> np.ndarray:
        """Log of prior times likelihood: a row per text, a column per language."""
        grams, bounds = _features(texts)
        out = np.tile(self.prior, (len(texts), 1))
        for a in range(0, len(texts), _BLOCK):
            part = bounds[a : a + _BLOCK + 1]
            text, gram, count = counts_of(grams, part)
            at = np.searchsorted(text, np.arange(len(part)))
            out[a : a + _BLOCK] += segment_sums(self.log_prob[gram] * count[:, None], at)
        return out

    def score(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        sums = self.log_scores(texts)
        best = sums.argmax(axis=1)
        spread = np.exp(sums - sums.max(axis=1, keepdims=True))
        share = 1.0 / spread.sum(axis=1)
        letters = pc.match_substring_regex(pa.array(texts, pa.string()), _LETTER)
        known = letters.to_numpy(zero_copy_only=False).astype(bool)
        names = [
            self.languages[b] if k else UNKNOWN
            for b, k in zip(best, known, strict=True)
        ]
        return names, np.where(known, share, 0.0)


def fit(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    language: str = "lang",
    docs_per_language: int = DOCS_PER_LANGUAGE,
) -> Model:
    """Learn from the rows of ``docs`` that have a language."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col(key).alias("id"), F.col(text).alias("text"), F.col(language).alias("label")
    ).where(F.col("label").isNotNull())
    # One row per language label.
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((DIM, 0)), np.zeros(0))
    shares = spark.createDataFrame(
        list(sample_share(sizes, docs_per_language).items()), "label string, share double"
    )
    # Bounded by the parameter, so a fixed number of tasks and of result rows.
    sample = (
        rows.join(F.broadcast(shares), "label")
        .where(hashed_below("id", F.col("share")))
        # By id, for copies of one text may be many.
        .repartition(_FIT_TASKS, F.xxhash64("id", "text"))
        .select("text", "label")
    )
    counts = np.zeros((len(languages), DIM), np.float64)
    for row in sample.mapInArrow(
        _count(languages), "language int, counts binary"
    ).collect():
        counts[row["language"]] += np.frombuffer(row["counts"], np.int64)
    log_prob = np.log(counts + SMOOTHING)
    log_prob -= np.log((counts + SMOOTHING).sum(axis=1, keepdims=True))
    rows_of = np.array([sizes[language] for language in languages], float)
    return Model(languages, log_prob.T.copy(), np.log(rows_of / rows_of.sum()))


def predict(
    docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, lang_pred, score) for every row of ``docs``."""
    spark = docs.sparkSession
    # (bins x languages) floats: its size depends on the labels, not on the data.
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select(F.col(key).alias(key), F.col(text).alias("__text"))
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_column(batch, "__text")
            for a, b in steps(texts, 1 << 20):
                names, scores = shared.value.score(texts.slice(a, b - a).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(key).slice(a, b - a),
                        pa.array(names, pa.string()),
                        pc.cast(pa.array(scores), pa.float64()),
                    ],
                    names=[key, "lang_pred", "score"],
                )

    return rows.mapInArrow(run, f"`{key}` {kind}, lang_pred string, score double")


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    """Contract rows of op9: fit on the other folds, predict every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs.where(~held_out("doc_id")))
    found = predict(docs, model)
    return found.select(
        "doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score"
    )
