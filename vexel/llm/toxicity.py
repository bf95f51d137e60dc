"""Toxicity by multiple-instance learning: documents are bags of sentences.

Only documents carry labels.  A sentence scores ``p = sigmoid(b + sum of its words'
weights)`` and a document the noisy-or ``1 - prod(1 - p)``: it is toxic if any
sentence is.  The log-likelihood of the document labels is maximised over the word
weights, so the sentence scores, which locate what offends, come from document labels
alone.  A word's weight is the sum over its hashed features: the word and its
beginnings of 3 to 6 letters.

Fit: at most about ``DOCS_PER_CLASS`` documents per label, chosen by a hash of the id,
and of those at most ``MAX_FIT_WORDS`` words in that order; both bounds are parameters.
The classes are weighted back to their shares.  One task fits, as its input is bounded.
Scoring reads every whole text.

Defined cases: a null or empty text has no sentence and scores 0; labels other than 0
and 1, and labels of unknown documents, are not learned from; of several labels of one
document the larger counts; without both classes every score is 0; repeated rows are
scored each on its own; only the named columns are read and returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

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
    value_offsets,
)

BITS = 18
DIM = 1 << BITS
PREFIXES = (3, 4, 5, 6)
#: Bounds of what the model is fitted on.
DOCS_PER_CLASS = 3_000
MAX_FIT_WORDS = 6_000_000
ROUNDS = 80
_STEP = 0.3
_RIDGE = 2e-4
_SENTENCE_END = r"[.!?\n]+"
_EDGE = ".,;:!?\"'()[]{}<>|*#$%&-_=+/\\"


def _word_features(words: list[str]) -> np.ndarray:
    """(words, features) bins; bin DIM weighs nothing."""
    out = np.full((len(words), 1 + len(PREFIXES)), DIM, np.int32)
    low = DIM - 1
    for i, word in enumerate(words):
        if not word:
            continue
        out[i, 0] = crc32(word.encode("utf-8", "replace")) & low
        for j, size in enumerate(PREFIXES, 1):
            if len(word) > size:
                prefix = f"{size}^{word[:size]}"
                out[i, j] = crc32(prefix.encode("utf-8", "replace")) & low
    return out


class _Bags:
    """Texts cut into sentences and words; words are coded by a dictionary."""

    def __init__(self, texts: pa.Array) -> None:
        sentences = pc.split_pattern_regex(pc.utf8_lower(texts), _SENTENCE_END)
        self.sentence_at = value_offsets(sentences)
        flat = sentences.values.slice(
            self.sentence_at[0], self.sentence_at[-1] - self.sentence_at[0]
        )
        self.sentence_at = self.sentence_at - self.sentence_at[0]
        self.flat = flat
        words = pc.ascii_split_whitespace(flat)
        self.word_at = value_offsets(words)
        raw = words.values.slice(self.word_at[0], self.word_at[-1] - self.word_at[0])
        self.word_at = self.word_at - self.word_at[0]
        coded = raw.dictionary_encode()
        trimmed = pc.utf8_trim(coded.dictionary, characters=_EDGE).dictionary_encode()
        self.words = trimmed.dictionary.to_pylist()
        self.codes = trimmed.indices.to_numpy()[coded.indices.to_numpy()]
        real = np.array([bool(w) for w in self.words], np.int64)
        #: Words of each sentence, without those of signs alone.
        self.counts = self.sentence_sums(real)

    def sentence_sums(self, word_weight: np.ndarray) -> np.ndarray:
        return segment_sums(word_weight[self.codes], self.word_at)


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return np.exp(-np.logaddexp(0.0, -z))


class Model:
    """``weights[DIM]`` belongs to absent features and is 0."""

    def __init__(self, weights: np.ndarray, bias: float) -> None:
        self.weights = weights
        self.bias = bias

    def score(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, _Bags]:
        """Document scores, sentence scores and the sentences."""
        bags = _Bags(texts)
        weight = self.weights[_word_features(bags.words)].sum(axis=1, dtype=float)
        z = bags.sentence_sums(weight) + self.bias
        # A sentence without words says nothing.
        z = np.where(bags.counts > 0, z, -np.inf)
        total = segment_sums(_softplus(z), bags.sentence_at)
        return -np.expm1(-total), _sigmoid(z), bags


def _fit(texts: pa.Array, y: np.ndarray, weight: np.ndarray, rounds: int) -> Model:
    """Adam on the whole (bounded) sample."""
    bags = _Bags(texts)
    features = _word_features(bags.words)
    used, local = np.unique(features, return_inverse=True)
    local = local.reshape(features.shape)
    absent = used == DIM
    words = np.diff(bags.word_at)
    sentence_of_word = np.repeat(np.arange(len(words)), words)
    doc_of_sentence = np.repeat(np.arange(len(y)), np.diff(bags.sentence_at))
    share = float((weight * y).sum() / weight.sum())
    per_doc = max(1.0, len(words) / max(1, len(y)))
    b = float(np.log(-np.log1p(-share) / per_doc))
    w = np.zeros(len(used))
    m, v = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for round_ in range(1, rounds + 1):
        z = bags.sentence_sums(w[local].sum(axis=1)) + b
        z = np.where(bags.counts > 0, z, -np.inf)
        total = np.maximum(segment_sums(_softplus(z), bags.sentence_at), 1e-9)
        slope = weight * np.where(y > 0, -1.0 / np.expm1(np.minimum(total, 50)), 1.0)
        by_sentence = slope[doc_of_sentence] * _sigmoid(z) / weight.sum()
        by_word = np.bincount(
            bags.codes, by_sentence[sentence_of_word], minlength=len(bags.words)
        )
        grad = np.bincount(
            local.ravel(),
            np.repeat(by_word, local.shape[1]),
            minlength=len(used),
        )
        grad = np.append(grad + _RIDGE * w / 100, by_sentence.sum())
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        step = _STEP * (m / (1 - 0.9**round_)) / (
            np.sqrt(v / (1 - 0.99**round_)) + 1e-7
        )
        w = w - step[:-1]
        w[absent] = 0.0
        b -= step[-1]
    weights = np.zeros(DIM + 1, np.float32)
    weights[used] = w
    weights[DIM] = 0.0
    return Model(weights, b)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    docs_per_class: int = DOCS_PER_CLASS,
    max_words: int = MAX_FIT_WORDS,
    rounds: int = ROUNDS,
) -> Model:
    """Learn from the documents that have a label 0 or 1."""
    marked = (
        labels.where(F.col(label).isin(0, 1))
        .groupBy(F.col(key).alias("id"))
        .agg(F.max(label).cast("int").alias("y"))
        .where(F.col("id").isNotNull())
    )
    sizes = {r["y"]: r["count"] for r in marked.groupBy("y").count().collect()}
    nothing = Model(np.zeros(DIM + 1, np.float32), -np.inf)
    if len(sizes) < 2:
        return nothing
    shares = sample_share(sizes, docs_per_class)
    share = F.when(F.col("y") == 1, shares[1]).otherwise(shares[0])
    # At most about twice docs_per_class ids, so a broadcast keeps the texts in place.
    chosen = marked.where(hashed_below("id", share)).withColumn(
        "order", F.xxhash64("id", F.lit(1))
    )
    sample = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(
        F.broadcast(chosen), "id"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, ys, left = [], [], max_words
        for batch in batches:
            part = text_column(batch, "text")
            sizes = pc.list_value_length(pc.ascii_split_whitespace(part)).to_pylist()
            taken = []
            for i, size in enumerate(sizes):
                # A text that does not fit is passed over, not the end of the sample.
                if size <= left:
                    taken.append(i)
                    left -= size
            some = pa.array(taken, pa.int64())
            texts.append(part.take(some))
            ys.append(batch.column("y").take(some).to_numpy())
        y = np.concatenate(ys) if ys else np.zeros(0)
        if len(np.unique(y)) < 2:
            return
        model = _fit(
            pa.concat_arrays(texts),
            y.astype(float),
            np.where(y == 1, 1 / shares[1], 1 / shares[0]),
            rounds,
        )
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.weights.tobytes()]), pa.array([float(model.bias)])],
            names=["weights", "bias"],
        )

    rows = (
        sample.select("order", "id", "text", "y")
        .repartition(1)
        .sortWithinPartitions("order", "id", "text")
        .mapInArrow(run, "weights binary, bias double")
        .collect()
    )
    if not rows:
        return nothing
    return Model(np.frombuffer(rows[0]["weights"], np.float32), rows[0]["bias"])


def score(
    docs: DataFrame,
    model: Model,
    key: str = "doc_id",
    text: str = "text",
    locate: bool = False,
) -> DataFrame:
    """(key, score) for every row; with ``locate`` also ``offending``.

    ``offending`` lists the sentences that score 0.5 or more, lower-cased, with their
    scores, in text order.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # DIM floats
    rows = docs.select(F.col(key).alias(key), F.col(text).alias("__text"))
    kind = rows.schema[key].dataType.simpleString()
    out = f"`{key}` {kind}, score double"
    if locate:
        out += ", offending array<struct<sentence:string,score:double>>"
    found_type = pa.list_(
        pa.struct([("sentence", pa.string()), ("score", pa.float64())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_column(batch, "__text")
            for a, b in steps(texts):
                whole, parts, bags = shared.value.score(texts.slice(a, b - a))
                columns = [batch.column(key).slice(a, b - a), pa.array(whole)]
                if locate:
                    found: list[list[dict]] = [[] for _ in range(b - a)]
                    hits = np.flatnonzero(parts >= 0.5)
                    owner = np.searchsorted(bags.sentence_at, hits, "right") - 1
                    for hit, doc in zip(hits, owner, strict=True):
                        found[doc].append(
                            {
                                "sentence": bags.flat[int(hit)].as_py().strip(),
                                "score": float(parts[hit]),
                            }
                        )
                    columns.append(pa.array(found, found_type))
                names = [key, "score", "offending"][: len(columns)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, out)


def with_scores(
    docs: DataFrame, model: Model, name: str, text: str = "text"
) -> DataFrame:
    """``docs`` with a column of document scores; only the text goes to Python."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            texts = texts.fill_null("")
            parts = [shared.value.score(texts.slice(a, b - a))[0] for a, b in steps(texts)]
            yield pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return docs.withColumn(name, run.asNondeterministic()(F.col(text)))


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    """Contract rows of op4: fit on the other folds, score every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit(docs, labels.where(~held_out("doc_id")))
    return score(docs, model).select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def toxicity_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that are not rejected, with all their columns.

    Null and empty texts score 0 and stay; rows are judged each on its own, whatever
    their id; without labels of both kinds all stay.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit(docs, labels.where(~held_out("doc_id")))
    return with_scores(docs, model, "__toxic").where("__toxic < 0.5").select(*docs.columns)
