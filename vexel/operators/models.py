"""Embedding models: anything with ``dim`` and ``make_predict_fn()``.

``make_predict_fn`` runs once per Python worker and returns a function from a
NumPy array of strings to a float32 array of shape (rows, dim).
"""

from __future__ import annotations

import hashlib
from abc import ABC, abstractmethod
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from vexel.schema import DEFAULT_DIM, DEFAULT_MAX_TOKENS, DEFAULT_PAD_TO

PredictFn = Callable[[np.ndarray], np.ndarray]


class EmbeddingModel(ABC):
    """Contract of a pluggable model."""

    dim: int
    batch_size: int = 16_384

    @abstractmethod
    def make_predict_fn(self) -> PredictFn: ...


class HashingModel(EmbeddingModel):
    """Signed token counts, hashed into ``dim`` buckets.

    Tokens are lower-cased runs of letters and digits.  A token's bucket is its
    first 8 md5 hex digits modulo ``dim``; it counts +1 if the 9th digit is even
    and -1 if odd.  Lexical, not semantic, but it needs no weights and can be
    restated in SQL.
    """

    def __init__(self, dim: int = 64) -> None:
        if dim <= 0:
            raise ValueError("dim must be positive")
        self.dim = dim

    def make_predict_fn(self) -> PredictFn:
        dim = self.dim

        def predict(texts: np.ndarray) -> np.ndarray:
            lowered = pc.utf8_lower(pa.array(texts, pa.string()))
            parts = pc.split_pattern_regex(lowered, r"[^\p{L}\p{N}]+")
            row = pc.list_parent_indices(parts).to_numpy()
            # Each distinct token of the batch is hashed once.
            coded = parts.flatten().dictionary_encode()
            words = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False)
            digests = b"".join([hashlib.md5(w).digest() for w in words])
            raw = np.frombuffer(digests, np.uint8).reshape(len(words), 16)
            bucket = raw[:, :4].copy().view(">u4").ravel().astype(np.int64) % dim
            sign = np.where(raw[:, 4] >> 4 & 1, -1.0, 1.0)
            # An empty piece at either end of a text is not a token.
            sign[pc.equal(coded.dictionary, "").to_numpy(zero_copy_only=False)] = 0.0
            code = coded.indices.to_numpy()
            sums = np.bincount(
                row * dim + bucket[code],
                weights=sign[code],
                minlength=len(texts) * dim,
            )
            return sums.reshape(len(texts), dim).astype(np.float32)

        return predict


class ConstantModel(EmbeddingModel):
    """The same vector for every text; for tests of search."""

    def __init__(self, vector: Sequence[float]) -> None:
        self.vector = [float(x) for x in vector]
        self.dim = len(self.vector)

    def make_predict_fn(self) -> PredictFn:
        vector = np.array(self.vector, np.float32)
        return lambda texts: np.tile(vector, (len(texts), 1))


class OnnxModel(EmbeddingModel):
    """A sentence-transformer ONNX graph with its ``tokenizer.json``.

    Texts are truncated, padded on the right to ``pad_to`` (or to the longest row
    of the batch if that is longer), run, and mean-pooled over unmasked tokens.
    Both paths must be readable on every executor.
    """

    batch_size = 64

    def __init__(
        self,
        model_path: str,
        tokenizer_path: str,
        dim: int = DEFAULT_DIM,
        max_tokens: int = DEFAULT_MAX_TOKENS,
        pad_to: int = DEFAULT_PAD_TO,
    ) -> None:
        self.model_path = model_path
        self.tokenizer_path = tokenizer_path
        self.dim = dim
        self.max_tokens = max_tokens
        self.pad_to = pad_to

    def make_predict_fn(self) -> PredictFn:
        try:
            import onnxruntime
            from tokenizers import Tokenizer
        except ImportError as error:
            raise RuntimeError("OnnxModel needs onnxruntime and tokenizers") from error
        options = onnxruntime.SessionOptions()
        # One Spark task is one core.
        options.intra_op_num_threads = 1
        options.inter_op_num_threads = 1
        session = onnxruntime.InferenceSession(
            self.model_path, options, providers=["CPUExecutionProvider"]
        )
        tokenizer = Tokenizer.from_file(self.tokenizer_path)
        tokenizer.enable_truncation(self.max_tokens)
        tokenizer.no_padding()
        wanted = {i.name for i in session.get_inputs()}
        pad_to = self.pad_to

        def predict(texts: np.ndarray) -> np.ndarray:
            encoded = tokenizer.encode_batch(list(texts), add_special_tokens=True)
            width = max([pad_to, *(len(e.ids) for e in encoded)])
            ids = np.zeros((len(encoded), width), np.int64)
            mask = np.zeros_like(ids)
            types = np.zeros_like(ids)
            for i, e in enumerate(encoded):
                n = len(e.ids)
                ids[i, :n] = e.ids
                mask[i, :n] = e.attention_mask
                types[i, :n] = e.type_ids
            feed = {
                "input_ids": ids,
                "attention_mask": mask,
                "token_type_ids": types,
            }
            (hidden,) = session.run(
                ["last_hidden_state"], {k: v for k, v in feed.items() if k in wanted}
            )
            return masked_mean(hidden, mask)

        return predict


def masked_mean(hidden: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """(rows, tokens, dim) and (rows, tokens) to (rows, dim); no token gives NaN."""
    sums = np.einsum("rtd,rt->rd", hidden.astype(np.float64), mask)
    with np.errstate(invalid="ignore"):
        return (sums / mask.sum(axis=1, keepdims=True)).astype(np.float32)
