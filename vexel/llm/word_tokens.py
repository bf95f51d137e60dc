"""Token ids of whole texts, with a cache of words.

The vocabulary file cuts a text at white space and between letters, digits and
other signs before it merges, so a text's ids are the ids of its words in order,
and a word of letters with a full stop or comma behind it has the ids of both.
Words repeat, so each is given to the tokenizers library once per worker.
"""

from __future__ import annotations

import os
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from vexel.llm.common import value_offsets

#: Words kept per worker (about 80 MB); beyond it the more used half stays.
CACHE_WORDS = 400_000
#: Bytes of text to encode at once.
ENCODE_BYTES = 4 << 20
#: A word that may be cut before its last sign: letters that are letters in every
#: Unicode version and compose with nothing behind them.
_LETTERS_AND_SIGN = "^[A-Za-zÀ-ÖØ-öø-įı-ſ]+[.,;:!?]$"
#: Each of these letters has one small letter, whatever stands beside it.
_ANY_LETTERS = "^[A-Za-zÀ-ÖØ-öø-įı-ſ]+$"
_LETTERS = "^[a-zß-öø-įı-ſ]+$"
_TOGETHER = 1_000
#: What the vocabulary puts behind the last token of each piece.
_WORD_END = "</w>"

_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a vocabulary file, loaded once per process."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


class WordEncoder:
    def __init__(self, path: str) -> None:
        # Spark's tasks are the parallelism; threads would each keep memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._tokenizer = Tokenizer.from_file(path)
        vocabulary = self._tokenizer.get_vocab()
        self._closes = np.zeros(max(vocabulary.values()) + 1, bool)
        closing = [i for token, i in vocabulary.items() if token.endswith(_WORD_END)]
        self._closes[closing] = True
        self._reset()

    def _encode(self, texts: list[str]) -> list:
        return self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)

    def _reset(self) -> None:
        self._slot: dict[str, int] = {"": 0}
        self._ids = np.zeros(1 << 16, np.uint32)
        self._end = np.zeros(1 << 14, np.int32)
        self._hits = np.zeros(1 << 14, np.int32)
        self._slots, self._used = 1, 0

    def _evict(self) -> None:
        """Keep the half of the words that more steps have used; the rest is forgotten."""
        hits = self._hits[: self._slots]
        least = int(np.partition(hits, self._slots - CACHE_WORDS // 2)[-CACHE_WORDS // 2])
        # Of equals none stays, so that at most half does.
        kept = [(w, i) for w, i in self._slot.items() if i and hits[i] > least]
        old_ids, old_end, old_hits = self._ids, self._end, self._hits
        self._reset()
        if not kept:
            return
        words, slots = zip(*kept, strict=True)
        slots = np.array(slots)
        begin, end = old_end[slots - 1], old_end[slots]
        parts = [old_ids[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
        self._store(list(words), np.concatenate(parts), np.cumsum(end - begin))
        self._hits[1 : self._slots] = old_hits[slots] // 2

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's ids start."""
        # Space, newline and the like only: other white space stays in its word
        # and is the library's to judge.
        lists = pc.ascii_split_whitespace(texts)
        words = lists.values.slice(0, value_offsets(lists)[-1]).dictionary_encode()
        first, second = self._slots_of(words.dictionary)
        codes = words.indices.to_numpy()
        pairs = np.stack([first[codes], second[codes]], axis=1).ravel()
        begin = np.where(pairs > 0, self._end[pairs - 1], 0)
        lengths = self._end[pairs] - begin
        ends = np.cumsum(lengths, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        shift = (begin - (ends - lengths)).astype(np.int32)
        take = np.arange(total, dtype=np.int32)
        take += np.repeat(shift, lengths)
        after = np.concatenate([[0], ends])
        at = after[2 * value_offsets(lists)]
        # Else Arrow keeps what one step needed, for every worker.
        pa.default_memory_pool().release_unused()
        return self._ids[take], at

    def _slots_of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Cache slots of each word: of the whole, or of its letters and last sign."""
        if len(self._slot) > CACHE_WORDS:
            self._evict()
        signed = pc.match_substring_regex(words, _LETTERS_AND_SIGN)
        tails = pc.if_else(signed, pc.utf8_slice_codeunits(words, -1, None), "")
        heads = pc.if_else(signed, pc.utf8_slice_codeunits(words, 0, -1), words)
        # Other letters the library lowers by its own rules.
        plain = pc.or_(
            pc.string_is_ascii(heads), pc.match_substring_regex(heads, _ANY_LETTERS)
        )
        heads = pc.if_else(plain, pc.utf8_lower(heads), heads)
        return self._slot_array(heads), self._slot_array(tails)

    def _slot_array(self, parts: pa.Array) -> np.ndarray:
        coded = parts.dictionary_encode()
        unique = coded.dictionary.to_pylist()
        found = map(self._slot.get, unique, repeat(-1))
        slots = np.fromiter(found, np.int32, len(unique))
        new = np.flatnonzero(slots < 0)
        if len(new):
            words = list(map(unique.__getitem__, new.tolist()))
            slots[new] = self._learn(coded.dictionary.take(pa.array(new)), words)
        self._hits[slots] += 1
        return slots[coded.indices.to_numpy()]

    def _learn(self, new: pa.Array, words: list[str]) -> np.ndarray:
        # Words of letters alone are one piece each, so many go into one text and its
        # pieces, told by their ends, are theirs in order; the others go one by one.
        slots = np.zeros(len(new), np.int32)
        letters = pc.match_substring_regex(new, _LETTERS).to_numpy(zero_copy_only=False)
        for at, part in _parts(words, np.flatnonzero(letters)):
            ids = np.array(self._encode([" ".join(part)])[0].ids, np.uint32)
            ends = np.flatnonzero(self._closes[ids]) + 1
            if len(ends) != len(part):
                raise ValueError("the vocabulary does not mark the ends of words")
            slots[at] = self._store(part, ids, ends)
        for at, part in _parts(words, np.flatnonzero(~letters)):
            ids = [e.ids for e in self._encode(part)]
            flat = np.array([i for x in ids for i in x], np.uint32)
            slots[at] = self._store(part, flat, np.cumsum([len(x) for x in ids]))
        return slots

    def _store(self, words: list[str], ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        while self._slots + len(words) > len(self._end):
            self._end = np.concatenate([self._end, np.zeros_like(self._end)])
            self._hits = np.concatenate([self._hits, np.zeros_like(self._hits)])
        stop = self._used + len(ids)
        while stop > len(self._ids):
            self._ids = np.concatenate([self._ids, np.zeros_like(self._ids)])
        self._ids[self._used : stop] = ids
        slots = range(self._slots, self._slots + len(words))
        self._end[slots.start : slots.stop] = self._used + ends
        self._slot.update(zip(words, slots, strict=True))
        self._used, self._slots = stop, slots.stop
        return np.arange(slots.start, slots.stop, dtype=np.int32)


def _parts(words: list[str], places: np.ndarray):
    """Some of the words in bounded lists, each with their places."""
    for at in range(0, len(places), _TOGETHER):
        some = places[at : at + _TOGETHER]
        yield some, [words[i] for i in some.tolist()]
