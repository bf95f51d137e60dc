"""Alignment of two tokenizers on the same bytes.

The bytes of a text (a space and the text) are cut by two tokenizers A and B.  Where a
token of A and one of B end at the same byte, a group ends; a group is the tokens of
both since the last such place.  The two tokens that end there are linked.

A byte range of the token streams is a fragment: an open prefix (tokens up to the first
common end), closed groups, and an open suffix (tokens behind the last common end); a
range without a common end is open as a whole.  Putting two neighbours together joins
the left suffix and the right prefix to one group.  This is associative and has an
empty element, so a very long text is cut into pieces, its pieces are tokenized by
different tasks, each gives the fragments of fixed byte ranges, and a tree of ``FAN``
children a node puts them together, a level a shuffle.  A text of one range is its own
fragment and never leaves its task.

Pieces are cut before a space between two characters that are not white space: no token
of either tokenizer goes on beyond such a place (checked for B when it is loaded, given
by A's pattern), so a piece's tokens are the text's.  A range's ends lie anywhere.  Texts
of one range are cut at all such spaces: words repeat, so a worker aligns each distinct
piece once and puts a text's groups together from those of its pieces.

Link counts: the links of an id pair are summed over the corpus.  Pairs with more than
``1 / FREQUENT`` of all links, at most ``FREQUENT`` by that, are sent to every task; all
others are joined by pair, where none is frequent enough to burden a task.

Defined cases: a null or empty text, or one whose tokens do not give its bytes back, has
no tokens and no groups; repeated rows count each; an empty table gives an empty
result; only the two named columns are read, and no other's name matters.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vexel.llm.common import (
    drop_stage,
    segment_sums,
    stage,
    steps,
    text_column,
    value_offsets,
)

#: Bytes of a range; texts of more are spread over tasks.
CHUNK_BYTES = 1 << 18
#: Children of a node of the reduction tree.
FAN = 16
#: Bound on the id pairs that are sent to every task.
FREQUENT = 1 << 18
_STEP_BYTES = 1 << 20
_SPACE = "▁"
_BETWEEN_WORDS = re.compile(r"(?<=\S) (?=\S)")
_LOW = (1 << 32) - 1


# --- tokenizers -----------------------------------------------------------------


def _byte_alphabet() -> dict[str, int]:
    """The signs that stand for bytes in byte-level vocabularies.

    Printable bytes stand for themselves, the others follow from code point 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokens:
    """A vocabulary's ids for texts, and the bytes of each id."""

    def __init__(self, table: list[bytes]) -> None:
        self.bytes = pa.array(table, pa.binary())
        self.sizes = np.diff(value_offsets_of_binary(self.bytes))

    def encode(self, texts: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's start."""
        lists = self.encode(texts)
        at = np.zeros(len(lists) + 1, np.int64)
        np.cumsum([len(x) for x in lists], out=at[1:])
        return np.fromiter(chain.from_iterable(lists), np.int64, int(at[-1])), at

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ids, one after the other."""
        found = self.bytes.take(pa.array(ids))
        raw = found.buffers()[2]
        return np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)


def value_offsets_of_binary(array: pa.Array) -> np.ndarray:
    raw = np.frombuffer(array.buffers()[1], np.int32)
    return raw[array.offset : array.offset + len(array) + 1].astype(np.int64)


class ByteLevel(Tokens):
    """A byte-level vocabulary of the tokenizers library; sees space + text."""

    def __init__(self, path: str) -> None:
        # Spark's tasks are the parallelism.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        # Strings of special tokens in a text are plain text.
        self._tokenizer.encode_special_tokens = True
        letters = _byte_alphabet()
        vocabulary = self._tokenizer.get_vocab()
        table = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            table[number] = bytes(letters[c] for c in token)
        super().__init__(table)

    def encode(self, texts: list[str]) -> list[list[int]]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [x.ids for x in found]


class Pieces(Tokens):
    """A sentencepiece vocabulary, which puts the space before a text itself."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self._model = model = SentencePieceProcessor(model_file=path)
        names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        if any(_SPACE in name.lstrip(_SPACE) for name in names):
            raise ValueError("a piece goes on beyond a space: texts cannot be cut there")
        super().__init__(
            [
                bytes([int(name[3:5], 16)])
                if model.is_byte(i)
                else name.replace(_SPACE, " ").encode()
                for i, name in enumerate(names)
            ]
        )

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode([t[1:] for t in texts], num_threads=1)


class Aligner:
    """Both vocabularies, and the text of groups."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        self._first_b = 2 * len(self.a.bytes)
        # The text of an id within its group, and as its last on that side.
        self._written = pa.array(
            [f"{i}{end}" for i in range(len(self.a.bytes)) for end in ",|"]
            + [f"{i}{end}" for i in range(len(self.b.bytes)) for end in ",;"]
        )

    def write(
        self, a: np.ndarray, last_a: np.ndarray, b: np.ndarray, last_b: np.ndarray
    ) -> tuple[memoryview, np.ndarray]:
        """``a1,a2|b1;`` of whole groups, and where each group's text ends."""
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        through_a = np.flatnonzero(last_a) + 1
        before_b = np.concatenate([[0], np.flatnonzero(last_b) + 1])
        place_a = np.arange(len(a)) + before_b[group_a]
        place_b = np.arange(len(b)) + through_a[group_b]
        codes = np.empty(len(a) + len(b), np.int64)
        codes[place_a] = 2 * a + last_a
        codes[place_b] = self._first_b + 2 * b + last_b
        if not len(codes):
            return memoryview(b""), np.zeros(0, np.int64)
        text = self._written.take(pa.array(codes))
        ends = value_offsets(text)[place_b[last_b] + 1]
        return memoryview(text.buffers()[2]), ends


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """The worker's vocabularies, loaded once per process."""
    key = (path_a, path_b)
    if key not in _aligners:
        _aligners[key] = Aligner(path_a, path_b)
    return _aligners[key]


_caches: dict[tuple[str, str], PieceCache] = {}


def cache_of(path_a: str, path_b: str) -> PieceCache:
    key = (path_a, path_b)
    if key not in _caches:
        _caches[key] = PieceCache(aligner(path_a, path_b))
    return _caches[key]


def _common(ends_a: np.ndarray, ends_b: np.ndarray, first: int, stop: int):
    """Which tokens of each side end where one of the other side ends."""
    mark = np.zeros(stop - first + 1, np.uint8)
    mark[ends_a - first] = 1
    mark[ends_b - first] += 1
    return mark[ends_a - first] == 2, mark[ends_b - first] == 2


def _counted(pairs: np.ndarray, owner: np.ndarray, owners: int):
    """Distinct pairs of each owner, how often each, and where each owner's start."""
    order = np.lexsort((pairs, owner))
    pairs, owner = pairs[order], owner[order]
    new = np.ones(len(pairs), bool)
    new[1:] = (pairs[1:] != pairs[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(pairs)))
    return pairs[first], times, np.searchsorted(owner[first], np.arange(owners + 1))


# --- fragments ------------------------------------------------------------------


def _none() -> np.ndarray:
    return np.zeros(0, np.int64)


@dataclass
class Fragment:
    """What a byte range of both token streams holds; ``+`` is associative."""

    ok: bool = True
    cut: bool = False
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    pre_a: np.ndarray = field(default_factory=_none)
    pre_b: np.ndarray = field(default_factory=_none)
    closed: bytes = b""
    suf_a: np.ndarray = field(default_factory=_none)
    suf_b: np.ndarray = field(default_factory=_none)
    pairs: np.ndarray = field(default_factory=_none)
    times: np.ndarray = field(default_factory=_none)

    @classmethod
    def of(
        cls, both: Aligner, a: np.ndarray, ends_a: np.ndarray, b: np.ndarray,
        ends_b: np.ndarray,
    ) -> Fragment:
        """The fragment of the tokens that end in a range."""
        ends = np.concatenate([ends_a, ends_b])
        if not len(ends):
            return cls()
        last_a, last_b = _common(ends_a, ends_b, int(ends.min()), int(ends.max()))
        if not last_a.any():
            return cls(n_a=len(a), n_b=len(b), pre_a=a, pre_b=b)
        first_a, first_b = int(last_a.argmax()) + 1, int(last_b.argmax()) + 1
        stop_a = len(a) - int(last_a[::-1].argmax())
        stop_b = len(b) - int(last_b[::-1].argmax())
        text, _ = both.write(
            a[first_a:stop_a], last_a[first_a:stop_a],
            b[first_b:stop_b], last_b[first_b:stop_b],
        )
        linked = a[last_a] << 32 | b[last_b]
        pairs, times, _ = _counted(linked, np.zeros(len(linked), np.int64), 1)
        return cls(
            True, True, len(a), len(b), len(linked), a[:first_a], b[:first_b],
            bytes(text), a[stop_a:], b[stop_b:], pairs, times,
        )

    def __add__(self, other: Fragment) -> Fragment:
        pairs = np.concatenate([self.pairs, other.pairs])
        distinct, where = np.unique(pairs, return_inverse=True)
        times = np.zeros(len(distinct), np.int64)
        np.add.at(times, where, np.concatenate([self.times, other.times]))
        out = Fragment(
            self.ok and other.ok, self.cut or other.cut, self.n_a + other.n_a,
            self.n_b + other.n_b, self.n_groups + other.n_groups,
            pairs=distinct, times=times,
        )
        join = np.concatenate
        if self.cut and other.cut:
            middle = _group_text(
                join([self.suf_a, other.pre_a]), join([self.suf_b, other.pre_b])
            )
            out.pre_a, out.pre_b = self.pre_a, self.pre_b
            out.closed = self.closed + middle + other.closed
            out.suf_a, out.suf_b = other.suf_a, other.suf_b
        elif self.cut:
            out.pre_a, out.pre_b, out.closed = self.pre_a, self.pre_b, self.closed
            out.suf_a = join([self.suf_a, other.pre_a])
            out.suf_b = join([self.suf_b, other.pre_b])
        else:
            out.pre_a = join([self.pre_a, other.pre_a])
            out.pre_b = join([self.pre_b, other.pre_b])
            out.closed, out.suf_a, out.suf_b = other.closed, other.suf_a, other.suf_b
        return out

    def groups(self) -> bytes:
        """The groups of a whole text: its prefix is the first of them."""
        return (_group_text(self.pre_a, self.pre_b) + self.closed)[:-1]


def _group_text(a: np.ndarray, b: np.ndarray) -> bytes:
    return f"{','.join(map(str, a.tolist()))}|{','.join(map(str, b.tolist()))};".encode()


_PARTS = (
    "uid bigint, start bigint, ok boolean, cut boolean, n_a bigint, n_b bigint, "
    "n_groups bigint, pre_a array<bigint>, pre_b array<bigint>, closed binary, "
    "suf_a array<bigint>, suf_b array<bigint>, pairs array<bigint>, times array<bigint>"
)
_FIELDS = [part.split()[0] for part in _PARTS.split(", ")][2:]
_LISTS = {"pre_a", "pre_b", "suf_a", "suf_b", "pairs", "times"}


def _from_row(row: dict) -> Fragment:
    return Fragment(
        *(np.array(row[n], np.int64) if n in _LISTS else row[n] for n in _FIELDS)
    )


def _as_table(rows: list[tuple[int, int, Fragment]], key: pa.Array | None = None):
    columns = {
        "uid": pa.array([r[0] for r in rows], pa.int64()),
        "start": pa.array([r[1] for r in rows], pa.int64()),
    }
    for name in _FIELDS:
        values = [getattr(r[2], name) for r in rows]
        if name in _LISTS:
            columns[name] = pa.array(values, pa.list_(pa.int64()))
        elif name in ("ok", "cut"):
            columns[name] = pa.array(values, pa.bool_())
        else:
            columns[name] = pa.array(values, pa.binary() if name == "closed" else pa.int64())
    return pa.RecordBatch.from_pydict(columns)


def cut_places(text: str, least: int) -> Iterator[str]:
    """Space + text in pieces of at least ``least`` characters, each with its space."""
    whole, start = " " + text, 0
    while True:
        found = _BETWEEN_WORDS.search(whole, start + max(least, 1))
        if not found:
            yield whole[start:]
            return
        yield whole[start : found.start()]
        start = found.start()


def fragments_of(both: Aligner, piece: str, first: int, chunk: int):
    """(start, fragment) of a piece of text that begins at byte ``first``."""
    (a, _), (b, _) = both.a.flat([piece]), both.b.flat([piece])
    raw = np.frombuffer(piece.encode(), np.uint8)
    if not (np.array_equal(both.a.joined(a), raw) and np.array_equal(both.b.joined(b), raw)):
        yield first, Fragment(ok=False)
        return
    ends_a = first + np.cumsum(both.a.sizes[a])
    ends_b = first + np.cumsum(both.b.sizes[b])
    for k in range(first // chunk, (first + len(raw) - 1) // chunk + 1):
        mine_a = slice(*np.searchsorted(ends_a, [k * chunk, (k + 1) * chunk], "right"))
        mine_b = slice(*np.searchsorted(ends_b, [k * chunk, (k + 1) * chunk], "right"))
        yield max(first, k * chunk), Fragment.of(
            both, a[mine_a], ends_a[mine_a], b[mine_b], ends_b[mine_b]
        )


# --- short texts ----------------------------------------------------------------


class Aligned:
    """Alignments of several byte strings, one after the other."""

    def __init__(self, ok, n_a, n_b, n_groups, text, text_at, links) -> None:
        self.ok, self.n_a, self.n_b, self.n_groups = ok, n_a, n_b, n_groups
        #: Text of the groups, each with its ``;``, and where each string's starts.
        self.text, self.text_at = text, text_at
        #: Linked pairs in order; string i has ``n_groups[i]``.
        self.links = links


def align_strings(both: Aligner, spaced: pa.Array) -> Aligned:
    """Alignments of strings that begin with their space."""
    at = value_offsets(spaced)
    raw = np.frombuffer(spaced.buffers()[2], np.uint8)[at[0] : at[-1]]
    words = spaced.to_pylist()
    (a, at_a), (b, at_b) = both.a.flat(words), both.b.flat(words)
    sizes = np.diff(at)
    fine = sizes > 1
    for side, ids, starts in ((both.a, a, at_a), (both.b, b, at_b)):
        sums = np.concatenate([[0], np.cumsum(side.sizes[ids])])[starts]
        fine &= np.diff(sums) == sizes
    keep_a, keep_b = np.repeat(fine, np.diff(at_a)), np.repeat(fine, np.diff(at_b))
    a, b = a[keep_a], b[keep_b]
    mine = raw[np.repeat(fine, sizes)]
    same = (both.a.joined(a) == mine) & (both.b.joined(b) == mine)
    if not same.all():  # as long as the string, but not its bytes
        docs = np.flatnonzero(fine)
        ends = np.cumsum(sizes[docs])
        bad = np.unique(np.searchsorted(ends, np.flatnonzero(~same), "right"))
        out = np.isin(np.arange(len(docs)), bad)
        a = a[~np.repeat(out, np.diff(at_a)[docs])]
        b = b[~np.repeat(out, np.diff(at_b)[docs])]
        fine[docs[bad]] = False
    stops = np.cumsum(sizes * fine)
    ends_a, ends_b = np.cumsum(both.a.sizes[a]), np.cumsum(both.b.sizes[b])
    last_a, last_b = _common(ends_a, ends_b, 0, int(stops[-1]))
    text, group_ends = both.write(a, last_a, b, last_b)
    through = np.searchsorted(ends_a[last_a], stops, "right")
    cuts = np.concatenate([[0], group_ends])[np.concatenate([[0], through])]
    return Aligned(
        fine, np.diff(at_a) * fine, np.diff(at_b) * fine, np.diff(through, prepend=0),
        np.frombuffer(text, np.uint8), cuts, a[last_a] << 32 | b[last_b],
    )


def _cuts(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the pieces of strings start (with the end), and each string's first piece.

    A piece starts at a space between two characters that are surely not white space:
    ASCII signs, or others that no Unicode space begins or ends like.
    """
    n = len(raw)
    back = [np.concatenate([np.zeros(k, np.uint8), raw])[:n] for k in (1, 2, 3)]
    ahead = np.concatenate([raw[1:], np.zeros(1, np.uint8)])
    space_lead = np.array([0xE1, 0xE2, 0xE3], np.uint8)
    before = ((back[0] > 0x20) & (back[0] < 0x7F)) | (
        (back[0] >= 0x80) & (back[1] != 0xC2) & ~np.isin(back[2], space_lead)
    )
    after = ((ahead > 0x20) & (ahead < 0x7F)) | (
        (ahead >= 0x80) & (ahead != 0xC2) & ~np.isin(ahead, space_lead)
    )
    start = (raw == 0x20) & before & after
    # A string's own start, whatever stands there; and none just before its end.
    start[at[1:-1][at[1:-1] < n] - 1] = False
    start[at[:-1][np.diff(at) > 0]] = True
    starts = np.flatnonzero(start)
    return np.append(starts, n), np.searchsorted(starts, at)


#: Pieces whose alignment a worker keeps (about 120 MB); beyond it all are made anew.
CACHE_PIECES = 500_000


class PieceCache:
    """Alignments of the pieces between safe spaces, each made once.

    Such a piece is a fragment without open ends, so a text is its pieces' groups in
    order.  Words repeat, so most pieces were seen before.
    """

    def __init__(self, both: Aligner) -> None:
        self.both = both
        self._reset()

    def _reset(self) -> None:
        self.slot: dict[str, int] = {}
        self.parts: list[Aligned] = []
        self.whole: Aligned | None = None

    def slots(self, pieces: pa.Array) -> np.ndarray:
        """The place of each of some distinct pieces in ``whole``."""
        if len(self.slot) > CACHE_PIECES:
            self._reset()
        names = pieces.to_pylist()
        known = np.fromiter(map(self.slot.get, names, repeat(-1)), np.int64, len(names))
        new = np.flatnonzero(known < 0)
        if len(new):
            found = align_strings(self.both, pieces.take(pa.array(new)))
            first = len(self.slot)
            known[new] = np.arange(first, first + len(new))
            self.slot.update(zip((names[i] for i in new), range(first, first + len(new)), strict=True))
            self.whole = found if self.whole is None else _joined(self.whole, found)
        return known


def _joined(one: Aligned, two: Aligned) -> Aligned:
    both = [np.concatenate(pair) for pair in (
        (one.ok, two.ok), (one.n_a, two.n_a), (one.n_b, two.n_b),
        (one.n_groups, two.n_groups), (one.text, two.text),
        (one.text_at, one.text_at[-1] + two.text_at[1:]), (one.links, two.links),
    )]
    return Aligned(*both)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of the ranges [start, start + size), one range after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


# --- jobs -----------------------------------------------------------------------

_ALIGNED = (
    "n_a bigint, n_b bigint, n_groups bigint, groups string, pairs array<bigint>, "
    "times array<bigint>"
)


def _short_texts(rows: DataFrame, kind: str, paths: tuple[str, str]) -> DataFrame:
    """Texts of one range: pieces, fragments and whole text in one."""

    def align(texts: pa.Array):
        cache = cache_of(*paths)
        spaced = pc.binary_join_element_wise(" ", texts, "")
        at = value_offsets(spaced)
        raw = np.frombuffer(spaced.buffers()[2], np.uint8)[at[0] : at[-1]]
        cuts, first = _cuts(raw, at - at[0])
        pieces = pa.StringArray.from_buffers(
            len(cuts) - 1, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(raw)
        ).dictionary_encode()
        codes = cache.slots(pieces.dictionary)[pieces.indices.to_numpy()]
        held = cache.whole
        # One piece without tokens, and the text has none.
        fine = segment_sums((~held.ok[codes]).astype(np.int64), first) == 0
        fine &= np.diff(at) > 1
        codes = codes[np.repeat(fine, np.diff(first))]
        first = np.concatenate([[0], np.cumsum(np.diff(first) * fine)])
        n_a, n_b, n_groups = (
            segment_sums(n[codes], first) for n in (held.n_a, held.n_b, held.n_groups)
        )
        sizes = np.diff(held.text_at)[codes]
        text = held.text[_ranges(held.text_at[codes], sizes)]
        text_at = np.concatenate([[0], np.cumsum(sizes)])[first]
        link_at = np.concatenate([[0], np.cumsum(held.n_groups)])
        links = held.links[_ranges(link_at[codes], held.n_groups[codes])]
        owner = np.repeat(np.arange(len(texts)), n_groups)
        pairs, times, own = _counted(links, owner, len(texts))
        whole = memoryview(text)
        bounds = text_at.tolist()
        groups = [bytes(whole[x : max(x, y - 1)]) for x, y in zip(bounds, bounds[1:], strict=False)]
        lists = pa.array(own.astype(np.int32))
        return [
            pa.array(n_a), pa.array(n_b), pa.array(n_groups),
            pa.array(groups, pa.binary()).cast(pa.string()),
            pa.ListArray.from_arrays(lists, pa.array(pairs)),
            pa.ListArray.from_arrays(lists, pa.array(times)),
        ]

    names = [part.split()[0] for part in _ALIGNED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_column(batch, "__text")
            for x, y in steps(texts, _STEP_BYTES):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(x, y - x), *align(texts.slice(x, y - x))],
                    names=["__key", *names],
                )

    return rows.mapInArrow(run, f"__key {kind}, {_ALIGNED}")


def _long_texts(rows: DataFrame, kind: str, paths: tuple[str, str], chunk: int) -> DataFrame:
    """Texts of many ranges: pieces, fragments, and the tree over them."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                first = 0
                for piece in cut_places(batch.column("__text")[row].as_py(), chunk):
                    raw = piece.encode()
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("uid").slice(row, 1), pa.array([first]),
                         pa.array([raw], pa.binary())],
                        names=["uid", "start", "piece"],
                    )
                    first += len(raw)

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(*paths)
        for batch in batches:
            for row in range(batch.num_rows):
                uid, first, raw = (c[row].as_py() for c in batch.columns)
                for start, found in fragments_of(both, raw.decode(), first, chunk):
                    yield _as_table([(uid, start, found)])

    def put_together(table: pa.Table) -> pa.Table:
        rows = sorted(table.drop_columns(["node"]).to_pylist(), key=lambda r: r["start"])
        total = Fragment()
        for row in rows:
            total = total + _from_row(row)
        return pa.Table.from_batches([_as_table([(rows[0]["uid"], rows[0]["start"], total)])])

    named = stage(
        rows.select("__key", "__text", F.monotonically_increasing_id().alias("uid")), "long"
    )
    pieces = named.select("uid", "__text").mapInArrow(
        cut, "uid bigint, start bigint, piece binary"
    )
    parts = stage(
        pieces.repartition("uid", "start").mapInArrow(tokenize, _PARTS), "fragments"
    )
    longest = parts.agg(F.max("start")).first()[0] or 0
    reach, tree = chunk, parts
    while reach <= longest:
        reach *= FAN
        tree = tree.withColumn("node", F.expr(f"start div {reach}"))
        tree = tree.groupBy("uid", "node").applyInArrow(put_together, _PARTS)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                whole = _from_row(row)
                if not whole.ok:
                    whole = Fragment()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["uid"]]), pa.array([whole.n_a]), pa.array([whole.n_b]),
                        pa.array([whole.n_groups]),
                        pa.array([whole.groups().decode() if whole.n_groups else ""]),
                        pa.array([whole.pairs], pa.list_(pa.int64())),
                        pa.array([whole.times], pa.list_(pa.int64())),
                    ],
                    names=["uid", *names],
                )

    names = [part.split()[0] for part in _ALIGNED.split(", ")]
    done = tree.mapInArrow(finish, f"uid bigint, {_ALIGNED}")
    return named.select("uid", "__key").join(done, "uid").drop("uid")


def align_texts(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    key: str = "doc_id",
    text: str = "text",
    chunk: int = CHUNK_BYTES,
) -> DataFrame:
    """(key, n_a, n_b, n_groups, groups, pairs, times) of every row.

    ``groups`` is ``a1,a2|b1;a3|b2,b3``; ``pairs`` are the linked ids of the text, each
    ``a << 32 | b``, and ``times`` how often each is linked in it.
    """
    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    kind = rows.schema["__key"].dataType.simpleString()
    long = F.coalesce(F.octet_length("__text"), F.lit(0)) >= chunk
    short = _short_texts(rows.where(~long), kind, (path_a, path_b))
    spread = _long_texts(rows.where(long), kind, (path_a, path_b), chunk)
    return short.unionByName(spread).withColumnRenamed("__key", key)


def link_counts(aligned: DataFrame) -> DataFrame:
    """(pair, count, best) over the corpus; best: no pair of the same B id has more."""
    counts = aligned.select(F.inline(F.arrays_zip("pairs", "times"))).groupBy("pairs")
    counts = stage(counts.agg(F.sum("times").alias("count")), "counts")
    b = F.col("pairs").bitwiseAND(F.lit(_LOW))
    # One row per id of B: no more than its vocabulary has.
    most = counts.groupBy(b.alias("b")).agg(F.max("count").alias("most"))
    found = stage(
        counts.withColumn("b", b)
        .join(F.broadcast(most), "b")
        .select(F.col("pairs").alias("pair"), "count", (F.col("count") == F.col("most")).alias("best")),
        "link-counts",
    )
    drop_stage(counts)
    return found


def link_sums(aligned: DataFrame, counts: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """``aligned (uid, pairs, times, ...)`` with ``n_best`` and ``count_sum`` instead of
    pairs and times."""
    spark = aligned.sparkSession
    total = counts.agg(F.sum("count")).first()[0] or 0
    often = F.col("count") * frequent > total
    table = counts.where(often).orderBy("pair").toArrow()
    sent = spark.sparkContext.broadcast(
        tuple(table[c].to_numpy() for c in ("pair", "count", "best"))
    )

    def places(batch: pa.RecordBatch):
        pairs = batch.column("pairs")
        at = value_offsets(pairs)
        ids = pairs.values.to_numpy()[at[0] : at[-1]]
        times = batch.column("times")
        how = times.values.to_numpy()[value_offsets(times)[0] : value_offsets(times)[-1]]
        known = sent.value[0]
        place = np.searchsorted(known, ids)
        hit = place < len(known)
        hit[hit] = known[place[hit]] == ids[hit]
        return at - at[0], ids, how, place, hit

    def frequent_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, _, how, place, hit = places(batch)
            sums = []
            for column in (sent.value[2], sent.value[1]):
                each = np.zeros(len(how) + 1, np.int64)
                each[:-1][hit] = how[hit] * column[place[hit]].astype(np.int64)
                # A running sum, as a text may have no pair.
                run = np.concatenate([[0], np.cumsum(each)])
                sums.append(pa.array(run[at[1:]] - run[at[:-1]]))
            rest = [i for i, n in enumerate(batch.schema.names) if n not in ("pairs", "times")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in rest), *sums],
                names=[*(batch.schema.names[i] for i in rest), "n_best", "count_sum"],
            )

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, ids, how, _, hit = places(batch)
            owner = np.repeat(np.arange(batch.num_rows), np.diff(at))[~hit]
            yield pa.RecordBatch.from_arrays(
                [batch.column("uid").take(pa.array(owner)), pa.array(ids[~hit]), pa.array(how[~hit])],
                names=["uid", "pair", "how"],
            )

    kept = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}"
        for f in aligned.schema if f.name not in ("pairs", "times")
    )
    base = aligned.mapInArrow(frequent_sums, f"{kept}, n_best bigint, count_sum bigint")
    rare = (
        aligned.select("uid", "pairs", "times")
        .mapInArrow(others, "uid bigint, pair bigint, how bigint")
        .join(counts.where(~often), "pair")
        .groupBy("uid")
        .agg(
            F.sum(F.when(F.col("best"), F.col("how")).otherwise(0)).alias("more_best"),
            F.sum(F.col("how") * F.col("count")).alias("more_sum"),
        )
    )
    return (
        base.join(rare, "uid", "left")
        .withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0)))
        .withColumn("count_sum", F.col("count_sum") + F.coalesce("more_sum", F.lit(0)))
        .drop("more_best", "more_sum")
    )


def op11_token_alignment(spark, sf_dir: str) -> DataFrame:
    """Contract rows of op11."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = align_texts(
        docs,
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )
    aligned = stage(
        found.withColumn(
            "groups_sha256",
            F.when(F.col("n_groups") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise(""),
        )
        .drop("groups")
        .withColumn("uid", F.monotonically_increasing_id()),
        "aligned",
    )
    return link_sums(aligned, link_counts(aligned)).select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
        "n_best", "count_sum", "groups_sha256",
    )
