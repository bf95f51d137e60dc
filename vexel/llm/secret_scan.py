"""Secret scan: fixed patterns, and a linear-chain CRF that adds what they miss.

Tokens are tagged B (a secret begins), I (it goes on) or O.  Features are hashed: a
token's shape, length, digit share and letters, the words and shapes beside it, and
file features (the text's size, whether it names credentials, its share of digits).
The best tag sequence is found by Viterbi.  B and I are possible only inside
secret-shaped runs: 12 or more of ``[A-Za-z0-9+/_=-]`` with a letter and a digit.  All
else is O by constraint and parts the chain there, so only the runs and the tokens that
their features look at are decoded; every whole text is looked at.

Fit: the patterns' own matches are the labels.  About ``FIT_DOCS`` documents, chosen
by a hash of the id, give at most ``WINDOWS_PER_DOC`` windows of at most ``FIT_TOKENS``
tokens each; these are parameters.  Each window is learned twice, once without its
surroundings, so that a form the patterns do not know can be told by its looks.  One
task fits by gradient ascent on the conditional likelihood.

Defined cases: a null text is empty; a text without a match has counts 0, an empty
span list and the digest of empty text; of two overlapping spans of different kinds
both stay, and a CRF span that overlaps a pattern's is dropped; repeated rows are
scanned each; only the named columns are read and returned.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vexel.llm.common import hashed_below, text_column

#: The patterns, least lengths and order of kinds of the contract.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
    r"""([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "crf")
_ASSIGN_LEAST, _ACCESS_LEAST = 6, 20

FIT_DOCS = 20_000
WINDOWS_PER_DOC = 4
ROUNDS = 60
BITS = 14
DIM = 1 << BITS
#: Tokens before a run that its features look at.
BEFORE = 3
#: Places of the features that a token's surroundings give (see ``Window._bins``).
CONTEXT_FEATURES = [7, 8, 9, 10, 11, 12, 14]
#: Windows of more tokens are not learned from; they are decoded like all others.
FIT_TOKENS = 256
_O, _B, _I = 0, 1, 2
_NEVER = -1e9

_SIGNS = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
_DIGIT, _LETTER = re.compile("[0-9]"), re.compile("[A-Za-z]")
_TOKEN = re.compile(r"[^\W_]+|[^\w\s]|_")
_NAMES = re.compile(r"pass|secret|token|key|credential|auth", re.IGNORECASE)


def runs(text: str, start: int = 0, stop: int | None = None) -> Iterator[tuple[int, int]]:
    """The secret-shaped runs of a text, in time linear in its length."""
    stop = len(text) if stop is None else stop
    for m in _SIGNS.finditer(text, start, stop):
        found = m.group()
        if _DIGIT.search(found) and _LETTER.search(found):
            yield m.start(), m.end()


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the patterns' matches, by start, then kind."""
    found = [
        (m.start(), 0, m.end())
        for m in _ASSIGN.finditer(text)
        if len(m.group(2)) >= _ASSIGN_LEAST
    ]
    found += [
        (m.start(), 1, m.end())
        for m in _ACCESS.finditer(text)
        if m.end() - m.start() >= _ACCESS_LEAST
    ]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return [(a, KINDS[k], b) for a, k, b in sorted(found)]


def _shape(token: str) -> str:
    kinds = [
        "d" if c.isdigit() else "X" if c.isupper() else "x" if c.isalpha() else c
        for c in token
    ]
    return "".join(k for k, before in zip(kinds, ["", *kinds], strict=False) if k != before)


def _file_features(text: str) -> list[str]:
    digits = sum(text.count(d) for d in "0123456789")
    return [
        f"f:size{len(text).bit_length()}",
        f"f:names{bool(_NAMES.search(text))}",
        f"f:digits{digits * 20 // max(1, len(text))}",
    ]


class Window:
    """The tokens round one secret-shaped run, with features and allowed tags."""

    def __init__(self, text: str, start: int, stop: int, file: list[str]) -> None:
        self.tokens = [
            (start + m.start(), start + m.end())
            for m in _TOKEN.finditer(text[start:stop])
        ]
        words = [text[a:b] for a, b in self.tokens]
        shapes = [_shape(w) for w in words]
        self.allowed = np.zeros(len(words), bool)
        shaped = list(runs(text, start, stop))
        ends = np.array([y for _, y in shaped], np.int64)
        for i, (a, b) in enumerate(self.tokens):
            k = int(np.searchsorted(ends, b))
            self.allowed[i] = k < len(shaped) and shaped[k][0] <= a
        self.features = np.array(
            [self._bins(words, shapes, i, file) for i in range(len(words))], np.int32
        ).reshape(len(words), -1)

    @staticmethod
    def _bins(words: list[str], shapes: list[str], i: int, file: list[str]) -> list[int]:
        word = words[i]

        def near(values: list[str], j: int) -> str:
            return values[j].lower() if 0 <= j < len(values) else ""

        digits = sum(c.isdigit() for c in word)
        names = [
            "bias",
            f"s:{shapes[i][:12]}",
            f"changes:{min(len(shapes[i]), 12)}",
            f"len:{min(len(word), 48) // 4}",
            f"digits:{8 * digits // len(word)}",
            f"hex:{all(c in '0123456789abcdefABCDEF' for c in word)}",
            f"kinds:{min(len(set(word)), 20) // 2}",
            f"head:{word[:4]}",
            f"w-1:{near(words, i - 1)}",
            f"w-2:{near(words, i - 2)}",
            f"w-3:{near(words, i - 3)}",
            f"w+1:{near(words, i + 1)}",
            f"s-1:{near(shapes, i - 1)[:12]}",
            *(f"{f}:{len(word) // 12}" for f in file),
        ]
        return [crc32(n.encode("utf-8", "replace")) & (DIM - 1) for n in names]

    def tags(self, spans: list[tuple[int, int]]) -> np.ndarray:
        out = np.zeros(len(self.tokens), np.int64)
        for x, y in spans:
            inside = [
                i
                for i, (a, b) in enumerate(self.tokens)
                if x <= a and b <= y and self.allowed[i]
            ]
            out[inside] = _I
            out[inside[:1]] = _B
        return out


def windows(text: str) -> Iterator[tuple[int, int]]:
    """(start, stop) of the parts of lines round secret-shaped runs, disjoint.

    A part has all tokens that a run's features look at: ``BEFORE`` before it and one
    behind.  What lies between two parts is O by constraint, so it says nothing about
    the tags on either side, and the parts are decoded as the whole line would be.
    """
    start = stop = None
    before = 0
    for a, b in runs(text):
        line = text.rfind("\n", before, a) + 1
        # Without a line's end in between, no further back than the part before.
        floor = line or start or 0
        begin = _tokens_before(text, a, floor)
        after = _TOKEN.search(text, b)
        end = text.find("\n", b)
        end = len(text) if end < 0 else end
        finish = max(b, min(after.end(), end)) if after else b
        if start is not None and begin < stop:
            # They share tokens: one part.
            stop = max(stop, finish)
        else:
            if start is not None:
                yield start, stop
            start, stop = begin, finish
        before = b
    if start is not None:
        yield start, stop


def _tokens_before(text: str, at: int, floor: int) -> int:
    """Where the ``BEFORE`` tokens before a place begin, but not before ``floor``."""
    back = 64
    while True:
        low = max(floor, at - back)
        starts = [m.start() for m in _TOKEN.finditer(text, low, at)]
        if low == floor:
            return starts[-BEFORE] if len(starts) > BEFORE else floor
        # The first token may be cut.
        if len(starts) > BEFORE + 1:
            return starts[-BEFORE]
        back *= 2


class Crf:
    """Emissions (bins x tags), transitions (tags x tags); I only after B or I."""

    def __init__(self, emission: np.ndarray, transition: np.ndarray) -> None:
        self.emission = emission
        self.transition = transition

    def decode(self, window: Window) -> list[tuple[int, int]]:
        """Spans of the best tag sequence."""
        n = len(window.tokens)
        if not n or not window.allowed.any():
            return []
        score = self.emission[window.features].sum(axis=1)
        score[~window.allowed, 1:] = _NEVER
        best = score[0] + np.array([0.0, 0.0, _NEVER])
        back = np.zeros((n, 3), np.int64)
        for i in range(1, n):
            via = best[:, None] + self.transition
            back[i] = via.argmax(axis=0)
            best = via.max(axis=0) + score[i]
        tag = int(best.argmax())
        tags = [tag]
        for i in range(n - 1, 0, -1):
            tag = int(back[i, tag])
            tags.append(tag)
        spans: list[tuple[int, int]] = []
        for (a, b), tag in zip(window.tokens, tags[::-1], strict=True):
            if tag == _B:
                spans.append((a, b))
            elif tag == _I:
                spans[-1] = (spans[-1][0], b)
        return spans


def fit_crf(items: list[tuple[Window, np.ndarray]], rounds: int = ROUNDS) -> Crf:
    """Adam on the conditional log-likelihood of the tag sequences."""
    transition = np.zeros((3, 3))
    transition[_O, _I] = _NEVER
    emission = np.zeros((DIM, 3))
    items = [(w, t) for w, t in items if len(w.tokens)]
    if not items:
        emission[:, 1:] = -1.0
        return Crf(emission, transition)
    length = max(len(w.tokens) for w, _ in items)
    width = items[0][0].features.shape[1]
    n = len(items)
    features = np.zeros((n, length, width), np.int32)
    real = np.zeros((n, length), bool)
    allowed = np.zeros((n, length), bool)
    tags = np.zeros((n, length), np.int64)
    for k, (w, t) in enumerate(items):
        m = len(w.tokens)
        features[k, :m], real[k, :m], allowed[k, :m], tags[k, :m] = (
            w.features,
            True,
            w.allowed,
            t,
        )
    truth = np.eye(3)[tags] * real[..., None]
    pairs = np.einsum("nla,nlb->ab", truth[:, :-1], truth[:, 1:] )
    moments = [np.zeros((2, DIM, 3)), np.zeros((2, 3, 3))]
    for round_ in range(1, rounds + 1):
        score = emission[features].sum(axis=2)
        score = np.where(allowed[..., None] | (np.arange(3) == _O), score, _NEVER)
        forward = np.zeros_like(score)
        forward[:, 0] = score[:, 0] + np.array([0.0, 0.0, _NEVER])
        for i in range(1, length):
            via = forward[:, i - 1, :, None] + transition
            stepped = np.logaddexp.reduce(via, axis=1) + score[:, i]
            forward[:, i] = np.where(real[:, i, None], stepped, forward[:, i - 1])
        total = np.logaddexp.reduce(forward[:, -1], axis=1)
        backward = np.zeros_like(score)
        expected = np.zeros((3, 3))
        for i in range(length - 2, -1, -1):
            onward = score[:, i + 1] + backward[:, i + 1]
            via = transition + onward[:, None, :]
            stepped = np.logaddexp.reduce(via, axis=2)
            live = real[:, i + 1, None]
            backward[:, i] = np.where(live, stepped, backward[:, i + 1])
            both = forward[:, i, :, None] + via - total[:, None, None]
            expected += (np.exp(both) * live[..., None]).sum(axis=0)
        marginal = np.exp(forward + backward - total[:, None, None]) * real[..., None]
        slope = (truth - marginal).reshape(-1, 3)
        gradient = np.stack(
            [
                np.bincount(
                    features.reshape(-1, width).ravel(),
                    np.repeat(slope[:, tag], width),
                    minlength=DIM,
                )
                for tag in range(3)
            ],
            axis=1,
        )
        for value, grad, moment in (
            (emission, gradient / n - 1e-4 * emission, moments[0]),
            (transition, (pairs - expected) / n, moments[1]),
        ):
            moment[0] = 0.9 * moment[0] + 0.1 * grad
            moment[1] = 0.99 * moment[1] + 0.01 * grad * grad
            value += (
                0.1
                * (moment[0] / (1 - 0.9**round_))
                / (np.sqrt(moment[1] / (1 - 0.99**round_)) + 1e-8)
            )
        transition[_O, _I] = _NEVER
    return Crf(emission, transition)


def _training_rows(
    batches: Iterator[pa.RecordBatch], known: tuple[str, ...]
) -> Iterator[pa.RecordBatch]:
    """Windows of the fit documents: text, file features and secret spans.

    A window with a match of a kind that is not ``known`` is left out: it is neither an
    example nor a counterexample.
    """
    kinds = [pa.string(), pa.list_(pa.string()), pa.list_(pa.int64())]
    for batch in batches:
        rows: list[tuple] = []
        for text in text_column(batch, "text").to_pylist():
            found = base_spans(text)
            hidden = [(a, b) for a, kind, b in found if kind not in known]
            file = _file_features(text)
            spans = []
            for a, kind, b in found:
                if kind not in known:
                    continue
                if kind == "assign":  # the value, not the name before it
                    a = b - len(_ASSIGN.match(text, a).group(2))
                spans.append((a, b))
            taken = 0
            for start, stop in windows(text):
                if any(a < stop and start < b for a, b in hidden):
                    continue
                inside = [(a - start, b - start) for a, b in spans if start <= a < stop]
                flat = [x for span in inside for x in span]
                rows.append((text[start:stop], file, flat))
                taken += 1
                if taken == WINDOWS_PER_DOC:
                    break
        columns = list(zip(*rows, strict=True)) or [()] * 3
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["window", "file", "spans"],
        )


def without_context(window: Window) -> Window:
    """The window as its tokens alone show it: neighbours, first letters and the
    file's names are one and the same bin."""
    copy = object.__new__(Window)
    copy.tokens, copy.allowed = window.tokens, window.allowed
    copy.features = window.features.copy()
    copy.features[:, CONTEXT_FEATURES] = crc32(b"masked") & (DIM - 1)
    return copy


def _fit_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    items = []
    for batch in batches:
        for row in batch.to_pylist():
            window = Window(row["window"], 0, len(row["window"]), row["file"])
            if len(window.tokens) > FIT_TOKENS:
                continue
            flat = row["spans"]
            spans = list(zip(flat[::2], flat[1::2], strict=True))
            tags = window.tags(spans)
            # Learned with and without its surroundings, so that a secret is known by
            # its own looks too, wherever it stands.
            items += [(window, tags), (without_context(window), tags)]
    model = fit_crf(items)
    yield pa.RecordBatch.from_arrays(
        [pa.array([model.emission.tobytes()]), pa.array([model.transition.tobytes()])],
        names=["emission", "transition"],
    )


def fit(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    fit_docs: int = FIT_DOCS,
    kinds: tuple[str, ...] = KINDS[:3],
) -> Crf:
    """Learn from the patterns' matches of some ``kinds`` in a bounded choice of
    documents."""
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    share = min(1.0, fit_docs / max(1, rows.count()))
    sample = rows.where(hashed_below("id", F.lit(share))).select("text")
    found = (
        sample.mapInArrow(
            lambda batches: _training_rows(batches, kinds),
            "window string, file array<string>, spans array<bigint>",
        )
        .repartition(1)
        .sortWithinPartitions("window")
        .mapInArrow(_fit_task, "emission binary, transition binary")
        .first()
    )
    if found is None:  # no document at all
        return fit_crf([])
    return Crf(
        np.frombuffer(found["emission"]).reshape(DIM, 3),
        np.frombuffer(found["transition"]).reshape(3, 3),
    )


def scan_text(text: str, model: Crf) -> list[tuple[int, str, int]]:
    """All spans of one text, by start, then kind as listed."""
    found = base_spans(text)
    file = None
    for start, stop in windows(text):
        file = file or _file_features(text)
        for a, b in model.decode(Window(text, start, stop, file)):
            if not any(x < b and a < y for x, _, y in found):
                found.append((a, "crf", b))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


def scan(
    docs: DataFrame, model: Crf, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, found): the spans of every row as (kind, start, stop), in code points."""
    rows = docs.select(F.col(key).alias(key), F.col(text).alias("__text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bins x tags numbers
    kind = rows.schema[key].dataType.simpleString()
    spans_type = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [
                    {"kind": k, "start": a, "stop": b}
                    for a, k, b in scan_text(t.as_py(), shared.value)
                ]
                for t in text_column(batch, "__text")
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(found, spans_type)], names=[key, "found"]
            )

    span = "struct<kind:string,start:bigint,stop:bigint>"
    return rows.mapInArrow(run, f"`{key}` {kind}, found array<{span}>")


def _joined(spans):
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])
        ),
        ",",
    )


def op7_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Contract rows of op7."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = scan(docs, fit(docs))

    def number(kind: str):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint")

    base = F.filter("found", lambda s: s["kind"] != "crf")
    return rows.select(
        "doc_id",
        number("assign").alias("n_assign"),
        number("access").alias("n_access"),
        number("hex").alias("n_hex"),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined("found").alias("spans"),
    )


def digest(spans: list[tuple[int, str, int]]) -> str:
    """The base digest of one text, for checks against the scan."""
    joined = ",".join(f"{k}:{a}:{b}" for a, k, b in spans)
    return hashlib.sha256(joined.encode()).hexdigest()
