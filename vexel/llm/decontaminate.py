"""Benchmark decontamination by latent semantic retrieval.

1. The terms are the benchmark's words.  Tasks count over the whole corpus in how many
   documents each is, and which of them share a block of ``BLOCK`` words.
2. A randomised SVD of the TF-IDF matrix of all blocks of the corpus and all items:
   ``A'A`` of a task is its counts of pairs, which it multiplies with a random basis;
   Spark adds up the products, terms x (``RANK + OVERSAMPLE``) numbers, and the driver
   takes their leading directions (Nystrom).  No document is left out of the fit.
3. Passages of ``2 * BLOCK`` words, each ``BLOCK`` on from the last, are projected and
   compared with all items by cosine, the length being that before the projection.
   Words outside the benchmark count in that length as its median word.  A passage whose
   benchmark words hold too little of its length for any cosine above the bound is
   passed over without projecting it, which loses nothing.
4. Candidates above ``COSINE`` are checked exactly: the longest common subsequence of
   the item's and the passage's words.  ``VERBATIM`` of the item's words in order is a
   leak; so is ``PARAPHRASE`` of them if the answer is there too.  Either way the words
   found must carry ``CARRIED`` of the item's inverse frequencies, so common words alone
   prove nothing.  The answer is the benchmark's ``answer`` column, or else the item's
   last ``ANSWER_WORDS`` words.

Items are taken in blocks of ``BLOCK_ITEMS``, or fewer where they have more than
``BLOCK_TERMS`` words, each with terms and a projection of its own, so what travels to
the tasks and what they count is bounded per block; a task holds a number for each pair
of a block's terms.  The corpus is read once a block for the fit, and once in all for the
search.

An item shorter than ``LEAST_WORDS`` words has too little to be told by a share of it: it
is a leak where all its words follow each other, in every text, with no retrieval before.

Defined cases: null or wordless texts and items match nothing; repeated items count
once each, repeated documents are judged each, whatever their ids; an empty benchmark
rejects nothing; other columns do not matter, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vexel.llm.common import (
    segment_sums,
    steps,
    text_column,
    value_offsets,
)

RANK = 256
OVERSAMPLE = 8
BLOCK = 24
COSINE = 0.2
VERBATIM = 0.8
PARAPHRASE = 0.55
CARRIED = 0.5
ANSWER_WORDS = 8
ANSWER_SHARE = 0.6
LEAST_WORDS = 8
BLOCK_ITEMS = 256
#: Distinct words of a block of items, unless one item alone has more.
BLOCK_TERMS = 4_096
#: An item weighs this much of the whole corpus in the fit, so that the items' own
#: directions are kept: RANK holds a whole block of items, and directions left over are
#: those of the corpus.
ITEM_WEIGHT = 0.0015
#: Tasks of the fit for each core, so that its partial products do not grow in number.
_FIT_TASKS = 4
#: Terms whose products travel in one row.
_CHUNK = 128
#: Pairs counted before they are multiplied, which a 32-bit count holds.
_PAIRS = 1 << 31
#: Ranges summed at a time: their sums and one row each fit a core's cache.
_SUM_ROWS = 512
_SEED = 7
_EDGE = ".,;:!?\"'()[]{}<>|*#$%&-_=+/\\"


class Words:
    """Lower-cased words of some texts, without signs at their ends, as codes."""

    def __init__(self, texts: pa.Array) -> None:
        lists = pc.ascii_split_whitespace(pc.utf8_lower(texts))
        at = value_offsets(lists)
        raw = lists.values.slice(at[0], at[-1] - at[0]).dictionary_encode()
        trimmed = pc.utf8_trim(raw.dictionary, characters=_EDGE).dictionary_encode()
        words = trimmed.dictionary.to_pylist()
        codes = trimmed.indices.to_numpy()[raw.indices.to_numpy()]
        real = np.array([bool(w) for w in words], bool)
        keep = real[codes] if len(codes) else np.zeros(0, bool)
        self.words = words
        self.codes = codes[keep]
        self.at = np.concatenate([[0], np.cumsum(keep)])[at - at[0]]

    def terms(self, place: dict[str, int]) -> np.ndarray:
        """The term of each word; unknown words are the last."""
        unknown = len(place)
        known = [place.get(w, unknown) for w in self.words]
        return np.array(known, np.int64)[self.codes]

    def blocks(self) -> tuple[np.ndarray, np.ndarray]:
        """Where each block of words starts (with the end), and each text's blocks."""
        sizes = np.diff(self.at)
        counts = -(-sizes // BLOCK)
        first = np.concatenate([[0], np.cumsum(counts)])
        inside = np.arange(first[-1]) - np.repeat(first[:-1], counts)
        starts = np.repeat(self.at[:-1], counts) + BLOCK * inside
        return np.append(starts, self.at[-1]), first


def _passages(block_sums: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums over two blocks from each block on; the second stays within the text."""
    total = len(block_sums)
    out = block_sums.copy()
    last = np.zeros(total, bool)
    last[first[1:][first[1:] > first[:-1]] - 1] = True
    more = np.flatnonzero(~last)
    out[more] += block_sums[more + 1]
    # A last block alone is in the passage before it, unless it is the whole text.
    counts = np.diff(first)
    alone = np.repeat(counts == 1, counts)
    return out, np.flatnonzero(~last | alone)


def _summed(
    table: np.ndarray, rows: np.ndarray, starts: np.ndarray, stops: np.ndarray
) -> np.ndarray:
    """Sum of ``table[rows[start:stop]]`` of each range; 0 for an empty one.

    The i-th rows of many ranges are added at once, longer ranges first, so nothing
    is laid out per row and the sums stay in the cache.
    """
    size = stops - starts
    order = np.argsort(-size, kind="stable")
    out = np.zeros((len(starts), table.shape[1]), table.dtype)
    taken = np.empty((min(_SUM_ROWS, len(starts)), table.shape[1]), table.dtype)
    for low in range(0, len(order), _SUM_ROWS):
        mine = order[low : low + _SUM_ROWS]
        begin, shrinking = starts[mine], -size[mine]
        sums = np.zeros((len(mine), table.shape[1]), table.dtype)
        for i in range(-int(shrinking[0])):
            n = int(np.searchsorted(shrinking, -i))
            at = rows[begin[:n] + i]
            np.take(table, at, axis=0, out=taken[:n], mode="clip")
            sums[:n] += taken[:n]
        out[mine] = sums
    return out


class Terms:
    """The words of a block of items and their inverse document frequencies.

    ``idf`` has one more value, that of all other words.
    """

    def __init__(self, place: dict[str, int], idf: np.ndarray) -> None:
        self.place = place
        self.idf = idf


def _multiply(pairs: np.ndarray, basis: np.ndarray, product: np.ndarray) -> None:
    """Add the symmetric matrix of the pairs, times the basis, to the product."""
    for a in range(0, len(pairs), 256):
        part = pairs[a : a + 256].astype(np.float32)
        part += pairs[:, a : a + 256].T
        product[a : a + 256] += part @ basis


def _corpus_task(place: dict[str, int], basis: np.ndarray):
    """Counts of a task's texts, and its pairs of terms times the basis.

    A row per ``_CHUNK`` terms: documents and occurrences of each, and the products.
    A chunk of -1 counts the texts, their blocks and their words that are no terms.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(place)
        inside, seen = np.zeros(size, np.int64), np.zeros(size, np.int64)
        whole = np.zeros(3, np.int64)
        pairs, held = np.zeros((size, size), np.uint32), 0
        product = np.zeros(basis.shape)
        for batch in batches:
            texts = text_column(batch, "text")
            for a, b in steps(texts, 4 << 20):
                words = Words(texts.slice(a, b - a))
                terms = words.terms(place)
                known = terms < size
                found = terms[known]
                owner = np.repeat(np.arange(b - a), np.diff(words.at))[known]
                once = np.sort(owner * size + found)
                once = once[np.flatnonzero(np.diff(once, prepend=-1))]
                inside += np.bincount(once % size, minlength=size)
                seen += np.bincount(found, minlength=size)
                starts, _ = words.blocks()
                whole += [b - a, len(starts) - 1, len(terms) - len(found)]
                block = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[known]
                for gap in range(1, BLOCK):
                    both = np.flatnonzero(block[gap:] == block[:-gap])
                    if not len(both):
                        break
                    at = found[both] * size + found[both + gap]
                    # Ones of the counts' own type, or every one of them is converted.
                    np.add.at(pairs.reshape(-1), at, np.ones(len(at), pairs.dtype))
                    held += len(both)
                if held > _PAIRS:
                    _multiply(pairs, basis, product)
                    pairs[:], held = 0, 0
        _multiply(pairs, basis, product)
        product += seen[:, None] * basis
        chunk, counts, sums = [-1], [whole.tobytes()], [b""]
        for at in range(0, size, _CHUNK):
            part = slice(at, at + _CHUNK)
            chunk.append(at // _CHUNK)
            counts.append(np.stack([inside[part], seen[part]]).tobytes())
            sums.append(product[part].astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(chunk, pa.int64()), pa.array(counts), pa.array(sums)],
            names=["chunk", "counts", "sums"],
        )

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row of each chunk, with its sums."""
    counts: dict[int, np.ndarray] = {}
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for row in batch.to_pylist():
            chunk = row["chunk"]
            counts[chunk] = counts.get(chunk, 0) + np.frombuffer(row["counts"], np.int64)
            sums[chunk] = sums.get(chunk, 0) + np.frombuffer(row["sums"], np.float32).astype(
                np.float64
            )
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(list(counts), pa.int64()),
            pa.array([c.tobytes() for c in counts.values()], pa.binary()),
            pa.array([s.tobytes() for s in sums.values()], pa.binary()),
        ],
        names=["chunk", "counts", "sums"],
    )


def fit_projection(docs: DataFrame, texts: list[str]) -> tuple[Terms, np.ndarray]:
    """The terms of some items, and (terms, RANK): their weighted place in the latent space.

    Counted and fitted over every row of ``docs (text)``, which is read once.
    """
    words = Words(pa.array(texts, pa.large_string()))
    used = sorted({words.words[c] for c in words.codes})
    place = {w: i for i, w in enumerate(used)}
    size = len(place)
    width = min(size, RANK + OVERSAMPLE)
    basis = np.random.default_rng(_SEED).standard_normal((size, width), np.float32)
    inside, seen = np.zeros(size), np.zeros(size)
    product, whole = np.zeros((size, width)), np.zeros(3)
    if size:
        columns = "chunk bigint, counts binary, sums binary"
        cores = docs.sparkSession.sparkContext.defaultParallelism
        parts = (
            docs.coalesce(_FIT_TASKS * cores)
            .mapInArrow(_corpus_task(place, basis), columns)
            .repartition(_FIT_TASKS, "chunk")
            .mapInArrow(_added, columns)
        )
        for row in parts.toLocalIterator():  # terms x width numbers, whatever the corpus
            counts = np.frombuffer(row["counts"], np.int64)
            if row["chunk"] < 0:
                whole = counts
                continue
            part = slice(row["chunk"] * _CHUNK, (row["chunk"] + 1) * _CHUNK)
            inside[part], seen[part] = counts.reshape(2, -1)
            product[part] = np.frombuffer(row["sums"]).reshape(-1, width)
    idf = np.log((1 + whole[0]) / (1 + inside)) + 0.1
    # Words outside weigh as the benchmark's words do in the middle.
    idf = np.append(idf, np.median(idf) if size else 1.0)
    terms = Terms(place, idf)
    # All blocks of the corpus have a squared length of 1 together.
    length = (seen * idf[:-1] ** 2).sum() + whole[2] * idf[-1] ** 2
    product *= idf[:-1, None] / (length or 1)
    # The product is that of the weighted terms with a basis weighted the other way.
    basis = basis / idf[:-1, None]
    found = words.terms(place)
    rows = np.zeros((len(texts), size))
    for row, a, b in zip(rows, words.at, words.at[1:], strict=False):
        if a < b:
            np.add.at(row, found[a:b], idf[found[a:b]])
            row /= np.sqrt((idf[found[a:b]] ** 2).sum())
    product += ITEM_WEIGHT * (rows.T @ (rows @ basis))
    core = basis.T @ product
    values, turn = np.linalg.eigh((core + core.T) / 2)
    # Below this they are the rounding of the partial products.
    kept = values > 1e-7 * max(values.max(initial=0), 0)
    half = product @ (turn[:, kept] / np.sqrt(values[kept]))
    axes = np.linalg.svd(half, full_matrices=False)[0][:, :RANK]
    return terms, (idf[:-1, None] * axes).astype(np.float32)


class Items:
    """A block of benchmark items, ready for retrieval and checks."""

    def __init__(
        self,
        rows: list[tuple[int, str, str | None]],
        terms: Terms,
        vectors: np.ndarray,
    ) -> None:
        self.terms = terms
        self.vectors = vectors
        texts = Words(pa.array([t or "" for _, t, _ in rows], pa.large_string()))
        self.ids: list[int] = []
        self.words: list[list[str]] = []
        self.answers: list[list[str]] = []
        self.terms_of: list[np.ndarray] = []
        self.weights: list[np.ndarray] = []
        #: Short items by their first term: (id, terms).
        self.short: dict[int, list[tuple[int, np.ndarray]]] = {}
        owner, queries = [], []
        found = texts.terms(terms.place)
        for k, (number, _, answer) in enumerate(rows):
            codes = texts.codes[texts.at[k] : texts.at[k + 1]]
            if len(codes) < LEAST_WORDS:
                if len(codes):
                    own = found[texts.at[k] : texts.at[k + 1]]
                    self.short.setdefault(int(own[0]), []).append((number, own))
                continue
            words = [texts.words[c] for c in codes]
            self.ids.append(number)
            self.words.append(words)
            self.answers.append(
                _plain_words(answer) if answer else words[-ANSWER_WORDS:]
            )
            # A long item asks with each of its passages.
            own = found[texts.at[k] : texts.at[k + 1]]
            self.terms_of.append(own)
            self.weights.append(terms.idf[own])
            step = 2 * BLOCK
            for a in range(0, max(1, len(codes) - step // 2), step):
                owner.append(len(self.ids) - 1)
                part = own[a : a + step]
                length = np.sqrt((terms.idf[part] ** 2).sum())
                queries.append(vectors[part].sum(axis=0) / length)
        self.owner = np.array(owner, np.int64)
        self.queries = np.array(queries).reshape(len(owner), vectors.shape[1])
        self.masks = [_masks(w) for w in self.words]
        self.answer_masks = [_masks(w) for w in self.answers]


def _plain_words(text: str) -> list[str]:
    words = (w.strip(_EDGE) for w in text.lower().split())
    return [w for w in words if w]


def _masks(words: list[str]) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, word in enumerate(words):
        out[word] = out.get(word, 0) | 1 << i
    return out


def common_subsequence(masks: dict[str, int], size: int, words: list[str]) -> int:
    """Length of the longest common subsequence, a bit per word of the first."""
    full = (1 << size) - 1
    row = full
    for word in words:
        mask = masks.get(word)
        if mask:
            hit = row & mask
            row = ((row + hit) | (row - hit)) & full
    return size - row.bit_count()


def _may_leak(items: Items, k: int, terms: np.ndarray) -> bool:
    """Whether words of these terms can hold enough of the item, in whatever order."""
    held = np.zeros(len(items.terms.idf), bool)
    held[terms] = True
    found = held[items.terms_of[k]]
    if found.sum() < PARAPHRASE * len(found):
        return False
    weights = items.weights[k]
    return weights[found].sum() >= CARRIED * weights.sum()


def _is_leak(items: Items, k: int, words: list[str]) -> tuple[bool, float]:
    size = len(items.words[k])
    share = common_subsequence(items.masks[k], size, words) / size
    if share < PARAPHRASE:
        return False, share
    if share >= VERBATIM:
        return True, share
    answer = len(items.answers[k])
    found = common_subsequence(items.answer_masks[k], answer, words)
    return found >= ANSWER_SHARE * answer, share


def _search(words: Words, items: Items) -> Iterator[tuple]:
    """(text, item, share) of all leaks."""
    starts, first = words.blocks()
    if len(starts) < 2:
        return
    terms = words.terms(items.terms.place)
    yield from _short_leaks(words, terms, items)
    if not len(items.owner):
        return
    known = terms < len(items.terms.place)
    weight = items.terms.idf[terms] ** 2
    length, kept = _passages(segment_sums(weight, starts), first)
    inside, _ = _passages(segment_sums(weight * known, starts), first)
    kept = kept[inside[kept] >= COSINE**2 * length[kept]]
    last = first[1:][np.searchsorted(first, kept, "right") - 1]
    text_of = np.searchsorted(first, kept, "right") - 1
    found: dict[tuple[int, int], float] = {}
    inner = terms[known]
    at = np.concatenate([[0], np.cumsum(known)])[starts]
    for a in range(0, len(kept), 2_048):
        part = kept[a : a + 2_048]
        # Neighbouring passages share a block, which is summed once.
        two = part + 1 < last[a : a + 2_048]
        blocks = np.unique(np.concatenate([part, part[two] + 1]))
        sums = _summed(items.vectors, inner, at[blocks], at[blocks + 1])
        rows = sums[np.searchsorted(blocks, part)]
        rows[two] += sums[np.searchsorted(blocks, part[two] + 1)]
        rows /= np.sqrt(length[part])[:, None]
        for row, query in zip(*np.nonzero(rows @ items.queries.T >= COSINE), strict=True):
            text, item = int(text_of[a + row]), int(items.owner[query])
            if (text, item) in found:
                continue
            # The passage, and as many words on both sides as the item may reach.
            reach = max(BLOCK, len(items.words[item]))
            start = starts[part[row]]
            low = max(start - reach, words.at[text])
            high = min(start + 2 * BLOCK + reach, words.at[text + 1])
            if not _may_leak(items, item, terms[low:high]):
                continue
            near = [words.words[c] for c in words.codes[low:high]]
            leak, share = _is_leak(items, item, near)
            if leak:
                found[text, item] = share
    for (text, item), share in found.items():
        yield text, items.ids[item], share


def _short_leaks(words: Words, terms: np.ndarray, items: Items) -> Iterator[tuple]:
    """(text, item, 1) where all words of a short item follow each other."""
    if not items.short:
        return
    begins = np.flatnonzero(np.isin(terms, list(items.short)))
    owner = np.searchsorted(words.at, begins, "right") - 1
    found = set()
    for at, text in zip(begins.tolist(), owner.tolist(), strict=True):
        for number, own in items.short[int(terms[at])]:
            stop = at + len(own)
            if stop <= words.at[text + 1] and (terms[at:stop] == own).all():
                found.add((text, number))
    for text, number in sorted(found):
        yield text, number, 1.0


def item_blocks(benchmark: DataFrame) -> list[list[tuple]]:
    """The benchmark (id, text, answer), the stated query set, in blocks of items."""
    blocks: list[list[tuple]] = []
    terms: set[str] = set()
    for row in benchmark.toLocalIterator():
        own = set(_plain_words(row["text"] or ""))
        full = blocks and len(blocks[-1]) == BLOCK_ITEMS
        if not blocks or full or len(terms | own) > BLOCK_TERMS:
            blocks.append([])
            terms = set()
        blocks[-1].append((row["id"], row["text"], row["answer"]))
        terms |= own
    return blocks


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    answer: str | None = None,
) -> DataFrame:
    """(key, items, share) for every row: leaked item ids, sorted, and the best share.

    ``share`` is the part of an item's words found in order, null without a leak.
    """
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    shared = prepare(rows, benchmark, item, answer)
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_column(batch, "text")
            for a, b in steps(texts, 4 << 20):
                found, best = _leaks_of(texts.slice(a, b - a), shared.value)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(a, b - a),
                        pa.array([sorted(f) for f in found], pa.list_(pa.int64())),
                        pa.array(best, pa.float64()),
                    ],
                    names=["id", "items", "share"],
                )

    out = rows.mapInArrow(run, f"id {kind}, items array<bigint>, share double")
    return out.withColumnRenamed("id", key)


def prepare(rows: DataFrame, benchmark: DataFrame, item: str, answer: str | None):
    """The blocks of items, fitted on ``rows (id, text)`` and sent to the tasks."""
    asked = benchmark.select(
        F.col(item).cast("bigint").alias("id"),
        F.col("text").alias("text"),
        (F.col(answer) if answer else F.lit(None).cast("string")).alias("answer"),
    )
    blocks = []
    for block in item_blocks(asked):
        terms, vectors = fit_projection(rows.select("text"), [t or "" for _, t, _ in block])
        if terms.place:
            blocks.append(Items(block, terms, vectors))
    return rows.sparkSession.sparkContext.broadcast(blocks)


def _leaks_of(texts: pa.Array, blocks: list[Items]) -> tuple[list[set], list]:
    """The items found in each text, and the best share."""
    found: list[set] = [set() for _ in range(len(texts))]
    best: list[float | None] = [None] * len(texts)
    words = Words(texts)
    for items in blocks:
        for at, number, share in _search(words, items):
            found[at].add(number)
            best[at] = max(best[at] or 0.0, share)
    return found, best


def op5_decontamination(spark, sf_dir: str) -> DataFrame:
    """Every document with the benchmark items found in it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return find_leaks(docs, benchmark).select(
        "doc_id",
        (F.size("items") > 0).alias("contaminated"),
        F.array_join("items", ",").alias("items"),
        "share",
    )


def decontamination_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents without a leaked item, with all their columns.

    Null and empty texts stay.  Only the text goes to Python.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = docs.select(F.col("doc_id").alias("id"), "text")
    shared = prepare(rows, benchmark, "item_id", None)

    @F.arrow_udf("boolean")
    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            texts = texts.fill_null("")
            out: list[bool] = []
            for a, b in steps(texts, 4 << 20):
                found, _ = _leaks_of(texts.slice(a, b - a), shared.value)
                out += [not f for f in found]
            yield pa.array(out, pa.bool_())

    marked = docs.withColumn("__clean", clean.asNondeterministic()(F.col("text")))
    return marked.where("__clean").select(*docs.columns)
