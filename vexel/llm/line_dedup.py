"""Repeated line runs, deleted by a suffix array over line-id sequences.

1. Lines are hashed to 96 bits.  A line that occurs once cannot be in a repeated run,
   so only maximal runs of repeated lines go on (``runs``), and of those the ones with
   enough words.
2. Prefix doubling: names of single lines are ranks of their hashes; names of 2k lines
   are ranks of pairs of names of k lines.  A round groups the pairs (a hot line is
   summed up before the shuffle), sorts the distinct pairs by ranges and numbers them.
   It ends when no round splits a name any more; then the names order the suffixes.
3. Longest common prefixes of neighbours in that order.  Where the lines before two
   neighbours are equal too, the value is one less than at the place before, so only
   the other places compare lines.
4. LCP intervals: for each suffix the longest prefix that also occurs earlier in the
   corpus, by a stack over each range of the suffix array, both ways.  What a range
   leaves open is answered by the stacks of the ranges before or behind, each no longer
   than the longest repeated run.
5. A run of lines that occurs earlier, with ``MIN_WORDS`` words or more, is deleted; the
   first copy, by document id and line, stays.

Defined cases: a null text stays null and has no line; a line is what stands between
newlines, also if blank; documents with a null id come first; rows that agree in id and
text are one document and treated alike, rows that agree in the id alone are told apart
by a hash of the text; a document may lose all its lines and then is empty text; a run
repeated within one document loses its later copies too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vexel.llm.common import drop_stage, stage

#: Words that a repeated run must have to lose its later copies.
MIN_WORDS = 30
_SPACES = r"[ \t\n\x0B\f\r]+"
#: Lines that two suffixes compare in the first step; four times more in each next.
_COMPARE = 16
_NO_NAME = -1


def _lines(docs: DataFrame) -> DataFrame:
    """(d, x, n, h, g, words): every line of docs (d, x, text)."""
    each = docs.select("d", "x", F.posexplode(F.split("text", "\n", -1)).alias("n", "l"))
    return each.select(
        "d",
        "x",
        "n",
        F.xxhash64("l").alias("h"),
        F.hash("l").alias("g"),
        F.size(F.array_remove(F.split("l", _SPACES), "")).alias("words"),
    )


def _runs(docs: DataFrame, min_words: int) -> DataFrame:
    """(r, d, x, first, h, g, words): maximal runs of repeated lines, r in text order."""
    lines = _lines(docs)
    repeated = stage(
        lines.groupBy("h", "g").count().where("count > 1").select("h", "g"), "repeated"
    )
    document = Window.partitionBy("d", "x").orderBy("n")
    found = (
        lines.join(repeated, ["h", "g"])
        .groupBy("d", "x", "n")  # of rows that agree in id and text, one
        .agg(F.first("h").alias("h"), F.first("g").alias("g"), F.first("words").alias("words"))
        .withColumn("first", F.col("n") - F.row_number().over(document) + 1)
    )
    # In a run n rises with its place, so the difference is the same all along it.
    grouped = found.groupBy("d", "x", "first").agg(
        F.sort_array(F.collect_list(F.struct("n", "h", "g", "words"))).alias("s"),
        F.sum("words").alias("total"),
    )
    kept = grouped.where(F.col("total") >= min_words).select(
        "d",
        "x",
        F.col("s")[0]["n"].alias("first"),
        F.col("s.h").alias("h"),
        F.col("s.g").alias("g"),
        F.col("s.words").alias("words"),
    )
    runs = stage(
        kept.repartitionByRange("d", "x", "first")
        .sortWithinPartitions("d", "x", "first")
        .select(F.monotonically_increasing_id().alias("r"), "*"),
        "runs",
    )
    drop_stage(repeated)
    return runs


def _named(pairs: DataFrame) -> tuple[DataFrame, int]:
    """(r, names) in the order of pairs (r, i, a, b), and how many names there are."""
    names = stage(
        pairs.select("a", "b")
        .distinct()
        .repartitionByRange("a", "b")
        .sortWithinPartitions("a", "b")
        .select("a", "b", F.monotonically_increasing_id().alias("name")),
        "names",
    )
    count = names.count()
    named = stage(
        pairs.join(names, ["a", "b"])
        .groupBy("r")
        .agg(F.sort_array(F.collect_list(F.struct("i", "name"))).alias("s"))
        .select("r", F.col("s.name").alias("names")),
        "named",
    )
    drop_stage(names)
    return named, count


def _doubled(named: DataFrame, k: int) -> DataFrame:
    """Pairs of the names at each place and k places on."""
    size = F.size("names")
    onward = F.concat(
        F.slice("names", F.lit(k + 1), size),
        F.array_repeat(F.lit(_NO_NAME).cast("bigint"), F.least(F.lit(k), size)),
    )
    return named.select(
        "r", F.posexplode(F.arrays_zip(F.col("names").alias("a"), onward.alias("b"))).alias("i", "p")
    ).select("r", "i", F.col("p.a").alias("a"), F.col("p.b").alias("b"))


def _suffix_names(runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(r, names) of single lines, and (r, names) of whole suffixes."""
    first = runs.select(
        "r", F.posexplode(F.arrays_zip(F.col("h"), F.col("g"))).alias("i", "p")
    ).select("r", "i", F.col("p.h").alias("a"), F.col("p.g").cast("bigint").alias("b"))
    lines, count = _named(first)
    longest = runs.agg(F.max(F.size("h"))).first()[0] or 0
    suffixes, k = lines, 1
    while k < longest:
        following, more = _named(_doubled(suffixes, k))
        if suffixes is not lines:
            drop_stage(suffixes)
        suffixes, k = following, 2 * k
        if more == count:
            break
        count = more
    return lines, suffixes


_SA = (
    "range int, at bigint, r bigint, i int, before bigint, "
    "other_r bigint, other_i int, other_before bigint"
)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each suffix of a sorted range with the one before it."""
    task = TaskContext.get().partitionId()
    done, last = 0, None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        own = [batch.column(c) for c in ("r", "i", "before")]
        head = pa.array([0]) if last is None else None
        others = []
        for place, column in enumerate(own):
            start = pa.nulls(1, column.type) if head is not None else last[place]
            others.append(pa.concat_arrays([start, column.slice(0, n - 1)]))
        last = [column.slice(n - 1, 1) for column in own]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, task, np.int32)),
                pa.array(np.arange(done, done + n, dtype=np.int64)),
                *own,
                *others,
            ],
            names=[f.split()[0] for f in _SA.split(", ")],
        )
        done += n


def _suffix_array(lines: DataFrame, suffixes: DataFrame) -> DataFrame:
    """The sorted suffixes with their neighbours, in ranges of even size."""
    each = (
        suffixes.join(lines.select("r", F.col("names").alias("line")), "r")
        .select(
            "r",
            F.posexplode(
                F.arrays_zip(
                    F.col("names").alias("name"),
                    F.concat(
                        F.array(F.lit(None).cast("bigint")),
                        F.slice("line", F.lit(1), F.size("line") - 1),
                    ).alias("before"),
                )
            ).alias("i", "p"),
        )
        .select("r", "i", F.col("p.name").alias("name"), F.col("p.before").alias("before"))
    )
    order = ["name", "r", "i"]
    ranges = stage(
        each.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_neighbours, _SA),
        "suffixes",
    )
    # The first of a range has its neighbour at the end of the range before: one row
    # per range.
    ends = ranges.groupBy("range").agg(
        F.max_by(F.struct("r", "i", "before"), "at").alias("e")
    )
    handed = ends.select(
        F.lead("range").over(Window.orderBy("range")).alias("range"), "e"
    )
    mended = ranges.join(F.broadcast(handed), "range", "left")
    first = F.col("at") == 0
    for name, place in (("other_r", "r"), ("other_i", "i"), ("other_before", "before")):
        mended = mended.withColumn(
            name, F.when(first, F.col(f"e.{place}")).otherwise(F.col(name))
        )
    return mended.drop("e")


def _compared(pairs: DataFrame, lines: DataFrame, steps: list[DataFrame]) -> DataFrame:
    """(r, i, lcp) of pairs (r, i, other_r, other_i), by comparing their lines."""
    todo = pairs.withColumn("done", F.lit(0))
    size, parts = _COMPARE, []
    other = lines.select(F.col("r").alias("other_r"), F.col("names").alias("other"))
    while True:
        own = todo.join(lines, "r").withColumn(
            "mine", F.slice("names", F.col("i") + F.col("done") + 1, F.lit(size))
        ).drop("names")
        both = own.join(other, "other_r").select(
            "r", "i", "other_r", "other_i", "done", "mine",
            F.slice("other", F.col("other_i") + F.col("done") + 1, F.lit(size)).alias("theirs"),
        )
        equal = F.zip_with("mine", "theirs", lambda a, b: F.coalesce(a == b, F.lit(False)))
        miss = F.array_position(equal, False)
        step = stage(
            both.select(
                "r", "i", "other_r", "other_i",
                (F.col("done") + F.when(miss > 0, miss - 1).otherwise(F.size(equal)))
                .cast("int").alias("done"),
                ((miss == 0) & (F.size(equal) == size)).alias("open"),
            ),
            "compared",
        )
        steps.append(step)
        parts.append(step.where("NOT open").select("r", "i", F.col("done").alias("lcp")))
        todo = step.where("open").drop("open")
        if todo.isEmpty():
            break
        size *= 4
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    return found


def _with_lcp(array: DataFrame, lines: DataFrame) -> DataFrame:
    """(range, at, r, i, lcp): lines shared with the suffix before it in the order."""
    new = (
        F.col("before").isNull()
        | F.col("other_before").isNull()
        | (F.col("before") != F.col("other_before"))
    )
    pairs = array.where(F.col("other_r").isNotNull() & new).select(
        "r", "i", "other_r", "other_i"
    )
    steps: list[DataFrame] = []
    compared = _compared(pairs, lines, steps)
    run = Window.partitionBy("r").orderBy("i")
    # A suffix without a neighbour shares nothing; one not compared shares one line
    # less than the place before it.
    start = F.when(F.col("other_r").isNull(), F.col("i")).otherwise(
        F.col("lcp") + F.col("i")
    )
    filled = array.join(compared, ["r", "i"], "left").withColumn(
        "lcp", (F.last(start, ignorenulls=True).over(run) - F.col("i")).cast("int")
    )
    out = stage(filled.select("range", "at", "r", "i", "lcp"), "lcp")
    drop_stage(*steps)
    return out


class _Range:
    """One range of the suffix array: text places and LCPs with the one before."""

    def __init__(self, r: list[int], i: list[int], lcp: list[int]) -> None:
        self.place = [(a << 32) | b for a, b in zip(r, i, strict=True)]
        self.lcp = lcp

    def earlier(self, before: list, behind: list, next_lcp: int) -> list[int]:
        """Per suffix the longest prefix that occurs earlier in the text."""
        forward, _ = _scan(self.place, self.lcp, before)
        back_lcp = [next_lcp, *self.lcp[:0:-1]]
        backward, _ = _scan(self.place[::-1], back_lcp, behind)
        return [max(a, b) for a, b in zip(forward, backward[::-1], strict=True)]

    def chains(self) -> tuple[list, list]:
        """What the range tells those behind it, and those before it."""
        _, forward = _scan(self.place, self.lcp, [])
        _, backward = _scan(self.place[::-1], [0, *self.lcp[:0:-1]], [])
        return forward, backward


def _scan(place: list[int], lcp: list[int], handed: list) -> tuple[list[int], list]:
    """Longest prefix shared with the nearest smaller place on one side.

    ``lcp[j]`` is shared with the element before; ``handed`` are (place, lcp up to the
    end of its range) from the ranges before, nearest first.  Returns the values and
    the chain (place, lcp up to this end), nearest first.
    """
    out: list[int] = []
    stack: list[tuple[int, int]] = []
    for at, shared in zip(place, lcp, strict=True):
        while stack and stack[-1][0] > at:
            shared = min(shared, stack.pop()[1])
        if stack or not shared:
            out.append(shared if stack else 0)
        else:
            out.append(_ask(handed, at, shared))
        stack.append((at, shared))
    chain, low = [], None
    for at, shared in reversed(stack):
        # Up to here: the lowest of the values above this element.
        reach = low if low is not None else 1 << 30
        if reach <= 0:
            break
        if chain and chain[-1][1] == reach:
            chain.pop()
        chain.append((at, reach))
        low = shared if low is None else min(low, shared)
    return out, chain


def _ask(handed: list, at: int, shared: int) -> int:
    for place, reach in handed:
        if place < at:
            return min(shared, reach)
    return 0


def _hand_on(chains: list, lcps: list[int], lowest: list[int]) -> list[list]:
    """For each range the chain of all before it.

    ``lcps[j]``: lines shared across the border in front of range j; ``lowest[j]``: the
    least shared within range j.  Reaches fall strictly along a chain, so beside a range's
    own end it has no more entries than the longest repeated run has lines.
    """
    out: list[list] = []
    carry: list = []
    for j, chain in enumerate(chains):
        capped = [(p, min(m, lcps[j])) for p, m in carry if min(m, lcps[j]) > 0]
        out.append(carry)
        kept = list(chain)
        floor = min((p for p, _ in chain), default=None)
        for p, m in capped:
            m = min(m, lowest[j])
            if m > 0 and (floor is None or p < floor):
                # Of places with one reach the smallest answers for all.
                if kept and kept[-1][1] == m:
                    kept.pop()
                kept.append((p, m))
                floor = p
        carry = kept
    return out


def _by_range(rows: DataFrame) -> DataFrame:
    return rows.repartition("range").sortWithinPartitions("range", "at")


def _each_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, _Range, list, list]]:
    held: list[pa.RecordBatch] = []

    def made():
        table = pa.Table.from_batches(held)
        r, i = table.column("r").to_pylist(), table.column("i").to_pylist()
        number = held[0].column("range")[0].as_py()
        return number, _Range(r, i, table.column("lcp").to_pylist()), r, i

    for batch in batches:
        values = batch.column("range").to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(values)) + 1).tolist(), len(values)]
        for a, b in zip(edges, edges[1:], strict=False):
            if a == b:
                continue
            part = batch.slice(a, b - a)
            if held and held[0].column("range")[0].as_py() != values[a]:
                yield made()
                held = []
            held.append(part)
    if held:
        yield made()


_CHAINS = (
    "range int, first_lcp int, lowest int, "
    "ahead array<struct<p:string,m:int>>, back array<struct<p:string,m:int>>"
)
_CHAIN_TYPE = pa.list_(pa.struct([("p", pa.string()), ("m", pa.int32())]))


def _range_chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for number, part, _, _ in _each_range(batches):
        ahead, back = part.chains()
        rows = [[{"p": str(p), "m": m} for p, m in chain] for chain in (ahead, back)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int32()),
                pa.array([part.lcp[0]], pa.int32()),
                pa.array([min(part.lcp[1:], default=1 << 30)], pa.int32()),
                pa.array([rows[0]], _CHAIN_TYPE),
                pa.array([rows[1]], _CHAIN_TYPE),
            ],
            names=["range", "first_lcp", "lowest", "ahead", "back"],
        )


def _earlier(lcps: DataFrame) -> DataFrame:
    """(r, i, shared): lines from there on that also occur earlier in the text."""
    # One row per range; a chain is no longer than the longest repeated run.
    rows = sorted(
        _by_range(lcps).mapInArrow(_range_chains, _CHAINS).collect(),
        key=lambda row: row["range"],
    )
    chain = [
        [[(int(e["p"]), e["m"]) for e in row[side]] for row in rows]
        for side in ("ahead", "back")
    ]
    firsts = [row["first_lcp"] for row in rows]
    lowest = [row["lowest"] for row in rows]
    before = _hand_on(chain[0], firsts, lowest)
    nexts = [*firsts[1:], 0]
    behind = _hand_on(chain[1][::-1], nexts[::-1], lowest[::-1])[::-1]
    asked = {
        row["range"]: (before[j], behind[j], nexts[j]) for j, row in enumerate(rows)
    }
    shared = lcps.sparkSession.sparkContext.broadcast(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, part, r, i in _each_range(batches):
            found = part.earlier(*shared.value[number])
            yield pa.RecordBatch.from_arrays(
                [pa.array(r, pa.int64()), pa.array(i, pa.int32()), pa.array(found, pa.int32())],
                names=["r", "i", "shared"],
            )

    return _by_range(lcps).mapInArrow(run, "r bigint, i int, shared int")


def _deleter(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for first, words, spans in zip(
                batch.column("first").to_pylist(),
                batch.column("words").to_pylist(),
                batch.column("spans").to_pylist(),
                strict=True,
            ):
                before = np.concatenate([[0], np.cumsum(words)])
                edges = np.zeros(len(words) + 1, np.int64)
                for span in spans:
                    a, b = span["i"], span["i"] + span["shared"]
                    if before[b] - before[a] >= min_words:
                        edges[a] += 1
                        edges[b] -= 1
                gone = np.concatenate([[0], np.cumsum(edges)[:-1] > 0, [0]]).astype(int)
                turns = np.flatnonzero(np.diff(gone))
                out.append(
                    [
                        {"start": first + int(a), "stop": first + int(b)}
                        for a, b in turns.reshape(-1, 2)
                    ]
                )
            kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("d"), batch.column("x"), pa.array(out, kind)],
                names=["d", "x", "gone"],
            )

    return run


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(d, x, gone): line ranges to delete from documents (d, x, text)."""
    runs = _runs(docs, min_words)
    lines, suffixes = _suffix_names(runs)
    array = _suffix_array(lines, suffixes)
    lcps = _with_lcp(array, lines)
    spans = (
        _earlier(lcps)
        .where("shared > 0")
        .groupBy("r")
        .agg(F.collect_list(F.struct("i", "shared")).alias("spans"))
    )
    kind = runs.schema["d"].dataType.simpleString()
    found = (
        runs.join(spans, "r")
        .select("d", "x", "first", "words", "spans")
        .mapInArrow(
            _deleter(min_words),
            f"d {kind}, x bigint, gone array<struct<start:int,stop:int>>",
        )
        .where(F.size("gone") > 0)
        .groupBy("d", "x")
        .agg(F.array_sort(F.flatten(F.collect_list("gone"))).alias("gone"))
    )
    out = stage(found, "gone")
    drop_stage(runs, lines, suffixes, lcps)
    return out


def dedup_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """``docs`` with later copies gone from ``text``, and ``__gone``, the line ranges."""
    identity = (F.col(key).alias("d"), F.xxhash64(text).alias("x"))
    gone = repeated_runs(
        docs.select(*identity, F.col(text).alias("text")), min_words
    ).select(F.col("d").alias("__d"), F.col("x").alias("__x"), F.col("gone").alias("__gone"))
    # Texts are shuffled once, the ranges are the built side.
    joined = docs.join(
        gone.hint("shuffle_hash"),
        F.col(key).eqNullSafe(F.col("__d")) & (F.xxhash64(text) == F.col("__x")),
        "left",
    )
    kept = F.filter(
        F.split(text, "\n", -1),
        lambda line, i: ~F.exists(
            "__gone", lambda g: (g["start"] <= i) & (i < g["stop"])
        ),
    )
    cut = F.when(F.col("__gone").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    return joined.withColumn(text, cut).drop("__d", "__x")


def op2_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document with what is left of it: (doc_id, n_deleted, deleted, text)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = dedup_lines(docs)
    lines = F.coalesce(
        F.aggregate(
            "__gone", F.lit(0), lambda total, g: total + g["stop"] - g["start"]
        ),
        F.lit(0),
    )
    ranges = F.array_join(
        F.transform("__gone", lambda g: F.concat_ws("-", g["start"], g["stop"])), ","
    )
    return rows.select(
        "doc_id",
        lines.cast("bigint").alias("n_deleted"),
        F.coalesce(ranges, F.lit("")).alias("deleted"),
        "text",
    )


def line_dedup_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: all documents, without the later copies of line runs.

    A column that states the length of the text is left as it came.
    """
    return dedup_lines(docs).select(*docs.columns)
