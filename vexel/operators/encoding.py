"""Encoding texts as token ids against a vocabulary table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vexel.functions.tokens import (
    PAD_ID,
    PAD_TOKEN,
    attention_mask,
    pad_ids,
    split_tokens,
    truncate_ids,
    type_ids,
)
from vexel.schema import DEFAULT_MAX_TOKENS, DEFAULT_PAD_TO
from vexel.session import work_dir

# One text in so many is looked at to find the tokens that many texts have.
SAMPLED = 64
# Such a token is in more than one of so many texts.  There are at most this number
# times the tokens of a text, whatever the data.
FREQUENT_SHARE = 100


@dataclass(frozen=True)
class SpecialTokens:
    """Ids of the special tokens.  Fixed values of the uncased BERT vocabulary."""

    unk: int = 100
    cls: int = 101
    sep: int = 102
    pad: int = PAD_ID


def _frequent(lines: DataFrame, ids: DataFrame) -> DataFrame:
    """(token, id) of the tokens found in a large share of the sampled ``lines``.

    Only decides where ids are looked up, not what they are; bounded by
    ``FREQUENT_SHARE`` times the tokens of a text.
    """
    sampled = lines.where(F.pmod(F.xxhash64("__line"), F.lit(SAMPLED)) == 0)
    tokens = sampled.select(F.explode(F.array_distinct(_tokens())).alias("token"))
    total = sampled.select(F.count(F.lit(1))).scalar()
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    often = counts.where((F.col("n") > 1) & (F.col("n") * FREQUENT_SHARE > total))
    found = ids.join(F.broadcast(often.select("token")), "token", "left_semi")
    return found.where("id is not null")


def _tokens() -> Column:
    """The tokens of a line, which are joined by spaces and hold none."""
    return F.when(F.col("__line") == "", F.array().cast("array<string>")).otherwise(
        F.split("__line", " ")
    )


def _coded(names: pa.Array, numbers: pa.Array, unk: int):
    """Ids of each row's tokens: from the small table, or else the next of its own."""

    @F.arrow_udf("array<bigint>")
    def ids(tokens: pa.Array, others: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy()
        flat = tokens.flatten()
        place = pc.index_in(flat, value_set=names.cast(flat.type))
        known = pc.take(numbers, place)
        rest = pc.fill_null(others.flatten(), unk)
        out = pc.replace_with_mask(known, pc.is_null(place), rest)
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), out)

    return ids


def encode_tokens(
    texts: DataFrame,
    vocab: DataFrame,
    *,
    key: Sequence[str],
    text_col: str = "text",
    special: SpecialTokens = SpecialTokens(),
    with_special: bool = True,
    max_len: int = DEFAULT_MAX_TOKENS,
    pad_to: int = DEFAULT_PAD_TO,
) -> DataFrame:
    """``key`` with ``input_ids, tokens, attention_mask, token_type_ids, length, n_tokens``.

    ``vocab`` is (token, id) of any size; of a token listed twice the lowest id counts.
    Texts are cut to ``max_len`` tokens, special ones included, and padded on the right
    to ``pad_to``; longer rows stay longer.  Keys may repeat or be NULL and may have any
    name: rows are told apart by themselves.

    One plan at every size.  The cut texts are written once.  Tokens that many texts
    have are found in a sample and get their ids from a small table sent to every task;
    only the others travel, by themselves to the vocabulary, where none is frequent
    enough to burden a task, and as ids back to their text.  Key columns are of types
    that Parquet holds.
    """
    ends = 2 if with_special else 0
    if max_len < ends:
        raise ValueError("max_len leaves no room for the special tokens")
    spark = texts.sparkSession
    ids = vocab.groupBy("token").agg(F.min(F.col("id").cast("bigint")).alias("id"))
    body = truncate_ids(split_tokens(text_col), max_len - ends)
    names = [f"__key{i}" for i in range(len(key))]
    # Written, so that a row's number is the same wherever it is read.
    path = work_dir(spark, "lines")
    lines = texts.select(
        *(F.col(k).alias(n) for n, k in zip(names, key, strict=True)),
        F.array_join(body, " ").alias("__line"),
    ).withColumn("__row", F.monotonically_increasing_id())
    lines.write.parquet(path)
    lines = spark.read.schema(lines.schema).parquet(path)
    often = _frequent(lines, ids).toArrow()  # bounded, see there
    numbers = often.column("id").combine_chunks()
    known = spark.createDataFrame(often.select(["token"]))
    sought = lines.select("__row", F.posexplode(_tokens()).alias("__at", "token"))
    sought = sought.join(F.broadcast(known), "token", "left_anti")
    found = sought.join(ids, "token", "left").select("__row", "__at", "id")
    # By the row before they are collected: a group is at most ``max_len`` ids.
    rest = (
        found.repartition("__row")
        .groupBy("__row")
        .agg(F.array_sort(F.collect_list(F.struct("__at", "id"))).alias("__rest"))
        .select("__row", F.col("__rest.id").alias("__rest"))
    )
    coded = _coded(often.column("token").combine_chunks(), numbers, special.unk)
    ided = (
        lines.join(rest, "__row", "left")
        .select(*names, _tokens().alias("body"), "__rest")
        .withColumn("ids", coded.asNondeterministic()("body", "__rest"))
    )
    words = F.zip_with(
        "body", "ids", lambda t, i: F.when(i == special.unk, "[UNK]").otherwise(t)
    )
    input_ids: Column = F.col("ids")
    if with_special:
        words = F.concat(F.array(F.lit("[CLS]")), words, F.array(F.lit("[SEP]")))
        input_ids = F.concat(
            F.array(F.lit(special.cls).cast("bigint")),
            input_ids,
            F.array(F.lit(special.sep).cast("bigint")),
        )
    padded = ided.withColumn("n_tokens", F.size("ids") + ends)
    padded = padded.withColumn(
        "length", F.greatest("n_tokens", F.lit(pad_to)).cast("bigint")
    )
    length = F.col("length").cast("int")
    n = F.col("n_tokens")
    out = (
        padded.withColumn("input_ids", pad_ids(input_ids, pad_to, special.pad, size=n))
        .withColumn("tokens", pad_ids(words, pad_to, PAD_TOKEN, size=n))
        .withColumn("attention_mask", attention_mask("n_tokens", length))
        .withColumn("token_type_ids", type_ids(length))
    )
    return out.select(
        *(F.col(n).alias(k) for n, k in zip(names, key, strict=True)),
        "input_ids", "tokens", "attention_mask", "token_type_ids", "length", "n_tokens",
    )
