"""Column functions on token and id arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters and digits make a token; [PAD] has id 0 and type 0.
TOKEN_PATTERN = r"[\p{L}\p{N}]+"
PAD_ID = 0
PAD_TOKEN = "[PAD]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_tokens(text: Column | str) -> Column:
    """Lower-cased runs of letters and digits, in order."""
    lowered = F.lower(F.coalesce(_col(text), F.lit("")))
    return F.regexp_extract_all(lowered, F.lit(TOKEN_PATTERN), F.lit(0))


def truncate_ids(
    items: Column | str, max_len: int, *, head: int = 0, tail: int = 0
) -> Column:
    """Cut to ``max_len`` entries, keeping ``head`` first and ``tail`` last ones.

    ``head`` / ``tail`` are the special tokens: the cut takes body tokens only.
    """
    if max_len < head + tail:
        raise ValueError("max_len leaves no room for the special tokens")
    items = _col(items)
    if tail == 0:
        return F.slice(items, 1, max_len)
    cut = F.concat(
        F.slice(items, 1, max_len - tail), F.slice(items, -tail, tail)
    )
    return F.when(F.size(items) <= max_len, items).otherwise(cut)


def pad_ids(
    items: Column | str,
    pad_to: int,
    value: int | str = PAD_ID,
    *,
    size: Column | str | None = None,
) -> Column:
    """Right-pad to ``pad_to``; a longer array stays as it is.

    ``size``, if it is known as a column, saves evaluating ``items`` twice.
    """
    items = _col(items)
    n = F.size(items) if size is None else _col(size)
    fill = F.lit(value) if isinstance(value, str) else F.lit(value).cast("bigint")
    missing = F.greatest(F.lit(pad_to) - n, F.lit(0))
    return F.concat(items, F.array_repeat(fill, missing))


def attention_mask(n_tokens: Column | str, length: Column | str) -> Column:
    """1 for each of the ``n_tokens`` real tokens, then 0 up to ``length``."""
    n, total = _col(n_tokens), _col(length)
    ones = F.array_repeat(F.lit(1).cast("bigint"), n)
    zeros = F.array_repeat(F.lit(0).cast("bigint"), F.greatest(total - n, F.lit(0)))
    return F.concat(ones, zeros)


def type_ids(length: Column | str) -> Column:
    """Segment ids of a single-sentence input: all 0."""
    return F.array_repeat(F.lit(0).cast("bigint"), _col(length))
