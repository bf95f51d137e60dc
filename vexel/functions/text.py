"""Whitespace trimming and the empty-text rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The Unicode White_Space characters (not U+200B, not U+001C).
_WHITE_SPACE = (
    "\t\n\v\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip_space(text: str) -> str:
    """:func:`trim_space` for a plain string."""
    return text.strip(_WHITE_SPACE)


def trim_space(text: Column | str) -> Column:
    """Strip all Unicode white space from both ends; NULL becomes empty.

    A native trim looks at the ends only; a regular expression would try every
    white space inside the text.
    """
    col = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.btrim(col, F.lit(_WHITE_SPACE)), F.lit(""))


def require_text(
    df: DataFrame,
    col: str = "text",
    *,
    strict: bool = False,
    message: str = "no text provided to embed",
) -> DataFrame:
    """Trim ``col``; drop rows left empty, or fail on the first one if strict."""
    trimmed = trim_space(col)
    if strict:
        checked = F.when(F.length(trimmed) > 0, trimmed).otherwise(
            F.raise_error(F.lit(message)).cast("string")
        )
        return df.withColumn(col, checked)
    return df.withColumn(col, trimmed).filter(F.col(col) != "")
