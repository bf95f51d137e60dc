"""Quality rules as a ledger of bits: every rule is evaluated once per document.

``measure`` gives the measurements, ``ledger`` adds ``failed``, a BIGINT with one
bit per rule.  A policy is a mask of rules that count, so another policy, or the
effect of leaving a rule out, needs the ledger only and never the texts again.

Defined cases: a null or empty text has no word and every count 0; a rule whose
ratio has no denominator does not fail; repeated rows are measured each on its own;
an empty table gives an empty ledger.  Only the key, the text and the columns named
here are returned, so other columns of the input cannot clash.

Everything is built-in expressions over the columns of one row: no shuffle, no
Python.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPACES = r"[ \t\n\x0B\f\r]+"
_WORD_CHARACTER = r"[^ \t\n\x0B\f\r]"
_SYMBOLS = "[#*$%&|<>]+"


@dataclass(frozen=True)
class Rule:
    """``fails`` is SQL over the measurements."""

    name: str
    fails: str


#: The place of a rule is its bit and never changes; new rules go to the end.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > 3 * n_words"),
    Rule("repeated_lines", "2 * n_dup_lines > n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("lines_of_one_word", "10 * n_lines > 9 * n_words AND n_words > 0"),
)


def mask(*names: str) -> int:
    """The policy in which exactly these rules count."""
    place = {rule.name: bit for bit, rule in enumerate(RULES)}
    return sum(1 << place[name] for name in set(names))


BASE_RULES = mask("few_words", "repeated_words")
#: Version to mask; a published version is never changed.
POLICIES = {
    "v1": BASE_RULES,
    "v2": mask(*(rule.name for rule in RULES)),
}


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with its counts (BIGINT).

    n_words, word_chars (code points in words), n_symbols, n_lines (lines with a
    word), n_dup_lines (of those, equal to an earlier one), n_repeat_words (words
    in windows of three that the text holds twice or more, the first included).
    """
    base = docs.select(
        F.col(key).alias(key), F.coalesce(F.col(text), F.lit("")).alias("__t")
    )
    cut = base.select(
        key,
        "__t",
        F.array_remove(F.split("__t", _SPACES), "").alias("__w"),
        F.filter(
            F.split("__t", "\n", -1), lambda line: line.rlike(_WORD_CHARACTER)
        ).alias("__l"),
    )
    # Each lambda below reads a column of the row before, used more than once, so
    # the split is not evaluated again for every element.
    n = F.size("__w")
    windows = F.when(
        n >= 3,
        F.transform(
            F.slice("__w", 1, n - 2),
            lambda w, i: F.xxhash64(
                w, F.get(F.col("__w"), i + 1), F.get(F.col("__w"), i + 2)
            ),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    hashed = cut.select(
        key,
        n.cast("bigint").alias("n_words"),
        F.length(F.array_join("__w", "")).cast("bigint").alias("word_chars"),
        (F.length("__t") - F.length(F.regexp_replace("__t", _SYMBOLS, "")))
        .cast("bigint")
        .alias("n_symbols"),
        F.size("__l").cast("bigint").alias("n_lines"),
        (F.size("__l") - F.size(F.array_distinct("__l")))
        .cast("bigint")
        .alias("n_dup_lines"),
        windows.alias("__h"),
    )
    # Only texts that repeat a window are sorted.
    repeats = F.size(F.array_distinct("__h")) < F.size("__h")
    by_hash = hashed.withColumn(
        "__s",
        F.when(
            repeats,
            F.sort_array(
                F.arrays_zip(
                    F.col("__h").alias("h"),
                    F.sequence(F.lit(0), F.size("__h") - 1).alias("p"),
                )
            ),
        ),
    )
    same = by_hash.withColumn(
        "__p",
        F.sort_array(
            F.transform(
                F.filter(
                    "__s",
                    lambda x, i: (
                        (x["h"] == F.get(F.col("__s"), i - 1)["h"])
                        & (i > 0)
                    )
                    | F.coalesce(
                        x["h"] == F.get(F.col("__s"), i + 1)["h"], F.lit(False)
                    ),
                ),
                lambda x: x["p"],
            )
        ),
    )
    covered = F.aggregate(
        F.zip_with(
            "__p",
            F.slice("__p", 2, F.greatest(F.size("__p"), F.lit(1))),
            lambda at, following: F.least(
                F.lit(3), F.coalesce(following - at, F.lit(3))
            ),
        ),
        F.lit(0).cast("bigint"),
        lambda total, words: total + words,
    )
    return same.select(
        key,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_lines",
        "n_dup_lines",
        F.coalesce(F.when(F.size("__p") > 0, covered), F.lit(0).cast("bigint")).alias(
            "n_repeat_words"
        ),
    )


def failed_bits(rules: tuple[Rule, ...] = RULES) -> Column:
    bits = F.lit(0).cast("bigint")
    for bit, rule in enumerate(rules):
        bits = bits + F.when(
            F.coalesce(F.expr(rule.fails), F.lit(False)), F.lit(1 << bit)
        ).otherwise(F.lit(0)).cast("bigint")
    return bits


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The measurements and ``failed``, a bit per rule."""
    return measure(docs, key, text).withColumn("failed", failed_bits())


def passes(policy: int, failed: str = "failed") -> Column:
    """The verdict of a policy on a ledger."""
    return F.col(failed).bitwiseAND(F.lit(policy)) == 0


def apply_policies(ledger_rows: DataFrame, versions: dict[str, int] | None = None):
    """Adds a BOOLEAN ``kept_<version>`` per policy."""
    for version, policy in (versions or POLICIES).items():
        ledger_rows = ledger_rows.withColumn(f"kept_{version}", passes(policy))
    return ledger_rows


def ablation(ledger_rows: DataFrame, policy: int = POLICIES["v2"]) -> DataFrame:
    """Per rule of the policy: rows that fail it, rows that fail nothing else.

    ``only_this`` rows are those the policy would keep without the rule.  Rows are
    first counted by distinct ``failed`` value (at most 2 to the number of rules),
    so one small group is all that meets in a task.  ``any_failed`` is the OR and
    ``all_failed`` the AND of the failing rows' bits.
    """
    hit = F.col("failed").bitwiseAND(F.lit(policy))
    seen = ledger_rows.groupBy(hit.alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.array(
        *(
            F.struct(
                F.lit(rule.name).alias("rule"),
                F.lit(1 << bit).cast("bigint").alias("bit"),
            )
            for bit, rule in enumerate(RULES)
            if policy >> bit & 1
        )
    )
    each = seen.select("bits", "n", F.explode(rules).alias("r"))
    fails = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(fails, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias(
            "only_this"
        ),
        F.coalesce(F.bit_or(F.when(fails, F.col("bits"))), F.lit(0)).alias(
            "any_failed"
        ),
        F.coalesce(F.bit_and(F.when(fails, F.col("bits"))), F.lit(0)).alias(
            "all_failed"
        ),
    )


def op8_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Contract rows of op8: base measurements, base verdict and policy verdict."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = ledger(docs)
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~passes(BASE_RULES)).alias("base_failed"),
        (passes(BASE_RULES) & passes(POLICIES["v2"])).alias("kept"),
        "failed",
    )


def quality_ablation(spark, sf_dir: str) -> DataFrame:
    """What each rule of the current policy does to the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return ablation(ledger(docs))


_SQL_RULES = " + ".join(
    f"(CASE WHEN {rule.fails} THEN {1 << bit} ELSE 0 END)"
    for bit, rule in enumerate(RULES)
)

_SQL_LEDGER = rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                lambda x: x <> '') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)),
                lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents
), g AS (
  SELECT doc_id, unnest(range(1, len(ws) - 1)) AS p,
    unnest(list_zip(ws[:-3], ws[2:-2], ws[3:])) AS win
  FROM w WHERE len(ws) >= 3
), n AS (
  SELECT doc_id, p,
    count(*) OVER (PARTITION BY doc_id, win) AS times
  FROM g
), r AS (
  SELECT doc_id, count(DISTINCT q) AS k
  FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM n WHERE times > 1)
  GROUP BY doc_id
), m AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words,
    length(array_to_string(ws, ''))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT
      AS n_symbols,
    len(ls)::BIGINT AS n_lines,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(k, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN r USING (doc_id)
), f AS (SELECT *, ({_SQL_RULES})::BIGINT AS failed FROM m)
"""

OP8_SQL = rf"""{_SQL_LEDGER}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  failed & {BASE_RULES} <> 0 AS base_failed, failed = 0 AS kept, failed
FROM f
"""

_SQL_NAMES = ", ".join(
    f"('{rule.name}', {1 << bit}::BIGINT)"
    for bit, rule in enumerate(RULES)
    if POLICIES["v2"] >> bit & 1
)

ABLATION_SQL = rf"""{_SQL_LEDGER}, hits AS (
  SELECT rule, bit, failed & {POLICIES["v2"]} AS hit
  FROM f, (VALUES {_SQL_NAMES}) r(rule, bit)
)
SELECT rule, count_if(hit & bit <> 0)::BIGINT AS n_failed,
  count_if(hit = bit)::BIGINT AS only_this,
  coalesce(bit_or(CASE WHEN hit & bit <> 0 THEN hit END), 0)::BIGINT AS any_failed,
  coalesce(bit_and(CASE WHEN hit & bit <> 0 THEN hit END), 0)::BIGINT AS all_failed
FROM hits GROUP BY rule
"""
