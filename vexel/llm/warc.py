"""WARC revisits: "not modified" records resolved to the response they stand for.

A record is (record_id, kind, url, date, headers, payload columns...).  ``kind`` is
``response`` for a full response, ``revisit`` for a not-modified one; others pass
through.  A revisit is joined as of its date: the latest response of the same
canonical URL with a strictly earlier date, of those with equal dates the one with the
largest id.  Its validators must agree: a stated entity tag must be the response's
(weak and strong tags alike), else a stated modification date must be.  A resolved
revisit gets the response's payload and its headers, updated by the headers that a
not-modified answer may change.

One URL may hold a third of all records, so records are dealt out in (URL, date) order:
a URL with many records spans several ranges, each range finds its own latest
responses, and what earlier ranges found is handed on in a table with at most one row
per range.

Defined cases: a null URL has no canonical form and its revisits stay unresolved; a
null date comes before all others; null headers are none; header names compare in
lower case, of repeated names the first counts; records that repeat are resolved each;
an empty table gives an empty result.  States: ``full``, ``resolved``, ``unchecked``
(resolved without validators), ``mismatch``, ``orphan``, ``other``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vexel.llm.common import drop_stage, stage

#: Headers of the stored response that a not-modified answer does not replace.
KEPT_HEADERS = (
    "content-encoding",
    "content-length",
    "content-range",
    "content-type",
    "transfer-encoding",
)

#: Columns of the result beside the payload.
RESULT = ("record_id", "kind", "date", "url_key", "state", "source_id", "headers")


def canonical_url(url: str) -> Column:
    """Host in lower case without port 80 or 443 and www., path without a last slash,
    query parameters in order without tracking ones; no scheme, no fragment."""
    u = F.col(url)
    host = F.lower(F.regexp_extract(u, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, ":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_extract(u, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(
        F.filter(
            F.split(query, "&"), lambda p: (p != "") & ~F.startswith(p, F.lit("utm_"))
        )
    )
    return F.concat(
        host,
        F.regexp_replace(path, "/+$", ""),
        F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(
            ""
        ),
    )


def _lower_names(headers: Column) -> Column:
    entries = F.transform(
        F.map_entries(headers),
        lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")),
    )
    first = F.filter(
        entries,
        lambda e, i: F.array_position(
            F.transform(entries, lambda x: x["key"]), e["key"]
        )
        == i + 1,
    )
    return F.coalesce(
        F.map_from_entries(first), F.create_map().cast("map<string,string>")
    )


def _tag(headers: str) -> Column:
    return F.regexp_replace(F.element_at(headers, F.lit("etag")), "^W/", "")


def merged_headers(stored: str, fresh: str) -> Column:
    """The stored headers, with those a not-modified answer may change replaced."""
    allowed = F.map_filter(fresh, lambda k, v: ~k.isin(*KEPT_HEADERS))
    rest = F.map_filter(
        stored, lambda k, v: ~F.array_contains(F.map_keys(allowed), k)
    )
    return F.map_concat(rest, allowed)


def resolve_revisits(records: DataFrame, payload: tuple[str, ...] = ()) -> DataFrame:
    """Every record with ``url_key``, ``state``, ``source_id``, ``headers``, payload.

    ``payload`` names columns that a resolved revisit takes from its response; pass
    small ones (a digest, a place in a file) and fetch bodies by ``source_id``.  One
    that is called like a column of the result is returned as ``payload_`` and its name.
    """
    # Payload columns travel under names of their own, so theirs may be any.
    held = {p: f"payload_{i}" for i, p in enumerate(payload)}
    clean = records.select(
        "record_id",
        "kind",
        "date",
        F.coalesce(canonical_url("url"), F.lit(None)).alias("url_key"),
        _lower_names(F.col("headers")).alias("headers"),
        *(F.col(p).alias(name) for p, name in held.items()),
        F.when(F.col("kind") == "response", 1).otherwise(0).alias("turn"),
    )
    order = ["url_key", "date", "turn", "record_id"]
    dealt = stage(
        clean.repartitionByRange(*order).withColumn("range", F.spark_partition_id()),
        "records",
    )
    full = F.when(
        F.col("turn") == 1,
        F.struct(
            F.col("record_id").alias("id"), "date", "headers", *held.values()
        ),
    )
    within = (
        Window.partitionBy("range", "url_key")
        .orderBy("date", "turn", "record_id")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    seen = dealt.withColumn("own", F.last(full, ignorenulls=True).over(within))
    # Only a range's last URL can go on in the next: a row per range, summed up
    # before the shuffle.
    ends = dealt.groupBy("range").agg(F.max("url_key").alias("url_key"))
    latest = (
        dealt.where("turn = 1")
        .join(F.broadcast(ends), ["range", "url_key"])
        .groupBy("range", "url_key")
        .agg(F.max_by(full, F.struct("date", "record_id")).alias("found"))
    )
    # A URL's first row in a range looks to the ranges before: at most one row each.
    firsts = dealt.groupBy("range").agg(F.min("url_key").alias("url_key"))
    gaps = firsts.join(latest, ["range", "url_key"], "left").select(
        "range", "url_key", "found"
    )
    chain = gaps.union(latest.join(gaps, ["range", "url_key"], "left_anti"))
    handed = chain.withColumn(
        "before",
        F.last("found", ignorenulls=True).over(
            Window.partitionBy("url_key")
            .orderBy("range")
            .rowsBetween(Window.unboundedPreceding, -1)
        ),
    ).select("range", "url_key", "before")
    handed = stage(handed.where("before IS NOT NULL"), "handed")
    joined = seen.join(F.broadcast(handed), ["range", "url_key"], "left").withColumn(
        "source", F.coalesce("own", "before")
    )
    state = (
        F.when(F.col("turn") == 1, "full")
        .when(F.coalesce(F.col("kind") != "revisit", F.lit(True)), "other")
        .when(F.col("source").isNull() | F.col("url_key").isNull(), "orphan")
        .when(
            _tag("headers").isNotNull(),
            F.when(_tag("headers") == _tag("source.headers"), "resolved").otherwise(
                "mismatch"
            ),
        )
        .when(
            F.element_at("headers", F.lit("last-modified")).isNotNull(),
            F.when(
                F.element_at("headers", F.lit("last-modified"))
                == F.element_at("source.headers", F.lit("last-modified")),
                "resolved",
            ).otherwise("mismatch"),
        )
        .otherwise("unchecked")
    )
    marked = joined.withColumn("state", state)
    takes = F.col("state").isin("resolved", "unchecked")
    return marked.select(
        "record_id",
        "kind",
        "date",
        "url_key",
        "state",
        F.when(takes, F.col("source.id")).alias("source_id"),
        F.when(takes, merged_headers("source.headers", "headers"))
        .otherwise(F.col("headers"))
        .alias("headers"),
        *(
            F.when(takes, F.col(f"source.{name}"))
            .otherwise(F.col(name))
            .alias(f"payload_{p}" if p in RESULT else p)
            for p, name in held.items()
        ),
    )


def crawl_records(pages: DataFrame) -> DataFrame:
    """Records derived from the table of pages: per page a response and a later check.

    The page's number is its time; the check comes up to 400 steps later under another
    spelling of the URL, or earlier for every thirteenth page.  Most checks name the
    entity tag, some a stale one, some only a date, some nothing.
    """
    p = F.col("page_id")
    html = F.coalesce("html", F.lit(""))
    base = pages.select(
        p.alias("n"),
        "url",
        F.md5(html).alias("payload_md5"),
        F.length(html).cast("bigint").alias("payload_chars"),
    ).withColumn("tag", F.concat(F.lit('"'), F.col("payload_md5"), F.lit('"')))
    response = base.select(
        (F.col("n") * 2).alias("record_id"),
        F.lit("response").alias("kind"),
        "url",
        (F.col("n") * 60).alias("date"),
        F.create_map(
            F.lit("ETag"),
            F.col("tag"),
            F.lit("Last-Modified"),
            F.col("n").cast("string"),
            F.lit("Content-Length"),
            F.col("payload_chars").cast("string"),
            F.lit("Cache-Control"),
            F.lit("max-age=60"),
        ).alias("headers"),
        "payload_md5",
        "payload_chars",
    )
    n = F.col("n")
    empty = F.create_map().cast("map<string,string>")
    revisit = base.select(
        (n * 2 + 1).alias("record_id"),
        F.lit("revisit").alias("kind"),
        F.regexp_replace("url", "^http:", "HTTP:").alias("url"),
        F.when(n % 13 == 0, n * 60 - 1)
        .otherwise(n * 60 + (n * 37) % 400 + 1)
        .alias("date"),
        F.map_concat(
            F.create_map(F.lit("Content-Length"), F.lit("0")),
            F.create_map(F.lit("Cache-Control"), F.lit("max-age=90")),
            F.when(n % 11 == 0, empty)
            .when(n % 7 == 0, F.create_map(F.lit("etag"), F.lit('"stale"')))
            .when(
                n % 5 == 0, F.create_map(F.lit("last-modified"), n.cast("string"))
            )
            .otherwise(
                F.create_map(F.lit("etag"), F.concat(F.lit("W/"), F.col("tag")))
            ),
        ).alias("headers"),
        F.lit(None).cast("string").alias("payload_md5"),
        F.lit(None).cast("bigint").alias("payload_chars"),
    )
    return response.unionByName(revisit)


def op6_warc_revisits(spark, sf_dir: str) -> DataFrame:
    """Every record of the derived crawl, resolved; headers as sorted text."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = resolve_revisits(crawl_records(pages), ("payload_md5", "payload_chars"))
    text = F.array_join(
        F.array_sort(
            F.transform(
                F.map_entries("headers"),
                lambda e: F.concat(e["key"], F.lit(": "), e["value"]),
            )
        ),
        "; ",
    )
    return found.withColumn("headers", text)


OP6_SQL = r"""
WITH base AS (
  SELECT page_id AS n, url, md5(coalesce(html, '')) AS tag,
    length(coalesce(html, ''))::BIGINT AS chars FROM pages
), records AS (
  SELECT n * 2 AS record_id, 'response' AS kind, url, n * 60 AS date, n, tag, chars,
    1 AS turn
  FROM base
  UNION ALL
  SELECT n * 2 + 1, 'revisit', url,
    CASE WHEN n % 13 = 0 THEN n * 60 - 1 ELSE n * 60 + (n * 37) % 400 + 1 END,
    n, tag, chars, 0
  FROM base
), cut AS (
  SELECT *,
    regexp_replace(regexp_replace(lower(
      regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)),
      ':(80|443)$', ''), '^www\.', '') AS host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path,
    list_sort(list_filter(
      string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&'),
      lambda p: p <> '' AND NOT starts_with(p, 'utm_'))) AS params
  FROM records
), keyed AS (
  SELECT *, host || regexp_replace(path, '/+$', '') ||
    CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END
    AS url_key
  FROM cut
), found AS (
  SELECT *, last_value(CASE WHEN turn = 1 THEN n END IGNORE NULLS) OVER (
    PARTITION BY url_key ORDER BY date, turn, record_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m
  FROM keyed
), states AS (
  SELECT f.*, s.chars AS source_chars, s.tag AS source_tag,
    CASE WHEN turn = 1 THEN 'full' WHEN m IS NULL THEN 'orphan'
    WHEN f.n % 11 = 0 THEN 'unchecked' WHEN f.n % 7 = 0 THEN 'mismatch'
    WHEN f.n % 5 = 0 THEN CASE WHEN m = f.n THEN 'resolved' ELSE 'mismatch' END
    WHEN s.tag = f.tag THEN 'resolved' ELSE 'mismatch' END AS state,
    CASE WHEN f.n % 11 = 0 THEN NULL WHEN f.n % 7 = 0 THEN '"stale"'
    WHEN f.n % 5 = 0 THEN NULL ELSE 'W/"' || f.tag || '"' END AS check_tag,
    CASE WHEN f.n % 5 = 0 AND f.n % 7 <> 0 AND f.n % 11 <> 0 THEN f.n END AS check_date
  FROM found f LEFT JOIN base s ON s.n = f.m
)
SELECT record_id, kind, date, url_key, state,
  CASE WHEN state IN ('resolved', 'unchecked') THEN m * 2 END AS source_id,
  CASE WHEN turn = 1 THEN 'cache-control: max-age=60; content-length: ' || chars
      || '; etag: "' || tag || '"; last-modified: ' || n
    WHEN state IN ('resolved', 'unchecked') THEN
      'cache-control: max-age=90; content-length: ' || source_chars || '; etag: '
      || coalesce(check_tag, '"' || source_tag || '"')
      || '; last-modified: ' || coalesce(check_date, m)
    ELSE 'cache-control: max-age=90; content-length: 0'
      || coalesce('; etag: ' || check_tag, '')
      || coalesce('; last-modified: ' || check_date, '') END AS headers,
  CASE WHEN turn = 1 THEN tag WHEN state IN ('resolved', 'unchecked')
    THEN source_tag END AS payload_md5,
  CASE WHEN turn = 1 THEN chars WHEN state IN ('resolved', 'unchecked')
    THEN source_chars END AS payload_chars
FROM states
"""
