"""The registered queries again, as plain SQL over the same tables."""

from __future__ import annotations

_LONG_ZERO = "+ 0.0::DOUBLE"

_SCALED = """
scaled AS (
  SELECT vec_id,
         list_transform(embedding, lambda x: (x * CASE WHEN vec_id % 7 = 0
           THEN 0.0::DOUBLE ELSE 3.0::DOUBLE END)::FLOAT) AS v
  FROM embeddings
), sized AS (
  SELECT vec_id, v,
         sqrt(list_dot_product(v::DOUBLE[], v::DOUBLE[])) AS mag
  FROM scaled
), unit AS (
  SELECT vec_id, mag,
         CASE WHEN mag = 0 THEN v
              ELSE list_transform(v, lambda x: (x::DOUBLE / mag)::FLOAT) END AS u
  FROM sized
)"""

# Vocabulary, and one row per token with its id.
_VOCAB = r"""
vocab AS (
  SELECT token, (999 + row_number() OVER (ORDER BY n DESC, token))::BIGINT AS id
  FROM (
    SELECT token, count(*) AS n
    FROM (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS token
          FROM documents)
    GROUP BY token
  )
)"""


def _encoded(source: str, key: str, special: bool, max_len: int, pad_to: int) -> str:
    body = max_len - (2 if special else 0)
    keys = [k.strip() for k in key.split(",")]
    joined = " AND ".join(f"b.{k} = i.{k}" for k in keys)
    cls_ids, sep_ids = ("[101]::BIGINT[]", "[102]::BIGINT[]") if special else (
        "[]::BIGINT[]", "[]::BIGINT[]")
    cls_tok, sep_tok = ("['[CLS]']", "['[SEP]']") if special else (
        "[]::VARCHAR[]", "[]::VARCHAR[]")
    return rf"""
WITH {_VOCAB}, bodies AS (
  SELECT {key},
         regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+')[1:{body}] AS body
  FROM {source}
), tok AS (
  SELECT {key}, unnest(body) AS token, generate_subscripts(body, 1) AS ix FROM bodies
), ided AS (
  SELECT {key}, list(coalesce(id, 100) ORDER BY ix) AS ids,
         list(CASE WHEN id IS NULL THEN '[UNK]' ELSE token END ORDER BY ix) AS toks
  FROM tok LEFT JOIN vocab USING (token) GROUP BY {key}
), real AS (
  SELECT {", ".join("b." + k for k in keys)},
         {cls_ids} || coalesce(i.ids, []::BIGINT[]) || {sep_ids} AS ids,
         {cls_tok} || coalesce(i.toks, []::VARCHAR[]) || {sep_tok} AS toks
  FROM bodies b LEFT JOIN ided i ON {joined}
), sized AS (
  SELECT *, len(ids) AS n, greatest(len(ids), {pad_to}) AS w FROM real
)
SELECT {key},
       array_to_string(ids || list_transform(range(w - n), lambda x: 0::BIGINT), ' ')
         AS input_ids,
       array_to_string(toks || list_transform(range(w - n), lambda x: '[PAD]'), ' ')
         AS tokens,
       array_to_string(list_transform(range(w),
         lambda x: CASE WHEN x < n THEN 1 ELSE 0 END), ' ') AS attention_mask,
       array_to_string(list_transform(range(w), lambda x: 0), ' ') AS token_type_ids,
       n::BIGINT AS n_tokens, w::BIGINT AS length
FROM sized"""


# Dense 64-element vector of each distinct text of a relation ``texts(text)``.
_HASHED = r"""
tok AS (
  SELECT text, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS t
  FROM texts
), sparse AS (
  SELECT text, (('0x' || substr(md5(t), 1, 8))::BIGINT % 64) AS dim,
         sum(CASE WHEN ('0x' || substr(md5(t), 9, 1))::BIGINT % 2 = 0
             THEN 1 ELSE -1 END) AS s
  FROM tok GROUP BY ALL
), grid AS (
  SELECT text, d.dim, coalesce(sparse.s, 0)::DOUBLE AS s
  FROM texts CROSS JOIN (SELECT range AS dim FROM range(64)) d
  LEFT JOIN sparse USING (text, dim)
), raw AS (
  SELECT text, list(s ORDER BY dim) AS v FROM grid GROUP BY text
), mags AS (
  SELECT text, v, sqrt(list_dot_product(v, v)) AS mag FROM raw
), unit AS (
  SELECT text, CASE WHEN mag = 0 THEN v
    ELSE list_transform(v, lambda x: (x / mag)::FLOAT::DOUBLE) END AS u
  FROM mags
)"""

_CHUNKS = """
lists AS (
  SELECT doc_id, string_split(text, '.') AS chunks FROM documents WHERE text <> ''
), chunks AS (
  SELECT doc_id, unnest(chunks) AS chunk,
         generate_subscripts(chunks, 1) - 1 AS pos
  FROM lists
)"""

# Every element of the vectors that the store queries append, with its position.
_STORED = f"""
sources AS (
  SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS pos, 'label ' || label AS text,
         list_transform(embedding, lambda x: (x * 3.0::DOUBLE)::FLOAT::DOUBLE) AS v
  FROM embeddings
), stored AS (
  SELECT vec_id, pos, text, (unnest(range(64)))::INTEGER AS dim,
         round((unnest(v) / sqrt(list_dot_product(v, v)))::FLOAT::DOUBLE, 6) {_LONG_ZERO}
           AS value
  FROM sources
)"""

_FIRSTS = """
firsts AS (
  SELECT label::BIGINT AS query_id, min_by(embedding, vec_id) AS q
  FROM embeddings GROUP BY label
)"""

_BATCH = f"""
WITH {_FIRSTS}, scored AS (
  SELECT query_id, vec_id AS pos,
         list_dot_product(embedding::DOUBLE[], q::DOUBLE[]) AS score
  FROM embeddings, firsts
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, pos) AS rank
  FROM scored
)
SELECT query_id, rank::BIGINT AS rank, pos, round(score, 6) {_LONG_ZERO} AS score
FROM ranked WHERE rank <= 10"""

_FIRST_SCORES = """
scored AS (
  SELECT vec_id AS pos,
         list_dot_product(embedding::DOUBLE[],
           (SELECT min_by(embedding, vec_id) FROM embeddings)::DOUBLE[]) AS score
  FROM embeddings
)"""

ORACLES = {
    "text_source": r"""
SELECT doc_id, text, length(text)::BIGINT AS n_chars
FROM (
  SELECT doc_id, regexp_replace(text, '^\s+|\s+$', '', 'g') AS text FROM (
    SELECT doc_id, ' ' || chr(10) || chr(9) || text || chr(13) || chr(10) || ' ' AS text
    FROM documents
    UNION ALL SELECT -1 - conv_id, text FROM conversations)
) WHERE text <> ''""",
    "file_source": r"""
SELECT item_id, regexp_replace(text, '^\s+|\s+$', '', 'g') AS text FROM benchmark
WHERE regexp_replace(text, '^\s+|\s+$', '', 'g') <> ''""",
    "chunk_delimiter": f"""
WITH {_CHUNKS} SELECT doc_id, pos::INTEGER AS pos, chunk FROM chunks""",
    "chunk_fixed": """
SELECT doc_id, i::INTEGER AS pos, substr(text, i * 1500 + 1, 1500) AS chunk
FROM (SELECT doc_id, text,
             unnest(range((length(text) + 1499) // 1500)) AS i FROM documents)""",
    "chunk_passthrough": """
SELECT doc_id, 0::INTEGER AS pos, text AS chunk, chunker
FROM documents, (VALUES ('delimiter'), ('fixed')) t(chunker)""",
    "require_chunks": """
SELECT doc_id, unnest(lines) AS chunk,
       (generate_subscripts(lines, 1) - 1)::INTEGER AS pos
FROM (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: length(x) > 40)
        AS lines FROM documents)
WHERE len(lines) > 0""",
    "encode_tokens": _encoded("documents", "doc_id", True, 384, 128),
    "truncate_pad_mask": _encoded("conversations", "conv_id, turn", False, 24, 16),
    "hash_embed": f"""
WITH texts AS (SELECT DISTINCT text FROM documents), {_HASHED}
SELECT doc_id, (unnest(range(64)))::INTEGER AS dim,
       round(unnest(v), 6) {_LONG_ZERO} AS value
FROM documents JOIN raw USING (text)""",
    "mean_pool": f"""
WITH rows AS (
  SELECT vec_id, i, j,
         embedding[i * 8 + j + 1]::DOUBLE AS x,
         CASE WHEN vec_id % 3 = 0 THEN 0 ELSE (vec_id + i) % 2 END AS mask
  FROM embeddings, (SELECT range AS i FROM range(8)), (SELECT range AS j FROM range(8))
)
SELECT vec_id, j::INTEGER AS dim,
       round((avg(x) FILTER (mask = 1))::FLOAT::DOUBLE, 6) {_LONG_ZERO} AS value
FROM rows GROUP BY vec_id, j""",
    "mean_pool_rows": f"""
WITH rows AS (
  SELECT label, vec_id % 2 AS mask, unnest(embedding)::DOUBLE AS x,
         generate_subscripts(embedding, 1) - 1 AS dim
  FROM embeddings
)
SELECT label, dim::INTEGER AS dim,
       round(avg(x) FILTER (mask = 1), 6) {_LONG_ZERO} AS value
FROM rows GROUP BY label, dim""",
    "vec_validate": """
SELECT vec_id, 64::BIGINT AS n FROM embeddings
WHERE vec_id % 5 <> 0 AND vec_id % 11 <> 0 AND len(embedding) = 64""",
    "vec_dot": f"""
SELECT vec_id, round(list_dot_product(embedding::DOUBLE[],
         list_reverse(embedding)::DOUBLE[]), 6) {_LONG_ZERO} AS dot
FROM embeddings""",
    "vec_magnitude": f"""
WITH {_SCALED} SELECT vec_id, round(mag, 6) AS magnitude FROM unit""",
    "vec_normalise": f"""
WITH {_SCALED}
SELECT vec_id, (unnest(range(64)))::INTEGER AS dim,
       round(unnest(u)::DOUBLE, 6) {_LONG_ZERO} AS value
FROM unit""",
    "vec_cosine": f"""
WITH {_SCALED}
SELECT vec_id, round(list_dot_product(u::DOUBLE[], list_reverse(u)::DOUBLE[]), 6)
         {_LONG_ZERO} AS cosine
FROM unit""",
    "search_topk": f"""
WITH {_FIRST_SCORES}
SELECT row_number() OVER (ORDER BY score DESC, pos)::BIGINT AS rank, pos,
       round(score, 6) {_LONG_ZERO} AS score
FROM scored ORDER BY score DESC, pos LIMIT 10""",
    "search_topk_padded": f"""
WITH long AS (
  SELECT label, unnest(embedding)::DOUBLE AS x,
         generate_subscripts(embedding, 1) AS dim
  FROM embeddings
), means AS (
  SELECT label, dim, avg(x)::FLOAT::DOUBLE AS x FROM long GROUP BY label, dim
), query AS (
  SELECT unnest(q)::DOUBLE AS y, generate_subscripts(q, 1) AS dim
  FROM (SELECT min_by(embedding, vec_id) AS q FROM embeddings)
), scored AS (
  SELECT label, sum(x * y) AS score FROM means JOIN query USING (dim) GROUP BY label
), ranked AS (
  SELECT label, score, row_number() OVER (ORDER BY score DESC, label) AS rank
  FROM scored
)
SELECT rank::BIGINT AS rank, round(coalesce(score, 0), 6) {_LONG_ZERO} AS score,
       coalesce('label ' || label, '') AS text
FROM (SELECT range AS rank FROM range(1, 16)) LEFT JOIN ranked USING (rank)""",
    "search_every_vector": f"""
WITH scored AS (
  SELECT a.vec_id AS query_id, b.vec_id AS pos,
         list_dot_product(b.embedding::DOUBLE[], a.embedding::DOUBLE[]) AS score
  FROM embeddings a, embeddings b
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, pos) AS rank
  FROM scored
)
SELECT query_id, rank::BIGINT AS rank, pos, round(score, 6) {_LONG_ZERO} AS score
FROM ranked WHERE rank <= 10""",
    "search_batch": _BATCH,
    "search_batch_blocks": _BATCH,
    "semantic_search": f"""
WITH {_CHUNKS}, query AS (
  SELECT string_split(min_by(text, doc_id), '.')[1] AS text
  FROM documents WHERE lang = 'en'
), texts AS (
  SELECT chunk AS text FROM chunks UNION SELECT text FROM query
), {_HASHED}, scored AS (
  SELECT doc_id, pos, chunk,
         round(list_dot_product(u, (SELECT u FROM unit JOIN query USING (text))), 6)
           {_LONG_ZERO} AS score
  FROM chunks JOIN unit ON chunk = unit.text
)
SELECT row_number() OVER (ORDER BY score DESC, doc_id, pos)::BIGINT AS rank,
       score, doc_id, pos::INTEGER AS pos, chunk
FROM scored ORDER BY score DESC, doc_id, pos LIMIT 10""",
    "store_search": f"""
WITH {_CHUNKS}, queries AS (
  SELECT min(doc_id) AS query_id, trim(string_split(min_by(text, doc_id), '.')[1]) AS text
  FROM documents GROUP BY lang
), texts AS (
  SELECT chunk AS text FROM chunks UNION SELECT text FROM queries
), {_HASHED}, query_vectors AS (
  SELECT query_id, u AS q FROM queries JOIN unit USING (text)
), scored AS (
  SELECT query_id, doc_id, pos, chunk, list_dot_product(u, q) AS score
  FROM chunks JOIN unit ON chunk = unit.text CROSS JOIN query_vectors
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id, pos)
              AS rank
  FROM scored
), stored AS (
  SELECT doc_id, pos AS chunk_pos, row_number() OVER (ORDER BY doc_id, pos) - 1 AS pos
  FROM chunks
)
SELECT query_id, rank::BIGINT AS rank, round(score, 6) {_LONG_ZERO} AS score,
       s.pos::BIGINT AS pos, r.doc_id, s.chunk_pos::INTEGER AS chunk_pos, chunk AS text
FROM ranked r JOIN stored s ON r.doc_id = s.doc_id AND r.pos = s.chunk_pos
WHERE rank <= 10""",
    "file_search": f"""
WITH items AS (
  SELECT item_id, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS text FROM benchmark
), chunks AS (
  SELECT item_id, i, substr(text, i * 80 + 1, 80) AS chunk
  FROM (SELECT item_id, text, unnest(range((length(text) + 79) // 80)) AS i FROM items)
), stored AS (
  SELECT chunk, row_number() OVER (ORDER BY item_id, i) - 1 AS pos FROM chunks
), queries AS (
  SELECT item_id AS query_id, substr(text, 1, 40) AS text FROM benchmark
), texts AS (
  SELECT chunk AS text FROM chunks UNION SELECT text FROM queries
), {_HASHED}, query_vectors AS (
  SELECT query_id, u AS q FROM queries JOIN unit USING (text)
), ranked AS (
  SELECT query_id, pos, chunk, list_dot_product(u, q) AS score,
         row_number() OVER (PARTITION BY query_id
           ORDER BY list_dot_product(u, q) DESC, pos) AS rank
  FROM stored JOIN unit ON chunk = unit.text CROSS JOIN query_vectors
)
SELECT query_id, rank::BIGINT AS rank, round(score, 6) {_LONG_ZERO} AS score,
       pos::BIGINT AS pos, chunk AS text
FROM ranked WHERE rank <= 3""",
    "store_append": f"""
WITH {_STORED}
SELECT pos + turn * (SELECT count(*) FROM embeddings) AS pos, ingest_id,
       vec_id AS doc_id, text, dim, value
FROM stored, (VALUES ('first', 0), ('second', 1)) t(ingest_id, turn)""",
    "store_offsets": """
SELECT range AS pos, (range + 1) * 256 AS "offset"
FROM range((SELECT 2 * count(*) FROM embeddings))""",
    "store_retry": """
SELECT row_number() OVER (PARTITION BY turn ORDER BY vec_id) - 1 + turn * (SELECT count(*) FROM embeddings)
         AS pos, ingest_id, vec_id AS doc_id, 'label ' || label AS text
FROM embeddings, (VALUES ('first', 0), ('second', 1), ('third', 2)) t(ingest_id, turn)
""",
    "store_clear": """
SELECT 'before' AS step, 2 * count(*) AS n_rows, 2 * count(*) * 256 AS last_offset
FROM embeddings
UNION ALL SELECT 'cleared', 0, NULL
UNION ALL SELECT 'after', count(*), count(*) * 256 FROM embeddings""",
    "packed_roundtrip": f"""
SELECT pos, (unnest(range(64)))::INTEGER AS dim,
       round(unnest(embedding)::DOUBLE, 6) {_LONG_ZERO} AS value
FROM (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS pos, embedding
      FROM embeddings)""",
    "packed_append": f"""
WITH {_STORED}, halves AS (
  SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS pos
  FROM embeddings WHERE vec_id % 2 = 0
), first AS (SELECT count(*) AS n FROM halves)
SELECT h.pos, (h.pos + 1) * 256 AS "offset", s.text, 1 AS generation, s.dim, s.value
FROM halves h JOIN stored s USING (vec_id)
UNION ALL
SELECT pos + n, (pos + n + 1) * 256, text, 2, dim, value FROM stored, first""",
    "journal_roundtrip": """
SELECT doc_id AS pos, coalesce(text, '') AS text FROM documents""",
    "journal_lines": """
SELECT row_number() OVER (ORDER BY doc_id) - 1 AS pos,
       CASE WHEN doc_id % 7 <> 3 AND doc_id % 11 <> 5 AND doc_id % 3 > 0
            THEN 64::BIGINT END AS "offset",
       CASE WHEN doc_id % 7 = 3 OR doc_id % 11 = 5 THEN '' ELSE coalesce(text, '') END
         AS text
FROM documents""",
    "store_transfer": f"""
WITH {_STORED}
SELECT pos, (pos + 1) * 256 AS "offset", text, dim, value FROM stored""",
    "ingest_report": """
SELECT doc_id, len(string_split(text, '.'))::BIGINT AS n_chunks,
       64::BIGINT AS min_len, 64::BIGINT AS max_len
FROM documents""",
    "ingest_lines": f"""
WITH {_CHUNKS}
SELECT doc_id, 'Chunk ' || (pos + 1) || ' embedding length: 64' AS line FROM chunks""",
    "search_report": r"""
SELECT min(doc_id) AS query_id, 10::BIGINT AS n_hits,
       'Retrieved 10 results for query "' || replace(replace(replace(
         string_split(min_by(text, doc_id), '.')[1],
         '\', '\\'), '"', '\"'), chr(10), '\n') || '"' AS line
FROM documents GROUP BY lang""",
    "render_hits": f"""
WITH {_FIRST_SCORES}
SELECT pos, printf('%d) cos=%.4f',
         row_number() OVER (ORDER BY score DESC, pos), score) AS line
FROM scored ORDER BY score DESC, pos LIMIT 10""",
}
