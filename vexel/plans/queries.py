"""The registered queries: every operator over the given tables, whole."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vexel.functions import tokens as tk
from vexel.functions import vectors as vec
from vexel.functions.text import require_text
from vexel.operators import chunking, report
from vexel.operators import search as srch
from vexel.operators.embedding import embed
from vexel.operators.encoding import encode_tokens
from vexel.operators.models import HashingModel
from vexel.operators.numbering import assign_offsets
from vexel.plans.ingest import document_chunks, ingest
from vexel.plans.semantic import search_documents
from vexel.plans.transfer import export_store, import_pair
from vexel.session import range_count, spread_if_narrow, work_dir
from vexel.sources.journal import read_journal, read_journal_lines, write_journal
from vexel.sources.packed import read_packed_vectors, write_packed_vectors
from vexel.sources.pair import pair_records, read_pair
from vexel.sources.store import Store, append_store, clear_store, read_store, write_rows
from vexel.sources.text_files import from_text_table, read_text_files

DIM = 64
MODEL = HashingModel(DIM)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The embeddings table as (pos, embedding, label)."""
    return table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "pos")


def scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of length 3, every seventh one zero: (vec_id, v)."""
    zero = F.col("vec_id") % 7 == 0
    factor = F.when(zero, F.lit(0.0)).otherwise(F.lit(3.0))
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.transform("embedding", lambda x: (x * factor).cast("float")).alias("v"),
    )


def long_form(df: DataFrame, key: str, col: str) -> DataFrame:
    """One row per vector element, rounded."""
    rows = df.select(key, F.posexplode(col).alias("dim", "x"))
    return rows.select(key, "dim", F.round(F.col("x").cast("double"), 6).alias("value"))


# Sources


def text_source(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    ragged = docs.withColumn(
        "text", F.concat(F.lit(" \n\t"), F.col("text"), F.lit("\r\n "))
    )
    turns = table(spark, sf_dir, "conversations")
    texts = from_text_table(ragged, "text", "doc_id").unionByName(
        from_text_table(
            turns.withColumn("doc_id", -1 - F.col("conv_id")), "text", "doc_id"
        )
    )
    return require_text(texts).select(
        "doc_id", "text", F.length("text").cast("bigint").alias("n_chars")
    )


def _benchmark_files(spark, sf_dir) -> DataFrame:
    """Every benchmark text written to a file of its own and read back."""
    folder = work_dir(spark, "files")
    items = table(spark, sf_dir, "benchmark")
    items.select("item_id", "text").write.partitionBy("item_id").text(folder)
    return read_text_files(spark, folder)


def file_source(spark, sf_dir):
    files = _benchmark_files(spark, sf_dir)
    return require_text(files).select(F.col("item_id").cast("bigint"), "text")


# Chunking


def chunk_delimiter(spark, sf_dir):
    return chunking.chunk_documents(table(spark, sf_dir, "documents"))


def chunk_fixed(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return chunking.chunk_documents(docs, chunking.chunk_fixed(1500))


def chunk_passthrough(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    whole = chunking.chunk_documents(docs, chunking.chunk_delimiter(""))
    sized = chunking.chunk_documents(docs, chunking.chunk_fixed(0))
    return whole.withColumn("chunker", F.lit("delimiter")).unionByName(
        sized.withColumn("chunker", F.lit("fixed"))
    )


def require_chunks(spark, sf_dir):
    """A custom chunker: lines of more than 40 characters; some texts have none."""
    docs = table(spark, sf_dir, "documents")

    def long_lines(texts: pa.Array) -> pa.ListArray:
        lines = pc.split_pattern(texts, "\n")
        return chunking.filter_lists(lines, pc.greater(pc.utf8_length(lines.flatten()), 40))

    return chunking.chunk_documents(docs, chunking.arrow_chunker(long_lines))


# Token encoding


def vocabulary(spark, sf_dir) -> DataFrame:
    """(token, id): every word of the documents, the most frequent first."""
    docs = spread_if_narrow(
        table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text"
    )
    words = docs.select(F.explode(tk.split_tokens("text")).alias("token"))
    counts = words.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    kept = work_dir(spark, "words")
    counts.write.parquet(kept)
    counts = spark.read.schema(counts.schema).parquet(kept)
    # About 30 bytes a word.
    ranges = range_count(spark, 30 * counts.count())
    order = [F.desc("n"), F.asc("token")]
    ordered = counts.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    return assign_offsets(ordered, 1).select("token", (F.col("pos") + 1000).alias("id"))


def _encoded_row(df: DataFrame, *key: str) -> DataFrame:
    return df.select(
        *key,
        F.array_join("input_ids", " ").alias("input_ids"),
        F.array_join("tokens", " ").alias("tokens"),
        F.array_join("attention_mask", " ").alias("attention_mask"),
        F.array_join("token_type_ids", " ").alias("token_type_ids"),
        F.col("n_tokens").cast("bigint").alias("n_tokens"),
        "length",
    )


def encode_tokens_query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = spread_if_narrow(docs, "doc_id", "text")
    coded = encode_tokens(docs, vocabulary(spark, sf_dir), key=["doc_id"])
    return _encoded_row(coded, "doc_id")


def truncate_pad_mask(spark, sf_dir):
    """Conversation turns, no special tokens, cut at 24 and padded to 16."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    coded = encode_tokens(
        turns,
        vocabulary(spark, sf_dir),
        key=["conv_id", "turn"],
        with_special=False,
        max_len=24,
        pad_to=16,
    )
    return _encoded_row(coded, "conv_id", "turn")


# Embedding


def hash_embed(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = embed(spread_if_narrow(docs, "doc_id", "text"), MODEL, "text")
    return long_form(out, "doc_id", "embedding")


def mean_pool(spark, sf_dir):
    """Each vector as 8 token rows of 8; the mask varies, every third is all 0."""
    emb = table(spark, sf_dir, "embeddings")
    hidden = F.transform(
        F.sequence(F.lit(0), F.lit(7)), lambda i: F.slice("embedding", i * 8 + 1, 8)
    )
    mask = F.transform(
        F.sequence(F.lit(0), F.lit(7)),
        lambda i: F.when(F.col("vec_id") % 3 == 0, F.lit(0)).otherwise(
            (F.col("vec_id") + i) % 2
        ),
    )
    pooled = emb.select("vec_id", vec.mean_pool(hidden, mask).alias("pooled"))
    return long_form(pooled, "vec_id", "pooled")


def mean_pool_rows(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings").withColumn("mask", F.col("vec_id") % 2)
    return long_form(vec.mean_pool_rows(emb, ["label"]), "label", "pooled")


# Vector functions


def vec_validate(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    ragged = emb.withColumn(
        "embedding",
        F.when(F.col("vec_id") % 5 == 0, F.slice("embedding", 1, DIM - 1))
        .when(F.col("vec_id") % 11 == 0, F.slice("embedding", 1, 0))
        .otherwise(F.col("embedding")),
    )
    good = vec.validate_vector(ragged, DIM, strict=False)
    return good.select("vec_id", F.size("embedding").cast("bigint").alias("n"))


def vec_dot(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    product = vec.dot("embedding", F.reverse("embedding"))
    return emb.select("vec_id", F.round(product, 6).alias("dot"))


def vec_magnitude(spark, sf_dir):
    rows = scaled(spark, sf_dir)
    return rows.select("vec_id", F.round(vec.magnitude("v"), 6).alias("magnitude"))


def vec_normalise(spark, sf_dir):
    rows = scaled(spark, sf_dir).select("vec_id", vec.normalise("v").alias("u"))
    return long_form(rows, "vec_id", "u")


def vec_cosine(spark, sf_dir):
    """Cosine of each vector with its own reverse, both normalised first."""
    unit = scaled(spark, sf_dir).select("vec_id", vec.normalise("v").alias("u"))
    score = vec.cosine_normed("u", F.reverse("u"))
    return unit.select("vec_id", F.round(score, 6).alias("cosine"))


# Search


def _first_vector(spark, sf_dir) -> list[float]:
    emb = table(spark, sf_dir, "embeddings")
    return emb.agg(F.min_by("embedding", "vec_id")).first()[0]


def _label_queries(spark, sf_dir) -> DataFrame:
    """(query_id, embedding): the lowest-numbered vector of each label."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.groupBy(F.col("label").cast("bigint").alias("query_id")).agg(
        F.min_by("embedding", "vec_id").alias("embedding")
    )


def _rounded(hits: DataFrame) -> DataFrame:
    hits = hits.withColumn("score", F.round("score", 6))
    return hits.withColumn("rank", F.col("rank").cast("bigint"))


def search_topk(spark, sf_dir):
    hits = srch.search_vector(vectors(spark, sf_dir), _first_vector(spark, sf_dir))
    return _rounded(hits).select("rank", "pos", "score")


def search_topk_padded(spark, sf_dir):
    """The label means as a store of 10 vectors, asked for 15 hits."""
    emb = table(spark, sf_dir, "embeddings").withColumn("mask", F.lit(1))
    means = vec.mean_pool_rows(emb, ["label"])
    store = means.select(
        F.col("label").cast("bigint").alias("pos"),
        F.col("pooled").cast("array<float>").alias("embedding"),
    )
    store = store.withColumn("text", F.concat(F.lit("label "), F.col("pos")))
    query = spark.createDataFrame(
        [(0, _first_vector(spark, sf_dir))], "query_id bigint, embedding array<float>"
    )
    hits = srch.attach_text(srch.search_batch(store, query, DIM, 15), store)
    padded = srch.pad_hits(hits, query, 15)
    return _rounded(padded).select("rank", "score", "text")


def search_batch(spark, sf_dir):
    queries = _label_queries(spark, sf_dir)
    hits = srch.search_batch(vectors(spark, sf_dir), queries, DIM)
    return _rounded(hits).select("query_id", "rank", "pos", "score")


def search_batch_blocks(spark, sf_dir):
    """The same in blocks of three queries, which share one pass over the store."""
    hits = srch.search_batch(
        vectors(spark, sf_dir),
        _label_queries(spark, sf_dir),
        DIM,
        max_query_bytes=3 * DIM * 4,
    )
    return _rounded(hits).select("query_id", "rank", "pos", "score")


def search_every_vector(spark, sf_dir):
    """Every vector of the table as a query against all of them."""
    store = vectors(spark, sf_dir)
    queries = store.select(F.col("pos").alias("query_id"), "embedding")
    return _rounded(srch.search_batch(store, queries, DIM)).select(
        "query_id", "rank", "pos", "score"
    )


def first_english_chunk(spark, sf_dir) -> str:
    docs = table(spark, sf_dir, "documents").filter(F.col("lang") == "en")
    text = docs.agg(F.min_by("text", "doc_id")).first()[0]
    return text.split(".")[0]


def semantic_search(spark, sf_dir):
    """Flagship: chunk, embed, normalise and search all documents."""
    hits = search_documents(
        table(spark, sf_dir, "documents"),
        first_english_chunk(spark, sf_dir),
        MODEL,
        score_digits=6,
    )
    return hits.withColumn("rank", F.col("rank").cast("bigint"))


def _document_store(spark, sf_dir) -> str:
    path = work_dir(spark, "store")
    ingest(table(spark, sf_dir, "documents"), path, MODEL)
    return path


def _language_queries(spark, sf_dir) -> DataFrame:
    """(query_id, query): first chunk of the first document of each language."""
    docs = table(spark, sf_dir, "documents")
    firsts = docs.groupBy("lang").agg(
        F.min("doc_id").alias("query_id"), F.min_by("text", "doc_id").alias("text")
    )
    return firsts.select("query_id", F.split("text", "\\.")[0].alias("query"))


def store_search(spark, sf_dir):
    """All documents ingested into a store, then searched for four texts."""
    store = Store(spark, _document_store(spark, sf_dir))
    hits = srch.search(store, _language_queries(spark, sf_dir), MODEL)
    places = store.rows(store.files_of(hits)).select("pos", "doc_id", "chunk_pos")
    return _rounded(hits.join(places, "pos")).select(
        "query_id", "rank", "score", "pos", "doc_id", "chunk_pos", "text"
    )


def file_search(spark, sf_dir):
    """Benchmark texts as files, ingested with another chunker, then searched.

    From files to hits in one query: read, trim, cut, embed, store, search.
    """
    files = _benchmark_files(spark, sf_dir)
    docs = files.select(F.col("item_id").cast("bigint").alias("doc_id"), "text")
    path = work_dir(spark, "store")
    ingest(docs, path, MODEL, chunking.chunk_fixed(80))
    queries = table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.substring("text", 1, 40).alias("query")
    )
    hits = srch.search(Store(spark, path), queries, MODEL, 3)
    return _rounded(hits).select("query_id", "rank", "score", "pos", "text")


# Store


def _stored_rows(spark, sf_dir) -> DataFrame:
    emb = table(spark, sf_dir, "embeddings")
    emb = emb.repartitionByRange("vec_id").sortWithinPartitions("vec_id")
    return emb.select(
        F.col("vec_id").alias("doc_id"),
        F.lit(0).alias("chunk_pos"),
        F.concat(F.lit("label "), F.col("label")).alias("text"),
        F.transform("embedding", lambda x: (x * 3.0).cast("float")).alias("embedding"),
    )


def _two_appends(spark, sf_dir) -> str:
    path = work_dir(spark, "store")
    for run in ("first", "second"):
        append_store(_stored_rows(spark, sf_dir), path, DIM, ingest_id=run)
    # Already published: must not store anything again.
    append_store(_stored_rows(spark, sf_dir), path, DIM, ingest_id="second")
    return path


def store_append(spark, sf_dir):
    store = read_store(spark, _two_appends(spark, sf_dir))
    elements = store.select(
        "pos", "ingest_id", "doc_id", "text", F.posexplode("embedding").alias("dim", "x")
    )
    value = F.round(F.col("x").cast("double"), 6).alias("value")
    return elements.select("pos", "ingest_id", "doc_id", "text", "dim", value)


def store_offsets(spark, sf_dir):
    return read_store(spark, _two_appends(spark, sf_dir)).select("pos", "offset")


def store_retry(spark, sf_dir):
    """An append that stopped before its record, tried again, and one after it.

    What it left does not count: no gap, no copy.
    """
    path = work_dir(spark, "store")
    rows = _stored_rows(spark, sf_dir)
    append_store(rows, path, DIM, ingest_id="first")
    write_rows(rows, f"{path}/append-stopped")
    append_store(rows, path, DIM, ingest_id="second")
    append_store(rows, path, DIM, ingest_id="second")
    append_store(rows, path, DIM, ingest_id="third")
    return read_store(spark, path).select("pos", "ingest_id", "doc_id", "text")


def store_clear(spark, sf_dir):
    """Cleared after two appends; one append later the positions start anew."""
    path = _two_appends(spark, sf_dir)
    before = read_store(spark, path)
    clear_store(spark, path)
    cleared = read_store(spark, path)
    append_store(_stored_rows(spark, sf_dir), path, DIM, ingest_id="third")
    steps = [("before", before), ("cleared", cleared), ("after", read_store(spark, path))]
    counts = [
        rows.agg(
            F.count(F.lit(1)).alias("n_rows"), F.max("offset").alias("last_offset")
        ).select(F.lit(name).alias("step"), "n_rows", "last_offset")
        for name, rows in steps
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def packed_roundtrip(spark, sf_dir):
    path = work_dir(spark, "packed")
    write_packed_vectors(vectors(spark, sf_dir), path, DIM)
    back = read_packed_vectors(spark, path, DIM, split_bytes=64 << 10)
    return long_form(back, "pos", "embedding")


def packed_append(spark, sf_dir):
    """A store exported, appended to and exported again, with a torn generation left.

    The second generation starts at the last offset of the first.
    """
    root = work_dir(spark, "pair")
    rows = _stored_rows(spark, sf_dir)
    half = rows.where(F.col("doc_id") % 2 == 0)
    append_store(half, f"{root}/store", DIM)
    export_store(spark, f"{root}/store", f"{root}/pair")
    torn = vectors(spark, sf_dir).select("pos", "embedding")
    write_packed_vectors(torn, f"{root}/pair/generation-torn", DIM)
    append_store(rows, f"{root}/store", DIM)
    export_store(spark, f"{root}/store", f"{root}/pair")
    pair = read_pair(spark, f"{root}/pair", DIM)
    start = F.when(F.col("offset") > _first_end(spark, f"{root}/pair"), 2).otherwise(1)
    elements = pair.select(
        "pos", "offset", "text", start.alias("generation"),
        F.posexplode("embedding").alias("dim", "x"),
    )
    value = F.round(F.col("x").cast("double"), 6).alias("value")
    return elements.select("pos", "offset", "text", "generation", "dim", value)


def _first_end(spark, path: str) -> int:
    first = pair_records(spark, path)[0]
    return first["rows"] * DIM * 4


def journal_roundtrip(spark, sf_dir):
    """Document texts journalled, then attached by position, line by line."""
    path = work_dir(spark, "journal")
    docs = table(spark, sf_dir, "documents")
    offset = (F.col("doc_id") + 1) * (DIM * 4)
    write_journal(docs.select(offset.alias("offset"), "text"), path)
    journal = read_journal(spark, path, DIM)
    wanted = spark.range(docs.count()).select(F.col("id").alias("pos"))
    return srch.attach_text(wanted, journal).select("pos", "text")


def journal_lines(spark, sf_dir):
    """Line i belongs to vector i: with broken, blank and repeated lines."""
    path = work_dir(spark, "journal")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    entry = F.to_json(
        F.struct(
            F.when(F.col("doc_id") % 3 > 0, F.lit(64)).alias("Offset"),
            F.col("text").alias("Text"),
        )
    )
    line = (
        F.when(F.col("doc_id") % 7 == 3, F.lit("{broken"))
        .when(F.col("doc_id") % 11 == 5, F.lit(""))
        .otherwise(entry)
    )
    lines = docs.select("doc_id", line.alias("line"))
    ordered = lines.repartitionByRange(5, "doc_id").sortWithinPartitions("doc_id")
    ordered.select("line").write.text(path)
    return read_journal_lines(spark, path).select("pos", "offset", "text")


def store_transfer(spark, sf_dir):
    """A store exported to packed vectors and a journal, and imported again."""
    root = work_dir(spark, "transfer")
    append_store(_stored_rows(spark, sf_dir), f"{root}/store", DIM)
    export_store(spark, f"{root}/store", f"{root}/pair")
    import_pair(spark, f"{root}/pair", f"{root}/copy", DIM)
    copy = read_store(spark, f"{root}/copy").select(
        "pos", "offset", "text", F.posexplode("embedding").alias("dim", "x")
    )
    value = F.round(F.col("x").cast("double"), 6).alias("value")
    return copy.select("pos", "offset", "text", "dim", value)


# Reports


def ingest_report(spark, sf_dir):
    chunks = document_chunks(table(spark, sf_dir, "documents"))
    per_doc = report.ingest_report(chunks, MODEL.dim, "doc_id")
    return per_doc.select(
        "doc_id",
        "n_chunks",
        F.col("min_len").cast("bigint").alias("min_len"),
        F.col("max_len").cast("bigint").alias("max_len"),
    )


def ingest_lines(spark, sf_dir):
    chunks = document_chunks(table(spark, sf_dir, "documents"))
    return chunks.select("doc_id", report.chunk_lines(MODEL.dim).alias("line"))


def search_report(spark, sf_dir):
    """Hits per text query, over the embeddings table as the store."""
    queries = _language_queries(spark, sf_dir)
    store = vectors(spark, sf_dir)
    hits = srch.search_batch(store, srch.embed_queries(queries, MODEL), DIM)
    return report.search_report(hits, queries)


def render_hits(spark, sf_dir):
    hits = srch.search_vector(vectors(spark, sf_dir), _first_vector(spark, sf_dir))
    return report.render_hits(hits).select("pos", "line")


def all_queries() -> dict:
    named = [
        text_source,
        file_source,
        chunk_delimiter,
        chunk_fixed,
        chunk_passthrough,
        require_chunks,
        truncate_pad_mask,
        hash_embed,
        mean_pool,
        mean_pool_rows,
        vec_validate,
        vec_dot,
        vec_magnitude,
        vec_normalise,
        vec_cosine,
        search_topk,
        search_topk_padded,
        search_batch,
        search_batch_blocks,
        search_every_vector,
        semantic_search,
        store_search,
        file_search,
        store_append,
        store_offsets,
        store_retry,
        store_clear,
        packed_roundtrip,
        packed_append,
        journal_roundtrip,
        journal_lines,
        store_transfer,
        ingest_report,
        ingest_lines,
        search_report,
        render_hits,
    ]
    return {"encode_tokens": encode_tokens_query} | {q.__name__: q for q in named}
