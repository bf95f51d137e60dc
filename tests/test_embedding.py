import hashlib
import os
import re
import struct
import sys
import unicodedata

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.errors import PySparkException

from tests.conftest import plan_of
from vexel.functions import tokens as tk
from vexel.operators import embedding, encoding
from vexel.operators.embedding import embed, embed_score
from vexel.operators.encoding import SpecialTokens, encode_tokens
from vexel.operators.models import (
    ConstantModel,
    EmbeddingModel,
    HashingModel,
    OnnxModel,
    masked_mean,
)
from vexel.operators.report import chunk_lines, ingest_report
from vexel.operators.search import unit_vector
from vexel.plans.ingest import document_chunks, embedded_chunks, ingest
from vexel.plans.semantic import search_documents
from vexel.sources.store import read_store
from vexel.streaming.ingest import ingest_new_files


# The models below are defined here, where workers cannot import from.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def hashed(text, dim):
    """The model's definition, one token at a time."""
    v = [0.0] * dim
    kept = (c if unicodedata.category(c)[0] in "LN" else " " for c in text.lower())
    for token in "".join(kept).split():
        digest = hashlib.md5(token.encode()).hexdigest()
        v[int(digest[:8], 16) % dim] += 1 if int(digest[8], 16) % 2 == 0 else -1
    return v


TEXTS = ["Hello, hello world", "", " .,_ ", "a_b c", "Grüße 12½ ÉTÉ", "x" * 5000, "a\nb\ta"]


def texts_df(spark, texts=TEXTS):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, chunk string")


@pytest.mark.parametrize("dim", [1, 7, 64])
def test_hashing_model(spark, dim):
    out = embed(texts_df(spark), HashingModel(dim)).orderBy("doc_id").collect()
    assert [r.embedding for r in out] == [hashed(t, dim) for t in TEXTS]
    unit = embed(texts_df(spark), HashingModel(dim), unit=True).collect()
    for r in unit:
        assert np.linalg.norm(r.embedding) == pytest.approx(
            1 if any(hashed(r.chunk, dim)) else 0, abs=1e-6
        )


def test_null_text_embeds_like_empty(spark):
    out = embed(texts_df(spark, [None, "a"]), HashingModel(4)).orderBy("doc_id").collect()
    assert out[0].embedding == [0] * 4


class Odd(EmbeddingModel):
    """Returns the wrong length."""

    dim = 3

    def make_predict_fn(self):
        return lambda texts: np.zeros((len(texts), 2), np.float32)


class Counting(EmbeddingModel):
    """Fails if a batch repeats a text or is larger than asked for."""

    dim = 1
    batch_size = 3

    def make_predict_fn(self):
        def predict(texts):
            assert len(set(texts)) == len(texts) <= 3
            return np.array([[float(t)] for t in texts], np.float32)

        return predict


def test_model_of_wrong_length(spark):
    with pytest.raises(PySparkException, match="of length 3"):
        embed(texts_df(spark), Odd()).collect()


def test_distinct_texts_in_small_batches(spark):
    df = texts_df(spark, [str(i % 10) for i in range(100)]).coalesce(1)
    got = embed(df, Counting()).collect()
    assert all(r.embedding == [float(r.chunk)] for r in got)


def test_score_equals_embed_then_dot(spark):
    model = HashingModel(16)
    query = unit_vector(model, "hello a c")
    scored = embed_score(texts_df(spark), model, query).orderBy("doc_id").collect()
    vectors = embed(texts_df(spark), model, unit=True).orderBy("doc_id").collect()
    want = [sum(a * b for a, b in zip(r.embedding, query)) for r in vectors]
    assert [r.score for r in scored] == want


def test_model_runs_once(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = plan_of(search_documents(docs, "the of", HashingModel(8)))
    assert plan.count("ArrowEvalPython") == 1
    assert "TakeOrderedAndProject" in plan
    kept = embedded_chunks(docs, HashingModel(8)).filter("size(embedding) = 8")
    assert plan_of(kept).count("ArrowEvalPython") == 1
    assert "ArrowEvalPython" not in plan_of(embedded_chunks(docs, HashingModel(8)).select("pos"))


def test_search_documents(spark):
    docs = spark.createDataFrame(
        [(1, " red fish. blue fish."), (2, "green bird"), (3, " ")], "doc_id bigint, text string"
    )
    hits = search_documents(docs, " blue FISH\n", HashingModel(64), 2).collect()
    assert [(h.rank, h.doc_id, h.pos, h.chunk) for h in hits][0] == (1, 1, 1, " blue fish")
    assert hits[0].score == pytest.approx(1, abs=1e-6)
    with pytest.raises(ValueError, match="query cannot be empty"):
        search_documents(docs, " 　", HashingModel(64))


def test_ingest(spark, tmp_path):
    docs = spark.createDataFrame(
        [(1, " a.b. "), (2, ""), (3, "c")], "doc_id bigint, text string"
    )
    path = str(tmp_path / "store")
    result = ingest(docs, path, HashingModel(8), ingest_id="one")
    assert (result.appended, result.n_chunks, result.min_len, result.max_len) == (True, 4, 8, 8)
    lines = result.lines("f.txt")
    assert lines[0] == "Source file: f.txt"
    assert re.fullmatch(r"Embedded 4 chunks in \d+\.\d{3}s", lines[1])
    assert re.fullmatch(r"Stored 4 chunks in \d+\.\d{3}s", lines[2])
    assert result.embed_seconds > 0 and result.store_seconds > 0
    again = ingest(docs, path, HashingModel(8), ingest_id="one")
    assert (again.appended, again.n_chunks) == (False, 0)
    got = read_store(spark, path).orderBy("doc_id", "chunk_pos").collect()
    assert [(r.doc_id, r.chunk_pos, r.text) for r in got] == [
        (1, 0, "a"),
        (1, 1, "b"),
        (1, 2, ""),
        (3, 0, "c"),
    ]
    assert [r.pos for r in got] == [0, 1, 2, 3]


def test_stream_ingests_each_file_once(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    (landing / "a.txt").write_text("one. two")
    store, state = str(tmp_path / "store"), str(tmp_path / "state")

    def run():
        query = ingest_new_files(
            spark, str(landing), store, HashingModel(8), state, stream_id="s"
        )
        query.awaitTermination(120)
        rows = read_store(spark, store).orderBy("pos").collect()
        return [(r.pos, r.text) for r in rows]

    assert run() == [(0, "one"), (1, " two")]
    assert run() == [(0, "one"), (1, " two")]
    (landing / "b.txt").write_text("three")
    assert run() == [(0, "one"), (1, " two"), (2, "three")]


def test_masked_mean():
    hidden = np.arange(12, dtype=np.float32).reshape(1, 4, 3) + 1
    assert masked_mean(hidden, np.array([[1, 1, 0, 0]])).tolist() == [[2.5, 3.5, 4.5]]
    assert np.isnan(masked_mean(hidden, np.zeros((1, 4), np.int64))).all()


# Token encoding


def vocab_df(spark):
    words = ["[PAD]", "[UNK]", "[CLS]", "[SEP]", "the", "cat", "sat", "é"]
    return spark.createDataFrame([(w, i) for i, w in enumerate(words)], "token string, id int")


SPECIAL = SpecialTokens(unk=1, cls=2, sep=3)
SENTENCES = ["The cat sat", "", "The É dog, the the!", "cat " * 20, None]


def sentences(spark):
    rows = [(i if i else None, t) for i, t in enumerate(SENTENCES)]
    return spark.createDataFrame(rows, "k int, text string")


def encoded(spark, **options):
    df = encode_tokens(sentences(spark), vocab_df(spark), key=["k"], special=SPECIAL, **options)
    return df.orderBy("k").collect()


def test_encode(spark):
    rows = encoded(spark, max_len=8, pad_to=6)
    assert rows[0].input_ids == [2, 4, 5, 6, 3, 0]
    assert rows[0].tokens == ["[CLS]", "the", "cat", "sat", "[SEP]", "[PAD]"]
    assert rows[0].attention_mask == [1, 1, 1, 1, 1, 0]
    assert rows[0].token_type_ids == [0] * 6
    assert (rows[0].n_tokens, rows[0].length) == (5, 6)
    assert rows[1].input_ids == [2, 3, 0, 0, 0, 0] == rows[4].input_ids
    assert rows[2].tokens == ["[CLS]", "the", "é", "[UNK]", "the", "the", "[SEP]"]
    assert rows[2].input_ids == [2, 4, 7, 1, 4, 4, 3]
    # Cut to 8, longer than the padding, in one job with short rows.
    assert rows[3].input_ids == [2, 5, 5, 5, 5, 5, 5, 3]


def test_encode_without_special_tokens(spark):
    rows = encoded(spark, max_len=3, pad_to=2, with_special=False)
    assert [r.input_ids for r in rows] == [[4, 5, 6], [0, 0], [4, 7, 1], [5, 5, 5], [0, 0]]
    with pytest.raises(ValueError):
        encoded(spark, max_len=1)


def test_keys_may_repeat_and_have_any_name(spark):
    rows = [(7, "the cat"), (7, "the cat"), (None, "sat"), (None, None)]
    df = spark.createDataFrame(rows, "id int, text string")
    vocab = vocab_df(spark).union(vocab_df(spark).selectExpr("token", "id + 50 as id"))
    out = encode_tokens(
        df, vocab, key=["id"], special=SPECIAL, with_special=False, max_len=4, pad_to=2
    )
    got = sorted(((r.id or 0), r.input_ids) for r in out.collect())
    assert got == [(0, [0, 0]), (0, [6, 0]), (7, [4, 5]), (7, [4, 5])]


@pytest.mark.parametrize("share", [1, 1_000_000])
def test_frequent_tokens_get_the_same_ids(spark, monkeypatch, share):
    """Whether all, some or no tokens count as frequent."""
    words = [f"w{i}" for i in range(60)] + ["the"] * 60
    rows = [(i, " ".join(words[(i * 7 + j) % 120] for j in range(30)) + " the") for i in range(400)]
    df = spark.createDataFrame(rows, "k int, text string").repartition(3)
    vocab = spark.createDataFrame(
        [(f"w{i}", 1_000 + i) for i in range(0, 60, 2)] + [("the", 5)], "token string, id bigint"
    )
    monkeypatch.setattr(encoding, "SAMPLED", 1)
    monkeypatch.setattr(encoding, "FREQUENT_SHARE", share)
    out = encode_tokens(df, vocab, key=["k"], with_special=False, max_len=64, pad_to=4)
    known = {f"w{i}": 1_000 + i for i in range(0, 60, 2)} | {"the": 5}
    for r in out.collect():
        assert r.input_ids == [known.get(w, 100) for w in rows[r.k][1].split()]


def test_frequent_tokens_stay_with_their_text(spark, monkeypatch):
    """They are gone before the exchange by token, and may have no id."""
    monkeypatch.setattr(encoding, "SAMPLED", 1)
    rows = [(i, f"the cat {'odd' if i == 3 else 'sat'}") for i in range(8)] + [(8, ""), (9, None)]
    df = spark.createDataFrame(rows, "k int, text string")
    vocab = spark.createDataFrame(
        [("the", 5), ("cat", None), ("sat", 7), ("odd", 8)], "token string, id bigint"
    )
    out = encode_tokens(df, vocab, key=["k"], with_special=False, max_len=64, pad_to=1)
    sent = [
        line.split("LeftAnti")[1]
        for line in out._jdf.queryExecution().sparkPlan().toString().splitlines()
        if "LeftAnti" in line
    ]
    assert len(sent) == 1
    got = {r.k: r.input_ids for r in out.collect()}
    assert got == {i: [5, 100, 8 if i == 3 else 7] for i in range(8)} | {8: [0], 9: [0]}


class Recording(EmbeddingModel):
    """Notes the process that loads it."""

    dim = 1

    def __init__(self, path):
        self.path = path

    def make_predict_fn(self):
        with open(self.path, "a") as out:
            out.write(f"{os.getpid()}\n")
        return lambda texts: np.ones((len(texts), 1), np.float32)


def test_a_worker_loads_a_model_once(spark, tmp_path):
    path = str(tmp_path / "loads")
    for _ in range(3):
        df = texts_df(spark, [str(i) for i in range(40)]).repartition(8)
        assert embed(df, Recording(path)).count() == 40
        embed(df, Recording(path)).collect()
    with open(path) as loads:
        pids = loads.read().split()
    assert pids and len(pids) == len(set(pids))


def test_loaded_models_are_bounded(monkeypatch):
    monkeypatch.setattr(embedding, "KEPT_BYTES", 100)
    monkeypatch.setattr(embedding, "_registry", lambda known={}: known)
    made = []

    class Model:
        def make_predict_fn(self):
            made.append(self)
            return len

    for key in ("a", "b", "a", "c", "a", "b"):
        embedding.loaded(Model(), key, 50)
    # c pushed out b, which was unused longest; b then pushed out c.
    assert len(made) == 4 and sorted(embedding._registry()) == ["a", "b"]


def test_reports_run_no_model(spark, sf_dir):
    chunks = document_chunks(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    for rows in (ingest_report(chunks, 8, "doc_id"), chunks.select(chunk_lines(8))):
        assert "Python" not in plan_of(rows) and "Arrow" not in plan_of(rows)


def test_truncate_keeps_the_ends(spark):
    df = spark.createDataFrame([([1, 2, 3, 4, 5],)], "a array<bigint>")
    got = df.select(
        tk.truncate_ids("a", 3, head=1, tail=1), tk.truncate_ids("a", 9, tail=1)
    ).first()
    assert list(got) == [[1, 2, 5], [1, 2, 3, 4, 5]]


# A one-node ONNX graph, last_hidden_state = Gather(table, input_ids), written in
# the protobuf wire format since no ONNX library is installed.


def field(number, payload):
    if isinstance(payload, int):
        return varint(number << 3) + varint(payload)
    raw = payload.encode() if isinstance(payload, str) else payload
    return varint(number << 3 | 2) + varint(len(raw)) + raw


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def value_info(name, kind, dims):
    shape = b"".join(
        field(1, field(2, d) if isinstance(d, str) else field(1, d)) for d in dims
    )
    return field(1, name) + field(2, field(1, field(1, kind) + field(2, shape)))


def gather_model(table):
    rows, dim = table.shape
    tensor = field(1, rows) + field(1, dim) + field(2, 1) + field(8, "table")
    tensor += field(9, struct.pack(f"<{rows * dim}f", *table.ravel()))
    node = field(1, "table") + field(1, "input_ids") + field(2, "last_hidden_state")
    node += field(4, "Gather")
    graph = field(1, node) + field(2, "g") + field(5, tensor)
    graph += field(11, value_info("input_ids", 7, ["b", "s"]))
    graph += field(12, value_info("last_hidden_state", 1, ["b", "s", dim]))
    return field(1, 8) + field(7, graph) + field(8, field(1, "") + field(2, 13))


def test_onnx_model(spark, tmp_path):
    pytest.importorskip("onnxruntime")
    tokenizers = pytest.importorskip("tokenizers")
    words = ["[PAD]", "[UNK]", "[CLS]", "[SEP]", "cat", "sat", "##s"]
    tokenizer = tokenizers.BertWordPieceTokenizer({w: i for i, w in enumerate(words)})
    tokenizer.save(str(tmp_path / "tokenizer.json"))
    table = np.random.default_rng(5).normal(size=(7, 4)).astype(np.float32)
    (tmp_path / "model.onnx").write_bytes(gather_model(table))
    model = OnnxModel(
        str(tmp_path / "model.onnx"),
        str(tmp_path / "tokenizer.json"),
        dim=4,
        max_tokens=6,
        pad_to=5,
    )
    texts = {"cats sat": [2, 4, 6, 5, 3], "": [2, 3], "cat " * 9: [2, 4, 4, 4, 4, 3]}
    out = embed(texts_df(spark, list(texts)), model).collect()
    for r in out:
        # Padding must not count; a row longer than it shares a batch with others.
        want = table[texts[r.chunk]].mean(axis=0)
        assert r.embedding == pytest.approx(want.tolist(), abs=1e-6)


def test_constant_model():
    assert unit_vector(ConstantModel([3.0, 4.0]), "x") == pytest.approx([0.6, 0.8])


def test_token_pattern_matches_the_model(spark):
    texts = ["a_b É12½ x-y", "ﬁ Ⅳ ² 中文"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(tk.split_tokens("t")).collect()]
    assert got == [re.findall(r"[^\W_]+", t.lower()) for t in texts]
