import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import plan_of
from vexel.operators import chunking as ck


def chunks(spark, chunker, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    out = df.orderBy("i").select(chunker(F.col("t"))).collect()
    return [r[0] for r in out]


def test_delimiter(spark):
    got = chunks(spark, ck.chunk_delimiter("."), "a..b.", ".", ".a", "", " a . b ")
    assert got == [["a", "", "b", ""], ["", ""], ["", "a"], [], [" a ", " b "]]


def test_any_single_byte_delimiter_is_literal(spark):
    delimiters = list("|\\ ^$*+?()[]{}.x-#&\n\t\"'")
    texts = [f"a{d}b{d}{d}cd" for d in delimiters]
    df = spark.createDataFrame([tuple(texts)], [f"c{i}" for i in range(len(texts))])
    cut = [ck.chunk_delimiter(d)(F.col(f"c{i}")) for i, d in enumerate(delimiters)]
    assert list(df.select(*cut).first()) == [t.split(d) for t, d in zip(texts, delimiters)]


def test_delimiter_must_be_one_byte():
    for bad in ("..", "é"):
        with pytest.raises(ValueError):
            ck.chunk_delimiter(bad)


def test_pass_through(spark):
    assert chunks(spark, ck.chunk_delimiter(""), "a.b", "") == [["a.b"], [""]]
    assert chunks(spark, ck.chunk_fixed(0), "a.b", "") == [["a.b"], [""]]
    assert chunks(spark, ck.chunk_fixed(-3), "abc") == [["abc"]]


def test_fixed(spark):
    assert chunks(spark, ck.chunk_fixed(10), "short") == [["short"]]
    assert chunks(spark, ck.chunk_fixed(4), "abcdefghijkl", "") == [
        ["abcd", "efgh", "ijkl"],
        [],
    ]
    assert chunks(spark, ck.chunk_fixed(3), "ab\U0001f600cd\ne") == [
        ["ab\U0001f600", "cd\n", "e"]
    ]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=40), min_size=1, max_size=30))
def test_chunkers_against_python(spark, texts):
    texts = [t.replace("\x00", "") for t in texts]
    assert chunks(spark, ck.chunk_delimiter("."), *texts) == [
        t.split(".") if t else [] for t in texts
    ]
    assert chunks(spark, ck.chunk_fixed(3), *texts) == [
        [t[i : i + 3] for i in range(0, len(t), 3)] for t in texts
    ]


def docs(spark):
    rows = [(1, " a.b. "), (2, "  "), (3, None), (4, "x")]
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def test_documents(spark):
    got = ck.chunk_documents(docs(spark)).orderBy("doc_id", "pos").collect()
    assert [tuple(r) for r in got] == [(1, 0, "a"), (1, 1, "b"), (1, 2, ""), (4, 0, "x")]
    full = ck.chunk_documents(docs(spark), drop_empty=True)
    assert sorted(r.chunk for r in full.collect()) == ["a", "b", "x"]


def test_strict_documents_fail(spark):
    with pytest.raises(PySparkException, match="no text provided"):
        ck.chunk_documents(docs(spark), strict=True).collect()
    none = ck.arrow_chunker(lambda texts: pa.array([[]] * len(texts), pa.list_(pa.string())))
    some = docs(spark).filter("doc_id = 4")
    with pytest.raises(PySparkException, match="no chunks"):
        ck.chunk_documents(some, none, strict=True).collect()
    assert ck.chunk_documents(some, none).count() == 0


def test_a_custom_chunker_sees_batches(spark):
    def lines(texts):
        assert isinstance(texts, pa.StringArray) and not texts.null_count
        lists = pc.split_pattern(texts, "\n")
        return ck.filter_lists(lists, pc.greater(pc.utf8_length(lists.flatten()), 1))

    rows = [(1, "a\nbb\nccc"), (2, ""), (3, "x"), (4, "yy")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    got = ck.chunk_documents(df, ck.arrow_chunker(lines)).orderBy("doc_id", "pos").collect()
    assert [tuple(r) for r in got] == [(1, 0, "bb"), (1, 1, "ccc"), (4, 0, "yy")]
    short = ck.arrow_chunker(lambda texts: pa.array([["a"]] * (len(texts) - 1)))
    with pytest.raises(PySparkException, match="one list per text"):
        ck.chunk_documents(df, short).collect()


def test_filtered_lists_of_a_slice():
    lists = pa.array([["a", "b"], [], ["c"], ["d", "e"]]).slice(1)
    kept = ck.filter_lists(lists, pa.array([True, None, True]))
    assert kept.to_pylist() == [[], ["c"], ["e"]]


def test_require_chunks(spark):
    df = spark.createDataFrame([(1, ["a"]), (2, [])], "i int, chunks array<string>")
    assert [r.i for r in ck.require_chunks(df).collect()] == [1]
    with pytest.raises(PySparkException, match="no chunks"):
        ck.require_chunks(df, strict=True).collect()


def test_text_is_trimmed_and_cut_once(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = plan_of(ck.chunk_documents(table))
    assert plan.count("split(") == 1 and plan.count("trim(") == 1
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    assert "Exchange" not in plan
    strict = plan_of(ck.chunk_documents(table, strict=True))
    assert strict.count("split(") == 1 and strict.count("trim(") == 1
