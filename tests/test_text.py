import pytest
from pyspark.errors import PySparkException

from vexel.functions.text import require_text, strip_space, trim_space
from vexel.sources.text_files import from_text_table, read_text_files


def trimmed(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(trim_space("t")).collect()]


def test_trim_removes_unicode_white_space(spark):
    spaces = [" ", "　", " ", "\u0085", "\t\r\n", " \v\f"]
    texts = [f"{s}a b{s}" for s in spaces]
    assert trimmed(spark, texts) == ["a b"] * len(spaces)
    assert [strip_space(t) for t in texts] == ["a b"] * len(spaces)


def test_trim_keeps_what_is_not_white_space(spark):
    texts = ["​x​", "\x1cx\x1c"]
    assert trimmed(spark, texts) == texts
    assert [strip_space(t) for t in texts] == texts


def test_trim_of_null_and_blank_is_empty(spark):
    assert trimmed(spark, [None, "", " \n"]) == ["", "", ""]


def test_require_text_drops_or_fails(spark):
    df = spark.createDataFrame([(1, " a "), (2, "　"), (3, None)], "i int, text string")
    assert [tuple(r) for r in require_text(df).collect()] == [(1, "a")]
    with pytest.raises(PySparkException, match="no text provided"):
        require_text(df, strict=True).collect()


def test_whole_files(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"one\r\ntwo\n")
    (tmp_path / "b.txt").write_bytes(b"bad \xff byte")
    (tmp_path / "c.txt").write_bytes(b"")
    rows = read_text_files(spark, str(tmp_path)).collect()
    got = {r.path.rsplit("/", 1)[1]: r.text for r in rows}
    assert got == {"a.txt": "one\r\ntwo\n", "b.txt": "bad � byte"}
    glob = read_text_files(spark, [f" {tmp_path}/a.* "])
    assert glob.count() == 1


def test_file_errors(spark, tmp_path):
    with pytest.raises(ValueError, match="empty"):
        read_text_files(spark, "  ")
    with pytest.raises(PySparkException):
        read_text_files(spark, str(tmp_path / "missing.txt"))


def test_text_table(spark):
    df = spark.createDataFrame([(1, "x", 9)], "k int, body string, other int")
    assert from_text_table(df, "body", "k").columns == ["k", "text"]
