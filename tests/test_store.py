import json
import os

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import plan_of, vectors_df
from vexel.operators.models import HashingModel
from vexel.operators.numbering import assign_offsets
from vexel.operators.search import attach_text, search
from vexel.plans.ingest import ingest
from vexel.plans.transfer import export_store, import_pair, import_store
from vexel.session import spread_if_narrow, work_dir, work_root
from vexel.sources import commits as commits_module
from vexel.sources import store as store_module
from vexel.sources.commits import CommitLog
from vexel.sources.journal import read_journal, read_journal_lines, write_journal
from vexel.sources.packed import read_packed_vectors, write_packed_vectors
from vexel.sources.pair import append_pair, pair_end, read_pair, read_plain_pair
from vexel.sources.store import Store, append_store, clear_store, read_store, vacuum_store


def rows(spark, *entries):
    """(doc_id, text, {dim: value}) of 384 dimensions."""
    out = []
    for doc_id, text, values in entries:
        v = [0.0] * 384
        for i, x in values.items():
            v[i] = x
        out.append((doc_id, 0, text, v))
    return spark.createDataFrame(
        out, "doc_id bigint, chunk_pos int, text string, embedding array<float>"
    )


def test_two_appends(spark, tmp_path):
    path = str(tmp_path / "store")
    for doc_id, text in enumerate(["first", "second"]):
        append_store(rows(spark, (doc_id, text, {0: 3.0, 1: 4.0})), path, 384)
    got = read_store(spark, path).orderBy("pos").collect()
    assert [(r.pos, r.offset, r.text) for r in got] == [
        (0, 1536, "first"),
        (1, 3072, "second"),
    ]
    for r in got:
        assert len(r.embedding) == 384
        assert r.embedding[:3] == pytest.approx([0.6, 0.8, 0], abs=1e-5)


def test_same_ingest_is_stored_once(spark, tmp_path):
    path = str(tmp_path / "store")
    data = rows(spark, (1, "a", {0: 1.0}))
    assert append_store(data, path, 384, ingest_id="x")
    assert not append_store(data, path, 384, ingest_id="x")
    assert append_store(data, path, 384, ingest_id="y")
    assert read_store(spark, path).count() == 2


def test_failed_append_publishes_nothing(spark, tmp_path):
    path = str(tmp_path / "store")
    append_store(rows(spark, (1, "a", {0: 1.0})), path, 384)
    many = rows(spark, *[(i, "b", {0: 1.0}) for i in range(40)]).repartition(4, "doc_id")
    bad = many.withColumn(
        "embedding",
        F.when(F.col("doc_id") == 39, F.array(F.lit(1.0).cast("float"))).otherwise(
            F.col("embedding")
        ),
    )
    with pytest.raises(PySparkException, match="of length 384"):
        append_store(bad, path, 384)
    assert read_store(spark, path).count() == 1


def test_dimension_must_match_the_store(spark, tmp_path):
    path = str(tmp_path / "store")
    append_store(rows(spark, (1, "a", {0: 1.0})), path, 384)
    short = rows(spark, (1, "a", {0: 1.0})).withColumn("embedding", F.slice("embedding", 1, 4))
    with pytest.raises(ValueError, match="length 384"):
        append_store(short, path, 4)


def test_positions_are_dense_over_many_partitions(spark):
    df = spark.range(1000).repartition(13, "id")
    numbered = assign_offsets(df, 3, 24)
    got = numbered.select("pos", "offset").orderBy("pos").collect()
    assert [r.pos for r in got] == list(range(2, 1002))
    assert all(r.offset == (r.pos + 1) * 12 for r in got)
    # Order within a partition follows the rows.
    assert numbered.select("id").distinct().count() == 1000


def test_positions_follow_row_order(spark, tmp_path):
    spark.range(500).repartitionByRange(5, "id").sortWithinPartitions("id").write.parquet(
        str(tmp_path / "t")
    )
    df = spark.range(0, 500, 1, 6)
    bad = assign_offsets(df, 1).filter("pos <> id")
    assert bad.count() == 0


def test_empty_partitions_are_numbered(spark):
    df = spark.range(0, 100, 1, 10).filter("id >= 55")
    got = assign_offsets(df, 1).orderBy("id").collect()
    assert [r.pos for r in got] == list(range(45))


def test_numbering_has_no_shuffle_of_the_rows(spark, sf_dir):
    emb = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    plan = plan_of(assign_offsets(emb, 64))
    left, right = plan.split("BroadcastExchange")
    assert "Exchange" not in left
    assert "ReadSchema: struct<__row:bigint>" in right


@pytest.mark.parametrize("partitions", [1, 16])
def test_changing_input_leaves_no_gap(spark, partitions):
    draw = F.pandas_udf(lambda ids: ids * 0.0 + np.random.rand(len(ids)), "double")
    df = spark.range(0, 4000, 1, partitions)
    df = df.withColumn("r", draw.asNondeterministic()("id")).filter("r < 0.5")
    numbered = assign_offsets(df, 1)
    for _ in range(2):
        got = sorted(r.pos for r in numbered.select("pos").collect())
        assert got == list(range(len(got)))


def test_hits_do_not_depend_on_partitions(spark, tmp_path):
    """Ties on purpose: every text occurs in several documents."""
    texts = ["red fish. blue fish", "blue fish. red fish", "one fish", "", None]
    docs = spark.createDataFrame(
        [(i, texts[i % 5]) for i in range(60)], "doc_id bigint, text string"
    )
    query = spark.createDataFrame([(1, "red fish")], "query_id bigint, query string")
    model, seen = HashingModel(16), []
    for n in (1, 3, 16):
        path = str(tmp_path / f"store{n}")
        ingest(docs.repartition(n), path, model)
        hits = search(read_store(spark, path), query, model, 7).collect()
        stored = read_store(spark, path).select("pos", "doc_id", "chunk_pos", "text")
        seen.append((sorted(hits), sorted(stored.collect())))
    assert seen[0] == seen[1] == seen[2]
    assert [r.doc_id for r in seen[0][1]] == sorted(r.doc_id for r in seen[0][1])


def test_offset_continues(spark):
    one = vectors_df(spark, [(0, [1.0, 2.0, 3.0])]).drop("pos")
    assert assign_offsets(one, 3, 12).first().offset == 24
    with pytest.raises(ValueError):
        assign_offsets(one, 3, 13)


def test_clear(spark, tmp_path):
    path = str(tmp_path / "store")
    with pytest.raises(FileNotFoundError):
        clear_store(spark, path)
    append_store(rows(spark, (1, "a", {0: 1.0})), path, 384)
    clear_store(spark, path)
    store = read_store(spark, path)
    assert store.count() == 0 and Store(spark, path).last_offset() == 0
    append_store(rows(spark, (2, "b", {0: 1.0})), path, 384)
    assert read_store(spark, path).first().offset == 1536
    # The cleared rows are still on disk until they are swept.
    assert len(vacuum_store(spark, path)) == 1 and vacuum_store(spark, path) == []
    assert read_store(spark, path).first().text == "b"


def test_missing_store_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_store(spark, str(tmp_path / "none"))


def test_a_stopped_append_leaves_nothing(spark, tmp_path, monkeypatch):
    """Stopped between the data and its record, as by a lost driver."""
    path = str(tmp_path / "store")
    append_store(rows(spark, (1, "a", {0: 1.0})), path, 384, ingest_id="one")
    data = rows(spark, (2, "b", {0: 1.0}), (3, "c", {1: 1.0}))
    monkeypatch.setattr(store_module.CommitLog, "add", lambda *_: 1 / 0)
    monkeypatch.setattr(store_module.paths, "delete", lambda *_: None)
    with pytest.raises(ZeroDivisionError):
        append_store(data, path, 384, ingest_id="two")
    monkeypatch.undo()
    assert len([n for n in os.listdir(path) if n.startswith("append-")]) == 2
    assert read_store(spark, path).count() == 1
    assert Store(spark, path).last_offset() == 1536
    assert append_store(data, path, 384, ingest_id="two")
    got = [(r.pos, r.text) for r in read_store(spark, path).orderBy("pos").collect()]
    assert got == [(0, "a"), (1, "b"), (2, "c")]
    assert len(vacuum_store(spark, path)) == 1


def test_the_slower_of_two_writers_goes_behind(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    real, turns = store_module._files, []

    def files(spark_, folder):
        if not turns:  # another writer commits between this one's data and its record
            turns.append(1)
            assert append_store(rows(spark, (9, "other", {0: 1.0})), path, 384)
        return real(spark_, folder)

    monkeypatch.setattr(store_module, "_files", files)
    assert append_store(rows(spark, (1, "mine", {0: 1.0})), path, 384, ingest_id="x")
    got = [(r.pos, r.text) for r in read_store(spark, path).orderBy("pos").collect()]
    assert got == [(0, "other"), (1, "mine")]


def test_log_numbers_are_taken_once(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path))
    seen = []

    def late(live):
        # Another writer takes the number while this record is made.
        if len(live) == 1 and not seen:
            seen.append(log.add(lambda _: {"kind": "x", "by": "other"}))
        return {"kind": "x", "after": len(live)}

    log.add(lambda live: {"kind": "x", "after": 0})
    assert log.add(late) == {"kind": "x", "after": 2, "number": 2}
    assert [r["number"] for r in log.records()] == [0, 1, 2]


def test_long_log_is_read_from_its_snapshot(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits_module, "SNAPSHOT", 4)
    log = CommitLog(spark, str(tmp_path))
    for i in range(11):
        log.add(lambda live, i=i: {"kind": "clear"} if i == 5 else {"kind": "x", "i": i})
    opened = []
    real = commits_module.paths.read_text
    monkeypatch.setattr(
        commits_module.paths, "read_text", lambda s, p: opened.append(p) or real(s, p)
    )
    assert [r["i"] for r in log.records()] == [6, 7, 8, 9, 10]
    assert len(opened) == 4  # 10, 9, 8 and the snapshot 7
    assert log.add(lambda live: None) is None


def test_append_reads_no_stored_data(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    append_store(rows(spark, (1, "a", {0: 1.0})), path, 384)
    (old,) = [n for n in os.listdir(path) if n.startswith("append-")]
    os.rename(f"{path}/{old}", f"{path}/away")
    assert append_store(rows(spark, (2, "b", {0: 1.0})), path, 384, ingest_id="x")
    assert not append_store(rows(spark, (2, "b", {0: 1.0})), path, 384, ingest_id="x")
    assert Store(spark, path).last_offset() == 3072
    os.rename(f"{path}/away", f"{path}/{old}")
    assert read_store(spark, path).count() == 2


def test_many_files_are_read_in_parts(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    many = rows(spark, *[(i, f"t{i}", {i: 1.0}) for i in range(40)])
    append_store(many.repartitionByRange(8, "doc_id"), path, 384)
    want = sorted((r.pos, r.text) for r in read_store(spark, path).collect())
    assert [p for p, _ in want] == list(range(40))
    monkeypatch.setattr(store_module, "INDEX_FILES", 3)
    assert sorted((r.pos, r.text) for r in read_store(spark, path).collect()) == want


def test_packed_file(spark, tmp_path):
    path = tmp_path / "v.bin"
    values = np.array([[1.5, -2.25, 0.5], [4.0, 5.0, 6.0], [7.0, 8.0, 9.0]], "<f4")
    path.write_bytes(values.tobytes() + b"\x01\x02\x03\x04\x05")
    for split in (12, 24, 1 << 20):
        df = read_packed_vectors(spark, str(path), 3, split_bytes=split)
        got = df.orderBy("pos").collect()
        assert [r.pos for r in got] == [0, 1, 2]
        assert [r.embedding for r in got] == values.tolist()
    assert df.rdd.getNumPartitions() == 1
    assert read_packed_vectors(spark, str(path), 3, split_bytes=12).rdd.getNumPartitions() == 3


def test_packed_edges(spark, tmp_path):
    empty = tmp_path / "e.bin"
    empty.write_bytes(b"")
    assert read_packed_vectors(spark, str(empty), 3).count() == 0
    with pytest.raises(PySparkException):
        read_packed_vectors(spark, str(tmp_path / "none"), 3).count()


def packed_bytes(folder):
    with open(f"{folder}/manifest.json") as manifest:
        runs = json.load(manifest)["runs"]
    return b"".join(open(f"{folder}/{r['vectors']}", "rb").read() for r in runs)


@pytest.mark.parametrize("in_runs", [False, True])
def test_packed_export(spark, tmp_path, in_runs):
    path = str(tmp_path / "out")
    data = [(i, [float(i), -float(i)]) for i in range(100)]
    given = vectors_df(spark, data[::-1]).repartition(5, "pos")
    if in_runs:
        given = given.repartitionByRange(5, "pos").sortWithinPartitions("pos")
    write_packed_vectors(given, path, 2, in_runs=in_runs)
    assert packed_bytes(path) == np.array([v for _, v in data], "<f4").tobytes()
    back = read_packed_vectors(spark, path, 2, split_bytes=80)
    assert sorted((r.pos, r.embedding) for r in back.collect()) == data


def test_runs_are_not_shuffled_and_must_tile(spark, tmp_path):
    data = [(i, [float(i)]) for i in (7, 5, 6, 0, 1, 2, 3, 4)]
    path = str(tmp_path / "runs")
    write_packed_vectors(vectors_df(spark, data).coalesce(1), path, 1, in_runs=True)
    assert packed_bytes(path) == np.arange(8, dtype="<f4").tobytes()
    for bad in ([(0, [1.0]), (2, [1.0])], [(0, [1.0]), (0, [1.0])], [(1, [1.0])]):
        with pytest.raises(PySparkException, match="positions must follow"):
            write_packed_vectors(vectors_df(spark, bad), str(tmp_path / "bad"), 1)
        assert not (tmp_path / "bad").exists()


def test_an_unfinished_export_cannot_be_read(spark, tmp_path):
    path = tmp_path / "out"
    write_packed_vectors(vectors_df(spark, [(0, [1.0])]), str(path), 1)
    (path / "manifest.json").unlink()
    with pytest.raises(PySparkException, match="no finished export"):
        read_packed_vectors(spark, str(path), 1).collect()


def test_failed_packed_export_leaves_no_data(spark, tmp_path):
    path = tmp_path / "out"
    with pytest.raises(PySparkException):
        write_packed_vectors(vectors_df(spark, [(0, [1.0, 2.0]), (1, [1.0])]), str(path), 2)
    assert not path.exists() or list(path.iterdir()) == []


def test_packed_export_needs_a_new_folder(spark, tmp_path):
    with pytest.raises(PySparkException, match="FileExistsError"):
        write_packed_vectors(vectors_df(spark, [(0, [1.0])]), str(tmp_path), 1)


def test_missing_journal_is_created(spark, tmp_path):
    path = tmp_path / "meta.jsonl"
    journal = read_journal(spark, str(path), 3)
    assert journal.count() == 0 and path.exists()
    assert read_journal_lines(spark, str(tmp_path / "lines.jsonl")).count() == 0


def test_journal_positions_come_from_offsets(spark, tmp_path):
    path = tmp_path / "meta.jsonl"
    lines = ['{"Offset":12,"Text":"a <b> & c"}', "", "not json", '{"Offset":36,"Text":"c"}']
    path.write_text("\n".join(lines) + "\n")
    journal = read_journal(spark, str(path), 3)
    assert sorted((r.pos, r.text) for r in journal.collect()) == [(0, "a <b> & c"), (2, "c")]
    vectors = vectors_df(spark, [(i, [0.0] * 3) for i in range(3)])
    got = attach_text(vectors.select("pos"), journal).collect()
    assert sorted((r.pos, r.text) for r in got) == [(0, "a <b> & c"), (1, ""), (2, "c")]


def test_journal_lines_have_their_numbers(spark, tmp_path):
    """Blank lines before the first entry do not count, all others do."""
    text = ['{"Offset":12,"Text":"a"}', "", "not json", '{"Text":"no offset"}', '{"Offset":12}']
    text += [f'{{"Offset":{i},"Text":"é{i}"}}' + "\r" * (i % 2) for i in range(5, 400)]
    path = tmp_path / "meta.jsonl"
    path.write_bytes(("\n \t\n" + "\n".join(text) + "\n\n").encode())
    want = [(0, 12, "a"), (1, None, ""), (2, None, ""), (3, None, "no offset"), (4, 12, "")]
    want += [(i, i, f"é{i}") for i in range(5, 400)] + [(400, None, "")]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for split in ("128m", "1k", "100"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            got = read_journal_lines(spark, str(path))
            if split == "1k":
                assert got.rdd.getNumPartitions() > 3
            assert sorted(tuple(r) for r in got.collect()) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_vector_and_line_are_paired_by_number(spark, tmp_path):
    vectors, journal = tmp_path / "v.bin", tmp_path / "meta.jsonl"
    vectors.write_bytes(np.eye(4, dtype="<f4").tobytes() + b"\x01")
    journal.write_text('{"Offset":999,"Text":"a"}\n{"Text":"b"}\nbroken\n')
    got = read_plain_pair(spark, str(vectors), str(journal), 4).orderBy("pos").collect()
    assert [(r.pos, r.offset, r.text) for r in got] == [
        (0, 16, "a"), (1, 32, "b"), (2, 48, ""), (3, 64, "")]
    import_store(spark, str(vectors), str(journal), str(tmp_path / "store"), 4)
    back = read_store(spark, str(tmp_path / "store")).orderBy("pos").collect()
    assert [(r.pos, r.text, r.embedding) for r in back] == [
        (r.pos, r.text, r.embedding) for r in got]


def test_repeated_and_crooked_offsets(spark, tmp_path):
    path = tmp_path / "twice.jsonl"
    path.write_text('{"Offset":12,"Text":"b"}\n{"Offset":12,"Text":"a"}\n')
    hits = vectors_df(spark, [(i, [0.0] * 3) for i in range(2)]).select("pos")
    got = attach_text(hits, read_journal(spark, str(path), 3)).collect()
    assert sorted((r.pos, r.text) for r in got) == [(0, "a"), (1, "")]
    path = tmp_path / "crooked.jsonl"
    path.write_text('{"Offset":13,"Text":"b"}\n')
    with pytest.raises(PySparkException, match="not a multiple of 12"):
        read_journal(spark, str(path), 3).collect()


def test_journal_round_trip(spark, tmp_path):
    path = str(tmp_path / "journal")
    texts = ["plain", "line\nbreak", 'quote " \\ ', "é\U0001f600<&>", "", None]
    df = spark.createDataFrame(
        [((i + 1) * 8, t) for i, t in enumerate(texts)], "offset bigint, text string"
    )
    write_journal(df.repartition(3), path)
    parts = sorted(p for p in os.listdir(path) if p.startswith("part-"))
    lines = [x for p in parts for x in open(f"{path}/{p}", encoding="utf-8")]
    assert [json.loads(x)["Offset"] for x in lines] == [8, 16, 24, 32, 40, 48]
    got = read_journal(spark, path, 2).orderBy("pos").collect()
    assert [r.text for r in got] == [t or "" for t in texts]


def test_transfer(spark, tmp_path):
    first, copy, pair = (str(tmp_path / n) for n in ("store", "copy", "pair"))
    many = [(i, f"text {i}\n", {i: 2.0, i + 1: 1.0}) for i in range(30)]
    append_store(rows(spark, *many).repartitionByRange(4, "doc_id"), first, 384)
    store = read_store(spark, first)
    assert export_store(spark, first, pair) == 30
    assert export_store(spark, first, pair) == 0
    import_pair(spark, pair, copy, 384)
    cols = ["pos", "offset", "text", "embedding"]
    back = read_store(spark, copy).select(cols)
    assert back.count() == 30
    assert back.exceptAll(store.select(cols)).count() == 0
    with pytest.raises(FileExistsError):
        import_pair(spark, pair, copy, 384)


def test_pair_grows_by_whole_generations(spark, tmp_path):
    path = str(tmp_path / "pair")
    assert pair_end(spark, path) == 0
    with pytest.raises(FileNotFoundError):
        read_pair(spark, path, 2)

    def some(first, n):
        data = [(i, [float(i), 1.0], f"t{i}") for i in range(first, first + n)]
        return spark.createDataFrame(data, "pos bigint, embedding array<float>, text string")

    assert append_pair(some(0, 5), path, 2) == 5
    assert pair_end(spark, path) == 40
    # A torn generation: vectors without a record.
    write_packed_vectors(some(5, 9), f"{path}/generation-torn", 2, first=5)
    with pytest.raises(PySparkException, match="positions must follow"):
        append_pair(some(0, 3), path, 2)
    with pytest.raises(ValueError, match="length 2"):
        append_pair(some(5, 3), path, 3)
    assert append_pair(some(5, 3), path, 2) == 3
    got = read_pair(spark, path, 2).orderBy("pos").collect()
    assert [(r.pos, r.offset, r.text) for r in got] == [
        (i, 8 * (i + 1), f"t{i}") for i in range(8)]
    assert [r.embedding[0] for r in got] == [float(i) for i in range(8)]


def test_work_dir_is_below_the_configured_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first.startswith(root + "/") and first != second


class FakeConf(dict):
    def set(self, key, value):
        self[key] = value


class FakeSession:
    def __init__(self, **conf):
        self.conf = FakeConf({k.replace("_", "."): v for k, v in conf.items()})


def test_work_dir_without_a_configured_folder():
    local = FakeSession(spark_master="local[2]")
    assert work_root(local) == work_root(local)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_root(FakeSession(spark_master="spark://host:7077"))


def test_spread(spark):
    narrow = spark.range(0, 100, 1, 1)
    assert spread_if_narrow(narrow, "id").rdd.getNumPartitions() == 8
    wide = spark.range(0, 100, 1, 9)
    assert spread_if_narrow(wide, "id").rdd.getNumPartitions() == 9
