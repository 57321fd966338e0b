import datetime
import decimal
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.errors import AlreadyExists, FailedPrecondition, InvalidArgument, NotFound
from plumbline.functions import sizing
from plumbline.operators import changes as replay
from plumbline.operators.fulltext import Analyzer, search_index, search_scan
from plumbline.operators.ivf import build_ivf
from plumbline.operators.knn import knn
from plumbline.plans.indexes import (
    create_index,
    open_index,
    rebuild_indexes,
    search_stored,
    search_text_stored,
)
from plumbline.sources.schema import Field, Schema, index_settings, spark_type
from plumbline.sources.table import Table
from plumbline.streaming.change_stream import ChangeStream

EVOLUTION = Schema("evolution", (Field("rank", "int64", index=index_settings("inverted")),), 2_000)


def content(frame):
    return {r["id"]: tuple(r)[1:] for r in frame.collect()}


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / uuid.uuid4().hex)


def test_schema_rules():
    for bad in (
        lambda: Field("", "string"),
        lambda: Field("v", "vectorFloat32"),
        lambda: Field("v", "string", dim=3),
        lambda: Field("v", "sparseVectorFloat32", dim=3),
        lambda: Field("v", "undefined"),
        lambda: Schema("", ()),
        lambda: Schema("s", (Field("t", "string"), Field("t", "string"))),
        lambda: Schema("s", (), 999),
        lambda: index_settings("graph"),
        lambda: index_settings("flat", cells=3),
    ):
        with pytest.raises(InvalidArgument):
            bad()
    assert Schema.from_json(EVOLUTION.to_json()) == EVOLUTION
    assert index_settings("ivf")["cells"] == 1_024


def test_lifecycle(spark, path):
    table = Table.create(spark, path, EVOLUTION)
    with pytest.raises(AlreadyExists):
        Table.create(spark, path, EVOLUTION)
    table, results = table.insert(spark.createDataFrame([(0, "one", 1)], "pos int, id string, rank long"))
    assert results.first()["ok"]
    _, missing = table.update(spark.createDataFrame([(0, "missing", 2)], "pos int, id string, rank long"))
    assert not missing.first()["ok"]
    table = Table.open(spark, path)
    table = table.add_column(Field("priority", "int32", nullable=True)).alter_column("priority", new_name="weight")
    assert table.schema["weight"].vtype == "int32"
    table = table.set_index("rank", index_settings("inverted")).drop_column("weight")
    table = Table.open(spark, path)
    assert table.schema.segment_rows == 2_000
    assert table.schema["rank"].index == index_settings("inverted")
    assert Field.from_struct(table.scan().schema["rank"]) == table.schema["rank"]
    assert content(table.scan()) == {"one": (1,)}
    table = table.delete_where("rank = 1")
    assert table.statistics().first()["documents"] == 0
    with pytest.raises(NotFound):
        Table.open(spark, path + "-other")


def test_old_version_stays_readable_and_stale_writes_fail(spark, path):
    first = Table.create(spark, path, EVOLUTION)
    row = spark.createDataFrame([(0, "one", 1)], "pos int, id string, rank long")
    second, _ = first.insert(row)
    assert content(Table.open(spark, path, version=0).scan()) == {}
    assert content(second.scan()) == {"one": (1,)}
    with pytest.raises(FailedPrecondition):
        first.insert(row)


def test_layers_and_compaction(spark, path):
    kind = "pos int, id string, rank long"
    rows = spark.createDataFrame([(f"k{i}", i) for i in range(50)], "id string, rank long")
    table = Table.create(spark, path, EVOLUTION, rows)
    table, _ = table.upsert(spark.createDataFrame([(0, "k1", 100), (1, "new", 7)], kind))
    table, _ = table.delete(spark.createDataFrame([(0, "k2"), (1, "new")], "pos int, id string"))
    table, _ = table.insert(spark.createDataFrame([(0, "new", 8)], kind))
    table, _ = table.update(spark.createDataFrame([(0, "k3", 33), (1, "none", 1)], kind))
    expected = {f"k{i}": (i,) for i in range(50)} | {"k1": (100,), "k3": (33,), "new": (8,)}
    del expected["k2"]
    assert content(table.scan()) == expected
    table = table.add_column(Field("double_rank", "int64"), "rank * 2").alter_column("rank", "place", "int32")
    table, _ = table.upsert(spark.createDataFrame([(0, "k4", 1)], "pos int, id string, place int"))
    before = content(table.scan())
    assert before["k1"] == (100, 200) and before["k4"] == (1, None)
    compacted = table.compact(3)
    assert compacted.version.layers == () and content(compacted.scan()) == before
    assert compacted.scan().schema == table.scan().schema


def test_schema_change_errors(spark, path):
    table = Table.create(spark, path, EVOLUTION)
    with pytest.raises(InvalidArgument):
        table.drop_column("nope")
    with pytest.raises(InvalidArgument):
        table.add_column(Field("x", "int32"))
    with pytest.raises(AlreadyExists):
        table.add_column(Field("rank", "int32", nullable=True))
    for unstable in ("rand()", "unix_timestamp(current_timestamp())", "missing + 1"):
        with pytest.raises(InvalidArgument):
            table.add_column(Field("x", "double"), unstable)
    with pytest.raises(InvalidArgument):
        table.alter_column("rank")


def test_every_value_type_round_trips(spark, path):
    sparse = ([1, 7], [1.5, 2.5])
    values = {
        "binary": bytearray([0, 255, 0, 7]),
        "string": "Swift 中文 \0 suffix",
        "bool": True,
        "int32": -32,
        "int64": -64,
        "uint32": 2**32 - 1,
        "uint64": decimal.Decimal(2**64 - 1),
        "float": 1.25,
        "double": 2.5,
        "arrayBinary": [bytearray([0, 1]), bytearray(), bytearray([255])],
        "arrayString": ["a", "中文", ""],
        "arrayBool": [True, False, True],
        "arrayInt32": [-1, 2],
        "arrayInt64": [],
        "arrayUInt32": [5, 6],
        "arrayUInt64": [decimal.Decimal(7), decimal.Decimal(2**64 - 1)],
        "arrayFloat": [1.5, 2.5],
        "arrayDouble": [3.5, 4.5],
        "vectorBinary32": bytearray([1, 2, 3, 4]),
        "vectorBinary64": bytearray(range(8)),
        "vectorFloat16": [1.0, 2.0],
        "vectorFloat32": [3.0, 4.0],
        "vectorFloat64": [5.0, 6.0],
        "vectorInt4": [2, 1, -8],
        "vectorInt8": [-1, 2],
        "vectorInt16": [-3, 4],
        "sparseVectorFloat16": sparse,
        "sparseVectorFloat32": sparse,
    }
    dims = {"vectorBinary32": 32, "vectorBinary64": 64, "vectorInt4": 3}
    fields = tuple(
        Field(f"f_{k}", k, dim=dims.get(k, 2 if k.startswith("vector") else 0)) for k in values
    )
    schema = Schema("all", fields)
    rows = spark.createDataFrame([("all", *values.values())], schema.struct())
    table = Table.create(spark, path, schema, rows)
    assert table.violations(rows).count() == 0
    back = Table.open(spark, path).scan().first()
    for name, value in values.items():
        got = back[f"f_{name}"]
        assert (tuple(got) if name.startswith("sparse") else got) == value, name
    assert spark_type("uint64").simpleString() == "decimal(20,0)"


@pytest.mark.parametrize(
    "settings",
    [
        index_settings("ivf", cells=3, metric="l2"),
        index_settings("ivf", cells=3, spill=True),
        index_settings("approximate", metric="l2"),
        index_settings("flat", quantization="int8", metric="l2"),
    ],
)
def test_stored_vector_index_is_reopened(spark, path, settings):
    schema = Schema("v", (Field("embedding", "vectorFloat32", nullable=True, dim=2),))
    rows = spark.createDataFrame(
        [(str(i), [1.0 + i % 5, 1.0 + i // 5]) for i in range(25)], "id string, embedding array<float>"
    )
    table = create_index(Table.create(spark, path, schema, rows), "embedding", settings)
    table = Table.open(spark, path)
    assert table.schema["embedding"].index == settings
    assert table.index_statistics().first()["completeness"] == 1.0
    index = open_index(table, "embedding")
    query = spark.createDataFrame([("q", [3.0, 4.0])], "qid string, qvec array<float>")
    hits = search_stored(table, "embedding", query, 3, effort=25)
    expected = knn(table.scan(), query, 3, metric=settings["metric"])
    assert index is not None
    key = lambda r: (r["rank"], r["id"])
    assert sorted(map(key, hits.collect())) == sorted(map(key, expected.collect()))


def test_stored_text_index_is_reopened(spark, path):
    schema = Schema("t", (Field("title", "string"),))
    rows = spark.createDataFrame([("a", "swift vector database"), ("b", "swift server")], "id string, title string")
    settings = index_settings("fulltext", tokenizer="whitespace", filters=["lowercase"])
    create_index(Table.create(spark, path, schema, rows), "title", settings)
    table = Table.open(spark, path)
    query = spark.createDataFrame([(1, "SWIFT -database")], "qid int, text string")
    index = open_index(table, "title")
    assert index.analyzer == Analyzer("whitespace", ("lowercase",), {})
    hits = search_index(index, query, 3, mode="query")
    assert [r["id"] for r in hits.collect()] == ["b"]
    assert table.index_statistics().first()["completeness"] == 1.0
    with pytest.raises(InvalidArgument):
        create_index(table, "title", index_settings("ivf"))


def test_index_statistics(spark, path):
    schema = Schema("v", (Field("embedding", "vectorFloat32", nullable=True, dim=2),))
    rows = spark.createDataFrame(
        [(str(i), [float(i), 1.0] if i < 8 else None) for i in range(10)], "id string, embedding array<float>"
    )
    table = Table.create(spark, path, schema, rows)
    side = f"{path}-cells"
    build_ivf(table.scan().where("id < '6'"), cells=2, path=side)
    table = table.set_index("embedding", index_settings("ivf", cells=2), side)
    row = Table.open(spark, path).index_statistics().first()
    assert tuple(row) == ("embedding", 0.75)


CHANGES = "seq long, id string, op string, rank long"


def test_stream_equals_batch(spark, path, tmp_path):
    source, log = str(tmp_path / "in"), f"{path}-log"
    rows = [
        (i, f"k{i % 7}", ["insert", "update", "upsert", "delete", "update"][(i * 7 + i // 5) % 5], i) for i in range(90)
    ]
    changes = spark.createDataFrame(rows, CHANGES)
    changes.where("seq < 40").coalesce(1).write.parquet(source)
    table = Table.create(spark, path, EVOLUTION, spark.createDataFrame([("k0", 0), ("k1", 1)], "id string, rank long"))
    stream = ChangeStream(spark, log)
    flow = spark.readStream.schema(changes.schema).parquet(source)
    stream.start(flow, f"{path}-checkpoint").awaitTermination()
    folded = stream.fold(table, changes.schema)
    last = folded.mark(stream.log_path)
    assert content(folded.scan()) == content(
        replay.apply_changes(table.scan(), changes.where("seq < 40")).table
    )
    changes.where("seq >= 40").coalesce(1).write.mode("append").parquet(source)
    stream.start(flow, f"{path}-checkpoint").awaitTermination()
    expected = content(replay.apply_changes(table.scan(), changes).table)
    assert content(stream.current(folded.scan(), changes.schema, last).table) == expected
    again = stream.fold(folded, changes.schema)
    assert content(again.scan()) == expected and again.mark(stream.log_path) > last
    assert stream.fold(Table.open(spark, path), changes.schema).version == again.version


def test_nothing_logged_yet(spark, path):
    table = Table.create(spark, path, EVOLUTION, spark.createDataFrame([("k0", 0)], "id string, rank long"))
    stream = ChangeStream(spark, f"{path}-log")
    shape = spark.createDataFrame([], CHANGES).schema
    assert stream.pending(shape).count() == 0
    assert content(stream.current(table.scan(), shape).table) == content(table.scan())
    assert stream.fold(table, shape).version == table.version


@pytest.mark.parametrize("parts", [1, 3])
def test_changes_stream_from_a_file_or_a_folder(spark, tmp_path, parts):
    from catalog import tables

    source = "/root/testdata/sf0.001"
    for name in ("events", "customer"):
        frame = spark.read.parquet(f"{source}/{name}.parquet")
        frame.repartition(parts).write.parquet(str(tmp_path / f"{name}.parquet"))
    expected = sorted(map(tuple, tables.changes_apply(spark, source).collect()))
    assert sorted(map(tuple, tables.changes_stream(spark, str(tmp_path)).collect())) == expected
    assert sorted(map(tuple, tables.changes_stream(spark, source).collect())) == expected


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = sizing.shared_dir(spark)
    assert folder == named if named else folder == sizing.shared_dir(spark)
    frame = sizing.materialize(spark.range(5), "probe")
    assert frame.count() == 5 and all(folder in f for f in frame.inputFiles())


def test_broadcast_follows_measured_size(spark):
    small, hinted = sizing.broadcast_if_small(spark.range(10))
    assert hinted
    large, hinted = sizing.broadcast_if_small(spark.range(1000), limit=1_000)
    assert not hinted


VECTORS = Schema("v", (Field("embedding", "vectorFloat32", dim=2), Field("label", "int32", nullable=True)))


def vector_rows(spark, n=60):
    rows = [(str(i), [float(np.cos(i)), float(np.sin(i))], i % 5) for i in range(n)]
    return spark.createDataFrame(rows, "id string, embedding array<float>, label int")


@pytest.mark.parametrize("kind, more", [("ivf", {"cells": 4}), ("approximate", {}), ("flat", {"quantization": "int8"})])
def test_stored_index_answers_over_live_rows(spark, path, kind, more):
    rows = vector_rows(spark)
    table = create_index(Table.create(spark, path, VECTORS, rows), "embedding", index_settings(kind, **more))
    table = table.delete_where("id = '7'")
    new = spark.createDataFrame([(1, "twin", [float(np.cos(7)), float(np.sin(7))], 1)], "pos long, id string, embedding array<float>, label int")
    table, _ = table.insert(new)
    query = spark.createDataFrame([("q", [float(np.cos(7)), float(np.sin(7))])], "qid string, qvec array<float>")

    def found(t, name="embedding", **options):
        hits = search_stored(t, name, query, 3, effort=1_000, **options)
        return [r["id"] for r in hits.orderBy("rank").collect()]

    expected = found(table, linear=True)
    assert expected[0] == "twin" and "7" not in expected
    assert found(table) == expected
    assert found(table, where="label = 2") == found(table, where="label = 2", linear=True)
    renamed = table.alter_column("embedding", new_name="vector")
    assert found(Table.open(spark, path), "vector") == expected
    assert renamed.index_statistics().count() == 1
    folded = renamed.compact()
    assert found(folded, "vector") == expected
    # Twice, and with a write in between; the index is asked and not the table alone.
    stored = folded.stored_index("vector")
    assert folded.covers(stored) and stored.changed and not folded.version.layers
    assert Table.open(spark, path).compact().compact().stored_index("vector").changed == stored.changed
    folded = Table.open(spark, path)
    assert found(folded, "vector") == expected
    assert folded.index_statistics().first()["completeness"] < 1.0
    again = rebuild_indexes(folded)
    assert found(again, "vector") == expected
    assert again.index_statistics().first()["completeness"] == 1.0


def test_index_built_before_any_row(spark, path):
    empty = Table.create(spark, path, VECTORS)
    for kind, more in (("ivf", {"cells": 4}), ("approximate", {})):
        table = create_index(Table.open(spark, path), "embedding", index_settings(kind, **more))
        table, _ = table.insert(vector_rows(spark, 3).withColumn("pos", F.monotonically_increasing_id()))
        query = spark.createDataFrame([("q", [1.0, 0.0])], "qid string, qvec array<float>")
        assert search_stored(table, "embedding", query, 5).count() == 3
        table = table.delete_where("id IS NOT NULL")
    assert empty.scan().count() == 0


def test_alter_column_refuses_what_does_not_fit(spark, path):
    schema = Schema("t", (Field("word", "string", nullable=True), Field("n", "string", nullable=True)))
    rows = spark.createDataFrame([("1", "x", "5"), ("2", "7", "6")], "id string, word string, n string")
    table = Table.create(spark, path, schema, rows)
    with pytest.raises(InvalidArgument):
        table.alter_column("word", vtype="int32")
    assert Table.open(spark, path).scan().count() == 2
    gone = table.delete_where("word = 'x'").alter_column("word", vtype="int32").alter_column("n", vtype="int64")
    assert [tuple(r) for r in gone.scan().collect()] == [("2", 7, 6)]
    with pytest.raises(InvalidArgument):
        gone.add_column(Field("bad", "int32"), "'text'")


def test_rows_that_break_the_schema_fail_alone(spark, path):
    schema = Schema("t", (Field("v", "vectorFloat32", dim=2), Field("u", "uint32", nullable=True)))
    table = Table.create(spark, path, schema)
    batch = spark.createDataFrame(
        [(0, "a", [1.0, 2.0], 1), (1, " ", [1.0, 2.0], 1), (2, "b", [1.0], 1), (3, "c", [1.0, 2.0], -5),
         (4, "d", None, 1), (5, None, [1.0, 2.0], 1)],
        "pos long, id string, v array<float>, u long",
    )
    table, results = table.insert(batch)
    codes = {r["pos"]: r["error_code"] for r in results.collect()}
    assert codes == {0: None, 1: "invalidArgument", 2: "invalidArgument", 3: "invalidArgument", 4: "invalidArgument", 5: "invalidArgument"}
    assert [r["id"] for r in table.scan().collect()] == ["a"]
    with pytest.raises(InvalidArgument):
        Table.create(spark, path + "-2", schema, batch.select("id", "v", "u"))


def test_half_precision_is_stored_rounded(spark, path):
    schema = Schema("h", (Field("v", "vectorFloat16", dim=1),))
    rows = spark.createDataFrame([("a", [0.1])], "id string, v array<float>")
    assert Table.create(spark, path, schema, rows).scan().first()["v"] == [float(np.float16(0.1))]


def test_text_index_stays_live_and_complete(spark, path):
    schema = Schema("t", (Field("text", "string", nullable=True),))
    rows = [(str(i), f"word{i % 7} common") for i in range(40)] + [("blank", "...")]
    table = Table.create(spark, path, schema, spark.createDataFrame(rows, "id string, text string"))
    table = create_index(table, "text", index_settings("fulltext"))
    assert table.index_statistics().first()["completeness"] == 1.0
    table = table.delete_where("id = '3'")
    patch = spark.createDataFrame([(1, "10", "word0 word0 common"), (2, "50", "word3")], "pos long, id string, text string")
    table, _ = table.upsert(patch)
    assert table.index_statistics().first()["completeness"] < 1.0
    asked = spark.createDataFrame([("a", "word3 common"), ("b", "+word0 -word1")], "qid string, text string")
    for mode in ("match", "query"):
        key = lambda r: (r["qid"], r["rank"], r["id"], round(r["score"], 9))
        stored = search_text_stored(table, "text", asked, 5, mode=mode)
        scanned = search_scan(table.scan(), asked, 5, mode=mode)
        assert sorted(map(key, stored.collect())) == sorted(map(key, scanned.collect()))


def test_discard_removes_scratch(spark):
    frame = sizing.materialize(spark.range(3), "gone")
    files = frame.inputFiles()
    assert files
    sizing.discard(frame, None, spark.range(1))
    import os

    assert not any(os.path.exists(f.removeprefix("file://")) for f in files)
