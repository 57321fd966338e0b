import random

import pytest
from pyspark.sql import functions as F

from plumbline.errors import InvalidArgument
from plumbline.functions import joins
from plumbline.operators import changes as replay
from plumbline.operators import reads, validation, writes
from plumbline.sources.schema import Field, Schema

ROWS = "id string, a int, b string"


@pytest.fixture
def table(spark):
    return spark.createDataFrame([("one", 1, "x"), ("two", 2, "y")], ROWS)


def batch(spark, rows, kind="pos int, id string, a int, b string"):
    return spark.createDataFrame(rows, kind)


def outcome(write):
    return [(r["id"], r["ok"], r["error_code"]) for r in write.results.orderBy("pos").collect()]


def content(frame):
    return {r["id"]: tuple(r)[1:] for r in frame.collect()}


def test_insert(spark, table):
    done = writes.insert(table, batch(spark, [(0, "one", 9, "n"), (1, "new", 3, "z"), (2, "new", 4, "w")]))
    assert outcome(done) == [
        ("one", False, "alreadyExists"),
        ("new", True, None),
        ("new", False, "alreadyExists"),
    ]
    assert content(done.table) == {"one": (1, "x"), "two": (2, "y"), "new": (3, "z")}
    assert tuple(writes.summary(done.results).first()) == (1, 2)


def test_empty_batches(spark, table):
    empty = batch(spark, [])
    for run in (writes.insert, writes.update, writes.upsert):
        done = run(table, empty)
        assert tuple(writes.summary(done.results).first()) == (0, 0)
        assert content(done.table) == content(table)
    done = writes.delete_ids(table, empty.select("pos", "id"))
    assert content(done.table) == content(table)


def test_insert_missing_columns_become_null(spark, table):
    done = writes.insert(table, spark.createDataFrame([(0, "n", 5)], "pos int, id string, a int"))
    assert content(done.table)["n"] == (5, None)
    with pytest.raises(InvalidArgument):
        writes.insert(table, spark.createDataFrame([(0, "n", 5)], "pos int, id string, zzz int"))


def test_update_present_null_differs_from_absent(spark, table):
    kind = "pos int, id string, a int, b string, _set array<string>"
    rows = [
        (0, "one", None, None, ["b"]),
        (1, "missing", 5, "q", ["a", "b"]),
        (2, "two", 7, None, ["a"]),
        (3, "two", None, "late", ["b"]),
    ]
    done = writes.update(table, batch(spark, rows, kind))
    assert outcome(done) == [
        ("one", True, None),
        ("missing", False, "notFound"),
        ("two", True, None),
        ("two", True, None),
    ]
    assert content(done.table) == {"one": (1, None), "two": (7, "late")}
    assert content(done.rows.drop("_deleted")) == content(done.table)


def test_hot_ids_are_salted_alike(spark, monkeypatch):
    """A third of the rows name one id; the unique side is too large to broadcast."""
    many = spark.range(300).select(
        F.col("id").alias("pos"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("id"),
    )
    unique = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(20)], "id string, v int")
    expected = sorted(map(tuple, many.join(unique, "id", "left").select("pos", "id", "v").collect()))
    monkeypatch.setattr(joins, "broadcast_if_small", lambda df: (df, False))
    monkeypatch.setattr(joins, "SALT_ROWS", 7)
    found = joins.look_up(many, unique, "id", "pos")
    assert sorted(map(tuple, found.select("pos", "id", "v").collect())) == expected


def test_upsert_replaces_whole_row_last_wins(spark, table):
    done = writes.upsert(table, batch(spark, [(0, "one", 5, "p"), (1, "one", 6, None), (2, "n", 1, "m")]))
    assert content(done.table) == {"one": (6, None), "two": (2, "y"), "n": (1, "m")}
    assert all(ok for _, ok, _ in outcome(done))


def test_delete(spark, table):
    asked = spark.createDataFrame([(0, "one"), (1, "one"), (2, "gone")], "pos int, id string")
    done = writes.delete_ids(table, asked)
    assert outcome(done) == [("one", True, None), ("one", False, "notFound"), ("gone", False, "notFound")]
    assert content(done.table) == {"two": (2, "y")}


def test_delete_where_keeps_unknown(spark):
    table = spark.createDataFrame([("a", 1, None), ("b", None, None), ("c", 5, None)], ROWS)
    assert set(content(writes.delete_where(table, "a < 3"))) == {"b", "c"}
    with pytest.raises(InvalidArgument):
        writes.delete_where(table, "  ")


def test_merge_documents(spark):
    left = spark.createDataFrame([(1, "one", None, "insert", "t", 1)], "key int, id string, score double, op string, title string, n int")
    right = spark.createDataFrame([(1, "", None, "update", "Updated")], "key int, id string, score double, op string, title string")
    row = writes.merge_documents(left, right).first()
    assert (row["id"], row["title"], row["n"], row["op"], row["score"]) == ("one", "Updated", 1, "update", None)


def _replay_in_order(stored, changes):
    """Row-by-row replay of a small fixture."""
    state, ok = {k: dict(v) for k, v in stored.items()}, {}
    for seq, key, op, a, b, named in sorted(changes):
        here = key in state
        ok[seq] = {"insert": not here, "update": here, "delete": here, "upsert": True}[op]
        if not ok[seq]:
            continue
        if op == "delete":
            del state[key]
        elif op == "update":
            state[key].update({n: v for n, v in (("a", a), ("b", b)) if n in named})
        else:
            state[key] = {"a": a, "b": b}
    return {k: (v["a"], v["b"]) for k, v in state.items()}, ok


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("chunks", [1, 13])
def test_change_replay_equals_row_by_row(spark, seed, chunks):
    rng = random.Random(seed)
    stored = {f"k{i}": {"a": i, "b": "s"} for i in range(0, 12, 2)}
    changes = []
    for seq in range(400):
        key = "k0" if rng.random() < 0.4 else f"k{rng.randrange(12)}"
        named = rng.sample(["a", "b"], rng.randrange(3))
        op = rng.choice(["insert", "update", "update", "upsert", "delete"])
        changes.append((seq, key, op, rng.choice([None, rng.randrange(99)]), rng.choice([None, "z"]), named))
    state, ok = _replay_in_order(stored, changes)
    table = spark.createDataFrame([(k, v["a"], v["b"]) for k, v in stored.items()], ROWS)
    frame = spark.createDataFrame(changes, "seq long, id string, op string, a int, b string, _set array<string>")
    done = replay.apply_changes(table, frame, chunks=chunks)
    assert content(done.table) == state
    assert {r["seq"]: r["ok"] for r in done.results.collect()} == ok
    live = done.rows.where("NOT _deleted").drop("_deleted")
    assert content(live).items() <= state.items()


def test_one_id_on_one_date_is_cut_into_chunks(spark):
    rng = random.Random(9)
    ops = ["insert", "update", "upsert", "delete"]
    changes = [(seq, "k0", rng.choice(ops), seq, "z", ["a"]) for seq in range(300)]
    state, ok = _replay_in_order({}, changes)
    table = spark.createDataFrame([], ROWS)
    frame = spark.createDataFrame(changes, "seq long, id string, op string, a int, b string, _set array<string>")
    frame = frame.selectExpr("*", "date'2024-01-01' AS day").repartition(7)
    sizes = [r["count"] for r in replay._chunked(frame, ("day", "seq"), 10).groupBy("_chunk").count().collect()]
    assert len(sizes) >= 8 and max(sizes) <= 60
    done = replay.apply_changes(table, frame, order=("day", "seq"), chunks=10)
    assert content(done.table) == state
    assert {r["seq"]: r["ok"] for r in done.results.collect()} == ok


def test_browse(spark):
    rows = [("a", 3, "t"), ("b", 2, "u"), ("c", 1, "v")]
    docs = spark.createDataFrame(rows, ROWS)
    page = reads.browse(docs, "a >= 2 AND a <= 3", limit=1, output=["b"]).collect()
    assert [tuple(r) for r in page] == [("a", "t", True)]
    full = reads.browse(docs, " ", limit=10).collect()
    assert len(full) == 3 and not full[0]["limit_reached"]
    assert reads.browse(docs, limit=100_000).count() == 3
    for limit in (0, -1, 100_001):
        with pytest.raises(InvalidArgument):
            reads.browse(docs, limit=limit)
    with pytest.raises(Exception, match="missing_field"):
        reads.browse(docs, "missing_field = 1").collect()


def test_projection_hides_vectors(spark):
    schema = Schema("s", (Field("title", "string"), Field("embedding", "vectorFloat32", dim=2)))
    docs = spark.createDataFrame([("a", "t", [1.0, 0.0])], schema.struct())
    assert reads.project(docs).columns == ["id", "title"]
    assert reads.project(docs, ["embedding"]).columns == ["id"]
    assert reads.project(docs, ["embedding"], include_vector=True).columns == ["id", "embedding"]
    with pytest.raises(InvalidArgument):
        reads.project(docs, ["nope"])


def test_fetch(spark, table):
    asked = spark.createDataFrame([(0, "one"), (1, "missing"), (2, "one")], "pos int, id string")
    assert set(content(reads.fetch(table, asked))) == {"one"}
    assert reads.fetch(table, asked.where("false")).count() == 0
    got = [(r["id"], r["found"], r["a"]) for r in reads.fetch_ordered(table, asked).orderBy("pos").collect()]
    assert got == [("one", True, 1), ("missing", False, None), ("one", True, 1)]


SCHEMA = Schema(
    "validation",
    (
        Field("title", "string"),
        Field("subtitle", "string", nullable=True),
        Field("embedding", "vectorFloat32", dim=2),
        Field("bits", "vectorBinary32", dim=32),
        Field("n", "uint32", nullable=True),
        Field("q", "vectorInt4", nullable=True, dim=2),
    ),
)
BATCH = (
    "id string, title string, subtitle string, embedding array<float>, bits binary, n long, "
    "q array<tinyint>, missing string, _set array<string>"
)


def test_violations(spark, pairs):
    named = ["title", "subtitle", "embedding", "bits"]
    rows = [
        ("valid", "Swift", None, [1.0, 0.0], bytearray(4), None, None, None, named),
        ("", None, None, None, None, None, None, None, []),
        ("unknown", None, None, None, None, None, None, "x", ["missing"]),
        ("null", None, None, None, None, None, None, None, ["title"]),
        ("dim", None, None, [1.0], bytearray(3), None, None, None, ["embedding", "bits"]),
        ("range", None, None, None, None, 2**32, [8, 0], None, ["n", "q"]),
    ]
    found = validation.violations(spark.createDataFrame(rows, BATCH), SCHEMA)
    assert pairs(found, "id", "field", "rule") == sorted(
        [
            ("", "id", "blankId"),
            ("unknown", "missing", "unknownField"),
            ("null", "title", "notNullable"),
            ("dim", "embedding", "dimension"),
            ("dim", "bits", "dimension"),
            ("range", "n", "range"),
            ("range", "q", "range"),
        ],
        key=repr,
    )
    wrong = spark.createDataFrame([("a", 5)], "id string, title int")
    assert pairs(validation.violations(wrong, SCHEMA), "field", "rule") == [("title", "typeMismatch")]
    assert pairs(validation.rule_counts(found.where("id = 'dim'")), "field", "rule", "n") == [
        ("bits", "dimension", 1),
        ("embedding", "dimension", 1),
    ]
