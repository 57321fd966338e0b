"""Reads, look-ups, writes, change replay, schema changes and table maintenance."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.common import load
from plumbline.functions.sizing import shared_dir
from plumbline.operators import changes as replay
from plumbline.operators import reads, validation, writes
from plumbline.sources.schema import Field, Schema
from plumbline.sources.table import Table
from plumbline.streaming.change_stream import ChangeStream
from plumbline.streaming.keyed_changes import CLOSE, KeyedChanges

def parts(spark, sf_dir):
    return load(spark, sf_dir, "part").withColumnRenamed("p_partkey", "id")


def orders(spark, sf_dir):
    return load(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "id")


def accounts(spark, sf_dir):
    """Customers as documents."""
    return load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), "c_acctbal", "c_mktsegment")


def order_batch(spark, sf_dir):
    """Every order as a write to its customer: ids repeat, and urgent orders name ids that the
    table does not hold."""
    placed = load(spark, sf_dir, "orders")
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    segment = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    return placed.select(
        F.col("o_orderkey").alias("pos"),
        F.when(urgent, -F.col("o_custkey")).otherwise(F.col("o_custkey")).alias("id"),
        F.col("o_totalprice").alias("c_acctbal"),
        segment.alias("c_mktsegment"),
    )


def named_batch(spark, sf_dir):
    """The same writes, each naming the fields it carries by the order's status."""
    status = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("pos"), "o_orderstatus")
    carried = (
        F.when(F.col("o_orderstatus") == "F", F.array(F.lit("c_acctbal")))
        .when(F.col("o_orderstatus") == "O", F.array(F.lit("c_mktsegment")))
        .otherwise(F.array(F.lit("c_acctbal"), F.lit("c_mktsegment")))
    )
    return order_batch(spark, sf_dir).join(status.withColumn("_set", carried), "pos").drop("o_orderstatus")


def project(spark, sf_dir):
    docs = load(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "id")
    return reads.project(docs, ["label", "embedding"], vectors=("embedding",))


def browse(spark, sf_dir):
    return reads.browse(
        orders(spark, sf_dir),
        "o_totalprice >= 100000 AND o_orderstatus = 'F'",
        output=["o_custkey", "o_totalprice"],
    )


def filter_range(spark, sf_dir):
    rows = reads.filtered(orders(spark, sf_dir), "o_totalprice BETWEEN 50000 AND 90000")
    return reads.project(rows, ["o_custkey", "o_totalprice"])


def filter_like(spark, sf_dir):
    rows = reads.filtered(parts(spark, sf_dir), "p_name LIKE '%bolt' OR p_brand LIKE 'Brand#1_'")
    return reads.project(rows, ["p_name", "p_brand"])


def fetch_ids(spark, sf_dir):
    asked = load(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"))
    return reads.fetch(accounts(spark, sf_dir), asked)


def fetch_ordered(spark, sf_dir):
    """Every delivered part; returned ones are asked for by ids that do not exist."""
    part = F.when(F.col("l_returnflag") == "R", -F.col("l_partkey")).otherwise(F.col("l_partkey"))
    asked = load(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("pos"), part.alias("id")
    )
    return reads.fetch_ordered(parts(spark, sf_dir).select("id", "p_name", "p_size"), asked)


def _codes(results):
    return results.select("pos", "id", "ok", "error_code")


def insert_results(spark, sf_dir):
    return _codes(writes.insert(accounts(spark, sf_dir), order_batch(spark, sf_dir)).results)


def insert_table(spark, sf_dir):
    return writes.insert(accounts(spark, sf_dir), order_batch(spark, sf_dir)).table


def update_merge(spark, sf_dir):
    return writes.update(accounts(spark, sf_dir), named_batch(spark, sf_dir)).table


def update_results(spark, sf_dir):
    return _codes(writes.update(accounts(spark, sf_dir), named_batch(spark, sf_dir)).results)


def upsert(spark, sf_dir):
    return writes.upsert(accounts(spark, sf_dir), order_batch(spark, sf_dir)).table


def delete_ids(spark, sf_dir):
    asked = order_batch(spark, sf_dir).select("pos", "id")
    return _codes(writes.delete_ids(accounts(spark, sf_dir), asked).results)


def delete_ids_table(spark, sf_dir):
    closed = load(spark, sf_dir, "orders").where("o_totalprice > 450000 AND o_orderstatus = 'F'")
    asked = closed.select(F.col("o_orderkey").alias("pos"), F.col("o_custkey").alias("id"))
    return writes.delete_ids(accounts(spark, sf_dir), asked).table


def delete_where(spark, sf_dir):
    docs = accounts(spark, sf_dir)
    rated = docs.withColumn("c_acctbal", F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_acctbal")))
    return writes.delete_where(rated, "c_acctbal < 5000")


def write_summary(spark, sf_dir):
    return writes.summary(writes.insert(accounts(spark, sf_dir), order_batch(spark, sf_dir)).results)


def event_accounts(spark, sf_dir):
    return load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("value"), F.col("c_mktsegment").alias("kind")
    )


# How each event type acts on its user's document.
EVENT_OPERATIONS = {
    "signup": "insert",
    "click": "update",
    "view": "upsert",
    "error": "delete",
    "purchase": "update",
}


def event_changes(events, *more):
    """Events as changes; a purchase carries only its value. Two in five users are named by an
    id that no document has at first."""
    known = F.when(F.pmod("user_id", F.lit(5)) >= 2, F.col("user_id")).otherwise(-F.col("user_id"))
    kind = F.col("event_type")
    op = F.coalesce(*[F.when(kind == k, F.lit(v)) for k, v in EVENT_OPERATIONS.items()])
    carried = F.when(kind == "purchase", F.array(F.lit("value"))).otherwise(
        F.array(F.lit("value"), F.lit("kind"))
    )
    return events.select(
        F.col("event_id").alias("seq"),
        known.alias("id"),
        op.alias("op"),
        "value",
        kind.alias("kind"),
        carried.alias("_set"),
        *more,
    )


def changes_apply(spark, sf_dir):
    done = replay.apply_changes(
        event_accounts(spark, sf_dir), event_changes(load(spark, sf_dir, "events")), chunks=8
    )
    return done.table


def changes_by_day(spark, sf_dir):
    """Changes in the order of their day first; a day of one id is cut into several chunks."""
    day = F.col("ts").cast("date").alias("day")
    changes = event_changes(load(spark, sf_dir, "events"), day)
    done = replay.apply_changes(event_accounts(spark, sf_dir), changes, order=("day", "seq"), chunks=64)
    return done.results.select("seq", "id", "op", "ok", "error_code")


def changes_results(spark, sf_dir):
    done = replay.apply_changes(event_accounts(spark, sf_dir), event_changes(load(spark, sf_dir, "events")))
    return done.results.select("seq", "id", "op", "ok", "error_code")


def changes_stream(spark, sf_dir):
    """The events arrive as a file stream and are logged; the log is replayed."""
    root = f"{shared_dir(spark).rstrip('/')}/plumbline/stream-{uuid.uuid4().hex}"
    shape = load(spark, sf_dir, "events").schema
    # The brackets make a pattern of the path, which fits a file as well as a folder of them.
    source = spark.readStream.schema(shape).parquet(f"{sf_dir}/[e]vents.parquet")
    flow = event_changes(source)
    stream = ChangeStream(spark, f"{root}/log")
    stream.start(flow, f"{root}/checkpoint").awaitTermination()
    return stream.current(event_accounts(spark, sf_dir), flow.schema).table


# The events of `changes_keyed` arrive in so many batches; some come one batch late, some three.
ARRIVALS = 5
# Ids whose states are stored together.
IDS_A_BUCKET = 256


def arriving(events):
    """Events with the batch they arrive in, and the width of a batch in microseconds."""
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(at), F.max(at)).first()
    width = ((high or 0) - (low or 0)) // ARRIVALS + 1
    lag = F.when(F.col("event_id") % 50 == 7, 3).when(F.col("event_id") % 10 == 3, 1).otherwise(0)
    batch = F.floor((at - F.lit(low or 0)) / width) + lag
    return events.withColumn("batch", F.least(batch, F.lit(ARRIVALS + 1)).cast("int")), width


def changes_keyed(spark, sf_dir):
    """What becomes of every event when they stream in out of order, each id by its own state."""
    root = f"{shared_dir(spark).rstrip('/')}/plumbline/stream-{uuid.uuid4().hex}"
    events, width = arriving(load(spark, sf_dir, "events"))
    changes = event_changes(events, "ts", "batch")
    stored = event_accounts(spark, sf_dir).select(
        F.lit(-1).cast("long").alias("seq"), "id", F.lit("upsert").alias("op"), "value", "kind",
        F.lit(None).cast("array<string>").alias("_set"), F.timestamp_seconds(F.lit(0)).alias("ts"),
    )
    ids = changes.select("id").union(stored.select("id")).distinct()
    last = ids.withColumns({"seq": F.lit(-2).cast("long"), "op": F.lit(CLOSE), "ts": F.timestamp_seconds(F.lit(0))})
    shape = stored.schema
    fields = T.StructType([shape["value"], shape["kind"]])
    stream = KeyedChanges(fields, width, buckets=max(64, ids.count() // IDS_A_BUCKET))
    steps = [stored, *(changes.where(F.col("batch") == n).drop("batch") for n in range(ARRIVALS + 2)), last]
    for step in steps:
        missing = [c for c in shape.names if c not in step.columns]
        step = step.withColumns({c: F.lit(None).cast(shape[c].dataType) for c in missing})
        step.select(*(F.col(c).cast(shape[c].dataType) for c in shape.names)).write.mode("append").parquet(f"{root}/in")
        flow = spark.readStream.schema(shape).parquet(f"{root}/in")
        stream.start(flow, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return stream.settled(spark, f"{root}/out").where("seq >= 0").select("seq", "id", "op", "outcome")


def _loose_batch(spark, sf_dir):
    """Vectors and label facts joined loosely: gaps, odd lengths, undeclared fields."""
    docs = load(spark, sf_dir, "documents")
    facts = load(spark, sf_dir, "labels")
    stored = load(spark, sf_dir, "embeddings")
    cut = F.when(F.col("label") == 3, F.slice("embedding", 1, 60)).otherwise(F.col("embedding"))
    indices = F.array("n_chars", F.col("n_chars") + F.col("label") - 4)
    sparse = F.struct(
        indices.cast("array<bigint>").alias("indices"),
        F.array(F.lit(1.0), F.lit(2.0)).cast("array<float>").alias("values"),
    )
    joined = docs.join(facts, "doc_id", "left").join(stored, docs["doc_id"] == stored["vec_id"], "left")
    return joined.select(
        F.when(F.col("lang") != "es", docs["doc_id"].cast("string")).otherwise(F.lit(" ")).alias("id"),
        "quality",
        cut.alias("embedding"),
        "n_chars",
        (F.col("n_chars") * 1_000_000).alias("weight"),
        F.when(F.col("label").isNotNull(), sparse).alias("profile"),
        "source",
    )


LOOSE_SCHEMA = Schema(
    "loose",
    (
        Field("quality", "int32"),
        Field("embedding", "vectorFloat32", nullable=True, dim=64),
        Field("n_chars", "int32"),
        Field("weight", "uint32"),
        Field("profile", "sparseVectorFloat32", nullable=True),
    ),
)


def validate_batch(spark, sf_dir):
    return validation.violations(_loose_batch(spark, sf_dir), LOOSE_SCHEMA)


def validate_counts(spark, sf_dir):
    return validation.rule_counts(validation.violations(_loose_batch(spark, sf_dir), LOOSE_SCHEMA))


def merge_docs(spark, sf_dir):
    """Customers overlaid with what their orders say."""
    left = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"),
        F.col("c_name").alias("id"),
        F.lit(0.5).alias("score"),
        F.lit("insert").alias("op"),
        "c_acctbal",
        "c_mktsegment",
    )
    placed = load(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.max("o_totalprice").alias("top"), F.count("*").alias("n")
    )
    busy = F.col("n") > 10
    right = placed.select(
        F.col("o_custkey").alias("key"),
        F.when(busy, F.concat(F.lit("busy-"), F.col("o_custkey"))).otherwise("").alias("id"),
        F.when(busy, F.col("n") / 100).alias("score"),
        F.lit("update").alias("op"),
        F.col("top").alias("c_acctbal"),
        F.lit(None).cast("string").alias("c_mktsegment"),
        F.when(busy, F.array(F.lit("c_acctbal"), F.lit("c_mktsegment")))
        .otherwise(F.array(F.lit("c_acctbal")))
        .alias("_set"),
    )
    return writes.merge_documents(left, right)


PART_SCHEMA = Schema(
    "part",
    (
        Field("p_name", "string"),
        Field("p_brand", "string"),
        Field("p_size", "int32"),
        Field("p_retailprice", "double"),
    ),
)


def _table_path(spark):
    return f"{shared_dir(spark).rstrip('/')}/plumbline/table-{uuid.uuid4().hex}"


def part_table(spark, sf_dir):
    return Table.create(spark, _table_path(spark), PART_SCHEMA, parts(spark, sf_dir))


def _supply(spark, sf_dir):
    """Parts never delivered in volume, by id, and repriced ones."""
    sold = load(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").cast("string").alias("id")).agg(
        F.sum("l_quantity").alias("quantity"), F.max("l_extendedprice").alias("top")
    )
    return sold


def stats(spark, sf_dir):
    table = part_table(spark, sf_dir).delete_where("p_size < 5")
    return table.statistics()


def compact_roundtrip(spark, sf_dir):
    table = part_table(spark, sf_dir)
    sold = _supply(spark, sf_dir).where("quantity > 500")
    batch = sold.select(
        F.col("id").cast("long").alias("pos"),
        "id",
        F.col("top").alias("p_retailprice"),
        F.array(F.lit("p_retailprice")).alias("_set"),
    )
    table, _ = table.update(batch)
    table = table.delete_where("p_brand = 'Brand#7'").compact()
    return Table.open(spark, table.path).scan()


def schema_evolve(spark, sf_dir):
    table = part_table(spark, sf_dir)
    table = table.add_column(Field("p_tax", "double"), "p_retailprice * 0.1")
    table = table.add_column(Field("p_note", "string", nullable=True))
    table = table.alter_column("p_tax", new_name="p_duty").alter_column("p_size", vtype="int64")
    table = table.drop_column("p_brand").delete_where("p_size > 45")
    return Table.open(spark, table.path).scan().withColumn("p_duty", F.round("p_duty", 6))


QUERIES = {
    "project": project,
    "browse": browse,
    "filter_range": filter_range,
    "filter_like": filter_like,
    "fetch_ids": fetch_ids,
    "fetch_ordered": fetch_ordered,
    "insert_results": insert_results,
    "insert_table": insert_table,
    "update_merge": update_merge,
    "update_results": update_results,
    "upsert": upsert,
    "delete_ids": delete_ids,
    "delete_ids_table": delete_ids_table,
    "delete_where": delete_where,
    "write_summary": write_summary,
    "changes_apply": changes_apply,
    "changes_results": changes_results,
    "changes_by_day": changes_by_day,
    "changes_stream": changes_stream,
    "changes_keyed": changes_keyed,
    "validate_batch": validate_batch,
    "validate_counts": validate_counts,
    "merge_docs": merge_docs,
    "stats": stats,
    "compact_roundtrip": compact_roundtrip,
    "schema_evolve": schema_evolve,
}

_TABLE = "t AS (SELECT c_custkey AS id, c_acctbal, c_mktsegment FROM customer)"
_BATCH = (
    "b AS (SELECT o_orderkey AS pos, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN -o_custkey "
    "ELSE o_custkey END AS id, o_totalprice AS c_acctbal, "
    "CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS c_mktsegment, "
    "o_orderstatus <> 'O' AS has_bal, o_orderstatus <> 'F' AS has_seg FROM orders)"
)
_INSERTED = """
    j AS (SELECT b.pos, b.id, b.c_acctbal, b.c_mktsegment,
            t.id IS NULL AND row_number() OVER (PARTITION BY b.id ORDER BY b.pos) = 1 AS ok
          FROM b LEFT JOIN t ON b.id = t.id)"""
_CHANGES = """
    t AS (SELECT c_custkey AS id, c_acctbal AS value, c_mktsegment AS kind FROM customer),
    e AS (SELECT event_id AS seq, CASE WHEN user_id % 5 >= 2 THEN user_id ELSE -user_id END AS id, value, event_type AS kind,
            CASE event_type WHEN 'signup' THEN 'insert' WHEN 'view' THEN 'upsert' WHEN 'error' THEN 'delete'
              ELSE 'update' END AS op,
            row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events),
    w AS (
      SELECT i.id, 0::BIGINT AS n, t.id IS NOT NULL AS here, t.value, t.kind, true AS ok, NULL::BIGINT AS seq,
        NULL::VARCHAR AS op
      FROM (SELECT id FROM e UNION SELECT id FROM t) i LEFT JOIN t ON i.id = t.id
      UNION ALL
      SELECT w.id, e.n,
        CASE e.op WHEN 'delete' THEN false WHEN 'update' THEN w.here ELSE true END,
        CASE WHEN e.op = 'upsert' OR (e.op = 'insert' AND NOT w.here) OR (e.op = 'update' AND w.here)
          THEN e.value ELSE w.value END,
        CASE WHEN e.op = 'upsert' OR (e.op = 'insert' AND NOT w.here)
          OR (e.op = 'update' AND w.here AND e.kind <> 'purchase') THEN e.kind ELSE w.kind END,
        CASE e.op WHEN 'upsert' THEN true WHEN 'insert' THEN NOT w.here ELSE w.here END, e.seq, e.op
      FROM w JOIN e ON e.id = w.id AND e.n = w.n + 1)"""
_REPLAYED = f"""
    WITH RECURSIVE {_CHANGES}
    SELECT id, value, kind FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY n DESC) AS last FROM w)
    WHERE last = 1 AND here"""
# An event is late when its id has applied what is as new, after the batches before.
_KEYED = f"""
    WITH RECURSIVE t AS (SELECT c_custkey AS id FROM customer),
    b AS (SELECT min(epoch_us(ts)) AS low, (max(epoch_us(ts)) - min(epoch_us(ts))) // {ARRIVALS} + 1 AS width FROM events),
    a AS (SELECT event_id AS seq, CASE WHEN user_id % 5 >= 2 THEN user_id ELSE -user_id END AS id, epoch_us(ts) AS us, width,
            CASE event_type WHEN 'signup' THEN 'insert' WHEN 'view' THEN 'upsert' WHEN 'error' THEN 'delete'
              ELSE 'update' END AS op,
            least((epoch_us(ts) - low) // width + CASE WHEN event_id % 50 = 7 THEN 3 WHEN event_id % 10 = 3 THEN 1 ELSE 0 END,
              {ARRIVALS + 1}) AS batch FROM events, b),
    l AS (SELECT *, us <= coalesce(max(us) OVER before, -1) - width AS late FROM a
          WINDOW before AS (PARTITION BY id ORDER BY batch RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    e AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY us, seq) AS n FROM l WHERE NOT late),
    w AS (SELECT i.id, 0::BIGINT AS n, t.id IS NOT NULL AS here, NULL::BIGINT AS seq, NULL::BOOLEAN AS ok
          FROM (SELECT id FROM e UNION SELECT id FROM t) i LEFT JOIN t ON i.id = t.id
          UNION ALL
          SELECT w.id, e.n, CASE e.op WHEN 'delete' THEN false WHEN 'update' THEN w.here ELSE true END, e.seq,
            CASE e.op WHEN 'upsert' THEN true WHEN 'insert' THEN NOT w.here ELSE w.here END
          FROM w JOIN e ON e.id = w.id AND e.n = w.n + 1)
    SELECT l.seq, l.id, l.op, CASE WHEN late THEN 'late' WHEN ok THEN 'ok' WHEN op = 'insert' THEN 'alreadyExists'
      ELSE 'notFound' END AS outcome FROM l LEFT JOIN w ON w.seq = l.seq"""
_LOOSE = """
    b AS (SELECT CASE WHEN lang <> 'es' THEN d.doc_id::VARCHAR ELSE ' ' END AS id, quality, label, n_chars,
            vec_id IS NOT NULL AS stored
          FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id LEFT JOIN embeddings e ON d.doc_id = e.vec_id),
    v AS (SELECT id, 'id' AS field, 'blankId' AS rule FROM b WHERE trim(id) = ''
          UNION ALL SELECT id, 'quality', 'notNullable' FROM b WHERE quality IS NULL
          UNION ALL SELECT id, 'embedding', 'dimension' FROM b WHERE stored AND label = 3
          UNION ALL SELECT id, 'n_chars', 'typeMismatch' FROM b WHERE n_chars IS NOT NULL
          UNION ALL SELECT id, 'weight', 'range' FROM b WHERE n_chars * 1000000 > 4294967295
          UNION ALL SELECT id, 'profile', 'sparse' FROM b WHERE stored AND label <= 4
          UNION ALL SELECT id, 'source', 'unknownField' FROM b)"""

ORACLES = {
    "project": "SELECT vec_id AS id, label FROM embeddings",
    "browse": """
        SELECT o_orderkey AS id, o_custkey, o_totalprice, count(*) OVER () = 50 AS limit_reached FROM (
          SELECT * FROM orders WHERE o_totalprice >= 100000 AND o_orderstatus = 'F' ORDER BY o_orderkey LIMIT 50)""",
    "filter_range": "SELECT o_orderkey AS id, o_custkey, o_totalprice FROM orders "
    "WHERE o_totalprice BETWEEN 50000 AND 90000",
    "filter_like": "SELECT p_partkey AS id, p_name, p_brand FROM part "
    "WHERE p_name LIKE '%bolt' OR p_brand LIKE 'Brand#1_'",
    "fetch_ids": "SELECT c_custkey AS id, c_acctbal, c_mktsegment FROM customer "
    "WHERE c_custkey IN (SELECT o_custkey FROM orders)",
    "fetch_ordered": """
        WITH l AS (SELECT l_orderkey * 100 + l_linenumber AS pos,
          CASE WHEN l_returnflag = 'R' THEN -l_partkey ELSE l_partkey END AS id FROM lineitem)
        SELECT pos, id, p_partkey IS NOT NULL AS found, p_name, p_size FROM l LEFT JOIN part ON id = p_partkey""",
    "insert_results": f"WITH {_TABLE}, {_BATCH}, {_INSERTED} "
    "SELECT pos, id, ok, CASE WHEN NOT ok THEN 'alreadyExists' END AS error_code FROM j",
    "insert_table": f"WITH {_TABLE}, {_BATCH}, {_INSERTED} "
    "SELECT * FROM t UNION ALL SELECT id, c_acctbal, c_mktsegment FROM j WHERE ok",
    "update_merge": f"""
        WITH {_TABLE}, {_BATCH},
        x AS (SELECT id, arg_max(c_acctbal, pos) AS bal FROM b WHERE has_bal GROUP BY id),
        y AS (SELECT id, max(pos) AS pos FROM b WHERE has_seg GROUP BY id)
        SELECT t.id, coalesce(x.bal, t.c_acctbal) AS c_acctbal,
          CASE WHEN y.id IS NULL THEN t.c_mktsegment ELSE b.c_mktsegment END AS c_mktsegment
        FROM t LEFT JOIN x ON t.id = x.id LEFT JOIN y ON t.id = y.id LEFT JOIN b ON b.pos = y.pos""",
    "update_results": f"""
        WITH {_TABLE}, {_BATCH}
        SELECT b.pos, b.id, t.id IS NOT NULL AS ok, CASE WHEN t.id IS NULL THEN 'notFound' END AS error_code
        FROM b LEFT JOIN t ON b.id = t.id""",
    "upsert": f"""
        WITH {_TABLE}, {_BATCH},
        l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos DESC) AS n FROM b) WHERE n = 1)
        SELECT id, c_acctbal, c_mktsegment FROM l
        UNION ALL SELECT * FROM t WHERE id NOT IN (SELECT id FROM b)""",
    "delete_ids": f"""
        WITH {_TABLE}, {_BATCH},
        j AS (SELECT b.pos, b.id, t.id IS NOT NULL AND row_number() OVER (PARTITION BY b.id ORDER BY b.pos) = 1 AS ok
              FROM b LEFT JOIN t ON b.id = t.id)
        SELECT pos, id, ok, CASE WHEN NOT ok THEN 'notFound' END AS error_code FROM j""",
    "delete_ids_table": "SELECT c_custkey AS id, c_acctbal, c_mktsegment FROM customer "
    "WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000 AND o_orderstatus = 'F')",
    "delete_where": """
        WITH t AS (SELECT c_custkey AS id, CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_acctbal END AS c_acctbal,
          c_mktsegment FROM customer)
        SELECT * FROM t WHERE c_acctbal >= 5000 OR c_acctbal IS NULL""",
    "write_summary": f"WITH {_TABLE}, {_BATCH}, {_INSERTED} "
    "SELECT count(*) FILTER (ok) AS succeeded, count(*) FILTER (NOT ok) AS failed FROM j",
    "changes_apply": _REPLAYED,
    "changes_results": f"""
        WITH RECURSIVE {_CHANGES}
        SELECT seq, id, op, ok, CASE WHEN ok THEN NULL WHEN op = 'insert' THEN 'alreadyExists'
          ELSE 'notFound' END AS error_code FROM w WHERE n > 0""",
    "changes_by_day": f"""
        WITH RECURSIVE {_CHANGES.replace("ORDER BY event_id", "ORDER BY ts::DATE, event_id")}
        SELECT seq, id, op, ok, CASE WHEN ok THEN NULL WHEN op = 'insert' THEN 'alreadyExists'
          ELSE 'notFound' END AS error_code FROM w WHERE n > 0""",
    "changes_stream": _REPLAYED,
    "changes_keyed": _KEYED,
    "validate_batch": f"WITH {_LOOSE} SELECT id, field, rule FROM v",
    "validate_counts": f"WITH {_LOOSE} SELECT field, rule, count(*) AS n FROM v GROUP BY field, rule",
    "merge_docs": """
        WITH r AS (SELECT o_custkey AS key, max(o_totalprice) AS top, count(*) AS n FROM orders GROUP BY o_custkey)
        SELECT c_custkey AS key, CASE WHEN r.n > 10 THEN 'busy-' || c_custkey ELSE c_name END AS id,
          CASE WHEN r.n > 10 THEN r.n / 100 ELSE 0.5::DOUBLE END AS score,
          CASE WHEN r.n IS NULL THEN 'insert' ELSE 'update' END AS op,
          coalesce(r.top, c_acctbal) AS c_acctbal,
          CASE WHEN r.n > 10 THEN NULL ELSE c_mktsegment END AS c_mktsegment
        FROM customer LEFT JOIN r ON c_custkey = r.key""",
    "stats": "SELECT count(*) AS documents FROM part WHERE p_size >= 5",
    "compact_roundtrip": """
        WITH s AS (SELECT l_partkey, sum(l_quantity) AS quantity, max(l_extendedprice) AS top
                   FROM lineitem GROUP BY l_partkey)
        SELECT p_partkey::VARCHAR AS id, p_name, p_brand, p_size,
          CASE WHEN s.quantity > 500 THEN s.top ELSE p_retailprice END AS p_retailprice
        FROM part LEFT JOIN s ON p_partkey = l_partkey WHERE p_brand <> 'Brand#7'""",
    "schema_evolve": """
        SELECT p_partkey::VARCHAR AS id, p_name, p_size::BIGINT AS p_size, p_retailprice,
          round(p_retailprice * 0.1::DOUBLE, 6) AS p_duty, NULL::VARCHAR AS p_note
        FROM part WHERE p_size <= 45""",
}
