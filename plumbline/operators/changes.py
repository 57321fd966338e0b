"""Replay of a change table: inserts, updates, upserts and deletes in sequence order."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.errors import AlreadyExists, InvalidArgument, NotFound
from plumbline.functions.sizing import broadcast_if_small, materialize
from plumbline.operators.writes import stored_ids

# The operations a change row may carry.
OPERATIONS = ("insert", "update", "upsert", "delete")

ROWS_PER_CHUNK = 1_000_000


@dataclass(frozen=True)
class Applied:
    """``results`` has one row per change; ``rows`` are the changed documents with
    ``_deleted``; ``table`` is the whole next table."""

    results: DataFrame
    rows: DataFrame
    table: DataFrame


def _chunked(changes: DataFrame, order: tuple[str, ...], chunks: int | None) -> DataFrame:
    """Add ``_chunk``: ranges of the whole order with similar numbers of rows.

    One busy id, also with a single date, gets as many of the chunks as its share of the rows.
    """
    if chunks is None:
        chunks = -(-changes.count() // ROWS_PER_CHUNK)
    if chunks <= 1:
        return changes.withColumn("_chunk", F.lit(0))
    ranged = changes.repartitionByRange(chunks, *order).withColumn("_chunk", F.spark_partition_id())
    # Stored, as ranges are sampled anew whenever they are asked for.
    return materialize(ranged, "chunked-changes")


def judge(
    table: DataFrame,
    changes: DataFrame,
    *,
    order: tuple[str, ...] = ("seq",),
    chunks: int | None = None,
) -> DataFrame:
    """The changes with ``ok``: did the operation find the state it needs?

    Whether a document exists before a change follows from the last insert, upsert or
    delete before it. That is looked up inside a chunk of the order, then carried from
    earlier chunks, so the history of one id is never sorted in one piece.
    """
    keyed = _chunked(changes, order, chunks)
    leaves = F.when(F.col("op").isin("insert", "upsert"), True).when(F.col("op") == "delete", False)
    keyed = keyed.withColumn("_leaves", leaves)

    ends = keyed.groupBy("id", "_chunk").agg(
        F.max(F.when(F.col("_leaves").isNotNull(), F.struct(*order, "_leaves"))).alias("e")
    )
    ends = materialize(ends, "chunk-ends")
    held = stored_ids(table, ends).withColumn("_stored", F.lit(True))
    earlier = Window.partitionBy("id").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        ends.join(held, "id", "left")
        .withColumn("_before", F.last(F.col("e._leaves"), ignorenulls=True).over(earlier))
        .select(
            "id", "_chunk", F.coalesce("_before", "_stored", F.lit(False)).alias("_carried")
        )
    )
    inside = (
        Window.partitionBy("id", "_chunk")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = keyed.withColumn("_before", F.last("_leaves", ignorenulls=True).over(inside))
    before = F.coalesce("_before", "_carried")
    ok = (
        F.when(F.col("op") == "insert", ~before)
        .when(F.col("op").isin("update", "delete"), before)
        .when(F.col("op") == "upsert", F.lit(True))
        .otherwise(F.lit(False))
    )
    joined = placed.join(carried, ["id", "_chunk"])
    return joined.withColumn("ok", ok).drop("_before", "_carried", "_chunk", "_leaves")


def apply_changes(
    table: DataFrame,
    changes: DataFrame,
    *,
    order: tuple[str, ...] = ("seq",),
    chunks: int | None = None,
) -> Applied:
    """Replay ``changes (id, op, *order, *fields, [_set])`` over ``table``.

    ``order`` must be unique within an id. Insert and upsert set every field, update only
    those in ``_set`` (all without it). The last value of each field is a maximum by
    sequence, which combines before the shuffle.
    """
    skip = {"id", "op", "_set", *order}
    names = [c for c in changes.columns if c not in skip]
    unknown = [n for n in names if n not in table.columns]
    if unknown:
        raise InvalidArgument(f"unknown fields {unknown}")
    judged = judge(table, changes, order=order, chunks=chunks)
    results = judged.select(
        *order,
        "id",
        "op",
        "ok",
        F.when(~F.col("ok") & (F.col("op") == "insert"), AlreadyExists.code)
        .when(~F.col("ok") & F.col("op").isin("update", "delete"), NotFound.code)
        .when(~F.col("ok"), InvalidArgument.code)
        .alias("error_code"),
    )
    whole = F.col("op").isin("insert", "upsert")
    done = judged.where("ok")
    fields = []
    for field in table.schema.fields:
        if field.name == "id":
            continue
        if field.name in names:
            named = F.array_contains("_set", field.name) if "_set" in changes.columns else F.lit(True)
            sets = whole | ((F.col("op") == "update") & named)
            value = F.col(field.name).cast(field.dataType)
        else:
            sets, value = whole, F.lit(None).cast(field.dataType)
        fields.append(
            F.max(F.when(sets, F.struct(*order, value.alias("v")))).alias(f"_new_{field.name}")
        )
    leaves = F.when(whole, True).when(F.col("op") == "delete", False)
    folded = done.groupBy("id").agg(
        F.max(F.when(leaves.isNotNull(), F.struct(*order, leaves.alias("v")))).alias("_reset"),
        *fields,
    )
    folded = materialize(folded, "folded")
    ids, _ = broadcast_if_small(folded.select("id"))
    stored = table.join(ids, "id", "left_semi")
    joined = folded.join(stored, "id", "left")
    out = [F.col("id")]
    for field in table.schema.fields:
        if field.name != "id":
            new = F.col(f"_new_{field.name}")
            out.append(F.when(new.isNotNull(), new["v"]).otherwise(F.col(field.name)).alias(field.name))
    rows = joined.select(*out, (~F.coalesce(F.col("_reset.v"), F.lit(True))).alias("_deleted"))
    kept = table.join(ids, "id", "left_anti")
    after = kept.unionByName(rows.where(~F.col("_deleted")).drop("_deleted").select(*table.columns))
    return Applied(results, rows, after)
