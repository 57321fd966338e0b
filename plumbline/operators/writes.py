"""Batch writes as merges: each returns per-row results, changed rows, the next table.

A batch holds ``pos`` (its order), ``id`` and field columns. ``_set``, when present, names
the fields a row carries; a carried NULL differs from an absent field.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.errors import AlreadyExists, InvalidArgument, NotFound
from plumbline.functions.joins import look_up
from plumbline.functions.sizing import broadcast_if_small, materialize

BATCH_COLUMNS = ("pos", "id", "_set")


@dataclass(frozen=True)
class Write:
    """``results (pos, id, ok, error_code, message)``; ``rows`` are the changed rows with
    ``_deleted``; ``table`` is the whole next table."""

    results: DataFrame
    rows: DataFrame
    table: DataFrame


def fields_of(table: DataFrame, batch: DataFrame) -> list[str]:
    """Field columns of the batch; a column the table lacks is an error."""
    names = [c for c in batch.columns if c not in BATCH_COLUMNS]
    unknown = [n for n in names if n not in table.columns]
    if unknown:
        raise InvalidArgument(f"unknown fields {unknown}")
    return names


def stored_ids(table: DataFrame, ids: DataFrame) -> DataFrame:
    """Which of ``ids`` the table holds; the table stays in place when they are few."""
    wanted, _ = broadcast_if_small(materialize(ids.select("id").distinct(), "wanted-ids"))
    return table.select("id").join(wanted, "id", "left_semi")


def report(judged: DataFrame, error: type, text: str) -> DataFrame:
    """Per-row results; a row without an id is invalid whatever else holds."""
    nameless = F.col("id").isNull()
    ok = F.col("ok") & ~nameless
    return judged.select(
        "pos",
        "id",
        ok.alias("ok"),
        F.when(nameless, InvalidArgument.code).when(~ok, F.lit(error.code)).alias("error_code"),
        F.when(nameless, F.lit("the id is missing")).when(~ok, F.lit(text)).alias("message"),
    )


def _first_rows(table: DataFrame, batch: DataFrame) -> DataFrame:
    """``(id, pos, stored)``: the first row of each id and whether the table holds it.

    Grouping combines before the shuffle, so an id repeated through the batch is one row.
    """
    first = materialize(batch.groupBy("id").agg(F.min("pos").alias("pos")), "first")
    held = stored_ids(table, first).withColumn("stored", F.lit(True))
    judged = first.join(held, "id", "left").select(
        "id", "pos", F.coalesce("stored", F.lit(False)).alias("stored")
    )
    return materialize(judged, "judged")


def _shaped(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Columns of the table, NULL where the batch has none."""
    have = set(rows.columns)
    return rows.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in table.schema.fields
        ]
    )


def _replace(table: DataFrame, ids: DataFrame, rows: DataFrame) -> DataFrame:
    """The table with ``rows`` taking the place of the rows named in ``ids``."""
    ids, _ = broadcast_if_small(ids.select("id"))
    kept = table.join(ids, "id", "left_anti").select(*table.columns)
    return kept.unionByName(rows.where(~F.col("_deleted")).drop("_deleted"))


def insert(table: DataFrame, batch: DataFrame) -> Write:
    """New ids are added; a stored id, or an id seen earlier in the batch, fails its row."""
    fields_of(table, batch)
    first = _first_rows(table, batch)
    # (id, pos) is unique, so rows of a much-repeated id spread over the join.
    judged = batch.select("pos", "id").join(first, ["id", "pos"], "left")
    ok = F.coalesce(~F.col("stored"), F.lit(False))
    results = report(judged.withColumn("ok", ok), AlreadyExists, "the id already exists")
    # A missing id joins with nothing, so such a row is not added.
    added = batch.join(first.where(~F.col("stored")).select("id", "pos"), ["id", "pos"], "left_semi")
    rows = _shaped(added, table)
    return Write(results, rows.withColumn("_deleted", F.lit(False)), table.unionByName(rows))


def update(table: DataFrame, batch: DataFrame) -> Write:
    """Carried fields replace stored ones, in batch order; an unknown id fails its row."""
    names = fields_of(table, batch)
    merged = materialize(last_values(batch, names, "pos"), "patch")
    held = materialize(stored_ids(table, merged).withColumn("ok", F.lit(True)), "held")
    judged = look_up(batch.select("pos", "id"), held, "id", "pos")
    judged = judged.withColumn("ok", F.coalesce("ok", F.lit(False)))
    results = report(judged, NotFound, "no document has this id")
    patch, _ = broadcast_if_small(merged)
    changed = table.join(patch.select("id", *[F.col(n).alias(f"_new_{n}") for n in names]), "id")
    rows = overlay(changed, table, names).withColumn("_deleted", F.lit(False))
    return Write(results, rows, _replace(table, merged, rows))


def last_values(batch: DataFrame, names: list[str], order: str) -> DataFrame:
    """Per id and field, ``struct(order, value)`` of the last row carrying the field.

    A maximum combines before the shuffle, unlike a sorted group.
    """
    return batch.groupBy("id").agg(
        *[F.max(F.when(carried(batch, n), F.struct(order, F.col(n).alias("v")))).alias(n) for n in names]
    )


def carried(batch: DataFrame, name: str) -> F.Column:
    return F.array_contains("_set", name) if "_set" in batch.columns else F.lit(True)


def overlay(joined: DataFrame, table: DataFrame, names: list[str]) -> DataFrame:
    """Stored columns with ``_new_<name>`` values laid over them where carried."""
    out = []
    for column in table.schema.fields:
        if column.name in names:
            new = F.col(f"_new_{column.name}")
            value = F.when(new.isNotNull(), new["v"].cast(column.dataType)).otherwise(F.col(column.name))
            out.append(value.alias(column.name))
        else:
            out.append(F.col(column.name))
    return joined.select(*out)


def upsert(table: DataFrame, batch: DataFrame) -> Write:
    """Insert, or replace the whole row; the last row of an id wins."""
    names = fields_of(table, batch)
    results = batch.select("pos", "id", F.lit(True).alias("ok"))
    results = report(results, AlreadyExists, "")
    last = batch.where(F.col("id").isNotNull()).groupBy("id").agg(F.max(F.struct("pos", *names)).alias("r"))
    rows = _shaped(last.select("id", *[F.col(f"r.{n}").alias(n) for n in names]), table)
    rows = materialize(rows.withColumn("_deleted", F.lit(False)), "upserts")
    return Write(results, rows, _replace(table, rows, rows))


def delete_ids(table: DataFrame, requests: DataFrame) -> Write:
    """Remove rows by id from ``requests (pos, id)``; an unknown or repeated id fails."""
    first = _first_rows(table, requests)
    judged = requests.select("pos", "id").join(first, ["id", "pos"], "left")
    judged = judged.withColumn("ok", F.coalesce("stored", F.lit(False)))
    results = report(judged, NotFound, "no document has this id")
    gone, _ = broadcast_if_small(first.where("stored").select("id"))
    rows = _shaped(first.where("stored").select("id"), table).withColumn("_deleted", F.lit(True))
    return Write(results, rows, table.join(gone, "id", "left_anti").select(*table.columns))


def delete_where(table: DataFrame, where: str) -> DataFrame:
    """Rows for which the condition is not true; an unknown outcome keeps the row."""
    if not where or not where.strip():
        raise InvalidArgument("a delete filter must not be blank")
    return table.where(~F.coalesce(F.expr(where), F.lit(False)))


def summary(results: DataFrame) -> DataFrame:
    """``(succeeded, failed)``; zeros for an empty batch."""
    return results.agg(
        F.count(F.when(F.col("ok"), 1)).alias("succeeded"),
        F.count(F.when(~F.col("ok"), 1)).alias("failed"),
    )


def merge_documents(left: DataFrame, right: DataFrame, key: str = "key") -> DataFrame:
    """Lay ``right`` over ``left`` for equal ``key``; documents without a partner stay.

    Fields named by the right ``_set`` win (all its fields without one). A filled right
    ``id`` and ``score`` win, and ``op`` comes from the right.
    """
    special = {key, "id", "score", "op", "_set"}
    names = [c for c in right.columns if c not in special]
    patch = right.select(
        F.col(key),
        F.lit(True).alias("_hit"),
        *[F.col(c).alias(f"_r_{c}") for c in right.columns if c != key],
    )
    patch, _ = broadcast_if_small(patch)
    joined = left.join(patch, key, "left")
    out = []
    for column in left.columns:
        old, new = F.col(column), F.col(f"_r_{column}")
        if column == "id" and "id" in right.columns:
            old = F.when(F.length(new) > 0, new).otherwise(old)
        elif column == "score" and "score" in right.columns:
            old = F.coalesce(new, old)
        elif column == "op" and "op" in right.columns:
            old = F.when(F.col("_hit"), new).otherwise(old)
        elif column in names:
            wins = F.array_contains("_r__set", column) if "_set" in right.columns else F.col("_hit")
            old = F.when(wins, new).otherwise(old)
        out.append(old.alias(column))
    added = [n for n in names if n not in left.columns]
    return joined.select(*out, *[F.col(f"_r_{n}").alias(n) for n in added])
