"""Checks of a write batch against a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.operators.sparse import valid_sparse
from plumbline.sources.schema import ARRAYS, DENSE, RANGES, SPARSES, Field, Schema, spark_type

RESERVED = ("id", "pos", "_set", "op", "seq")


def _dimension(column: F.Column, item: Field) -> F.Column:
    if item.vtype in ("vectorBinary32", "vectorBinary64"):
        return F.octet_length(column) * 8 != item.dim
    return F.size(column) != item.dim


def _outside(column: F.Column, item: Field) -> F.Column:
    low, high = (F.lit(str(v)).cast("decimal(20,0)") for v in RANGES[item.vtype])
    if item.vtype in DENSE or item.vtype in ARRAYS:
        return F.exists(column, lambda x: (x < low) | (x > high))
    return (column < low) | (column > high)


def blank_id() -> F.Column:
    return F.col("id").isNull() | (F.trim(F.regexp_replace("id", r"\s+", " ")) == "")


def _value_checks(item: Field, value: F.Column, present: F.Column) -> list[tuple[str, F.Column]]:
    """Rules on a value of the declared type."""
    held, out = present & value.isNotNull(), []
    if not item.nullable:
        out.append(("notNullable", present & value.isNull()))
    if item.vtype in DENSE:
        out.append(("dimension", held & _dimension(value, item)))
    if item.vtype in SPARSES:
        out.append(("sparse", held & ~valid_sparse(value)))
    if item.vtype in RANGES:
        out.append(("range", held & _outside(value, item)))
    return out


def _present(batch: DataFrame, name: str) -> F.Column:
    return F.array_contains("_set", name) if "_set" in batch.columns else F.lit(True)


def unsound(batch: DataFrame, schema: Schema) -> F.Column:
    """Whether a row of a write breaks a rule once its values have the declared types."""
    checks = [blank_id()]
    for column in batch.schema.fields:
        item = next((f for f in schema.fields if f.name == column.name), None)
        if item is None or column.name in RESERVED:
            continue
        given, kind = F.col(f"`{column.name}`"), spark_type(item.vtype)
        value = given if same_type(column.dataType, kind) else given.try_cast(kind)
        present = _present(batch, column.name)
        checks.append(present & given.isNotNull() & value.isNull())
        checks += [broken for _, broken in _value_checks(item, value, present)]
    broken = F.lit(False)
    for check in checks:
        broken = broken | F.coalesce(check, F.lit(False))
    return broken


def violations(batch: DataFrame, schema: Schema) -> DataFrame:
    """``(id, field, rule)`` for every broken rule, in one pass over the batch.

    Rules: ``blankId``, ``unknownField``, ``notNullable``, ``typeMismatch``,
    ``dimension``, ``sparse``, ``range``. A field counts as present in a row when ``_set``
    names it; without a ``_set`` column every column is present. Missing fields are fine.
    """
    declared = {f.name: f for f in schema.fields}
    checks: list[tuple[str, str, F.Column]] = [("id", "blankId", blank_id())]
    for column in batch.schema.fields:
        name = column.name
        if name in RESERVED:
            continue
        value, present, item = F.col(f"`{name}`"), _present(batch, name), declared.get(name)
        if item is None:
            checks.append((name, "unknownField", present))
        elif same_type(column.dataType, spark_type(item.vtype)):
            checks += [(name, rule, broken) for rule, broken in _value_checks(item, value, present)]
        else:
            if not item.nullable:
                checks.append((name, "notNullable", present & value.isNull()))
            checks.append((name, "typeMismatch", present & value.isNotNull()))
    found = F.array(
        *[
            F.when(
                F.coalesce(broken, F.lit(False)),
                F.struct(F.lit(name).alias("field"), F.lit(rule).alias("rule")),
            )
            for name, rule, broken in checks
        ]
    )
    flat = batch.select("id", F.explode(F.filter(found, lambda v: v.isNotNull())).alias("v"))
    return flat.select("id", F.col("v.field").alias("field"), F.col("v.rule").alias("rule"))


def same_type(actual: T.DataType, expected: T.DataType) -> bool:
    return actual.simpleString() == expected.simpleString()


def rule_counts(broken: DataFrame) -> DataFrame:
    """Number of violations per field and rule."""
    return broken.groupBy("field", "rule").agg(F.count("*").alias("n"))
