"""Joins whose left side may hold a very common key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.sizing import broadcast_if_small, materialize

# Left rows of one key beyond this are spread over several tasks.
SALT_ROWS = 1_000_000


def salted_join(
    left: DataFrame, right: DataFrame, key: str, spread: str, how: str = "inner"
) -> DataFrame:
    """Equi-join a large ``left`` to ``right`` on ``key`` without one task per hot key.

    Keys heavy on the left are split by ``spread`` and the matching right rows are copied
    once per split. ``how`` is ``inner`` or ``left``.
    """
    counts = left.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > SALT_ROWS)
    splits = F.ceil(F.col("_n") / SALT_ROWS).cast("int").alias("_splits")
    heavy, _ = broadcast_if_small(materialize(counts.select(key, splits), "heavy-keys"))
    parts = F.coalesce(F.col("_splits"), F.lit(1)).cast("long")
    cut = left.join(heavy, key, "left").withColumn("_salt", F.pmod(F.xxhash64(spread), parts))
    copies = right.join(heavy, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))
    )
    return cut.drop("_splits").join(copies.drop("_splits"), [key, "_salt"], how).drop("_salt")


def look_up(rows: DataFrame, unique: DataFrame, key: str, spread: str) -> DataFrame:
    """Left join to a side with one row per key; a small one travels to ``rows``."""
    # Stored, because it is measured before it is joined.
    unique = materialize(unique, "look-up")
    small, hinted = broadcast_if_small(unique)
    if hinted:
        return rows.join(small, key, "left")
    return salted_join(rows, unique, key, spread, "left")
