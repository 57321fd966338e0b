"""Top-K per query with a reproducible tie rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Sums arrive in shuffle order, so their last bits vary from run to run. Scores equal to
# this many decimals count as tied and the id decides.
TIE_DIGITS = 9

# Above this K a single reducer would merge (map tasks x K) rows; a salted middle cut
# keeps each merge near (map tasks / CUT_SALTS) x K.
ONE_CUT_MAX_K = 1_000
CUT_SALTS = 64

# Metric -> True when a smaller score is better.
ASCENDING = {"l2": True, "cosine": True, "hamming": True, "mips_l2": True, "ip": False}


def rank_key(score: F.Column, ascending: bool) -> F.Column:
    key = F.round(score, TIE_DIGITS)
    return key.asc() if ascending else key.desc()


def top_k(
    hits: DataFrame,
    k: int,
    *,
    ascending: bool,
    by: str = "qid",
    score: str = "score",
    tie: str = "id",
    rank: str = "rank",
) -> DataFrame:
    """The best ``k`` rows per ``by``; Spark cuts each map partition to ``k`` first."""
    order = [rank_key(F.col(score), ascending), F.col(tie).asc()]
    if k > ONE_CUT_MAX_K:
        salted = hits.withColumn("_salt", F.spark_partition_id() % CUT_SALTS)
        first = Window.partitionBy(by, "_salt").orderBy(*order)
        hits = (
            salted.withColumn(rank, F.row_number().over(first))
            .where(F.col(rank) <= k)
            .drop("_salt", rank)
        )
    window = Window.partitionBy(by).orderBy(*order)
    return hits.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)
