"""Hybrid search: several ranked lists fused into one."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.errors import InvalidArgument, positive_int32
from plumbline.functions.ranking import top_k

# Fixed value: the usual reciprocal-rank constant.
RANK_CONSTANT = 60


@dataclass(frozen=True)
class SubResult:
    """Ranked hits ``(qid, id, score, rank)`` and the kind of their score."""

    hits: DataFrame
    kind: str


def unit_score(score: F.Column, kind: str) -> F.Column:
    """Scores of each kind mapped to [0, 1], larger is better."""
    if kind == "cosine":
        return 1 - score / 2
    if kind in ("l2", "mips_l2", "hamming"):
        return 1 / (1 + score)
    if kind in ("ip", "sparse"):
        return 0.5 + F.atan(score) / math.pi
    if kind == "text":
        return 2 * F.atan(score) / math.pi
    raise InvalidArgument(f"unknown score kind {kind!r}")


def _stack(parts: list[SubResult]) -> DataFrame:
    if len(parts) < 2:
        raise InvalidArgument("a hybrid query needs at least two sub-queries")
    frames = [
        part.hits.select(
            "qid",
            "id",
            F.lit(number).alias("sub"),
            "rank",
            unit_score(F.col("score"), part.kind).alias("unit"),
        )
        for number, part in enumerate(parts)
    ]
    return reduce(DataFrame.unionByName, frames)


def stacked(hits: DataFrame, kinds: list[str]) -> DataFrame:
    """Hits ``(sub, qid, id, score, rank)`` of several lists with their unit scores, ready to fuse."""
    units = [unit_score(F.col("score"), kind) for kind in kinds]
    unit = F.element_at(F.array(*units), F.col("sub") + 1)
    return hits.select("qid", "id", "sub", "rank", unit.alias("unit"))


def fuse_rrf(parts: list[SubResult], k: int, *, constant: int = RANK_CONSTANT) -> DataFrame:
    """``sum(1 / (constant + rank))`` over the lists a document appears in."""
    return fuse_stacked(_stack(parts), k, constant=constant)


def fuse_weighted(parts: list[SubResult], k: int, weights: list[float]) -> DataFrame:
    """Weighted sum of unit scores; a list without the document adds nothing."""
    if len(weights) != len(parts):
        raise InvalidArgument("one weight per sub-query is needed")
    return fuse_stacked(_stack(parts), k, weights=weights)


def fuse_stacked(
    lists: DataFrame, k: int, *, weights: list[float] | None = None, constant: int = RANK_CONSTANT
) -> DataFrame:
    """Stacked lists ``(qid, id, sub, rank, unit)`` fused by weights, or by ranks without any."""
    positive_int32(k, "k")
    positive_int32(constant, "constant")
    if weights is None:
        share = F.lit(1.0) / (F.lit(constant) + F.col("rank"))
    else:
        share = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("sub") + 1) * F.col("unit")
    fused = lists.groupBy("qid", "id").agg(F.sum(share).alias("score"))
    return top_k(fused, k, ascending=False)
