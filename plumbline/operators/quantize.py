"""Scalar quantization of a vector column, and coarse search refined by exact scores."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from plumbline.errors import InvalidArgument, positive_int32
from plumbline.functions.ranking import ASCENDING, top_k
from plumbline.functions.sizing import broadcast_if_small, materialize
from plumbline.operators import knn as exact
from plumbline.operators.blocks import QUERY_CHUNK, matrix, pair_scores, unit, values_of

# The largest code of each integer width.
CODE_LIMIT = {"int8": 127, "int4": 7}

# Codes scored at once.
CODE_ROWS = 4_096

# Fixed value: the smallest magnitude half precision rounds to infinity.
HALF_OVERFLOW = 65_520.0


def quantize(docs: DataFrame, kind: str, *, vector: str = "embedding") -> DataFrame:
    """Add ``code`` and ``scale``: ``code[i] = round(x[i] / scale)``, halves away from zero,
    ``scale = max|x| / limit`` per row. ``float16`` rounds each element and has scale 1."""
    if kind == "float16":
        return docs.withColumn("code", half(F.col(vector))).withColumn("scale", F.lit(1.0))
    if kind not in CODE_LIMIT:
        raise InvalidArgument(f"unknown quantization {kind!r}")
    x = F.col(vector).cast("array<double>")
    top = F.array_max(F.transform(x, F.abs))
    scaled = docs.withColumn("scale", top / F.lit(float(CODE_LIMIT[kind])))
    code = F.transform(
        x,
        lambda e: F.when(F.col("scale") > 0, F.round(e / F.col("scale"))).otherwise(0.0).cast("tinyint"),
    )
    return scaled.withColumn("code", code)


def half(vector: F.Column) -> F.Column:
    """Elements rounded to half precision (11 significant bits, ties to even)."""

    def rounded(x: F.Column) -> F.Column:
        magnitude = F.floor(F.log2(F.abs(x)))
        step = F.pow(F.lit(2.0), F.greatest(magnitude, F.lit(-14)) - 10)
        near = F.rint(x / step) * step
        return (
            F.when(x == 0, x)
            .when(F.abs(x) >= HALF_OVERFLOW, F.signum(x) * F.lit(float("inf")))
            .otherwise(near)
        )

    return F.transform(vector.cast("array<double>"), rounded).cast("array<float>")


def restore(codes: DataFrame, *, vector: str = "restored") -> DataFrame:
    """``(id, vector)`` with codes times scale, computed on Arrow batches."""
    id_type = codes.schema["id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = matrix(batch.column(1)) * np.asarray(batch.column(2))[:, None]
            values = pa.array(rows.ravel())
            offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(offsets, values)],
                names=["id", vector],
            )

    held = codes.select("id", "code", "scale").where(F.col("code").isNotNull())
    return held.mapInArrow(scan, f"id {id_type}, `{vector}` array<double>")


def code_errors(rows: np.ndarray, scale: np.ndarray, kind: str) -> np.ndarray:
    """How far each vector can lie from its restored code, as a length.

    Whole numbers round each element by half a step of ``scale`` at most. Half precision rounds
    by 2^-11 of the element, or half of its smallest step; beyond its range nothing is known.
    """
    if kind == "int":
        return np.abs(scale) / 2 * math.sqrt(rows.shape[1]) * (1 + 1e-9)
    with np.errstate(invalid="ignore", over="ignore"):
        each = np.abs(rows) * 2.0**-11 * (1 + 2.0**-9) + 2.0**-25
        error = np.sqrt(np.einsum("ij,ij->i", each, each))
    return np.where(np.isfinite(rows).all(axis=1), error, np.inf)


class Bounded:
    """Rows that may be among the best ``k`` of a query, told from their codes: the score of the
    code less its error reaches the K-th least of the scores plus their errors. Beside them the
    ``wide`` best by the score of the code. Lower is better here for every metric."""

    SETTLE_ROWS = 400_000

    def __init__(self, queries: np.ndarray, k: int, wide: int, metric: str):
        self.k, self.wide, self.metric = k, wide, metric
        self.queries = unit(queries) if metric == "cosine" else queries
        self.lengths = np.linalg.norm(queries, axis=1)
        # The K-th least upper bound and the last of the wide scores, as far as known.
        self.reach = np.full(len(queries), np.inf)
        self.last = np.full(len(queries), np.inf)
        self.held: list[tuple[np.ndarray, ...]] = []
        self.n_held = 0

    def add(self, rows: np.ndarray, errors: np.ndarray, ids: np.ndarray) -> None:
        lengths = np.linalg.norm(np.where(np.isfinite(rows), rows, 0.0), axis=1)
        unknown = ~np.isfinite(errors)
        if self.metric == "cosine":
            with np.errstate(invalid="ignore", divide="ignore"):
                unknown |= (lengths == 0) & (errors > 0)
                # Directions differ by at most twice the error over the length.
                errors = np.minimum(2 * errors / lengths, 2.0)
            rows = unit(rows)
        rows, errors = np.where(unknown[:, None], 0.0, rows), np.where(unknown, np.inf, errors)
        norms2 = np.einsum("ij,ij->i", rows, rows)
        for start in range(0, len(self.queries), QUERY_CHUNK):
            chunk = slice(start, start + QUERY_CHUNK)
            score = -(self.queries[chunk] @ rows.T)
            error = np.broadcast_to(errors, score.shape)
            if self.metric == "l2":
                square = 2 * score + norms2 + np.square(self.lengths[chunk])[:, None]
                score = np.sqrt(np.maximum(square, 0.0))
                # Cancellation in the square counts as error too.
                error = error + 1e-7 * (1 + self.lengths[chunk])[:, None]
            elif self.metric != "cosine":
                error = error * self.lengths[chunk][:, None]
            error = np.where(unknown, np.inf, error + 1e-9)
            low, high = score - error, score + error
            if score.shape[1] > self.k:
                kth = np.partition(high, self.k - 1, axis=1)[:, self.k - 1]
                self.reach[chunk] = np.fmin(self.reach[chunk], kth)
            last = self.last[chunk]
            if score.shape[1] > self.wide:
                last = np.fmin(last, np.partition(score, self.wide - 1, axis=1)[:, self.wide - 1])
                self.last[chunk] = last
            sound = ~np.isnan(score)
            q, r = np.nonzero(sound & ((low <= self.reach[chunk][:, None]) | (score <= last[:, None])))
            self.held.append((q + start, ids[r], score[q, r], low[q, r], high[q, r]))
            self.n_held += len(q)
        if self.n_held >= self.SETTLE_ROWS:
            self.settle()

    def settle(self) -> tuple[np.ndarray, ...]:
        """Drop what the bounds known by now rule out."""
        q, ids, score, low, high = (np.concatenate(part) for part in zip(*self.held))
        for values, n, bound in ((high, self.k, self.reach), (score, self.wide, self.last)):
            order = np.lexsort((values, q))
            first = np.searchsorted(q[order], np.arange(len(bound)))
            has = np.append(first[1:], len(q)) - first >= n
            bound[has] = np.fmin(bound[has], values[order][first[has] + n - 1])
        keep = (low <= self.reach[q]) | (score <= self.last[q])
        kept = tuple(part[keep] for part in (q, ids, score, low, high))
        self.held, self.n_held = [kept], 0
        return kept


def bounded_candidates(
    codes: DataFrame, block: exact.QueryBlock, k: int, wide: int, metric: str
) -> DataFrame:
    """``(qid, id)`` of all rows whose codes leave it open that they are among the best ``k``, and
    of the ``wide`` best by their codes; the codes are read once and not restored anywhere else."""
    id_type, element = codes.schema["id"].dataType, codes.schema["code"].dataType.elementType
    kind = "half" if isinstance(element, (T.FloatType, T.DoubleType)) else "int"
    kinds = zip(("score", "low", "high"), [T.DoubleType()] * 3)
    fields = [("qid", block.qid_type), ("id", id_type), *kinds]
    schema = T.StructType([T.StructField(name, dtype) for name, dtype in fields])
    arrow = to_arrow_schema(schema)
    qids, vectors = block.qids, block.vectors

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Bounded(vectors, k, wide, metric)
        for batch in batches:
            for start in range(0, batch.num_rows, CODE_ROWS):
                part = batch.slice(start, CODE_ROWS)
                scale = np.asarray(part.column(2), dtype=np.float64)
                rows = matrix(part.column(1), vectors.shape[1]) * scale[:, None]
                best.add(rows, code_errors(rows, scale, kind), values_of(part.column(0)))
        if best.held:
            q, ids, *bounds = best.settle()
            columns = [qids.take(pa.array(q)).cast(arrow.field(0).type), pa.array(ids, arrow.field(1).type)]
            yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, bounds)], schema=arrow)

    held = codes.select("id", "code", F.col("scale").cast("double").alias("scale")).where(F.col("code").isNotNull())
    hits = materialize(held.mapInArrow(scan, schema), "bounded")
    order = lambda by: Window.partitionBy("qid").orderBy(by, "id")
    kth = hits.withColumn("n", F.row_number().over(order("high"))).where(F.col("n") <= k)
    kth = kth.groupBy("qid").agg(F.max("high").alias("reach"), F.count("*").alias("n"))
    # With fewer than K rows every one of them is asked for.
    kth = kth.select("qid", F.when(F.col("n") < k, float("inf")).otherwise(F.col("reach")).alias("reach"))
    near = hits.withColumn("n", F.row_number().over(order("score")))
    near = near.join(broadcast_if_small(kth)[0], "qid")
    return near.where((F.col("low") <= F.col("reach")) | (F.col("n") <= wide)).select("qid", "id")


def refined_knn(
    docs: DataFrame,
    codes: DataFrame,
    queries: DataFrame,
    k: int,
    *,
    vector: str = "embedding",
    metric: str = "cosine",
    scale_factor: float = 1.0,
    radius: float | None = None,
) -> DataFrame:
    """The exact top ``k``, found on ``codes`` and ranked again by the vectors.

    A row is ranked again when its code, give or take what rounding can have moved it, may be
    among the best ``k``, and when it is one of the ``ceil(k * scale_factor)`` best by its code.
    So the result is exact for any factor. Rows of a query table too large to travel to the
    tasks are joined exactly, block by block, without the codes.
    """
    exact.check_search(docs, vector, metric, k)
    if scale_factor < 1:
        raise InvalidArgument("scale_factor must be at least 1")
    wide = positive_int32(math.ceil(k * scale_factor), "k * scale_factor")
    block = exact.small_queries(queries)
    if block is None or not len(block):
        coded = docs.join(codes.where(F.col("code").isNotNull()).select("id"), "id", "left_semi")
        return exact.knn(coded, queries, k, vector=vector, metric=metric, radius=radius)
    coarse = bounded_candidates(codes, block, k, wide, metric)
    return exact.within(rescore(docs, coarse, queries, k, vector=vector, metric=metric), metric, radius)


def rescore(
    docs: DataFrame, hits: DataFrame, queries: DataFrame, k: int, *, vector: str, metric: str
) -> DataFrame:
    """Exact scores for candidate pairs; only the candidates' vectors are read."""
    hits = materialize(hits.select("qid", "id"), "candidates")
    pairs, _ = broadcast_if_small(hits)
    asked, _ = broadcast_if_small(queries.select("qid", "qvec"))
    both = docs.select("id", vector).join(pairs, "id").join(asked, "qid")
    schema = exact.hit_schema(queries.schema["qid"].dataType, docs.schema["id"].dataType)
    arrow = to_arrow_schema(schema)
    bound = exact.largest_norm2(docs, vector) if metric == "mips_l2" else 0.0

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = pair_scores(matrix(batch.column(3)), matrix(batch.column(2)), metric, bound)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score)], schema=arrow
            )

    held = both.select("qid", "id", vector, "qvec").where(F.col(vector).isNotNull())
    scored = held.mapInArrow(scan, schema).where(~F.isnan("score"))
    return top_k(scored, k, ascending=ASCENDING[metric])
