"""Exact nearest neighbours for a table of queries against a table of documents."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from plumbline.errors import (
    FailedPrecondition,
    InvalidArgument,
    NotFound,
    NotSupported,
    positive_int32,
)
from plumbline.functions.ranking import ASCENDING, top_k
from plumbline.functions.sizing import BROADCAST_BYTES, broadcast_if_small, materialize
from plumbline.operators.blocks import Best, matrix, values_of

# Every task emits up to (queries x K) rows, so the broadcast form is kept to query tables
# of this size; larger ones are joined block by block in ``operators.cells``.
MAX_BROADCAST_QUERIES = 4_096

REPEATED = "each query needs a qid of its own"

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


@dataclass(frozen=True)
class QueryBlock:
    """A query table small enough to travel to every task."""

    qids: pa.Array
    vectors: np.ndarray
    qid_type: T.DataType

    def __len__(self) -> int:
        return len(self.qids)


def is_dense(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.BinaryType) or (
        isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, NUMERIC)
    )


def check_search(docs: DataFrame, vector: str, metric: str, k: int) -> None:
    if metric not in ASCENDING:
        raise InvalidArgument(f"unknown metric {metric!r}")
    positive_int32(k, "k")
    if vector not in docs.columns:
        raise InvalidArgument(f"unknown field {vector!r}")
    dtype = docs.schema[vector].dataType
    if not is_dense(dtype):
        raise NotSupported(f"field {vector!r} is not a dense vector")
    if isinstance(dtype, T.BinaryType) != (metric == "hamming"):
        raise NotSupported(f"metric {metric!r} does not fit field {vector!r}")


def small_queries(queries: DataFrame) -> QueryBlock | None:
    """The queries as one block, or None when they are too many to broadcast."""
    frame = queries.select("qid", "qvec").where(F.col("qvec").isNotNull())
    head = frame.limit(MAX_BROADCAST_QUERIES + 1).toArrow()
    if head.num_rows > MAX_BROADCAST_QUERIES or head.nbytes > BROADCAST_BYTES:
        return None
    qid_type = queries.schema["qid"].dataType
    qids = head["qid"].combine_chunks()
    if len(pc.unique(qids)) < len(qids):
        raise InvalidArgument(REPEATED)
    return QueryBlock(qids, matrix(head["qvec"]), qid_type)


def check_distinct(queries: DataFrame) -> None:
    """Two rows of one ``qid`` would share a single top K."""
    held = queries.where(F.col("qvec").isNotNull()).groupBy("qid").count()
    if not held.where(F.col("count") > 1).isEmpty():
        raise InvalidArgument(REPEATED)


def hit_schema(qid_type: T.DataType, id_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("qid", qid_type),
            T.StructField("id", id_type),
            T.StructField("score", T.DoubleType()),
        ]
    )


def largest_norm2(docs: DataFrame, vector: str) -> float:
    """Largest squared length in ``vector``: one number per task, then a max."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = 0.0
        for batch in batches:
            rows = matrix(batch.column(0))
            if len(rows):
                top = max(top, float(np.einsum("ij,ij->i", rows, rows).max()))
        yield pa.RecordBatch.from_pydict({"m": [top]})

    rows = docs.select(vector).where(F.col(vector).isNotNull())
    return float(rows.mapInArrow(scan, "m double").agg(F.max("m")).first()[0] or 0.0)


def scan_best(
    docs: DataFrame, block: QueryBlock, k: int, metric: str, vector: str, max_norm2: float = 0.0
) -> DataFrame:
    """One pass over ``docs``; each task returns its best K rows per query."""
    schema = hit_schema(block.qid_type, docs.schema["id"].dataType)
    arrow = to_arrow_schema(schema)
    qids, vectors = block.qids, block.vectors

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(vectors, k, metric, max_norm2)
        for batch in batches:
            best.add(matrix(batch.column(1), vectors.shape[1]), values_of(batch.column(0)))
        yield best.batch(qids, arrow)

    rows = docs.select("id", vector).where(F.col(vector).isNotNull())
    return rows.mapInArrow(scan, schema)


def dense_scorer(docs: DataFrame, queries: DataFrame, k: int, *, vector: str, metric: str):
    """``knn`` as a part of a common scan (``together.Scorer``); None for query tables without
    vectors or too large to travel, and for metrics that measure all rows first."""
    from plumbline.operators.together import Scorer

    check_search(docs, vector, metric, k)
    block = None if metric == "mips_l2" else small_queries(queries)
    if not block:
        return None
    vectors = block.vectors

    def feed(best: Best, arrays: list[pa.Array], ids: np.ndarray) -> None:
        best.add(matrix(arrays[0], vectors.shape[1]), ids)

    columns = [F.col(vector)]
    start = lambda: Best(vectors, k, metric)
    return Scorer(columns, start, feed, block.qids, block.qid_type, k, ASCENDING[metric])


def knn(
    docs: DataFrame,
    queries: DataFrame,
    k: int,
    *,
    vector: str = "embedding",
    metric: str = "cosine",
    where: str | None = None,
    radius: float | None = None,
) -> DataFrame:
    """Exact top ``k`` documents per query as ``(qid, id, score, rank)``.

    ``docs`` needs ``id`` and ``vector``; ``queries`` needs ``qid`` and ``qvec``. The filter
    ``where`` applies before the cut. Distances (``l2``, ``cosine``, ``hamming``,
    ``mips_l2``) rank ascending, ``ip`` descending; ``radius`` keeps rows on the better
    side of the bound, None means no bound. A repeated ``qid`` is an error.
    """
    check_search(docs, vector, metric, k)
    if where and where.strip():
        docs = docs.where(where)
    block = small_queries(queries)
    if block is None:
        from plumbline.operators.cells import exact_join

        check_distinct(queries)
        hits = exact_join(docs, queries, k, vector=vector, metric=metric)
    elif len(block) == 0:
        empty = hit_schema(block.qid_type, docs.schema["id"].dataType)
        hits = docs.sparkSession.createDataFrame([], empty)
    else:
        max_norm2 = largest_norm2(docs, vector) if metric == "mips_l2" else 0.0
        hits = scan_best(docs, block, k, metric, vector, max_norm2)
    return within(top_k(hits, k, ascending=ASCENDING[metric]), metric, radius)


def within(hits: DataFrame, metric: str, radius: float | None) -> DataFrame:
    """Keep hits inside ``radius``; None keeps all."""
    if radius is None:
        return hits
    score = F.col("score")
    return hits.where(score <= radius if ASCENDING[metric] else score >= radius)


def queries_by_id(docs: DataFrame, ids: DataFrame, *, vector: str = "embedding") -> DataFrame:
    """Query table whose vectors are read from stored rows; absent ids give no query."""
    if vector not in docs.columns:
        raise InvalidArgument(f"unknown field {vector!r}")
    if not is_dense(docs.schema[vector].dataType):
        raise NotSupported(f"field {vector!r} is not a dense vector")
    wanted, _ = broadcast_if_small(ids.select("id").distinct())
    return (
        docs.select("id", vector)
        .where(F.col(vector).isNotNull())
        .join(wanted, "id", "left_semi")
        .select(F.col("id").alias("qid"), F.col(vector).alias("qvec"))
    )


def query_by_id(docs: DataFrame, doc_id, *, vector: str = "embedding") -> DataFrame:
    """One-row query table for a stored document, with the error each gap calls for."""
    if doc_id is None or (isinstance(doc_id, str) and not doc_id):
        raise InvalidArgument("document id must not be empty")
    if vector not in docs.columns:
        raise InvalidArgument(f"unknown field {vector!r}")
    if not is_dense(docs.schema[vector].dataType):
        raise NotSupported(f"field {vector!r} is not a dense vector")
    source = docs.where(F.col("id") == F.lit(doc_id)).select(
        F.col("id").alias("qid"), F.col(vector).alias("qvec")
    )
    found = source.select(F.col("qvec").isNull().alias("empty")).first()
    if found is None:
        raise NotFound(f"no document {doc_id!r}")
    if found["empty"]:
        raise FailedPrecondition(f"document {doc_id!r} holds no {vector!r}")
    return source


def attach(hits: DataFrame, docs: DataFrame, output: list[str]) -> DataFrame:
    """Add document columns to ranked hits.

    The hits are stored first, so the search runs once; only the named columns are read,
    and the hits travel to the table when they are small enough.
    """
    if not output:
        return hits
    small, _ = broadcast_if_small(materialize(hits, "hits"))
    return docs.select("id", *output).join(small, "id", "inner").select(*hits.columns, *output)
