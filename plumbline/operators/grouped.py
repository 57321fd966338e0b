"""Vector search whose hits are grouped by a scalar field."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from plumbline.errors import InvalidArgument, positive_int32
from plumbline.functions.ranking import ASCENDING, TIE_DIGITS, rank_key, top_k
from plumbline.functions.sizing import BROADCAST_BYTES, broadcast_if_small, measured_bytes
from plumbline.operators.blocks import Best, matrix, unit, values_of
from plumbline.operators.knn import (
    MAX_BROADCAST_QUERIES,
    attach,
    check_distinct,
    check_search,
    hit_schema,
    knn,
    largest_norm2,
    small_queries,
)


def group_key(column: F.Column, dtype: T.DataType) -> F.Column:
    """Group values as text: whole numbers in decimal, fractions with six decimals.

    A binary value has no text form and yields NULL.
    """
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.when(column.isNotNull(), F.format_string("%.6f", column.cast("double")))
    if isinstance(dtype, T.BinaryType):
        return F.lit(None).cast("string")
    return column.cast("string")


def check_group_field(docs: DataFrame, field: str) -> T.DataType:
    if field not in docs.columns:
        raise InvalidArgument(f"unknown field {field!r}")
    dtype = docs.schema[field].dataType
    vtype = docs.schema[field].metadata.get("vtype", "")
    if isinstance(dtype, (T.ArrayType, T.StructType, T.MapType)) or vtype.startswith("vector"):
        raise InvalidArgument(f"field {field!r} cannot form groups")
    return dtype


def grouped_knn(
    docs: DataFrame,
    queries: DataFrame,
    group_by: str,
    *,
    groups: int,
    per_group: int,
    vector: str = "embedding",
    metric: str = "cosine",
    where: str | None = None,
    output: list[str] | None = None,
    ceiling: int | None = None,
) -> DataFrame:
    """``(qid, group_value, group_rank, rank_in_group, id, score, *output)``.

    Groups rank by their best hit; rows whose group value is NULL are skipped. With a
    ``ceiling`` only so many hits per query form groups. The group column is read for the
    grouping and returned only when ``output`` names it.
    """
    dtype = check_group_field(docs, group_by)
    positive_int32(groups, "groups")
    positive_int32(per_group, "per_group")
    check_search(docs, vector, metric, 1)
    rows = docs.where(where) if where and where.strip() else docs
    keyed = rows.select("id", vector, group_key(F.col(group_by), dtype).alias("group_value"))
    if ceiling is None:
        kept = _by_group(keyed, queries, vector, metric, groups, per_group)
    else:
        kept = _by_rank(keyed, queries, vector, metric, groups, per_group, ceiling)
    return attach(kept, docs, list(output or []))


def _by_rank(keyed, queries, vector, metric, groups, per_group, ceiling) -> DataFrame:
    """Groups among the first ``ceiling`` hits of each query."""
    hits = knn(keyed, queries, ceiling, vector=vector, metric=metric)
    named = keyed.where(F.col("group_value").isNotNull())
    hits = attach(hits, named, ["group_value"])
    # At most ``ceiling`` rows per query reach the windows below.
    in_group = Window.partitionBy("qid", "group_value")
    ranked = hits.withColumn("best", F.min("rank").over(in_group)).withColumn(
        "rank_in_group", F.row_number().over(in_group.orderBy("rank"))
    )
    return (
        ranked.where(F.col("rank_in_group") <= per_group)
        .withColumn("group_rank", F.dense_rank().over(Window.partitionBy("qid").orderBy("best")))
        .where(F.col("group_rank") <= groups)
        .select("qid", "group_value", "group_rank", "rank_in_group", "id", "score")
    )


def _by_group(keyed, queries, vector, metric, groups, per_group) -> DataFrame:
    """Groups among all hits, in two scans.

    The first finds each query's best groups: a group among the best of the table is among the
    best of the task that holds its best row, so a task returns ``groups`` rows per query. The
    second keeps the best ``per_group`` rows of each chosen group.
    """
    held = keyed.where(F.col("group_value").isNotNull() & F.col(vector).isNotNull())
    bound = largest_norm2(keyed, vector) if metric == "mips_l2" else 0.0
    parts = []
    for asked in _waves(queries):
        block = small_queries(asked)
        if block is None:
            raise InvalidArgument("the query vectors are too long to travel")
        parts.append(_wave(held, block, vector, metric, groups, per_group, bound))
    return reduce(DataFrame.unionByName, parts)


def _waves(queries: DataFrame) -> list[DataFrame]:
    """The queries in slices that can travel to every task."""
    asked = queries.select("qid", "qvec").where(F.col("qvec").isNotNull())
    if small_queries(asked) is not None:
        return [asked]
    check_distinct(asked)
    size = measured_bytes(asked)
    waves = max(-(-2 * asked.count() // MAX_BROADCAST_QUERIES), -(-2 * size // BROADCAST_BYTES))
    wave = F.pmod(F.xxhash64("qid"), F.lit(int(waves)))
    return [asked.where(wave == n) for n in range(int(waves))]


def _wave(held, block, vector, metric, groups, per_group, bound) -> DataFrame:
    ascending = ASCENDING[metric]
    sign = 1.0 if ascending else -1.0
    id_type, qids, vectors = held.schema["id"].dataType, block.qids, block.vectors
    schema = T.StructType(
        [
            T.StructField("number", T.IntegerType()),
            T.StructField("group_value", T.StringType()),
            T.StructField("id", id_type),
            T.StructField("score", T.DoubleType()),
        ]
    )
    arrow = to_arrow_schema(schema)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = GroupBest(vectors, groups, metric, bound)
        for batch in batches:
            if batch.num_rows:
                rows, ids = matrix(batch.column(1), vectors.shape[1]), values_of(batch.column(0))
                best.add(rows, ids, values_of(batch.column(2)))
        yield best.batch(arrow)

    source = held.select("id", vector, "group_value")
    order = [rank_key(F.col("score"), ascending), F.col("id").asc()]
    found = source.mapInArrow(first, schema)
    heads = found.withColumn("n", F.row_number().over(Window.partitionBy("number", "group_value").orderBy(*order)))
    ranked = heads.where("n = 1").withColumn(
        "group_rank", F.row_number().over(Window.partitionBy("number").orderBy(*order))
    )
    # At most ``groups`` rows per query of the wave come to the driver.
    chosen = ranked.where(F.col("group_rank") <= groups).select("number", "group_value", "group_rank").toArrow()
    number = chosen["number"].to_numpy()
    by_group: dict[str, list[int]] = {}
    for pair, value in enumerate(chosen["group_value"].to_pylist()):
        by_group.setdefault(value, []).append(pair)
    lists = {value: np.array(pairs) for value, pairs in by_group.items()}
    hits = hit_schema(T.IntegerType(), id_type)
    hits_arrow = to_arrow_schema(hits)

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(vectors[number], per_group, metric, bound)
        for batch in batches:
            values, code = np.unique(values_of(batch.column(2)).astype(str), return_inverse=True)
            rows, ids = matrix(batch.column(1), vectors.shape[1]), values_of(batch.column(0))
            for at, value in enumerate(values.tolist()):
                if value in lists:
                    which = code == at
                    best.add(rows[which], ids[which], lists[value])
        yield best.batch(pa.array(np.arange(len(number)), pa.int32()), hits_arrow)

    top = top_k(source.mapInArrow(second, hits), per_group, ascending=ascending, rank="rank_in_group")
    names = pa.table(
        {
            "pair": pa.array(np.arange(len(number)), pa.int32()),
            "asked": qids.take(pa.array(number)),
            "group_value": chosen["group_value"].cast(pa.string()),
            "group_rank": chosen["group_rank"],
        }
    )
    pairs = held.sparkSession.createDataFrame(
        names,
        T.StructType(
            [
                T.StructField("pair", T.IntegerType()),
                T.StructField("asked", block.qid_type),
                T.StructField("group_value", T.StringType()),
                T.StructField("group_rank", T.IntegerType()),
            ]
        ),
    )
    joined = top.withColumnRenamed("qid", "pair").join(broadcast_if_small(pairs)[0], "pair")
    return joined.select(
        F.col("asked").alias("qid"), "group_value", "group_rank", "rank_in_group", "id", "score"
    )


class GroupBest:
    """Each query's best row of every group, for its best ``groups`` groups."""

    CELLS = 1_000_000

    def __init__(self, queries: np.ndarray, groups: int, metric: str, max_norm2: float):
        self.scorer = Best(queries, 1, metric, max_norm2)
        self.scorer.k = np.iinfo(np.int64).max
        self.groups, self.queries = groups, len(queries)
        self.parts: list[tuple] = []
        self.waiting = 0
        self.kept = 0

    def add(self, rows: np.ndarray, ids: np.ndarray, values: np.ndarray) -> None:
        if self.scorer.metric == "cosine":
            rows = unit(rows)
        step = max(1, self.CELLS // len(rows))
        for start in range(0, self.queries, step):
            chunk = np.arange(start, min(start + step, self.queries))
            q, r, cost = self.scorer._candidates(chunk, rows)
            self.parts.append(self._cut(q, cost, ids[r], values[r]))
            self.waiting += len(self.parts[-1][0])
        if self.waiting > 2 * max(self.kept, 100_000):
            self._settle()

    def _settle(self) -> None:
        if self.parts:
            self.parts = [self._cut(*map(np.concatenate, zip(*self.parts)))]
            self.kept = self.waiting = len(self.parts[0][0])

    def _cut(self, q, cost, ids, values):
        tie = np.unique(ids, return_inverse=True)[1]
        group = np.unique(values.astype(str), return_inverse=True)[1]
        score = np.round(cost, TIE_DIGITS)
        order = np.lexsort((tie, score, group, q))
        head = np.ones(len(order), dtype=bool)
        head[1:] = (q[order][1:] != q[order][:-1]) | (group[order][1:] != group[order][:-1])
        order = order[head]
        order = order[np.lexsort((tie[order], score[order], q[order]))]
        at = np.arange(len(order))
        first = np.ones(len(order), dtype=bool)
        first[1:] = q[order][1:] != q[order][:-1]
        place = at - np.maximum.accumulate(np.where(first, at, 0)) if len(at) else at
        order = order[place < self.groups]
        return q[order], cost[order], ids[order], values[order]

    def batch(self, schema: pa.Schema) -> pa.RecordBatch:
        self._settle()
        if not self.parts:
            return pa.RecordBatch.from_arrays([pa.array([], f.type) for f in schema], schema=schema)
        q, cost, ids, values = self.parts[0]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(q, pa.int32()),
                pa.array(values, pa.string()),
                pa.array(ids, schema.field(2).type),
                pa.array(self.scorer.sign * cost),
            ],
            schema=schema,
        )
