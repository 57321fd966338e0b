"""Approximate top-K with one effort knob, over random-projection buckets."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from plumbline.errors import positive_int32
from plumbline.functions.ranking import ASCENDING, top_k
from plumbline.functions.sizing import broadcast_if_small, materialize
from plumbline.operators import cells as grid
from plumbline.operators import knn as exact
from plumbline.operators.blocks import matrix, values_of

# Fixed value: the usual default search effort.
DEFAULT_EFFORT = 50

TABLES = 16
BUCKET_LENGTH = 0.5
SEED = 7
# Buckets are wide if one in so many pairs of a row and a query meets in them.
WIDE_SHARE = 4

# A key is the table's number above, the bucket's number below.
MIDDLE = 1 << 31


@dataclass(frozen=True)
class BucketIndex:
    """Rows with the keys of their buckets, one per table, and how the keys are made."""

    rows: DataFrame
    vector: str
    metric: str
    max_norm2: float = 0.0
    tables: int = TABLES
    bucket_length: float = BUCKET_LENGTH
    seed: int = SEED


def _keys(rows: np.ndarray, index: BucketIndex) -> np.ndarray:
    rng = np.random.default_rng([index.seed, rows.shape[1]])
    axes = rng.standard_normal((rows.shape[1], index.tables))
    axes /= np.linalg.norm(axes, axis=0)
    # Far buckets of extreme vectors fold into the outermost ones.
    bucket = np.clip(np.floor(rows @ axes / index.bucket_length), -MIDDLE, MIDDLE - 1)
    return (np.arange(index.tables) << 32) + (bucket.astype(np.int64) + MIDDLE)


def _bucketed(df: DataFrame, vector: str, index: BucketIndex, query: bool) -> DataFrame:
    """Add ``cells``: one bucket key per hash table; rows no metric can place drop out."""
    name = df.columns[0]
    metric, bound = index.metric, index.max_norm2
    plain = BucketIndex(None, vector, metric, bound, index.tables, index.bucket_length, index.seed)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = grid.place(matrix(batch.column(1)), metric, bound, query)
            sound = np.nonzero(~np.isnan(rows).any(axis=1))[0]
            if not len(sound):
                continue
            kept = batch.take(pa.array(sound))
            keys = pa.array(list(_keys(rows[sound], plain)), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns, keys], names=[*kept.schema.names, "cells"])

    dtype, kind = df.schema[0].dataType.simpleString(), df.schema[vector].dataType.simpleString()
    held = df.select(name, vector).where(F.col(vector).isNotNull())
    return held.mapInArrow(scan, f"`{name}` {dtype}, `{vector}` {kind}, cells array<bigint>")


def build_lsh(
    docs: DataFrame,
    *,
    vector: str = "embedding",
    metric: str = "cosine",
    tables: int = TABLES,
    bucket_length: float = BUCKET_LENGTH,
    seed: int = SEED,
    path: str | None = None,
) -> BucketIndex:
    """Hash every row into ``tables`` buckets; rows are stored once, with their bucket keys."""
    exact.check_search(docs, vector, metric, 1)
    bound = exact.largest_norm2(docs, vector) if metric in ("ip", "mips_l2") else 0.0
    index = BucketIndex(None, vector, metric, bound, tables, bucket_length, seed)
    bucketed = _bucketed(docs.select("id", vector), vector, index, query=False)
    if path is None:
        rows = materialize(bucketed, "lsh")
    else:
        bucketed.write.mode("errorifexists").parquet(path)
        rows = docs.sparkSession.read.schema(bucketed.schema).parquet(path)
    return BucketIndex(rows, vector, metric, bound, tables, bucket_length, seed)


def _widest(index: BucketIndex, queries: DataFrame) -> int:
    """How many buckets rows and queries span in the widest table."""
    placed = _bucketed(queries.select("qid", "qvec"), "qvec", index, query=True)
    cells = index.rows.select("cells").union(placed.select("cells"))
    key = cells.select(F.explode("cells").alias("key"))
    table, bucket = F.shiftright("key", 32), F.col("key").bitwiseAND(F.lit((1 << 32) - 1))
    spans = key.groupBy(table.alias("table")).agg((F.max(bucket) - F.min(bucket)).alias("span"))
    return int(spans.agg(F.max("span")).first()[0] or 0)


def _meetings(index: BucketIndex, placed: DataFrame, reach: int) -> int:
    """(row, query) pairs that are at most ``reach`` buckets apart, counted in every table."""
    rows = index.rows.select(F.explode("cells").alias("cell")).groupBy("cell").agg(F.count("*").alias("n"))
    asked = placed.select(F.explode("cells").alias("key")).groupBy("key").agg(F.count("*").alias("m"))
    asked = asked.select(F.explode(_steps("key", reach)).alias("cell"), "m")
    pairs = rows.join(asked, "cell").agg(F.sum(F.col("n").cast("double") * F.col("m")))
    return int(pairs.first()[0] or 0)


def _steps(key: str | F.Column, reach: int) -> F.Column:
    steps = F.sequence(F.lit(-reach).cast("long"), F.lit(reach).cast("long"))
    return F.transform(steps, lambda step: (F.col(key) if isinstance(key, str) else key) + step)


def _hits(index: BucketIndex, queries: DataFrame, cut: int, reach: int, whole: bool) -> DataFrame:
    """The best ``cut`` rows per query among those at most ``reach`` buckets away; ``whole`` says
    that those are all rows."""
    placed = _bucketed(queries.select("qid", "qvec"), "qvec", index, query=True)
    block = exact.small_queries(queries)
    options = {"metric": index.metric, "max_norm2": index.max_norm2}
    if block is not None and whole:
        hits = _scan_all(index, block, cut, reach)
    elif block is not None:
        probes = placed.withColumn("cells", F.flatten(F.transform("cells", lambda key: _steps(key, reach))))
        keys = probes.select("qid", F.explode("cells").alias("cell")).toArrow()
        numbers = pc.index_in(keys["qid"], block.qids).to_numpy()
        asked = (numbers.astype(np.int64), keys["cell"].to_numpy())
        hits = grid.match_listed(index.rows, block, asked, cut, vector=index.vector, **options)
    elif whole or _meetings(index, placed, reach) * WIDE_SHARE >= index.rows.count() * placed.count():
        # Where most pairs meet, looking at each of them once is less than joining every table.
        rows = index.rows.select("id", F.col(index.vector).alias("vec"), "cells")
        hits = grid.striped(rows, placed, cut, reach=reach, **options)
        return top_k(hits, cut, ascending=ASCENDING[index.metric])
    else:
        rows = index.rows.withColumn("cell", F.explode("cells"))
        near = F.flatten(F.transform("cells", lambda key: _steps(key, reach)))
        asked = placed.withColumn("cell", F.explode(near)).drop("cells")
        hits = grid.match_large(rows, asked, cut, vector=index.vector, **options)
    return top_k(grid.one_per_pair(hits), cut, ascending=ASCENDING[index.metric])


def _scan_all(index: BucketIndex, block: exact.QueryBlock, cut: int, reach: int) -> DataFrame:
    """One pass over the rows; each task returns its best ``cut`` rows per query."""
    schema = exact.hit_schema(block.qid_type, index.rows.schema["id"].dataType)
    arrow = to_arrow_schema(schema)
    plain = replace(index, rows=None)
    qids, vectors = block.qids, block.vectors

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sound = np.flatnonzero(~np.isnan(grid.place(vectors, plain.metric, plain.max_norm2, True)).any(axis=1))
        asked = vectors[sound]
        keys = _keys(grid.place(asked, plain.metric, plain.max_norm2, True), plain)
        best = grid.Sharing(asked, keys, cut, plain.metric, plain.max_norm2, reach)
        for batch in batches:
            if batch.num_rows and len(sound):
                rows = matrix(batch.column(1), vectors.shape[1])
                best.add_listed(rows, values_of(batch.column(0)), grid.listed_keys(batch.column(2)))
        yield best.batch(qids.take(pa.array(sound)), arrow)

    return index.rows.select("id", index.vector, "cells").mapInArrow(scan, schema)


def search_lsh(
    index: BucketIndex,
    queries: DataFrame,
    k: int,
    *,
    effort: int = DEFAULT_EFFORT,
    radius: float | None = None,
) -> DataFrame:
    """Top ``k`` by exact score among rows sharing a bucket with the query.

    A query that meets fewer than ``max(k, effort)`` rows looks into the neighbouring buckets,
    twice as far each time, until it has met that many or there are no more. An effort beyond the
    number of rows is never met, so such a search looks into all buckets at once.
    """
    positive_int32(k, "k")
    effort = max(k, positive_int32(effort, "effort"))
    exact.check_distinct(queries)
    widest, reach, kept = None, 0, None
    asked = queries.select("qid", "qvec").where(F.col("qvec").isNotNull())
    if effort > index.rows.count():
        reach = widest = _widest(index, queries)
    while True:
        whole = widest is not None and reach >= widest
        # How many rows a query meets no longer matters once it has looked at all.
        found = _hits(index, asked, k if whole else effort, reach, whole).drop("rank")
        if whole:
            kept = found if kept is None else kept.unionByName(found)
            break
        found = materialize(found, "lsh-hits")
        enough = found.groupBy("qid").count().where(F.col("count") >= effort).select("qid")
        enough = materialize(enough, "lsh-answered")
        lacking = asked.join(broadcast_if_small(enough)[0], "qid", "left_anti")
        if lacking.isEmpty():
            kept = found if kept is None else kept.unionByName(found)
            break
        if widest is None:
            widest = _widest(index, queries)
        if reach >= widest:
            kept = found if kept is None else kept.unionByName(found)
            break
        done = found.join(broadcast_if_small(enough)[0], "qid", "left_semi")
        kept = done if kept is None else kept.unionByName(done)
        asked, reach = materialize(lacking, "lsh-lacking"), 2 * reach + 1
    ranked = top_k(kept, k, ascending=ASCENDING[index.metric])
    return exact.within(ranked, index.metric, radius)
