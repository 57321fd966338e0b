"""Vector tables split into cells, query-to-cell matching, and the exact join of two large
tables.

A cell may hold any share of the table: it is cut into row blocks and query blocks of
bounded size, and each (cell, row block, query block) is one task-sized unit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from plumbline.functions.sizing import broadcast_if_small, materialize
from plumbline.operators import knn as exact
from plumbline.operators.blocks import (
    GATHER_ROWS,
    QUERY_CHUNK,
    ROW_CHUNK,
    Best,
    doubles,
    matrix,
    opening_rows,
    stored_rows,
    unit,
    values_of,
)

ROW_BLOCK = 50_000
QUERY_BLOCK = 8_192
BLOCK_BYTES = 64 << 20

# An assignment compares at most so many (row, cell) pairs at a time.
ASSIGN_PAIRS = 2_000_000

# A task of the exact join holds so many queries, or those of so many hits, while rows stream past.
JOIN_QUERIES = 16_384
JOIN_HITS = 4_000_000
# Rows that meet queries without K hits at a time.
SHARED_CHUNK = 512
# Vectors of one stripe or block that are shuffled as one value, in bytes.
PACK_BYTES = 1 << 20
# Queries whose hits are kept together.
KEPT_TOGETHER = 2_048
# The rows that stream past are four row blocks; with a large K up to so many, as the hits
# of the opening ones bound the rest.
OPENING_SHARE = 16


def place(rows: np.ndarray, metric: str, max_norm2: float, query: bool = False) -> np.ndarray:
    """Map vectors to a space where Euclidean order is the metric's order.

    Inner product gains one coordinate that makes all rows equally long.
    """
    if metric == "cosine":
        return unit(rows)
    if metric in ("ip", "mips_l2"):
        if query:
            extra = np.zeros((len(rows), 1))
        else:
            norms2 = np.einsum("ij,ij->i", rows, rows)[:, None]
            extra = np.sqrt(np.maximum(max_norm2 - norms2, 0.0))
        return np.hstack([rows, extra])
    return rows


def gaps(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    square = (
        np.einsum("ij,ij->i", rows, rows)[:, None]
        + np.einsum("ij,ij->i", centers, centers)[None, :]
        - 2 * rows @ centers.T
    )
    return np.sqrt(np.maximum(square, 0.0))


def train_centers(
    docs: DataFrame,
    *,
    vector: str,
    metric: str,
    cells: int,
    iterations: int,
    max_norm2: float = 0.0,
    seed: int = 7,
) -> np.ndarray:
    """K-means centres of all rows; as many as asked for, or as there are distinct rows.

    A table without a usable row has no centres.
    """
    rows = docs.select(vector).where(F.col(vector).isNotNull())

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = place(matrix(batch.column(0)), metric, max_norm2)
            out = out[~np.isnan(out).any(axis=1)]
            yield pa.RecordBatch.from_pydict({"v": pa.array(list(out), pa.list_(pa.float64()))})

    points = rows.mapInArrow(placed, "v array<double>").select(array_to_vector("v").alias("v"))
    if points.isEmpty():
        return np.empty((0, 0))
    if cells == 1:
        return np.array([points.select(Summarizer.mean(F.col("v"))).first()[0].toArray()])
    model = KMeans(
        k=cells, maxIter=iterations, featuresCol="v", predictionCol="cell", seed=seed
    ).fit(points)
    return np.vstack(model.clusterCenters())


def assign(
    docs: DataFrame,
    centers: np.ndarray,
    *,
    vector: str,
    metric: str,
    max_norm2: float = 0.0,
    spill_weight: float | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Every row with its nearest cell: ``(cell, id, vector, gap, *keep)``.

    With ``spill_weight`` each row also joins a second cell, the one minimising
    ``|r2|^2 + weight * (r2 . r1 / |r1|)^2`` over the residuals.
    """
    source = docs.select("id", vector, *keep).where(F.col(vector).isNotNull())
    schema = T.StructType(
        [T.StructField("cell", T.IntegerType())]
        + list(source.schema.fields)
        + [T.StructField("gap", T.DoubleType())]
    )
    arrow = to_arrow_schema(schema)

    step = max(1, ASSIGN_PAIRS // max(1, len(centers)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (b.slice(start, step) for b in batches for start in range(0, b.num_rows, step))
        for batch in parts if len(centers) else ():
            rows = place(matrix(batch.column(1)), metric, max_norm2)
            distance = gaps(rows, centers)
            sound = ~np.isnan(distance).any(axis=1)
            at = np.nonzero(sound)[0]
            if len(at) == 0:
                continue
            rows, distance = rows[at], distance[at]
            cell = distance.argmin(axis=1)
            if spill_weight is not None and len(centers) > 1:
                second = spill_cell(rows, centers, cell, distance, spill_weight)
                at = np.r_[at, at]
                gap = np.r_[distance.min(axis=1), distance[np.arange(len(rows)), second]]
                cell = np.r_[cell, second]
            else:
                gap = distance.min(axis=1)
            kept = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell, pa.int32()), *kept.columns, pa.array(gap)], schema=arrow
            )

    return source.mapInArrow(scan, schema)


def spill_cell(rows, centers, first, distance, weight):
    near = np.arange(len(rows))
    residual = rows - centers[first]
    length = np.linalg.norm(residual, axis=1, keepdims=True)
    direction = np.divide(residual, length, out=np.zeros_like(residual), where=length > 0)
    along = np.einsum("ij,ij->i", rows, direction)[:, None] - direction @ centers.T
    loss = distance**2 + weight * along**2
    loss[near, first] = np.inf
    return loss.argmin(axis=1)


def match_small(
    rows: DataFrame,
    block: exact.QueryBlock,
    probes: dict,
    k: int,
    *,
    vector: str,
    metric: str,
    max_norm2: float = 0.0,
) -> DataFrame:
    """Scan the probed cells once; ``probes`` maps a cell to the numbers of its queries.

    Rows stay where they are: only the cell list reaches the scan as a filter.
    """
    schema = exact.hit_schema(block.qid_type, rows.schema["id"].dataType)
    arrow = to_arrow_schema(schema)
    qids, vectors = block.qids, block.vectors

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(vectors, k, metric, max_norm2)
        for batch in batches:
            held = matrix(batch.column(2), vectors.shape[1])
            ids, cells = values_of(batch.column(1)), values_of(batch.column(0))
            names, group = np.unique(cells, return_inverse=True)
            for number, cell in enumerate(names.tolist()):
                which = probes.get(cell)
                if which is not None:
                    picked = np.nonzero(group == number)[0]
                    best.add(held[picked], ids[picked], which)
        yield best.batch(qids, arrow)

    probed = rows.where(F.col("cell").isin(list(probes)))
    return probed.select("cell", "id", vector).mapInArrow(scan, schema)


def match_listed(
    rows: DataFrame,
    block: exact.QueryBlock,
    asked: tuple[np.ndarray, np.ndarray],
    k: int,
    *,
    vector: str,
    metric: str,
    max_norm2: float = 0.0,
) -> DataFrame:
    """Scan rows that each list several ``cells``; ``asked`` pairs query numbers with cells.

    A row is scored once per query it shares a cell with, however many they share.
    """
    schema = exact.hit_schema(block.qid_type, rows.schema["id"].dataType)
    arrow = to_arrow_schema(schema)
    qids, vectors = block.qids, block.vectors
    names, cell = np.unique(asked[1], return_inverse=True)
    order = np.argsort(cell, kind="stable")
    held, start = asked[0][order], np.searchsorted(cell[order], np.arange(len(names) + 1))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(vectors, k, metric, max_norm2)
        for batch in batches:
            lists = batch.column(2)
            flat = np.asarray(lists.flatten())
            row = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(lists.offsets)))
            at = np.minimum(np.searchsorted(names, flat), len(names) - 1)
            hit = names[at] == flat
            row, at = row[hit], at[hit]
            fan = start[at + 1] - start[at]
            entry = np.repeat(np.arange(len(at)), fan)
            offset = np.arange(len(entry)) - np.repeat(np.cumsum(fan) - fan, fan)
            pair = np.unique(held[start[at][entry] + offset] * batch.num_rows + row[entry])
            if len(pair):
                vecs = matrix(batch.column(1), vectors.shape[1])
                ids = values_of(batch.column(0))
                best.add_pairs(vecs, ids, pair // batch.num_rows, pair % batch.num_rows)
        yield best.batch(qids, arrow)

    return rows.select("id", vector, "cells").mapInArrow(scan, schema)


def match_large(
    rows: DataFrame,
    probes: DataFrame,
    k: int,
    *,
    vector: str,
    metric: str,
    max_norm2: float = 0.0,
) -> DataFrame:
    """Join ``probes (qid, qvec, cell)`` to ``rows`` on the cell, block by block."""
    held = rows.groupBy("cell").agg(F.count("*").alias("n_rows"))
    asked = probes.groupBy("cell").agg(F.count("*").alias("n_queries"))
    plan = (
        held.join(asked, "cell")
        .select(
            "cell",
            F.ceil(F.col("n_rows") / ROW_BLOCK).cast("int").alias("row_blocks"),
            F.ceil(F.col("n_queries") / QUERY_BLOCK).cast("int").alias("query_blocks"),
        )
    )
    # One row per probed cell; unprobed cells drop out before the shuffle when it is small.
    plan, _ = broadcast_if_small(materialize(plan, "cell-plan"))
    left = (
        rows.select("cell", "id", vector)
        .join(plan, "cell")
        .withColumn("rb", F.pmod(F.xxhash64("id"), F.col("row_blocks")))
        .withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)))
        .select("cell", "rb", F.col("qb").cast("long").alias("qb"), "id", vector)
    )
    right = (
        probes.join(plan, "cell")
        .withColumn("qb", F.pmod(F.xxhash64("qid"), F.col("query_blocks")))
        .withColumn("rb", F.explode(F.sequence(F.lit(0), F.col("row_blocks") - 1)))
        .select("cell", F.col("rb").cast("long").alias("rb"), "qb", "qid", "qvec")
    )
    schema = exact.hit_schema(probes.schema["qid"].dataType, rows.schema["id"].dataType)
    arrow = to_arrow_schema(schema)

    def score(block: pa.Table, asked: pa.Table) -> pa.Table:
        if block.num_rows == 0 or asked.num_rows == 0:
            return arrow.empty_table()
        best = Best(matrix(asked["qvec"]), k, metric, max_norm2)
        best.add(matrix(block[vector]), values_of(block["id"]))
        return pa.Table.from_batches([best.batch(asked["qid"].combine_chunks(), arrow)])

    keys = ["cell", "rb", "qb"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(score, schema)


def probed_cells(
    distance: np.ndarray, probes: int, sizes: np.ndarray | None = None, need: int = 0
) -> list[np.ndarray]:
    """The cells that each query asks, nearest first: ``probes`` of them, and with ``sizes`` as
    many more as it takes to hold ``need`` rows. Cells without a row are left out then."""
    order = np.argsort(distance, axis=1, kind="stable")
    if sizes is None:
        return list(order[:, :probes])
    held = np.cumsum(sizes[order], axis=1)
    enough = np.where(held[:, -1] >= need, (held >= need).argmax(axis=1) + 1, order.shape[1])
    return [line[:n][sizes[line[:n]] > 0] for line, n in zip(order, np.maximum(enough, probes))]


def nearest_cells(
    queries: DataFrame,
    centers: np.ndarray,
    probes: int,
    *,
    metric: str,
    max_norm2: float = 0.0,
    sizes: np.ndarray | None = None,
    need: int = 0,
) -> DataFrame:
    """``(qid, qvec, cell)`` for the cells that each query asks, as in ``probed_cells``."""

    def pick(rows: np.ndarray) -> list[np.ndarray]:
        return probed_cells(gaps(place(rows, metric, max_norm2, query=True), centers), probes, sizes, need)

    return _expand(queries, pick)


def _expand(queries: DataFrame, pick) -> DataFrame:
    source = queries.select("qid", "qvec").where(F.col("qvec").isNotNull())
    schema = T.StructType(
        [source.schema["qid"], source.schema["qvec"], T.StructField("cell", T.IntegerType())]
    )
    arrow = to_arrow_schema(schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            cells = pick(matrix(batch.column(1)))
            at = np.repeat(np.arange(len(cells)), [len(c) for c in cells])
            flat = np.concatenate(cells) if cells else np.empty(0)
            kept = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays(
                [kept.column(0), kept.column(1), pa.array(flat.astype(np.int32))], schema=arrow
            )

    return source.mapInArrow(scan, schema)


def exact_join(docs: DataFrame, queries: DataFrame, k: int, *, vector: str, metric: str) -> DataFrame:
    """Exact top-K candidates when both tables are large.

    Rows are dealt to stripes and queries to blocks; a task holds one block of queries and lets
    one stripe stream past it, so it returns K hits per query and stripe.
    """
    rows = docs.select("id", F.col(vector).alias("vec")).where(F.col("vec").isNotNull())
    asked = queries.select("qid", "qvec").where(F.col("qvec").isNotNull())
    bound = exact.largest_norm2(docs, vector) if metric == "mips_l2" else 0.0
    return striped(rows, asked, k, metric=metric, max_norm2=bound)


def striped(
    rows: DataFrame, asked: DataFrame, k: int, *, metric: str, max_norm2: float = 0.0, reach: int | None = None
) -> DataFrame:
    """Best ``k`` of ``rows (id, vec)`` per query of ``asked (qid, qvec)`` and stripe.

    With ``reach`` both sides list ``cells``, one bucket key per hash table, and only pairs at
    most so many buckets apart in some table count.
    """
    held = F.octet_length("vec") if metric == "hamming" else F.size("vec")
    total, wide = rows.agg(F.count("*"), F.max(held)).first()
    width = (wide or 1) * 8 * (8 if metric == "hamming" else 1)
    block = max(1, min(ROW_BLOCK, BLOCK_BYTES // width))
    stripes = max(1, -(-total // (block * max(4, min(OPENING_SHARE, k // 5)))))
    number, cores = asked.count(), rows.sparkSession.sparkContext.defaultParallelism
    most = max(QUERY_CHUNK, min(JOIN_QUERIES, JOIN_HITS // k))
    shared = min(-(-number // KEPT_TOGETHER), -(-2 * cores // stripes))
    blocks = max(1, -(-number // most), shared)
    return _visit(rows, asked, stripes, blocks, k=k, metric=metric, max_norm2=max_norm2, reach=reach)


class Sharing(Best):
    """Pairs count only if their rows list a bucket at most ``reach`` away in some hash table."""

    def __init__(self, queries: np.ndarray, keys: np.ndarray, k: int, metric: str, max_norm2: float, reach: int):
        super().__init__(queries, k, metric, max_norm2)
        self.keys, self.reach = keys, reach

    def add_listed(self, rows: np.ndarray, ids: np.ndarray, keys: np.ndarray) -> None:
        for at, part in self.row_chunks(rows):
            # Until every query has K hits all pairs are looked at, so the first rows are few.
            while len(at):
                step = len(at) if np.isfinite(self.bound).all() else SHARED_CHUNK
                self._add_listed(part[:step], ids[at[:step]], keys[at[:step]])
                at, part = at[step:], part[step:]

    def _add_listed(self, rows: np.ndarray, ids: np.ndarray, keys: np.ndarray) -> None:
        right = self.right(rows)
        for start in range(0, len(self.queries), QUERY_CHUNK):
            chunk = np.arange(start, min(start + QUERY_CHUNK, len(self.queries)))
            among = None
            if not np.isfinite(self.bound[chunk]).all():
                among = np.zeros((len(chunk), len(rows)), dtype=bool)
                for table in range(keys.shape[1]):
                    among |= self._near(self.keys[chunk, table][:, None], keys[:, table][None, :])
                    if among.all():
                        break
            q, r, cost = self.found(chunk, rows, right, among)
            if among is None and len(q):
                parts = range(0, len(q), GATHER_ROWS)
                near = [self._near(self.keys[q[n : n + GATHER_ROWS]], keys[r[n : n + GATHER_ROWS]]).any(axis=1) for n in parts]
                near = np.concatenate(near)
                q, r, cost = q[near], r[near], cost[near]
            self.merge(q, cost, ids[r])
        self.settle()

    def _near(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left == right if self.reach == 0 else np.abs(left - right) <= self.reach


def packed(rows: DataFrame, key: str, vector: str, parts: int, listed: bool) -> DataFrame:
    """Rows dealt to ``parts`` by their key, those of one part and batch together:
    ``(part, keys, kind, vecs)``, with ``listed`` also ``cells``.

    Every part goes to many tasks, and bytes are copied with less work than arrays. The part
    follows from the key, so a task that runs again deals its rows as before.
    """
    dealt = F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")
    source = rows.select(dealt.alias("part"), key, vector, *["cells"] * listed)
    schema = T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("keys", T.ArrayType(rows.schema[key].dataType)),
            T.StructField("kind", T.StringType()),
            T.StructField("vecs", T.BinaryType()),
        ]
        + [T.StructField("cells", T.BinaryType())] * listed
    )
    arrow = to_arrow_schema(schema)
    lists = arrow.field("keys").type

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            part, vecs = values_of(batch.column(0)), stored_rows(batch.column(2))
            order = np.argsort(part, kind="stable")
            part, vecs = part[order], vecs[order]
            keys = batch.column(1).take(pa.array(order)).cast(lists.value_type)
            step = max(1, PACK_BYTES // max(1, vecs.itemsize * vecs.shape[1]))
            change = np.flatnonzero(part[1:] != part[:-1]) + 1
            ends = [0, *change.tolist(), len(part)]
            cuts = [n for low, high in zip(ends, ends[1:]) for n in range(low, high, step)]
            spans = list(zip(cuts, [*cuts[1:], len(part)]))
            columns = [
                pa.array(part[cuts], pa.int32()),
                pa.ListArray.from_arrays(pa.array([*cuts, len(part)], pa.int32()), keys, type=lists),
                pa.array([vecs.dtype.str] * len(cuts)),
                pa.array([vecs[low:high].tobytes() for low, high in spans], pa.binary()),
            ]
            if listed:
                cells = listed_keys(batch.column(3))[order]
                columns.append(pa.array([cells[low:high].tobytes() for low, high in spans], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return source.mapInArrow(scan, schema)


class Unit:
    """A block of queries while the rows of one stripe stream past."""

    def __init__(self, k: int, metric: str, max_norm2: float, reach: int | None):
        self.options, self.reach = (k, metric, max_norm2), reach
        self.asked: list[tuple] = []
        self.best: list[tuple[pa.Array, Best]] = []
        self.rows: list[tuple] = []
        self.waiting, self.enough = 0, ROW_CHUNK

    def ask(self, qids: pa.Array, vectors: np.ndarray, keys: np.ndarray | None) -> None:
        self.asked.append((qids, vectors, keys))

    def meet(self, ids: pa.Array, vectors: np.ndarray, keys: np.ndarray | None) -> None:
        if self.asked:
            qids, asked, listed = _joined(self.asked)
            self.asked = []
            for start in range(0, len(qids), KEPT_TOGETHER):
                part = slice(start, start + KEPT_TOGETHER)
                if self.reach is None:
                    best = Best(asked[part], *self.options)
                else:
                    best = Sharing(asked[part], listed[part], *self.options, self.reach)
                self.best.append((qids.slice(start, KEPT_TOGETHER), best))
            if self.reach is None:
                self.enough = min(opening_rows(self.options[0]), max(ROW_CHUNK, BLOCK_BYTES // max(1, vectors[0].nbytes)))
        if self.best:
            self.rows.append((ids, vectors, keys))
            self.waiting += len(ids)
        if self.waiting >= self.enough:
            self.score()
            self.enough = ROW_CHUNK

    def score(self) -> None:
        if not self.rows:
            return
        ids, vectors, keys = _joined(self.rows)
        self.rows, self.waiting, ids = [], 0, values_of(ids)
        for _, best in self.best:
            if self.reach is None:
                best.add(vectors, ids)
            else:
                best.add_listed(vectors, ids, keys)

    def hits(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        self.score()
        return (best.batch(qids, schema) for qids, best in self.best)


def _joined(parts: list[tuple]) -> tuple[pa.Array, np.ndarray, np.ndarray | None]:
    keys, vectors, cells = zip(*parts)
    return pa.concat_arrays(keys), np.concatenate(vectors), None if cells[0] is None else np.concatenate(cells)


def _visit(
    rows: DataFrame, asked: DataFrame, stripes: int, blocks: int, *, k: int, metric: str, max_norm2: float, reach: int | None
) -> DataFrame:
    """Each stripe's best ``k`` rows per query."""
    schema = exact.hit_schema(asked.schema["qid"].dataType, rows.schema["id"].dataType)
    arrow = to_arrow_schema(schema)
    listed = reach is not None

    def every(parts: int) -> F.Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    # Queries come first in each unit of a stripe and a block.
    left = packed(asked, "qid", "qvec", blocks, listed).withColumn("stripe", every(stripes))
    left = left.withColumn("unit", F.col("stripe") * blocks + F.col("part")).withColumn("side", F.lit(0))
    right = packed(rows, "id", "vec", stripes, listed).withColumn("block", every(blocks))
    right = right.withColumn("unit", F.col("part") * blocks + F.col("block")).withColumn("side", F.lit(1))
    both = left.withColumnRenamed("keys", "qids").unionByName(
        right.withColumnRenamed("keys", "ids"), allowMissingColumns=True
    )
    # A task per unit: hashed, some tasks would get several and others none.
    tasks = min(stripes * blocks, 2_000)
    both = both.repartitionById(tasks, F.pmod("unit", F.lit(tasks))).sortWithinPartitions("unit", "side")
    both = both.select("unit", "side", "kind", "qids", "ids", "vecs", *["cells"] * listed)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, unit = None, None
        for batch in batches:
            units, sides, kinds = (batch.column(n).to_pylist() for n in range(3))
            for n, (number, side, kind) in enumerate(zip(units, sides, kinds)):
                if number != at:
                    if unit is not None:
                        yield from unit.hits(arrow)
                    at, unit = number, Unit(k, metric, max_norm2, reach)
                keys = batch.column(3 + side)[n].values
                vectors = np.frombuffer(batch.column(5)[n].as_buffer(), dtype=kind).reshape(len(keys), -1)
                cells = None
                if listed:
                    cells = np.frombuffer(batch.column(6)[n].as_buffer(), dtype=np.int64).reshape(len(keys), -1)
                (unit.meet if side else unit.ask)(keys, doubles(vectors), cells)
        if unit is not None:
            yield from unit.hits(arrow)

    return both.mapInArrow(scan, schema)


def listed_keys(column: pa.Array) -> np.ndarray:
    """Bucket keys of each row, one per hash table."""
    return np.asarray(column.flatten(), dtype=np.int64).reshape(len(column), -1)


def one_per_pair(hits: DataFrame) -> DataFrame:
    """One row per (query, document) when rows live in several cells."""
    return hits.groupBy("qid", "id").agg(F.min("score").alias("score"))
