"""Inverted-file index: build, second-cell spilling, probe search."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.errors import positive_int32
from plumbline.functions.ranking import ASCENDING, top_k
from plumbline.functions.sizing import discard, materialize
from plumbline.operators import cells as grid
from plumbline.operators import knn as exact

# The defaults users of an inverted-file index expect.
DEFAULT_CELLS = 1_024
DEFAULT_ITERATIONS = 10
DEFAULT_PROBES = 10

SPILL_WEIGHT = 1.0


@dataclass(frozen=True)
class CellIndex:
    """Rows by cell, the cell centres, and what is needed to score them again."""

    rows: DataFrame
    centers: np.ndarray
    vector: str
    metric: str
    max_norm2: float = 0.0
    spilled: bool = False


def build_ivf(
    docs: DataFrame,
    *,
    vector: str = "embedding",
    metric: str = "cosine",
    cells: int = DEFAULT_CELLS,
    iterations: int = DEFAULT_ITERATIONS,
    spill: bool = False,
    centers: np.ndarray | None = None,
    keep: tuple[str, ...] = (),
    path: str | None = None,
) -> CellIndex:
    """Cluster ``vector`` and store every row under its cell.

    ``keep`` names columns carried into the index so that searches can filter on them.
    The side table is partitioned by cell, which lets a search read only what it probes.
    """
    exact.check_search(docs, vector, metric, 1)
    positive_int32(cells, "cells")
    positive_int32(iterations, "iterations")
    bound = exact.largest_norm2(docs, vector) if metric in ("ip", "mips_l2") else 0.0
    if centers is None:
        centers = grid.train_centers(
            docs,
            vector=vector,
            metric=metric,
            cells=cells,
            iterations=iterations,
            max_norm2=bound,
        )
    rows = grid.assign(
        docs,
        centers,
        vector=vector,
        metric=metric,
        max_norm2=bound,
        spill_weight=SPILL_WEIGHT if spill else None,
        keep=keep,
    )
    # Ranges of (cell, hash) hold similar numbers of rows: a small cell lands in one file, a
    # large one is cut over as many tasks as its size asks for. The assignment is stored
    # first because placing ranges reads it twice.
    assigned = materialize(rows, "assigned")
    spread = assigned.repartitionByRange(F.col("cell"), F.xxhash64("id"))
    if path is None:
        stored = materialize(spread, "ivf", partition_by=["cell"])
    else:
        spread.write.mode("errorifexists").partitionBy("cell").parquet(path)
        stored = docs.sparkSession.read.schema(rows.schema).parquet(path)
    discard(assigned)
    return CellIndex(stored, centers, vector, metric, bound, spill)


def search_ivf(
    index: CellIndex,
    queries: DataFrame,
    k: int,
    *,
    probes: int = DEFAULT_PROBES,
    where: str | None = None,
    radius: float | None = None,
    fill: bool | None = None,
) -> DataFrame:
    """Top ``k`` among the rows of each query's ``probes`` nearest cells.

    With ``fill`` (by default under a filter) a query goes on to further cells, in order of
    distance, until those it has asked hold ``k`` passing rows or none is left; how many pass in
    each cell is told by one grouped count.
    """
    positive_int32(k, "k")
    positive_int32(probes, "probes")
    rows = index.rows.where(where) if where and where.strip() else index.rows
    probes = min(probes, len(index.centers))
    options = {"vector": index.vector, "metric": index.metric, "max_norm2": index.max_norm2}
    block = exact.small_queries(queries)
    if not len(index.centers) or (block is not None and len(block) == 0):
        empty = exact.hit_schema(queries.schema["qid"].dataType, rows.schema["id"].dataType)
        nothing = queries.sparkSession.createDataFrame([], empty)
        return top_k(nothing, k, ascending=ASCENDING[index.metric])
    if block is None:
        exact.check_distinct(queries)
    # A row stored under two cells can take two places, so twice K are kept until then.
    cut = 2 * k if index.spilled else k
    sizes = None
    if where and where.strip() if fill is None else fill:
        sizes = np.zeros(len(index.centers), dtype=np.int64)
        # One row per cell.
        for cell, n in rows.groupBy("cell").count().collect():
            sizes[cell] = n
    if block is not None:
        placed = grid.place(block.vectors, index.metric, index.max_norm2, query=True)
        asked: dict[int, list[int]] = {}
        for number, line in enumerate(grid.probed_cells(grid.gaps(placed, index.centers), probes, sizes, cut)):
            for cell in line.tolist():
                asked.setdefault(cell, []).append(number)
        lists = {cell: np.array(numbers) for cell, numbers in asked.items()}
        hits = grid.match_small(rows, block, lists, cut, **options)
    else:
        near = grid.nearest_cells(
            queries, index.centers, probes, metric=index.metric, max_norm2=index.max_norm2, sizes=sizes, need=cut
        )
        hits = grid.match_large(rows, near, cut, **options)
    if index.spilled:
        hits = grid.one_per_pair(hits)
    ranked = top_k(hits, k, ascending=ASCENDING[index.metric])
    return exact.within(ranked, index.metric, radius)


def completeness(docs: DataFrame, index_rows: DataFrame, vector: str) -> DataFrame:
    """Share of the documents holding ``vector`` that the index covers."""
    held = docs.where(F.col(vector).isNotNull()).select("id")
    covered = index_rows.select("id").distinct().withColumn("hit", F.lit(1))
    return held.join(covered, "id", "left").agg(
        F.count("*").alias("eligible"),
        F.count("hit").alias("indexed"),
        F.when(F.count("*") == 0, 1.0)
        .otherwise(F.count("hit") / F.count("*"))
        .alias("completeness"),
    )
