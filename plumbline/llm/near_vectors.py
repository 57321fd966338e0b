"""Near-duplicate vectors by p-stable hashing with exact cosine checks.

A table hashes a normalised vector by K quantised random projections ``floor((a·x + b) / w)``;
vectors that agree on all K share a bucket. Two vectors at a Euclidean distance d agree on one
projection with a probability that falls with d (Gaussian projections are 2-stable), so enough
tables let every close pair meet while distant pairs rarely do. K follows from the number of
rows, the number of tables from K and the pairs that may be missed. Buckets propose, cosines in
double precision decide.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.sizing import discard, materialize
from plumbline.llm.common import binary_rows, mix, small_batches
from plumbline.llm.linking import BUCKET_ROW, LEAF_ROWS, Sketching, in_batches, link_items

COSINE = 0.95
# Width of a projection's interval, in lengths of the unit sphere's radius.
WIDTH = 2.5
# Distant vectors that share a bucket of one table with a vector, on average.
STRANGERS = 32
# A pair at the threshold is in no common bucket with this probability.
MISSED = 1e-4
# Distance taken for unrelated vectors.
FAR = 1.3

SIGNS = 128
CODES = 16
DEEPER = 4

ITEM = pa.schema(
    [
        ("id", pa.int64()),
        ("class_key", pa.binary()),
        ("units", pa.int64()),
        ("payload", pa.binary()),
        ("vector", pa.binary()),
    ]
)


def agreement(distance: float, width: float = WIDTH) -> float:
    """Probability that one quantised projection agrees for two vectors at a distance."""
    c = width / distance
    below = 0.5 * math.erfc(c / math.sqrt(2))
    return 1 - 2 * below - 2 / (math.sqrt(2 * math.pi) * c) * (1 - math.exp(-c * c / 2))


def table_plan(rows: int, cosine: float = COSINE, missed: float = MISSED) -> tuple[int, int]:
    """Projections per table and tables for so many rows."""
    near, far = agreement(math.sqrt(2 - 2 * cosine)), agreement(FAR)
    projections = max(2, math.ceil(math.log(max(rows, 2) / STRANGERS) / math.log(1 / far)))
    tables = math.ceil(math.log(missed) / math.log(1 - near**projections))
    return projections, tables


@lru_cache(maxsize=8)
def projections(dims: int, count: int, purpose: int) -> tuple[np.ndarray, np.ndarray]:
    """Gaussian directions and uniform shifts, the same in every task."""
    rng = np.random.default_rng([1, purpose, dims, count])
    return rng.standard_normal((dims, count)), rng.uniform(0, WIDTH, count)


def _usable(value: list | None) -> np.ndarray | None:
    """The normalised vector, or None for null, zero or non-finite ones."""
    if not value or any(x is None for x in value):
        return None
    vector = np.array(value, dtype=np.float64)
    if not np.isfinite(vector).all():
        return None
    # Scaled first, so that neither very large nor very small components leave the range.
    largest = np.abs(vector).max()
    if not largest > 0:
        return None
    vector = vector / largest + 0.0
    return vector / math.sqrt(float(vector @ vector))


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for vec_id, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                vector = _usable(value.as_py())
                if vector is None:
                    yield vec_id, None, 0, None, None
                    continue
                load = vector.tobytes()
                yield vec_id, hashlib.blake2b(load, digest_size=16).digest(), len(vector), load, load

    yield from in_batches(ITEM, rows())


def _bucket_rows(per_table: int, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.array([len(v) // 8 for v in batch.column("vector").to_pylist()])
            for size in np.unique(dims):
                part = batch.take(pa.array(np.flatnonzero(dims == size)))
                x = binary_rows(part.column("vector"), np.float64, int(size))
                signs = np.packbits(x @ projections(int(size), SIGNS, 1)[0] > 0, axis=1)
                a, b = projections(int(size), CODES, 2)
                codes = np.floor((x @ a + b) / WIDTH).astype(np.int8).view(np.uint8)
                sketch = pa.array([bytes(row) for row in np.hstack([signs, codes])], type=pa.binary())
                a, b = projections(int(size), per_table * tables, 3)
                cells = np.floor((x @ a + b) / WIDTH).astype(np.int64)
                for table in range(tables):
                    own = cells[:, table * per_table : (table + 1) * per_table]
                    key = mix(np.full(len(x), size), np.full(len(x), table), *own.T)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(key.astype(np.int64)),
                            part.column("id"),
                            pa.array(np.ones(len(x), dtype=bool)),
                            sketch,
                        ],
                        names=["key", "id", "open", "sketch"],
                    )

    return run


_BITS = np.array([bin(b).count("1") for b in range(256)], dtype=np.int32)


def _alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal signs, which falls linearly with the angle."""
    n = SIGNS // 8
    return 1 - _BITS[a[..., :n] ^ b[..., :n]].sum(axis=-1) / SIGNS


def _children(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A large bucket is divided by further projections, which ones depends on the bucket."""
    codes = rows[:, SIGNS // 8 :]
    index, key = np.arange(len(keys)), mix(keys)
    for turn in range(DEEPER):
        chosen = (mix(keys, np.full(len(keys), turn)) % np.uint64(CODES)).astype(np.int64)
        key = mix(key, chosen, codes[index, chosen])
    return index, key.astype(np.int64)


# At a cosine of 0.95 the angle is 18.2 degrees, and 10 % of the signs differ, give or take
# 2.7 %. Links from 75 % agreement on miss such a pair once in millions. Rows within 5 % of a
# pivot leave the bucket; what is similar to them differs from the pivot in a fifth or so.
SKETCHING = Sketching(
    width=SIGNS // 8 + CODES, similarity=_alike, children=_children, link=0.75, pivot_link=0.66, near=0.95
)


def linked_vectors(cosine: float):
    def run(left: list[bytes], right: list[bytes], same: bool) -> np.ndarray:
        sizes = [len(v) for v in left + right]
        if len(set(sizes)) > 1:  # different dimensions never share a bucket
            out = np.zeros((len(left), len(right)), dtype=bool)
            for size in set(sizes):
                i = [k for k, v in enumerate(left) if len(v) == size]
                j = [k for k, v in enumerate(right) if len(v) == size]
                if i and j:
                    out[np.ix_(i, j)] = run([left[k] for k in i], [right[k] for k in j], False)
            return out
        a = np.frombuffer(b"".join(left), dtype=np.float64).reshape(len(left), -1)
        b = a if same else np.frombuffer(b"".join(right), dtype=np.float64).reshape(len(right), -1)
        return a @ b.T >= cosine

    return run


def vector_links(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    cosine: float = COSINE,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links`` (other vectors at this cosine or above,
    copies included), ``component_id`` (smallest id reachable by links), ``kept``
    (``vec_id = component_id``), ``class_id`` and ``n_class_links``.

    Vectors that are null, zero or hold null or non-finite components, and rows with a null
    id, link with nothing and are kept; so do vectors of different dimensions among each
    other. Rows that repeat an id and its vector count as one. Other columns are ignored.
    """
    small_batches(vectors.sparkSession)
    chosen = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("v"))
    schema = "id long, class_key binary, units long, payload binary, vector binary"
    items = materialize(chosen.mapInArrow(_items, schema), "vectors")
    per_table, tables = table_plan(items.count(), cosine)
    rows = _bucket_rows(per_table, tables)
    found = link_items(
        items,
        lambda heads: heads.select("id", "vector").mapInArrow(rows, BUCKET_ROW),
        SKETCHING,
        linked_vectors(cosine),
        leaf_rows,
    )
    alone = items.where("class_key is null or id is null").select("id").distinct()
    nothing = F.lit(0).cast("long")
    alone = alone.select(
        "id",
        F.col("id").alias("class_id"),
        F.col("id").alias("component_id"),
        nothing.alias("n_links"),
        nothing.alias("n_class_links"),
    )
    alone = materialize(alone, "unlinked")
    discard(items)
    every = found.select(*alone.columns).union(alone).withColumnRenamed("id", "vec_id")
    return every.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
