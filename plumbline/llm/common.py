"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Column = F.Column

# Output rows of a task are handed over in batches of about this many bytes.
BATCH_BYTES = 4 << 20

# Most bytes that Spark hands to a Python task at once.
INPUT_BYTES = 4 << 20

# ASCII white space: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\f\r"

# Some Unicode versions count these as white space, others do not.
DOUBTFUL = "\u180e\u200b\u2060\ufeff"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Set the session's limit on Arrow batches to ``INPUT_BYTES``: texts and payloads vary
    in length by orders of magnitude, and both sides hold a few batches at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(INPUT_BYTES))


def give_back() -> None:
    """Return what a worker has freed to the system: workers are kept between tasks, and idle ones
    share an executor's memory with those of later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is computed once per row however often it is used."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Pieces between ASCII white space."""
    flat = F.translate(text, SPACES[1:], " " * 5)
    return F.filter(F.split(flat, " "), lambda w: w != "")


def held_out(doc_id: Column) -> Column:
    """True for the third of the rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def binary_rows(column: pa.Array, dtype: np.dtype, width: int) -> np.ndarray:
    """Equally long binary values as the rows of a matrix."""
    flat = np.frombuffer(b"".join(column.to_pylist()), dtype=dtype)
    return flat.reshape(len(column), width)


def mix(*parts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of equally long integer arrays, element by element."""
    h = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        for part in parts:
            h = h ^ np.asarray(part).astype(np.uint64)
            h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            h = h ^ (h >> np.uint64(31))
    return h


def sorted_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str]
) -> Iterator[pa.Table]:
    """The groups of a partition that is sorted by ``keys``, one table each."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, dtype=bool)
        for values in columns:
            change[1:] |= values[1:] != values[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            if start == end:
                continue
            key = tuple(values[start] for values in columns)
            if last is not None and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)
