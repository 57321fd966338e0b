"""Measured-size broadcasts and the shared folder for cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024


def _width(column: F.Column, dtype: T.DataType) -> F.Column:
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        size = F.octet_length(column).cast("long") + 16
    elif isinstance(dtype, T.ArrayType):
        if isinstance(dtype.elementType, (T.StringType, T.BinaryType)):
            size = F.aggregate(
                column, F.lit(0).cast("long"), lambda acc, x: acc + F.octet_length(x) + 16
            )
        else:
            size = F.size(column).cast("long") * 8 + 24
    elif isinstance(dtype, T.StructType):
        size = F.lit(8).cast("long")
        for field in dtype.fields:
            size = size + _width(column[field.name], field.dataType)
    else:
        size = F.lit(8).cast("long")
    return F.coalesce(size, F.lit(8).cast("long"))


def measured_bytes(df: DataFrame) -> int:
    """In-memory size of ``df``, summed in one map-side aggregate."""
    width = F.lit(16).cast("long")
    for field in df.schema.fields:
        width = width + _width(F.col(f"`{field.name}`"), field.dataType)
    total = df.select(F.sum(width).alias("b")).first()["b"]
    return int(total or 0)


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Hint a broadcast only when the measured size is under ``limit``.

    Beyond it the frame comes back without a hint and the join shuffles.
    """
    if measured_bytes(df) <= limit:
        return F.broadcast(df), True
    return df, False


_own_folder: str | None = None


def use_scratch(folder: str | None) -> None:
    """Name a scratch folder for local sessions that set none, as tests and tools do."""
    global _own_folder
    _own_folder = folder


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; every executor reaches it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and spark.sparkContext.master.startswith("local"):
        folder = _own_folder
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return folder


def materialize(df: DataFrame, name: str = "stage", partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut and losing
    an executor costs a file read, not a recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/plumbline/{name}-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.scratch_path = path
    return stored


def discard(*frames: DataFrame | None) -> None:
    """Remove what ``materialize`` wrote for frames that nothing reads any more."""
    for frame in frames:
        path = getattr(frame, "scratch_path", None)
        if path:
            context = frame.sparkSession.sparkContext
            target = context._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)
