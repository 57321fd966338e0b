"""A stream of changes applied to a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from plumbline.operators.changes import Applied, apply_changes
from plumbline.sources.table import Table


class ChangeStream:
    """Logs each micro-batch, then replays the logged batches over the table.

    A micro-batch costs one append: folder ``batch=<id>`` is overwritten when Spark retries
    a batch, so every change is logged once. ``fold`` writes the outcome as one table layer
    together with the last batch it covers, so a repeated fold replays nothing twice.
    """

    def __init__(self, spark: SparkSession, log_path: str, order: tuple[str, ...] = ("seq",)):
        self.spark, self.log_path, self.order = spark, log_path.rstrip("/"), order

    def start(self, changes: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        """Begin logging ``changes``; by default all available input, then stop."""
        path = self.log_path

        def log(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

        return (
            changes.writeStream.foreachBatch(log)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )

    def pending(self, schema: T.StructType, after: int = -1, upto: int | None = None) -> DataFrame:
        """Logged changes of batches later than ``after``; only their folders are read. No rows
        where nothing was logged yet."""
        if not self._logged():
            return self.spark.createDataFrame([], schema)
        numbered = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
        logged = self.spark.read.schema(numbered).option("basePath", self.log_path)
        rows = logged.parquet(self.log_path).where(F.col("batch") > after)
        if upto is not None:
            rows = rows.where(F.col("batch") <= upto)
        return rows.drop("batch")

    def _logged(self) -> bool:
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(self.log_path)
        return path.getFileSystem(context._jsc.hadoopConfiguration()).exists(path)

    def current(self, table: DataFrame, schema: T.StructType, after: int = -1) -> Applied:
        """The table with all later changes replayed, without writing it."""
        return apply_changes(table, self.pending(schema, after), order=self.order)

    def fold(self, table: Table, schema: T.StructType) -> Table:
        """Write the changes the table does not hold yet as one layer."""
        if not self._logged():
            return table
        logged = self.spark.read.schema("batch long").option("basePath", self.log_path)
        last = logged.parquet(self.log_path).agg(F.max("batch")).first()[0]
        after = table.mark(self.log_path)
        if last is None or last <= after:
            return table
        changes = self.pending(schema, after, last)
        folded, _ = table.apply(changes, self.order, mark=(self.log_path, last))
        return folded
