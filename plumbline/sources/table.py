"""Stored tables: snapshots, small write layers over them, schema changes without rewrites.

A table directory holds ``_log``, one appended record per version, and the data folders
the records name. A version lists a base folder and the layers written since; a reader
keeps the version it opened. Compaction folds everything into a new base.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, replace
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from plumbline.errors import AlreadyExists, FailedPrecondition, InvalidArgument, NotFound
from plumbline.functions.sizing import broadcast_if_small, measured_bytes
from plumbline.operators import changes as replay
from plumbline.operators import quantize, validation, writes
from plumbline.operators.reads import filtered
from plumbline.sources.schema import Field, Schema, spark_type

LOG_SCHEMA = "version long, record string"
TARGET_FILE_BYTES = 512 * 1024 * 1024


@dataclass(frozen=True)
class Part:
    """A data folder, the schema it was written with, and the column expressions that bring
    it to the current schema."""

    path: str
    columns: str
    steps: tuple[tuple[str, ...], ...] = ()


@dataclass(frozen=True)
class StoredIndex:
    """An index of field ``name``: where it is, the column it was built on, the base and number of
    layers it covers, and the folder of ids that changed after it before the base was made."""

    name: str
    path: str
    column: str
    base: str
    layers: int
    changed: str = ""


@dataclass(frozen=True)
class Version:
    number: int
    schema: Schema
    base: Part
    layers: tuple[Part, ...] = ()
    indexes: tuple[StoredIndex, ...] = ()
    marks: tuple[tuple[str, int], ...] = ()

    def to_json(self) -> str:
        part = lambda p: {"path": p.path, "columns": p.columns, "steps": [list(s) for s in p.steps]}
        return json.dumps(
            {
                "schema": self.schema.to_json(),
                "base": part(self.base),
                "layers": [part(p) for p in self.layers],
                "indexes": [asdict(i) for i in self.indexes],
                "marks": [list(m) for m in self.marks],
            }
        )

    @staticmethod
    def from_json(number: int, text: str) -> Version:
        raw = json.loads(text)
        part = lambda p: Part(p["path"], p["columns"], tuple(tuple(s) for s in p["steps"]))
        return Version(
            number,
            Schema.from_json(raw["schema"]),
            part(raw["base"]),
            tuple(part(p) for p in raw["layers"]),
            tuple(StoredIndex(**i) for i in raw["indexes"]),
            tuple(tuple(m) for m in raw["marks"]),
        )


class Table:
    """One version of a stored table; every write returns the table at its next version."""

    def __init__(self, spark: SparkSession, path: str, version: Version):
        self.spark, self.path, self.version = spark, path.rstrip("/"), version

    # -- create, open, read ------------------------------------------------------------

    @classmethod
    def create(cls, spark: SparkSession, path: str, schema: Schema, rows: DataFrame | None = None) -> Table:
        """Make a table from a declared schema, empty or from ``rows``."""
        if cls._records(spark, path) is not None:
            raise AlreadyExists(f"a table exists at {path}")
        if rows is None:
            rows = spark.createDataFrame([], schema.struct())
        table = cls(spark, path, Version(0, schema, Part("", "")))
        if not rows.where(validation.unsound(rows, schema)).isEmpty():
            raise InvalidArgument("some rows break the declared schema")
        base = table._store(table._typed(rows), "data")
        return table._commit(replace(table.version, base=base))

    @classmethod
    def open(cls, spark: SparkSession, path: str, version: int | None = None) -> Table:
        """The latest version, or the one asked for."""
        records = cls._records(spark, path)
        if records is None:
            raise NotFound(f"no table at {path}")
        if version is not None:
            records = records.where(F.col("version") == version)
        row = records.orderBy(F.desc("version")).first()
        if row is None:
            raise NotFound(f"no version {version} at {path}")
        return cls(spark, path, Version.from_json(row["version"], row["record"]))

    @property
    def schema(self) -> Schema:
        return self.version.schema

    def scan(self) -> DataFrame:
        """All live rows with the declared columns and their metadata."""
        version = self.version
        base = self._read(version.base, layered=False)
        if version.layers:
            layers = [
                self._read(part, layered=True).withColumn("_layer", F.lit(number))
                for number, part in enumerate(version.layers)
            ]
            written = reduce(DataFrame.unionByName, layers)
            names = [f.name for f in self.schema.fields]
            latest = written.groupBy("id").agg(
                F.max(F.struct("_layer", "_deleted", *names)).alias("r")
            )
            ids, _ = broadcast_if_small(written.select("id").distinct())
            live = latest.where(~F.col("r._deleted")).select(
                "id", *[F.col(f"r.{n}").alias(n) for n in names]
            )
            base = base.join(ids, "id", "left_anti").unionByName(live)
        return self._typed(base)

    # -- writes ------------------------------------------------------------------------

    def insert(self, batch: DataFrame) -> tuple[Table, DataFrame]:
        return self._write(writes.insert, batch)

    def update(self, batch: DataFrame) -> tuple[Table, DataFrame]:
        return self._write(writes.update, batch)

    def upsert(self, batch: DataFrame) -> tuple[Table, DataFrame]:
        return self._write(writes.upsert, batch)

    def delete(self, requests: DataFrame) -> tuple[Table, DataFrame]:
        return self._layer(writes.delete_ids(self.scan(), requests))

    def _write(self, operation, batch: DataFrame) -> tuple[Table, DataFrame]:
        """Rows that break the declared schema fail on their own; the others are written."""
        broken = validation.unsound(batch, self.schema)
        table, results = self._layer(operation(self.scan(), batch.where(~broken)))
        failed = batch.where(broken).select("pos", "id", F.lit(False).alias("ok"))
        text = "the row breaks the declared schema"
        return table, results.unionByName(writes.report(failed, InvalidArgument, text))

    def apply(
        self,
        changes: DataFrame,
        order: tuple[str, ...] = ("seq",),
        mark: tuple[str, int] | None = None,
    ) -> tuple[Table, DataFrame]:
        """Replay a change table; ``mark`` records how far a named source has been read, in
        the same version as its rows."""
        done = replay.apply_changes(self.scan(), changes, order=order)
        return self._append(done.rows, mark), done.results

    def mark(self, name: str) -> int:
        """How far the source ``name`` has been read; -1 at first."""
        return dict(self.version.marks).get(name, -1)

    def delete_where(self, where: str) -> Table:
        """Mark matching rows as removed; only their ids are written."""
        if not where or not where.strip():
            raise InvalidArgument("a delete filter must not be blank")
        gone = filtered(self.scan(), where)
        rows = writes._shaped(gone.select("id"), gone).withColumn("_deleted", F.lit(True))
        return self._append(rows)

    def violations(self, batch: DataFrame) -> DataFrame:
        return validation.violations(batch, self.schema)

    # -- schema changes: records only, no data is rewritten ---------------------------

    def add_column(self, item: Field, default: str | None = None) -> Table:
        """Add a column; existing rows get ``default``, evaluated per row when read.

        Expressions that change between reads are rejected: their values would too.
        """
        if item.name in self._names() or item.name == "id":
            raise AlreadyExists(f"field {item.name!r} exists")
        if default is None and not item.nullable:
            raise InvalidArgument("a non-nullable column needs a default")
        value = default if default is not None else "NULL"
        self._check_stable(value)
        kind = spark_type(item.vtype).simpleString()
        self._check_cast(value, kind)
        step = [*map(quote, ["id", *self._names()]), f"TRY_CAST({value} AS {kind}) AS {quote(item.name)}"]
        schema = replace(self.schema, fields=(*self.schema.fields, item))
        return self._evolve(schema, step)

    def drop_column(self, name: str) -> Table:
        self.schema[name]
        kept = [f for f in self.schema.fields if f.name != name]
        step = [quote(n) for n in ["id", *[f.name for f in kept]]]
        return self._evolve(replace(self.schema, fields=tuple(kept)), step)

    def alter_column(self, name: str, new_name: str | None = None, vtype: str | None = None) -> Table:
        """Rename a column, change its type, or both."""
        old = self.schema[name]
        if new_name is None and vtype is None:
            raise InvalidArgument("give a new name or a new type")
        if new_name is not None and new_name != name and new_name in [*self._names(), "id"]:
            raise AlreadyExists(f"field {new_name!r} exists")
        retyped = vtype is not None and vtype != old.vtype
        new = replace(old, name=new_name or name, vtype=vtype or old.vtype)
        kind = spark_type(new.vtype).simpleString()
        if retyped:
            self._check_cast(quote(name), kind)
            new = replace(new, index=None)
        step, fields = [quote("id")], []
        for item in self.schema.fields:
            fields.append(new if item.name == name else item)
            text = quote(item.name)
            # Rows that a later layer replaced are read too, and need not fit the new type.
            step.append(f"TRY_CAST({text} AS {kind}) AS {quote(new.name)}" if item.name == name else text)
        kept = tuple(
            replace(i, name=new.name) if i.name == name else i
            for i in self.version.indexes
            if not (retyped and i.name == name)
        )
        return self._evolve(replace(self.schema, fields=tuple(fields)), step, kept)

    def set_index(self, name: str, settings: dict, side_table: str | None = None) -> Table:
        """Record an index on a field, replacing an earlier one, and where it is stored."""
        self.schema[name]
        fields = tuple(
            replace(f, index=settings) if f.name == name else f for f in self.schema.fields
        )
        indexes = tuple(i for i in self.version.indexes if i.name != name)
        if side_table:
            covered = self.version.base.path, len(self.version.layers)
            indexes = (*indexes, StoredIndex(name, side_table, name, *covered))
        return self._commit(
            replace(
                self.version,
                number=self.version.number + 1,
                schema=replace(self.schema, fields=fields),
                indexes=indexes,
            )
        )

    # -- maintenance -------------------------------------------------------------------

    def compact(self, files: int | None = None) -> Table:
        """Fold base and layers into well-sized files ordered by id; the rows stay equal.

        Indexes know rows by their ids, so they stay in use: the ids that changed since an index was
        built are written beside the new base.
        """
        rows = self.scan()
        if files is None:
            files = max(1, -(-measured_bytes(rows) // TARGET_FILE_BYTES))
        ordered = rows.repartitionByRange(int(files), "id").sortWithinPartitions("id")
        base = self._store(ordered, "data")
        indexes = tuple(self._carried(index, base) for index in self.version.indexes)
        return self._commit(
            replace(self.version, number=self.version.number + 1, base=base, layers=(), indexes=indexes)
        )

    def _carried(self, index: StoredIndex, base: Part) -> StoredIndex:
        if not self.covers(index):
            return index
        changed, kept = self.changed_since(index), index.changed
        if changed is not None and self.version.layers[index.layers :]:
            kept = self._store(changed, "changed").path
        return replace(index, base=base.path, layers=0, changed=kept)

    def statistics(self) -> DataFrame:
        """``(documents)``: the number of live rows."""
        return self.scan().agg(F.count("*").alias("documents"))

    def stored_index(self, name: str) -> StoredIndex | None:
        return next((i for i in self.version.indexes if i.name == name), None)

    def covers(self, index: StoredIndex) -> bool:
        """Whether what changed since an index was built is known."""
        return index.base == self.version.base.path

    def changed_since(self, index: StoredIndex) -> DataFrame | None:
        """Ids written or removed after an index was built; None when there are none."""
        later = self.version.layers[index.layers :]
        ids = [self._read(part, layered=True).select("id") for part in later]
        if index.changed:
            ids.append(self.spark.read.schema("id string").parquet(f"{self.path}/{index.changed}"))
        if not ids:
            return None
        return reduce(DataFrame.unionByName, ids).distinct()

    def index_statistics(self) -> DataFrame:
        """``(index_name, completeness)`` per stored index: the share of the rows with a value
        that the index holds as they are now."""
        rows, out = self.scan(), []
        for index in self.version.indexes:
            held = rows.where(F.col(quote(index.name)).isNotNull()).select("id")
            kind = (self.schema[index.name].index or {}).get("kind")
            changed = self.changed_since(index)
            good = F.lit(self.covers(index))
            if kind != "fulltext":  # a text without a term has no posting and is covered
                ids = self.spark.read.parquet(index.path).select("id").distinct()
                held = held.join(ids.withColumn("_hit", F.lit(1)), "id", "left")
                good = good & F.col("_hit").isNotNull()
            if changed is not None:
                held = held.join(changed.withColumn("_new", F.lit(1)), "id", "left")
                good = good & F.col("_new").isNull()
            share = F.when(F.count("*") == 0, 1.0).otherwise(F.count(F.when(good, 1)) / F.count("*"))
            name = F.lit(index.name).alias("index_name")
            out.append(held.agg(share.alias("completeness")).select(name, "completeness"))
        if not out:
            return self.spark.createDataFrame([], "index_name string, completeness double")
        return reduce(DataFrame.unionByName, out)

    # -- internals ---------------------------------------------------------------------

    def _names(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    def _typed(self, rows: DataFrame) -> DataFrame:
        """Declared columns in declared order, with metadata; absent ones are NULL."""
        have = set(rows.columns)
        out = [F.col("id").cast("string").alias("id")]
        for item in self.schema.fields:
            column = item.struct_field()
            value = F.col(quote(item.name)) if item.name in have else F.lit(None)
            value = value.cast(column.dataType)
            if item.vtype == "vectorFloat16":
                value = quantize.half(value).cast(column.dataType)
            out.append(value.alias(item.name, metadata=column.metadata))
        return rows.select(*out)

    def _read(self, part: Part, layered: bool) -> DataFrame:
        columns = T.StructType.fromJson(json.loads(part.columns))
        rows = self.spark.read.schema(columns).parquet(f"{self.path}/{part.path}")
        for step in part.steps:
            rows = rows.selectExpr(*step, *(["_deleted"] if layered else []))
        return rows

    def _store(self, rows: DataFrame, kind: str) -> Part:
        name = f"{kind}-{uuid.uuid4().hex}"
        (
            rows.write.mode("errorifexists")
            .option("maxRecordsPerFile", self.schema.segment_rows)
            .parquet(f"{self.path}/{name}")
        )
        return Part(name, rows.schema.json())

    def _layer(self, done) -> tuple[Table, DataFrame]:
        return self._append(done.rows), done.results

    def _append(self, rows: DataFrame, mark: tuple[str, int] | None = None) -> Table:
        marks = self.version.marks
        if mark is not None:
            marks = (*[m for m in marks if m[0] != mark[0]], mark)
        part = self._store(self._typed_layer(rows), "layer")
        return self._commit(
            replace(
                self.version,
                number=self.version.number + 1,
                layers=(*self.version.layers, part),
                marks=marks,
            )
        )

    def _typed_layer(self, rows: DataFrame) -> DataFrame:
        names = ["id", *self._names()]
        return rows.select(*[F.col(quote(n)) for n in names], "_deleted")

    def _evolve(
        self, schema: Schema, step: list[str], indexes: tuple[StoredIndex, ...] | None = None
    ) -> Table:
        more = lambda part: Part(part.path, part.columns, (*part.steps, tuple(step)))
        names = {f.name for f in schema.fields}
        return self._commit(
            replace(
                self.version,
                number=self.version.number + 1,
                schema=schema,
                base=more(self.version.base),
                layers=tuple(more(p) for p in self.version.layers),
                indexes=tuple(i for i in (self.version.indexes if indexes is None else indexes) if i.name in names),
            )
        )

    def _check_stable(self, expression: str) -> None:
        try:
            plan = self.scan().selectExpr(expression)._jdf.queryExecution().analyzed()
        except AnalysisException as error:
            raise InvalidArgument(str(error)) from error
        text = expression.lower()
        if not plan.deterministic() or any(w in text for w in ("current_", "now(", "localtimestamp")):
            raise InvalidArgument("a default must give the same value on every read")

    def _check_cast(self, expression: str, kind: str) -> None:
        """Every live row must yield a value of the type wherever the expression has one."""
        lost = f"({expression}) IS NOT NULL AND TRY_CAST({expression} AS {kind}) IS NULL"
        try:
            fails = not self.scan().where(lost).isEmpty()
        except PySparkException as error:
            raise InvalidArgument(str(error)) from error
        if fails:
            raise InvalidArgument(f"{expression} does not fit {kind} in every row")

    def _commit(self, version: Version) -> Table:
        latest = self._records(self.spark, self.path)
        if latest is not None:
            top = latest.agg(F.max("version")).first()[0]
            if top is not None and top >= version.number:
                raise FailedPrecondition("the table has a newer version; open it again")
        record = self.spark.range(1).select(
            F.lit(version.number).cast("long").alias("version"),
            F.lit(version.to_json()).alias("record"),
        )
        record.coalesce(1).write.mode("append").parquet(f"{self.path}/_log")
        return Table(self.spark, self.path, version)

    @staticmethod
    def _records(spark: SparkSession, path: str) -> DataFrame | None:
        try:
            return spark.read.schema(LOG_SCHEMA).parquet(f"{path.rstrip('/')}/_log")
        except AnalysisException:
            return None


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
