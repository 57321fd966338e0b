"""A stream of changes applied id by id, with the state of every id held by the stream.

Events come out of order. What an id has met is held back until the id's own newest event is
``delay`` past it, then applied in the order of event time and sequence number. An event that
arrives after later ones were applied is reported as late and left out; one that comes again is
reported once more and left out too.
"""

from __future__ import annotations

import json
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from plumbline.errors import AlreadyExists, InvalidArgument, NotFound, positive_int32

OK, LATE, REPEATED = "ok", "late", "repeated"
# An event that has all pending ones of its id applied.
CLOSE = "close"
NEVER = -(1 << 62)

STATE = T.StructType([T.StructField("held", T.BinaryType())])

# Ids that share an entry of the state store, which costs as much as the work of many ids.
BUCKETS = 1_024


@dataclass
class Held:
    """What the stream knows of one id: its document (None: not there), events that wait,
    ``(at, seq, op, fields, named)``, and the sequence numbers of those lately applied."""

    document: dict | None = None
    newest: int = NEVER
    frontier: int = NEVER
    waiting: list[tuple] = field(default_factory=list)
    applied: dict[int, int] = field(default_factory=dict)

    def receive(self, events: list[tuple], delay: int) -> Iterator[tuple]:
        """``(at, seq, op, outcome, document)`` of every event that is settled now."""
        known = {event[1] for event in self.waiting}.union(self.applied)
        closing = False
        for event in sorted(events, key=lambda e: e[:2]):
            at, seq, op = event[:3]
            if op == CLOSE:
                closing = True
            elif seq in known:
                yield at, seq, op, REPEATED, None
            elif at <= self.frontier:
                yield at, seq, op, LATE, None
            else:
                known.add(seq)
                self.waiting.append(event)
                self.newest = max(self.newest, at)
        frontier = self.newest if closing else max(self.frontier, self.newest - delay)
        for event in sorted((e for e in self.waiting if e[0] <= frontier), key=lambda e: e[:2]):
            at, seq, op, fields, named = event
            yield at, seq, op, self._apply(op, fields, named), self.document
            self.applied[seq] = at
        self.waiting = [e for e in self.waiting if e[0] > frontier]
        self.frontier = frontier
        # A repeated event is told from a late one for as long again.
        self.applied = {seq: at for seq, at in self.applied.items() if at > frontier - delay}

    def _apply(self, op: str, fields: dict, named: list | None) -> str:
        there = self.document is not None
        if op == "upsert" or (op == "insert" and not there):
            self.document = dict(fields)
        elif op == "update" and there:
            chosen = fields if named is None else {name: fields.get(name) for name in named if name in fields}
            self.document = {**self.document, **chosen}
        elif op == "delete" and there:
            self.document = None
        else:
            return AlreadyExists.code if op == "insert" else NotFound.code if op in ("update", "delete") else InvalidArgument.code
        return OK


class KeyedChanges:
    """``changes (id, op, seq, time, *fields, [_set])`` folded per id while they stream.

    ``seq`` tells the events of an id apart; events of one time are applied by it. Documents that
    are there before the stream begins are upserts of an early time. An id's state is its
    document and the events of the last ``delay`` microseconds. The states of the ids that fall in
    one of ``buckets`` are stored together; a stream keeps the number it began with.
    """

    def __init__(self, fields: T.StructType, delay: int, *, time: str = "ts", buckets: int = BUCKETS):
        self.fields, self.delay, self.time = fields, delay, time
        self.buckets = positive_int32(buckets, "buckets")

    def outcomes(self, changes: DataFrame) -> DataFrame:
        """One row per settled event: ``id, at, seq, op, outcome, document`` (JSON of the fields after
        it; null where the id has none or the event was left out)."""
        names = [f.name for f in self.fields]
        packed = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
        named = F.to_json("_set") if "_set" in changes.columns else F.lit(None).cast("string")
        id_field = changes.schema["id"]
        binary = isinstance(id_field.dataType, T.BinaryType)
        rows = changes.select(
            F.pmod(F.xxhash64("id"), F.lit(self.buckets)).alias("bucket"),
            # As text, because a null would turn whole numbers into floating ones in a task.
            (F.base64("id") if binary else F.col("id").cast("string")).alias("name"),
            F.unix_micros(F.col(self.time).cast("timestamp")).alias("at"),
            F.col("seq").cast("long").alias("seq"),
            "op",
            packed.alias("fields"),
            named.alias("named"),
        )
        shape = T.StructType(
            [
                T.StructField("id", T.StringType()),
                T.StructField("at", T.LongType()),
                T.StructField("seq", T.LongType()),
                T.StructField("op", T.StringType()),
                T.StructField("outcome", T.StringType()),
                T.StructField("document", T.StringType()),
            ]
        )
        delay, out = self.delay, pd.Index(shape.names, dtype=object)

        def fold(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
            held = pickle.loads(state.get[0]) if state.exists else {}
            events: dict[str | None, list[tuple]] = {}
            for frame in frames:
                lists = (frame[c].tolist() for c in ("name", "at", "seq", "op", "fields", "named"))
                for name, at, seq, op, fields, listed in zip(*lists):
                    event = (int(at), int(seq), op, json.loads(fields), json.loads(listed) if listed else None)
                    events.setdefault(name, []).append(event)
            settled = []
            for name, own in events.items():
                known = Held(*held[name]) if name in held else Held()
                for at, seq, op, outcome, document in known.receive(own, delay):
                    settled.append((name, at, seq, op, outcome, None if document is None else json.dumps(document)))
                held[name] = tuple(vars(known).values())
            state.update((pickle.dumps(held),))
            if settled:
                lines = np.empty((len(settled), len(out)), dtype=object)
                lines[:] = settled
                yield pd.DataFrame(lines, columns=out, copy=False)

        folded = rows.groupBy("bucket").applyInPandasWithState(fold, shape, STATE, "append", GroupStateTimeout.NoTimeout)
        back = F.unbase64("id") if binary else F.col("id").cast(id_field.dataType)
        return folded.withColumn("id", back)

    def start(self, changes: DataFrame, out: str, checkpoint: str, **trigger) -> StreamingQuery:
        """Begin writing outcomes as Parquet; by default all available input, then stop."""
        return (
            self.outcomes(changes)
            .writeStream.format("parquet")
            .outputMode("append")
            .option("path", out)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )

    def settled(self, spark: SparkSession, out: str) -> DataFrame:
        return spark.read.parquet(out)

    def current(self, spark: SparkSession, out: str) -> DataFrame:
        """``id`` and the fields of every document that is there after what is settled."""
        done = self.settled(spark, out).where(F.col("outcome") == OK)
        last = done.groupBy("id").agg(F.max(F.struct("at", "seq", "document")).alias("last"))
        there = last.where("last.document IS NOT NULL")
        return there.select("id", F.from_json("last.document", self.fields).alias("f")).select("id", "f.*")
