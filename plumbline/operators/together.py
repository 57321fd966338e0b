"""One scan for several scorers: what a hybrid search reads, it reads once."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from plumbline.functions.ranking import TIE_DIGITS
from plumbline.operators.blocks import Keeper, values_of
from plumbline.operators.knn import hit_schema


@dataclass(frozen=True)
class Scorer:
    """How a task scores rows for one bounded query table.

    ``columns`` are read beside the id. ``start`` makes the holder of a task's best ``k``, ``feed``
    gives it a batch: the arrays of the columns, without rows where the first is null, and the ids.
    """

    columns: list[F.Column]
    start: Callable[[], Keeper]
    feed: Callable[[Keeper, list[pa.Array], np.ndarray], None]
    qids: pa.Array
    qid_type: T.DataType
    k: int
    ascending: bool


def scan_together(docs: DataFrame, scorers: list[Scorer]) -> DataFrame:
    """``(sub, qid, id, score, rank)``: the best ``k`` of every scorer, numbered as listed, from one
    pass over ``docs``; a task returns at most ``k`` rows per scorer and query."""
    hit = hit_schema(scorers[0].qid_type, docs.schema["id"].dataType)
    schema = T.StructType([T.StructField("sub", T.IntegerType()), *hit.fields])
    inner, names = to_arrow_schema(hit), to_arrow_schema(schema).names
    columns, places = [], []
    for scorer in scorers:
        places.append(range(len(columns) + 1, len(columns) + 1 + len(scorer.columns)))
        columns += scorer.columns
    listed = [column.alias(f"c{n}") for n, column in enumerate(columns)]

    # Columns stay on the driver.
    held = [(s.start, s.feed, s.qids, place) for s, place in zip(scorers, places)]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [start() for start, *_ in held]
        for batch in batches:
            ids = values_of(batch.column(0))
            for keeper, (_, feed, _, place) in zip(best, held):
                arrays, own = [batch.column(at) for at in place], ids
                if arrays[0].null_count:
                    there = arrays[0].is_valid()
                    arrays, own = [a.filter(there) for a in arrays], ids[np.asarray(there)]
                if len(own):
                    feed(keeper, arrays, own)
        for number, (keeper, (_, _, qids, _)) in enumerate(zip(best, held)):
            found = keeper.batch(qids, inner)
            sub = pa.array(np.full(found.num_rows, number, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([sub, *found.columns], names=names)

    # No filter on missing values: Catalyst would compute the columns a second time for it.
    rows = docs.select("id", *listed)
    rising = F.array(*[F.lit(1.0 if s.ascending else -1.0) for s in scorers])
    most = F.array(*[F.lit(s.k) for s in scorers])
    cost = F.round(F.col("score") * F.element_at(rising, F.col("sub") + 1), TIE_DIGITS)
    window = Window.partitionBy("sub", "qid").orderBy(cost.asc(), F.col("id").asc())
    ranked = rows.mapInArrow(scan, schema).withColumn("rank", F.row_number().over(window))
    # The literal bound lets Spark cut before the shuffle; the other one is that of each scorer.
    ranked = ranked.where(F.col("rank") <= max(s.k for s in scorers))
    return ranked.where(F.col("rank") <= F.element_at(most, F.col("sub") + 1))
