"""Sparse-vector search by inner product."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from plumbline.errors import positive_int32
from plumbline.functions.joins import salted_join
from plumbline.functions.ranking import top_k
from plumbline.functions.sizing import BROADCAST_BYTES, broadcast_if_small, materialize
from plumbline.operators.blocks import SparseBest, SparseQueries, SparseStripe, values_of
from plumbline.operators.knn import MAX_BROADCAST_QUERIES, hit_schema
from plumbline.operators.together import Scorer

# Query entries that may travel to every task, about 24 bytes each.
MAX_QUERY_ENTRIES = 2_000_000

# When both tables are large a task holds so many entries of rows, while so many of queries pass.
HELD_ENTRIES = 12_000_000
PASSING_ENTRIES = 48_000_000
# Smaller tables are cut all the same, as long as parts have so many entries.
STRIPES, BLOCKS, LEAST_ENTRIES = 6, 4, 500_000
# Entries of a query that travel as one row.
LONGEST_QUERY = 4_000_000


def explode_sparse(df: DataFrame, vector: str, key: str) -> DataFrame:
    """``(key, idx, val)`` from a ``struct<indices, values>`` column."""
    pairs = F.arrays_zip(F.col(f"{vector}.indices").alias("i"), F.col(f"{vector}.values").alias("v"))
    flat = df.select(key, F.explode_outer(pairs).alias("p")).where(F.col("p").isNotNull())
    return flat.select(
        key, F.col("p")["i"].alias("idx"), F.col("p")["v"].cast("double").alias("val")
    )


def valid_sparse(vector: F.Column) -> F.Column:
    """True when counts agree and indices strictly increase."""
    indices, values = vector["indices"], vector["values"]
    steps = F.sequence(F.lit(2), F.size(indices))
    rising = (F.size(indices) < 2) | F.forall(
        steps, lambda i: F.element_at(indices, i) > F.element_at(indices, i - 1)
    )
    return (F.size(indices) == F.size(values)) & rising


@dataclass(frozen=True)
class TermBlock:
    """Query terms small enough to travel to every task: ``held`` numbers the distinct
    ``terms`` and the ``qids``."""

    qids: pa.Array
    qid_type: T.DataType
    terms: pa.Array
    held: SparseQueries


def term_block(
    qid: pa.ChunkedArray, qid_type: T.DataType, term: pa.ChunkedArray, weight: np.ndarray, role: np.ndarray
) -> TermBlock:
    qids, terms = pc.unique(qid), pc.unique(term)
    held = SparseQueries(
        pc.index_in(qid, qids).to_numpy(),
        pc.index_in(term, terms).to_numpy(),
        weight,
        role,
        len(terms),
        len(qids),
    )
    return TermBlock(qids, qid_type, terms, held)


def small_terms(queries: DataFrame) -> pa.Table | None:
    """The rows of a query-term table, or None when they are too many to broadcast."""
    head = queries.limit(MAX_QUERY_ENTRIES + 1).toArrow()
    if head.num_rows > MAX_QUERY_ENTRIES or head.nbytes > BROADCAST_BYTES:
        return None
    if len(pc.unique(head["qid"])) > MAX_BROADCAST_QUERIES:
        return None
    return head


def rank_entries(entries: DataFrame, block: TermBlock, k: int) -> DataFrame:
    """Top ``k`` from ``entries (id, term, val)``: sums of ``val`` times query weight.

    Entries no query asks for are dropped first; the rest move once, by id, and each task
    returns its best ``k`` per query. An id has at most one entry per query term.
    """
    spark = entries.sparkSession
    schema = hit_schema(block.qid_type, entries.schema["id"].dataType)
    if len(block.qids) == 0:
        return top_k(spark.createDataFrame([], schema), k, ascending=False)
    kind = entries.schema["term"].dataType
    wanted = spark.createDataFrame(
        pa.table({"term": block.terms, "at": pa.array(np.arange(len(block.terms)))}),
        T.StructType([T.StructField("term", kind), T.StructField("at", T.LongType())]),
    )
    found = entries.join(F.broadcast(wanted), "term").select("id", "at", F.col("val").cast("double"))
    held, qids, arrow = block.held, block.qids, to_arrow_schema(schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, rest = SparseBest(held, k), None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            if table.num_rows == 0:
                continue
            ids = values_of(table["id"])
            # The last id may go on in the next batch.
            last = int(np.nonzero(ids != ids[-1])[0][-1]) + 1 if (ids != ids[-1]).any() else 0
            rest = table.slice(last)
            _add_runs(best, table.slice(0, last), ids[:last])
        if rest is not None:
            _add_runs(best, rest, values_of(rest["id"]))
        yield best.batch(qids, arrow)

    placed = found.repartition("id").sortWithinPartitions("id")
    return top_k(placed.mapInArrow(scan, schema), k, ascending=False)


def _add_runs(best: SparseBest, table: pa.Table, ids: np.ndarray) -> None:
    if len(ids) == 0:
        return
    first = np.r_[True, ids[1:] != ids[:-1]]
    best.add(np.cumsum(first) - 1, values_of(table["at"]), values_of(table["val"]), ids[first])


def sparse_knn(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Top ``k`` by inner product from ``rows (id, idx, val)`` and ``queries (qid, idx, val)``.

    Only rows sharing an index with the query are candidates. A query table too large to
    travel meets the rows stripe by stripe.
    """
    positive_int32(k, "k")
    asked = queries.select("qid", "idx", F.col("val").cast("double").alias("weight"))
    head = small_terms(asked)
    if head is not None:
        weight = head["weight"].to_numpy()
        block = term_block(
            head["qid"], queries.schema["qid"].dataType, head["idx"], weight, np.zeros(len(weight), int)
        )
        return rank_entries(rows.select("id", F.col("idx").alias("term"), "val"), block, k)
    return top_k(_both_large(rows, asked, k), k, ascending=False)


def _both_large(rows: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Hits ``(qid, id, score)`` that hold the best ``k`` of every query.

    Rows are dealt to stripes by id and queries to blocks; a task holds the entries of a stripe,
    listed by index, while the queries of a block pass, so products are added up where they are made and at
    most ``k`` hits per query and stripe move. Rows and queries with a key or value that is null or not finite,
    very long queries, and tables whose indices are no whole numbers, are joined entry by entry.
    """
    whole = all(isinstance(f.schema["idx"].dataType, T.IntegralType) for f in (rows, asked))
    rows = materialize(rows.select("id", "idx", F.col("val").cast("double")).where(F.col("idx").isNotNull()), "entries")
    asked = materialize(asked.where(F.col("idx").isNotNull()), "asked")
    if not whole:
        return _entry_by_entry(rows, asked)
    held, passing = _survey(rows, "id", "val"), _survey(asked, "qid", "weight")
    sizes = asked.groupBy("qid").count()
    longest = sizes.agg(F.max("count")).first()[0] or 0
    hits = []
    if held["odd"]:
        rows, others = _apart(rows, "id", rows.where(_odd("id", "val")).select("id"))
        hits.append(_entry_by_entry(others, asked))
    if passing["odd"] or longest > LONGEST_QUERY:
        names = asked.where(_odd("qid", "weight")).select("qid").union(sizes.where(F.col("count") > LONGEST_QUERY).select("qid"))
        asked, others = _apart(asked, "qid", names)
        hits.append(_entry_by_entry(rows, others))
    hits.append(_in_stripes(rows, asked, held, passing, k))
    return reduce(DataFrame.unionByName, hits)


def _entry_by_entry(rows: DataFrame, asked: DataFrame) -> DataFrame:
    products = salted_join(rows, asked, "idx", "id")
    return products.groupBy("qid", "id").agg(F.sum(F.col("val") * F.col("weight")).alias("score"))


def _odd(key: str, value: str) -> F.Column:
    number = F.col(value)
    return F.col(key).isNull() | number.isNull() | F.isnan(number) | (F.abs(number) == float("inf"))


def _apart(entries: DataFrame, key: str, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The entries of all other keys, and those of the named ones; a null is a key too."""
    named = names.select(F.col(key).alias("_key"), F.lit(True).alias("_named")).distinct()
    named, _ = broadcast_if_small(materialize(named, "odd-keys"))
    marked = entries.join(named, F.col(key).eqNullSafe(F.col("_key")), "left")
    kept = marked.where(F.col("_named").isNull()).select(*entries.columns)
    return kept, marked.where(F.col("_named")).select(*entries.columns)


def _in_stripes(rows: DataFrame, asked: DataFrame, held: dict, passing: dict, k: int) -> DataFrame:
    def parts(number: int, most: int, few: int) -> int:
        return max(1, -(-number // most), min(few, -(-number // LEAST_ENTRIES)))

    stripes, blocks = parts(held["n"], HELD_ENTRIES, STRIPES), parts(passing["n"], PASSING_ENTRIES, BLOCKS)
    # Four bytes do for most indices and values.
    index = "long" if held["wide"] or passing["wide"] else "int"
    value, weight = ("double" if found["fine"] else "float" for found in (held, passing))
    right = _packed(rows.select("id", F.col("idx").cast(index), F.col("val").cast(value)), stripes)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    right = right.withColumn("block", every(blocks)).select(
        (F.col("stripe") * blocks + F.col("block")).alias("unit"), F.lit(0).alias("side"), "row"
    )
    entry = F.struct(F.col("idx").cast(index).alias("idx"), F.col("weight").cast(weight).alias("weight"))
    listed = asked.groupBy("qid").agg(F.sort_array(F.collect_list(entry)).alias("e"))
    left = listed.withColumn("stripe", every(stripes)).select(
        (F.col("stripe") * blocks + F.pmod(F.xxhash64("qid"), F.lit(blocks)).cast("int")).alias("unit"),
        F.lit(1).alias("side"),
        F.struct("qid", "e.idx", "e.weight").alias("asked"),
    )
    both = right.unionByName(left, allowMissingColumns=True)
    both = both.repartition(min(4 * stripes * blocks, 2_000), "unit").sortWithinPartitions("unit", "side")
    schema = hit_schema(asked.schema["qid"].dataType, rows.schema["id"].dataType)
    arrow = to_arrow_schema(schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, waiting, stripe = None, [], None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            units, sides = values_of(batch.column(0)), values_of(batch.column(1))
            change = np.flatnonzero((units[1:] != units[:-1]) | (sides[1:] != sides[:-1])) + 1
            cuts = [0, *change.tolist(), batch.num_rows]
            for start, end in zip(cuts, cuts[1:]):
                if units[start] != at:
                    at, waiting, stripe = units[start], [], None
                part = batch.slice(start, end - start)
                if sides[start] == 0:
                    packed = part.column(2).flatten()
                    waiting.append([column.flatten() for column in packed])
                    continue
                if waiting:
                    stripe, waiting = SparseStripe(*(pa.chunked_array(c) for c in zip(*waiting))), []
                if stripe is not None:
                    qids, lists, weights = part.column(3).flatten()
                    for best, low, high in stripe.best(lists, weights, k):
                        yield best.batch(qids.slice(low, high - low), arrow)

    return both.select("unit", "side", "row", "asked").mapInArrow(scan, schema)


def _survey(entries: DataFrame, key: str, value: str) -> dict:
    """How many entries there are, how many of them have no key or no finite value, and whether some
    index or value takes more than four bytes."""
    number = F.col(value)
    found = entries.agg(
        F.count("*").alias("n"),
        F.count_if(_odd(key, value)).alias("odd"),
        F.count_if(~F.col("idx").cast("long").between(-(2**31), 2**31 - 1)).alias("wide"),
        F.count_if(~F.isnan(number) & (number.cast("float").cast("double") != number)).alias("fine"),
    )
    return found.first().asDict()


def _packed(entries: DataFrame, stripes: int) -> DataFrame:
    """``stripe`` and ``row``: the entries ``(id, idx, val)`` of an Arrow batch that belong there, as lists."""
    fields = entries.schema.fields
    packed = T.StructType([T.StructField(f.name, T.ArrayType(f.dataType)) for f in fields])
    schema = T.StructType([T.StructField("stripe", T.IntegerType()), T.StructField("row", packed)])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stripe = values_of(batch.column(0))
            order = np.argsort(stripe, kind="stable")
            held, count = np.unique(stripe, return_counts=True)
            ends = pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32))
            taken = batch.take(pa.array(order)).columns[1:]
            lists = [pa.ListArray.from_arrays(ends, column) for column in taken]
            row = pa.StructArray.from_arrays(lists, names=[f.name for f in fields]).cast(arrow.field("row").type)
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), row], schema=arrow)

    stripe = F.pmod(F.xxhash64("id"), F.lit(stripes)).cast("int").alias("stripe")
    return entries.select(stripe, *entries.columns).mapInArrow(run, schema)


def _sparse_scorer(head: pa.Table, qid_type: T.DataType, k: int, vector: str) -> Scorer:
    weight = head["val"].to_numpy()
    block = term_block(head["qid"], qid_type, head["idx"], weight, np.zeros(len(weight), int))
    held, terms = block.held, block.terms

    def feed(best: SparseBest, arrays: list[pa.Array], ids: np.ndarray) -> None:
        indices, values = arrays
        row = np.repeat(np.arange(len(ids)), np.diff(np.asarray(indices.offsets)))
        at = pc.index_in(indices.flatten(), terms)
        hit = np.asarray(at.is_valid())
        value = np.asarray(values.flatten(), dtype=np.float64)[hit]
        best.add(row[hit], at.drop_null().to_numpy(), value, ids)

    columns = [F.col(f"{vector}.indices"), F.col(f"{vector}.values")]
    return Scorer(columns, lambda: SparseBest(held, k), feed, block.qids, qid_type, k, False)


def sparse_scorer(queries: DataFrame, k: int, *, vector: str) -> Scorer | None:
    """``sparse_scan`` as a part of a common scan; None for query tables without entries or too
    large to travel."""
    head = small_terms(queries.select("qid", F.col("idx").cast("long"), F.col("val").cast("double")))
    if head is None or head.num_rows == 0:
        return None
    return _sparse_scorer(head, queries.schema["qid"].dataType, k, vector)


def sparse_scan(docs: DataFrame, queries: DataFrame, k: int, *, vector: str) -> DataFrame:
    """The same ranking over a ``struct<indices, values>`` column, without a shuffle.

    Each task scores whole rows against the queries and returns its best ``k``; query
    tables too large to travel go through ``sparse_knn``.
    """
    positive_int32(k, "k")
    head = small_terms(queries.select("qid", F.col("idx").cast("long"), F.col("val").cast("double")))
    if head is None:
        return sparse_knn(explode_sparse(docs, vector, "id"), queries, k)
    schema = hit_schema(queries.schema["qid"].dataType, docs.schema["id"].dataType)
    if head.num_rows == 0:
        return top_k(docs.sparkSession.createDataFrame([], schema), k, ascending=False)
    scorer = _sparse_scorer(head, schema["qid"].dataType, k, vector)
    start, feed, qids, arrow = scorer.start, scorer.feed, scorer.qids, to_arrow_schema(schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = start()
        for batch in batches:
            feed(best, batch.columns[1:], values_of(batch.column(0)))
        yield best.batch(qids, arrow)

    rows = docs.where(F.col(vector).isNotNull()).select(
        "id", F.col(f"{vector}.indices").alias("i"), F.col(f"{vector}.values").alias("v")
    )
    return top_k(rows.mapInArrow(scan, schema), k, ascending=False)
