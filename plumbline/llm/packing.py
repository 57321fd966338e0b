"""Packing of documents into training sequences of several permitted lengths.

Variable-capacity best fit: pieces go, longest first, into the open bin they fill best; when
none has room, the permitted length that costs least is opened; at the end each bin shrinks to
the shortest length that holds its contents. Which lengths may be *opened* is itself optimised:
a shard is packed once for every choice of openings with the largest length among them, and the
packing that costs least after the shrinking is kept.

Pieces are dealt to shards by hash. A shard is a bounded piece of the corpus, so memory and
task time do not grow with it; the price is one partly filled bin of each size per shard.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.sizing import materialize
from plumbline.llm import byte_bpe
from plumbline.llm.common import Column, small_batches, sorted_groups, words_of

CAPACITIES = (512, 1024, 2048, 4096, 8192)
SHARD_PIECES = 20_000
# One place per document for the token that ends it.
SEPARATOR = 1
# Sequence length at which attention costs as much as everything else.
BALANCE = 16_384


def sequence_cost(capacity: int) -> float:
    """Work of one sequence: a linear part and a quadratic one."""
    return capacity * (1 + capacity / BALANCE)


def best_fit(
    lengths: Sequence[int],
    capacities: Sequence[int] = CAPACITIES,
    cost: Callable[[int], float] = sequence_cost,
    smallest: int = 0,
    openings: Sequence[int] | None = None,
) -> tuple[list[int], list[int]]:
    """The bin of each piece and the final capacity of each bin.

    ``lengths`` descend and none is above the largest capacity. Only ``openings`` (default: all
    capacities) of ``smallest`` or more are opened. Ties go to the bin opened last and to the
    shorter capacity.
    """
    sizes = sorted(capacities)
    opened = [c for c in sizes if c >= smallest and (openings is None or c in openings)]
    price = {c: cost(c) for c in sizes}
    unit = min(price[c] / c for c in sizes)
    roomy: dict[int, list[int]] = {}
    present = 0  # bit r: some open bin has r places left
    used: list[int] = []
    bins: list[int] = []
    rest = sum(lengths)
    for length in lengths:
        rest -= length
        fits = present >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            stack = roomy[room]
            number = stack.pop()
            if not stack:
                present ^= 1 << room
        else:
            # What an opening costs, less what its free places are worth to later pieces.
            allowed = [c for c in opened if c >= length] or [sizes[-1]]
            room = min(allowed, key=lambda c: (price[c] - unit * min(c - length, rest), c))
            number = len(used)
            used.append(0)
        used[number] += length
        bins.append(number)
        left = room - length
        if left:
            stack = roomy.setdefault(left, [])
            if not stack:
                present |= 1 << left
            stack.append(number)
    edges = np.searchsorted(sizes, used)
    return bins, [sizes[k] for k in edges]


def best_packing(
    lengths: Sequence[int], capacities: Sequence[int] = CAPACITIES, cost: Callable[[int], float] = sequence_cost
) -> tuple[list[int], list[int]]:
    """The cheapest of the packings over all choices of openings; ties go to the most openings."""
    *smaller, largest = sorted(capacities)
    chosen = [some for n in range(len(smaller), -1, -1) for some in combinations(smaller, n)]
    tried = (best_fit(lengths, capacities, cost, openings=(*some, largest)) for some in chosen)
    return min(tried, key=lambda t: sum(map(cost, t[1])))


def pieces(docs: DataFrame, length: Column, largest: int, id_column: str = "doc_id") -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``: documents longer than the largest
    capacity are cut into full pieces and a rest, so every token is packed."""
    measured = docs.select(F.col(id_column).alias("doc_id"), length.cast("long").alias("n"))
    number = F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("n") / largest) - 1)).alias("piece")
    cut = measured.where("n > 0").select("doc_id", "n", number)
    start = F.col("piece") * largest
    return cut.select(
        "doc_id", "piece", start.alias("start"), F.least(F.col("n") - start, F.lit(largest)).cast("int").alias("length")
    )


def word_length(text: Column) -> Column:
    """Words between white space and the separator; empty and null texts keep the latter."""
    return F.size(words_of(F.coalesce(text, F.lit("")))) + SEPARATOR


def pack(
    docs: DataFrame,
    length: Column | None = None,
    capacities: Sequence[int] = CAPACITIES,
    cost: Callable[[int], float] = sequence_cost,
    shard_pieces: int = SHARD_PIECES,
    id_column: str = "doc_id",
) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``bin_id``,
    ``bin_offset``, ``bin_capacity``, ``bin_used``.

    ``length`` counts a document's places (default: its words and a separator) and is read twice, so a
    costly one should be stored. Documents
    of no length have no row. Null ids and repeated rows are packed like others; other columns
    are ignored.
    """
    small_batches(docs.sparkSession)
    sizes = tuple(sorted(capacities))
    length = word_length(F.col("text")) if length is None else length
    cut = pieces(docs, length, sizes[-1], id_column)
    shards = max(1, -(-cut.count() // shard_pieces))
    # The number of the row tells apart null ids and rows that repeat.
    row = F.monotonically_increasing_id()
    shard = F.pmod(F.xxhash64("doc_id", "piece", "length", row), F.lit(shards)).cast("int")
    dealt = cut.withColumn("shard", shard).repartition(shards, "shard")
    dealt = dealt.sortWithinPartitions("shard", F.desc("length"), "doc_id", "piece")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["shard"]):
            group = group.combine_chunks()
            lengths = group.column("length").to_pylist()
            bins, final = best_packing(lengths, sizes, cost)
            numbers, each = np.array(bins), np.array(lengths, dtype=np.int64)
            order = np.argsort(numbers, kind="stable")
            running = np.cumsum(each[order]) - each[order]
            first = np.r_[True, numbers[order][1:] != numbers[order][:-1]]
            begin = np.maximum.accumulate(np.where(first, running, 0))
            offset = np.empty(len(each), dtype=np.int64)
            offset[order] = running - begin
            used = np.bincount(numbers, weights=each).astype(np.int64)
            base = group.column("shard")[0].as_py() << 32
            table = group.drop_columns(["shard"])
            for name, values in (
                ("bin_id", base + numbers.astype(np.int64)),
                ("bin_offset", offset),
                ("bin_capacity", np.array(final, dtype=np.int64)[numbers]),
                ("bin_used", used[numbers]),
            ):
                table = table.append_column(name, pa.array(values))
            yield from table.to_batches()

    kind = cut.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, piece long, start long, length int, "
        "bin_id long, bin_offset long, bin_capacity long, bin_used long"
    )
    return dealt.select("doc_id", "piece", "start", "length", "shard").mapInArrow(run, schema)


def pack_tokens(
    docs: DataFrame,
    path: str,
    pattern: str,
    id_column: str = "doc_id",
    remembered: int = byte_bpe.CACHED_COUNTS,
    release: bool = False,
) -> DataFrame:
    """``pack`` by the tokens of every whole text under the ranks of a file, and a separator each;
    ``remembered`` and ``release`` as in ``byte_bpe.lengths``."""
    counted = byte_bpe.lengths(docs, path, pattern, id_column, remembered=remembered, release=release)
    # Written, as the lengths are read twice.
    return pack(materialize(counted, "lengths"), F.col("n_tokens") + SEPARATOR)
