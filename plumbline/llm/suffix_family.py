"""Long repeated passages through a logarithmic family of suffix arrays.

A repeat is a string of ``length`` bytes that starts in two places. Of the starts of all suffixes
only some enter an array: in every string of ``length`` bytes the place whose next bytes hash least,
among the places that still have ``beginning`` bytes left in it. Equal strings choose the same
place, so two of them always meet as two suffixes with the same beginning.

* A new batch of texts gets its suffix array: its suffixes in the order of their beginnings (by a
  hash of them, so that equal ones are neighbours and ranges are even).
* The array is scanned in step with every level of the family. What stands in both has met.
* Arrays of equal size are merged into one of twice the size, in the same pass as the scan.

Suffixes that have met are compared for good. Those with the same surroundings, as far as any
string that chose them reaches, are one class: two members are a repeat of all those strings. Of
classes that share only the beginning the right surroundings get a suffix array and the left ones
another, with the lengths that neighbours share. A string that starts o bytes before its suffix
is repeated where two suffixes share ``length`` - o bytes to the right and o bytes to the left,
which both arrays tell for all suffixes at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.joins import look_up
from plumbline.functions.sizing import broadcast_if_small, materialize
from plumbline.llm.common import Column, mix, small_batches

LENGTH = 200
BEGINNING = 64
BATCHES = 4
# Bytes of text sampled at once, and of the strings a place is chosen by.
PART_BYTES = 1 << 20
GRAM = 8
# Suffixes with one beginning but different surroundings: up to so many are compared in one task,
# beyond that every string of them is counted on its own.
GROUP_ROWS = 20_000
TASK_ROWS = 50_000


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The least of ``values[i : i + width]`` for every i that has so many."""
    n = len(values) - width + 1
    rows = -(-len(values) // width)
    padded = np.full(rows * width, np.iinfo(values.dtype).max, dtype=values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(rows, width)
    from_start = np.minimum.accumulate(blocks, axis=1).ravel()
    to_end = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(to_end[:n], from_start[width - 1 : width - 1 + n])


def _bytes_hash(rows: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of a matrix of bytes."""
    width = -(-rows.shape[1] // 8) * 8
    padded = np.zeros((len(rows), width), dtype=np.uint8)
    padded[:, : rows.shape[1]] = rows
    return mix(*padded.view(np.uint64).T) if len(rows) else np.empty(0, np.uint64)


class Sample:
    """The chosen suffixes of several texts that lie in one buffer.

    ``at`` is where a suffix starts in its text, ``owner`` which text that is. The strings that
    chose it start ``last`` to ``first`` bytes before it.
    """

    def __init__(self, texts: list[bytes], length: int, beginning: int):
        self.length, self.beginning = length, beginning
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        ends = np.cumsum(sizes)
        self.starts = starts = ends - sizes
        self.buffer = np.frombuffer(b"".join(texts) + bytes(length), dtype=np.uint8)
        count = np.maximum(sizes - length + 1, 0)
        n = int(count.sum())
        # Where a string can start, over all texts.
        start = np.arange(n) - np.repeat(np.cumsum(count) - count, count) + np.repeat(starts, count)
        place = self._places(int(ends[-1]) if len(ends) else 0)[start] if n else start
        opens = np.ones(n, dtype=bool)
        opens[1:] = (np.diff(place) != 0) | (np.diff(start) != 1)
        head = np.flatnonzero(opens)
        tail = np.append(head[1:], n)[: len(head)] - 1
        self.place = place[head]
        self.owner = np.searchsorted(ends, self.place, side="right")
        self.at = self.place - starts[self.owner]
        self.first, self.last = self.place - start[head], self.place - start[tail]

    def _places(self, size: int) -> np.ndarray:
        """For every start the place its string chooses; the first one where hashes tie."""
        gram = np.zeros(size, dtype=np.uint64)
        for k in range(GRAM):
            gram |= self.buffer[k : k + size].astype(np.uint64) << np.uint64(8 * k)
        with np.errstate(over="ignore"):
            gram *= np.uint64(0x9E3779B97F4A7C15)
            gram ^= gram >> np.uint64(29)
            gram *= np.uint64(0xBF58476D1CE4E5B9)
        low = np.uint64((1 << 32) - 1)
        ranked = (gram & ~low) | np.arange(size, dtype=np.uint64)
        return (_sliding_minimum(ranked, self.length - self.beginning + 1) & low).astype(np.int64)

    def beginnings(self) -> np.ndarray:
        rows = self.buffer[self.place[:, None] + np.arange(self.beginning)]
        return _bytes_hash(rows).view(np.int64)

    def surroundings(self, rows: np.ndarray | slice = slice(None)) -> tuple[np.ndarray, np.ndarray]:
        """Matrices of the bytes after each place, and before it from the nearest on; zeros beyond
        the strings that chose it."""
        place, first, last = (x[rows][:, None] for x in (self.place, self.first, self.last))
        right, left = np.arange(self.length), np.arange(self.length - self.beginning)
        after = self.buffer[place + right]
        after[right >= self.length - last] = 0
        before = self.buffer[np.maximum(place - 1 - left, 0)]
        before[left >= first] = 0
        return after, before


def _samples(texts: list[bytes], length: int, beginning: int) -> Iterator[tuple[int, Sample]]:
    """Samples of about ``PART_BYTES`` of text each, with the number of their first text."""
    start, size = 0, 0
    for number, text in enumerate(texts, 1):
        size += len(text)
        if size >= PART_BYTES or number == len(texts):
            yield start, Sample(texts[start:number], length, beginning)
            start, size = number, 0


def _texts(column: pa.Array) -> list[bytes]:
    return [value.as_py() or b"" for value in column]


def keyed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``k1`` and ``k2`` (a 128-bit key of id and text), ``doc_id`` and the bytes of ``text``."""
    chosen = docs.select(
        F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column).cast("binary"), F.lit(b"")).alias("text")
    )
    return chosen.select(
        F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64(F.lit(1), "text", "doc_id").alias("k2"), "doc_id", "text"
    )


def suffixes(keyed_docs: DataFrame, length: int = LENGTH, beginning: int = BEGINNING) -> DataFrame:
    """The chosen suffixes of every text, as lists: ``h`` (hash of the beginning), ``c`` (hash of
    the surroundings), ``at``, ``first``, ``last``. Texts shorter than ``length`` have no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, sample in _samples(_texts(batch.column("text")), length, beginning):
                h = sample.beginnings()
                after, before = sample.surroundings()
                ends = np.stack([sample.first, sample.last], axis=1).astype(np.uint64)
                c = mix(_bytes_hash(after), _bytes_hash(before), *ends.T).view(np.int64)
                owners, counts = np.unique(sample.owner, return_counts=True)
                cuts = pa.array(np.append(0, np.cumsum(counts)).astype(np.int32))
                part = batch.select(["k1", "k2"]).take(pa.array(begin + owners))
                lists = [
                    pa.ListArray.from_arrays(cuts, pa.array(values.astype(kind)))
                    for values, kind in (
                        (h, np.int64), (c, np.int64), (sample.at, np.int32), (sample.first, np.int16), (sample.last, np.int16)
                    )
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column("k1"), part.column("k2"), *lists], names=["k1", "k2", "h", "c", "at", "first", "last"]
                )

    schema = "k1 long, k2 long, h array<long>, c array<long>, at array<int>, first array<smallint>, last array<smallint>"
    return keyed_docs.select("k1", "k2", "text").mapInArrow(run, schema)


class SuffixFamily:
    """Suffix arrays of sizes that double, over all batches added so far.

    An array is a stored table of beginnings (``h``) in their order, each with whether it stands in
    it ``again``. Levels of one rank hold as many batches, 2^rank.
    """

    def __init__(self) -> None:
        self.levels: dict[int, DataFrame] = {}

    def add(self, batch: DataFrame) -> DataFrame:
        """Add the beginnings ``h`` of a batch, one row per suffix; returns those that are repeated
        in the batch or stand in the family already, each at least once."""
        array = self._store(batch.groupBy("h").agg((F.count("*") > 1).alias("again")))
        met = [array.where("again").select("h")]
        fresh, waiting = array, dict(self.levels)
        rank = 0
        while rank in self.levels:
            # Scan and merge in one pass.
            level = waiting.pop(rank)
            both = self._merged(array, level)
            met.append(both.where("crossed").select("h"))
            del self.levels[rank]
            array, rank = both, rank + 1
        for level in waiting.values():
            met.append(fresh.select("h").join(level.select("h"), "h", "left_semi"))
        self.levels[rank] = array.select("h", "again")
        found = met[0]
        for more in met[1:]:
            found = found.unionByName(more)
        return materialize(found, "met")

    def _merged(self, one: DataFrame, two: DataFrame) -> DataFrame:
        sides = one.select("h", "again", F.lit(1).alias("side")).unionByName(
            two.select("h", "again", F.lit(2).alias("side"))
        )
        crossed = F.min("side") != F.max("side")
        return self._store(sides.groupBy("h").agg(F.max("again").alias("again"), crossed.alias("crossed")))

    def _store(self, array: DataFrame) -> DataFrame:
        return materialize(array.sortWithinPartitions("h"), "suffix-array")


def met_beginnings(entries: DataFrame, batches: int = BATCHES) -> DataFrame:
    """The beginnings that stand in more than one place, found by adding the texts batch by batch."""
    family, found = SuffixFamily(), None
    for number in range(batches):
        batch = entries.where(F.col("batch") == number).select(F.explode("h").alias("h"))
        met = family.add(batch)
        found = met if found is None else found.unionByName(met)
    return found.distinct()


def _shared(rows: np.ndarray) -> np.ndarray:
    """How many bytes each row of a sorted matrix shares with the row before."""
    out = np.zeros(len(rows), dtype=np.int64)
    differ = rows[1:] != rows[:-1]
    out[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return out


def repeated_strings(
    h: np.ndarray, first: np.ndarray, last: np.ndarray, after: np.ndarray, before: np.ndarray, several: np.ndarray,
    length: int = LENGTH,
) -> np.ndarray:
    """Row r, column o: whether the string that starts o bytes before suffix r is chosen by it and
    starts elsewhere too. Suffixes with ``several`` occurrences repeat as they are."""
    m = len(h)
    heads = h.astype(">i8").reshape(-1, 1).view(np.uint8).reshape(m, 8)
    ranked = []
    for side in (after, before):
        rows = np.ascontiguousarray(np.concatenate([heads, side], axis=1))
        flat, width = rows.tobytes(), rows.shape[1]
        order = np.array(sorted(range(m), key=lambda i: flat[i * width : (i + 1) * width]), dtype=np.int64)
        ranked.append((order, _shared(rows[order]) - 8))
    found = np.zeros((m, before.shape[1] + 1), dtype=bool)
    numbers = np.empty((2, m), dtype=np.int64)
    for o in range(found.shape[1]):
        rows = np.flatnonzero((last <= o) & (o <= first))
        if not len(rows):
            continue
        # Suffixes that share enough to a side stand beside each other in its array.
        for number, (order, shared), need in zip(numbers, ranked, (length - o, o)):
            number[order] = np.cumsum(shared < need)
        key = numbers[0, rows] * (m + 1) + numbers[1, rows]
        _, place, count = np.unique(key, return_inverse=True, return_counts=True)
        found[rows, o] = (count[place] > 1) | several[rows]
    return found


def _ranges(found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and last column of each stretch of set values in a row."""
    edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, low = np.nonzero(edge == 1)
    return row, low, np.nonzero(edge == -1)[1] - 1


def _surround(length: int, beginning: int):
    """The bytes around the asked places of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["h", "k1", "k2", "at", "several", "first", "last", "after", "before"]
        for batch in batches:
            keys, asked = batch.select(["k1", "k2"]), batch.column("asked")
            for begin, sample in _samples(_texts(batch.column("text")), length, beginning):
                part = asked.slice(begin, len(sample.starts))
                at, several = part.flatten().flatten()
                owner = np.repeat(np.arange(len(part)), part.value_lengths().to_numpy())
                row = np.searchsorted(sample.place, sample.starts[owner] + at.to_numpy())
                part = keys.take(pa.array(begin + owner))
                after, before = sample.surroundings(row)
                columns = [
                    pa.array(sample.beginnings()[row]),
                    *part.columns,
                    at,
                    several,
                    *(pa.array(values[row].astype(np.int16)) for values in (sample.first, sample.last)),
                    *(pa.array([line.tobytes() for line in side], pa.binary()) for side in (after, before)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _compare(length: int):
    """All suffixes of a task, whose beginnings are nowhere else."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        h, at, first, last = (table.column(n).to_numpy().astype(np.int64) for n in ("h", "at", "first", "last"))
        several = table.column("several").to_numpy()
        sides = [
            np.frombuffer(b"".join(table.column(n).to_pylist()), dtype=np.uint8).reshape(len(h), -1)
            for n in ("after", "before")
        ]
        found = repeated_strings(h, first, last, *sides, several, length)
        found[several] = False
        row, low, high = _ranges(found)
        part = table.select(["k1", "k2"]).take(pa.array(row)).combine_chunks()
        columns = [pa.array((at[row] - x).astype(np.int32)) for x in (high, low)]
        for k, name in enumerate(("begin", "end")):
            part = part.append_column(name, columns[k])
        yield from part.to_batches()

    return run


def _strings(length: int):
    """Every string that chose a suffix, as a 128-bit hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                first, last = (part.column(n).to_numpy().astype(np.int64) for n in ("first", "last"))
                after, before = (
                    np.frombuffer(b"".join(part.column(n).to_pylist()), dtype=np.uint8).reshape(part.num_rows, -1)
                    for n in ("after", "before")
                )
                whole = np.concatenate([before[:, ::-1], after], axis=1)
                n = first - last + 1
                row = np.repeat(np.arange(len(n)), n)
                o = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + last[row]
                strings = whole[row[:, None], (before.shape[1] - o)[:, None] + np.arange(length)]
                w1 = _bytes_hash(strings)
                w2 = _bytes_hash(strings[:, ::-1])
                taken = part.select(["k1", "k2", "at", "several"]).take(pa.array(row))
                begin = pa.array((taken.column("at").to_numpy() - o).astype(np.int32))
                hashes = [pa.array(w.view(np.int64)) for w in (w1, w2)]
                columns = [*hashes, taken.column("k1"), taken.column("k2"), begin, taken.column("several")]
                yield pa.RecordBatch.from_arrays(columns, names=["w1", "w2", "k1", "k2", "begin", "several"])

    return run


def _joined(docs: DataFrame, per_text: DataFrame, how: str) -> DataFrame:
    """Texts beside what is known of them; a small table travels to the texts."""
    small, _ = broadcast_if_small(per_text)
    return docs.join(small, ["k1", "k2"], how)


def repeated_ranges(
    docs: DataFrame, length: int = LENGTH, beginning: int = BEGINNING, batches: int = BATCHES, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """``k1``, ``k2``, ``begin``, ``end``: ranges of starts (both included) of repeated strings."""
    entries = suffixes(docs, length, beginning).withColumn("batch", F.pmod("k1", F.lit(batches)).cast("int"))
    entries = materialize(entries, "suffixes", ["batch"])
    met = materialize(met_beginnings(entries, batches), "met")
    each = F.explode(F.arrays_zip("h", "c", "at", "first", "last")).alias("s")
    listed = entries.select("k1", "k2", each).select("k1", "k2", "s.*")
    known = met.withColumn("known", F.lit(True))
    flagged = look_up(listed, known, "h", "k2").where("known").drop("known")
    flagged = materialize(flagged.withColumn("class", F.struct("h", "c")), "met-suffixes")

    member = F.min(F.struct("k1", "k2", "at")).alias("member")
    classes = flagged.groupBy("class").agg((F.count("*") > 1).alias("several"), member)
    classes = materialize(classes.select("class", F.col("class.h").alias("h"), "several", "member"), "classes")
    copied = classes.where("several").select("class", "several")
    whole = look_up(flagged, copied, "class", "k2").where("several")
    begin, end = ((F.col("at") - F.col(name)).cast("int") for name in ("first", "last"))
    whole = whole.select("k1", "k2", begin.alias("begin"), end.alias("end"))

    groups = classes.groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    groups = materialize(groups, "groups")
    different = look_up(classes, groups, "h", "class").where("n > 1")
    asked = different.select("member.*", "several").groupBy("k1", "k2")
    asked = materialize(asked.agg(F.collect_list(F.struct("at", "several")).alias("asked")), "asked")
    shape = "h long, k1 long, k2 long, at int, several boolean, first smallint, last smallint, after binary, before binary"
    around = _joined(docs.select("k1", "k2", "text"), asked, "inner").mapInArrow(_surround(length, beginning), shape)
    # A repeated row comes more than once, but then all its suffixes occur several times anyway.
    around = materialize(around, "surroundings")
    hot = materialize(groups.where(F.col("n") > group_rows).select("h", F.lit(True).alias("hot")), "hot")
    marked = look_up(around, hot, "h", "k2")
    few = marked.where(F.col("hot").isNull()).drop("hot")
    tasks = max(1, -(-around.count() // TASK_ROWS))
    parts = few.repartition(tasks, "h").mapInArrow(_compare(length), "k1 long, k2 long, begin int, end int")
    found = whole.unionByName(parts)
    if hot.count():
        found = found.unionByName(_counted(marked.where("hot").drop("hot"), length))
    return found


def _counted(around: DataFrame, length: int) -> DataFrame:
    """Repeated strings of beginnings with very many different surroundings, one by one."""
    shape = "w1 long, w2 long, k1 long, k2 long, begin int, several boolean"
    strings = around.mapInArrow(_strings(length), shape).withColumn("string", F.struct("w1", "w2"))
    strings = materialize(strings.drop("w1", "w2"), "strings")
    weight = F.sum(F.when(F.col("several"), 2).otherwise(1))
    repeated = strings.groupBy("string").agg((weight > 1).alias("repeated")).where("repeated")
    found = look_up(strings, repeated, "string", "begin").where("repeated AND NOT several")
    return found.select("k1", "k2", "begin", F.col("begin").alias("end"))


def covered_spans(ranges: DataFrame, length: int = LENGTH) -> DataFrame:
    """``k1``, ``k2`` and the maximal runs of covered bytes, ``starts`` and ``ends``."""
    listed = ranges.groupBy("k1", "k2").agg(F.collect_list(F.struct("begin", "end")).alias("r"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, ends = [], []
            for value in batch.column("r"):
                flat = value.values.flatten()
                begin, end = (part.to_numpy().astype(np.int64) for part in flat)
                order = np.argsort(begin)
                begin, end = begin[order], np.maximum.accumulate(end[order] + length)
                opens = np.append(True, begin[1:] > end[:-1])
                starts.append(begin[opens].astype(np.int32))
                ends.append(end[np.append(np.flatnonzero(opens)[1:] - 1, len(end) - 1)].astype(np.int32))
            columns = [pa.array(x, pa.list_(pa.int32())) for x in (starts, ends)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("k1"), batch.column("k2"), *columns], names=["k1", "k2", "starts", "ends"]
            )

    return listed.mapInArrow(run, "k1 long, k2 long, starts array<int>, ends array<int>")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, kept = _texts(batch.column("text")), []
        for text, starts, ends in zip(texts, batch.column("starts"), batch.column("ends")):
            starts, ends = starts.as_py() or [], ends.as_py() or []
            kept.append(b"".join([text[a:b] for a, b in zip([0, *ends], [*starts, len(text)])]))
        names = ["doc_id", "n_bytes", "starts", "ends", "kept"]
        sizes = pa.array(list(map(len, texts)), pa.int64())
        columns = [batch.column("doc_id"), sizes, batch.column("starts"), batch.column("ends"), pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    beginning: int = BEGINNING,
    batches: int = BATCHES,
    group_rows: int = GROUP_ROWS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id``, ``n_bytes``, the removed runs of bytes (``starts`` and ``ends``; null where there
    are none) and the ``kept`` bytes of every text.

    A byte goes if a string of ``length`` bytes that also starts elsewhere, in any text, covers it.
    Repeated rows are texts of their own. Null and empty texts keep nothing and lose nothing, null
    ids stay, other columns are not carried.
    """
    if not GRAM <= beginning < length:
        raise ValueError("beginning must be at least 8 and below length")
    small_batches(docs.sparkSession)
    texts = keyed(docs, id_column, text_column)
    ranges = repeated_ranges(texts, length, beginning, batches, group_rows)
    spans = materialize(covered_spans(ranges, length), "spans")
    kind = texts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, starts array<int>, ends array<int>, kept binary"
    return _joined(texts, spans, "left").select("doc_id", "text", "starts", "ends").mapInArrow(_cut, schema)


def removed_bytes(starts: Column, ends: Column) -> Column:
    runs = F.zip_with(ends, starts, lambda end, start: (end - start).cast("long"))
    return F.coalesce(F.aggregate(runs, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long"))
