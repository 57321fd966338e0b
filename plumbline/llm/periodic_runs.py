"""Maximal periodic runs of words, found in tiles whose size follows the period.

Periods are taken octave by octave, P <= p < 2P. In every octave a text has boundaries at equal
distances, close enough that a run of such a period holds a boundary b together with b + p. What
repeats to the right of b and to the left of it is told by two Z-functions of a window of some P
words around b, so an octave needs no more than tiles that overlap by a few P:

    forward(p)  = common beginning of w[b:] and w[b + p:]
    backward(p) = common end of w[:b] and w[:b + p]
    a fragment w[b - backward(p) : b + p + forward(p)] of period p

Windows cut fragments short; fragments of one text and period that share p words or more are the
same run, so what tiles find on their own is put together by (text, period).

Texts up to ``TILE_BYTES`` lie in a tile as a whole, many of them in one, each closed by a mark
that occurs once; nothing of them is shuffled. Longer texts are cut into tiles that are dealt out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.joins import look_up
from plumbline.functions.sizing import materialize
from plumbline.llm.common import mix, small_batches

MIN_WORDS = 12
TILE_BYTES = 32 << 10
# Words of the texts that are solved together, and of the core of a tile in the lower octaves.
SHARED_WORDS = 1 << 16
CORE_WORDS = 1 << 14
# All octaves up to this one have the same tiles; from there on a core has so many times P words.
LOW_OCTAVE = 512
CORE_OCTAVES = 8
# Up to so many shifts at a boundary are compared outright; for more the Z-functions are computed.
FEW_SHIFTS = 6

RUN = "struct<start:bigint,length:bigint,period:bigint>"
RUN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def z_function(s: list[int | None]) -> list[int]:
    """Length of the common beginning of ``s`` and ``s[i:]``, for every i."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        left, right = i, i + k
    return z


def needed(period: int, least: int = MIN_WORDS) -> int:
    """Words by which a run reaches beyond one period."""
    return max(least, 2 * period) - period


@lru_cache(maxsize=1 << 16)
def proper_roots(period: int) -> tuple[int, ...]:
    """``period / r`` for its prime factors r: a word that is a power is one of such a root."""
    found, rest, r = [], period, 2
    while r * r <= rest:
        if rest % r == 0:
            found.append(period // r)
            while rest % r == 0:
                rest //= r
        r += 1
    if rest > 1:
        found.append(period // rest)
    return tuple(found)


def _floor_power(n: int) -> int:
    return 1 << (n.bit_length() - 1)


def _first_mismatch(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    differ = a[:n] != b[:n]
    at = int(differ.argmax()) if n else 0
    return at if n and differ[at] else n


class Tile:
    """A stretch of words, as numbers, in which the octaves are searched."""

    def __init__(self, words: np.ndarray, least: int = MIN_WORDS):
        self.words, self.least = words, least
        self.size, self.hash = 1, mix(words)

    def _blocks(self, size: int) -> np.ndarray:
        """Hashes of all blocks of ``size`` words, from those of half the size."""
        if size < self.size:
            self.size, self.hash = 1, mix(self.words)
        with np.errstate(over="ignore"):
            while self.size < size:
                h = self.hash
                more = np.uint64(2 * self.size + 1) * np.uint64(0x9E3779B97F4A7C15)
                self.hash = (h[: -self.size] * more) ^ ((h[: -self.size] >> np.uint64(29)) + h[self.size :])
                self.size *= 2
        return self.hash

    def octave(self, low: int, start: int, end: int) -> list[tuple[int, int, int]]:
        """(period, from, to) of the fragments around the boundaries in [start, end)."""
        n = len(self.words)
        need = min(needed(p, self.least) for p in range(low, 2 * low)) if low < self.least else low
        step, block = _floor_power(need), _floor_power((need + 1) // 2)
        if n < low + need or block >= n:
            return []
        hashes = self._blocks(block)
        # A fragment reaches at least half of what is needed to one side of its boundary.
        at, period = self._candidates(hashes, low, step, block)
        inside = (at >= start) & (at < end)
        at, period = at[inside], period[inside]
        found = []
        clip = max(2 * low, self.least)
        cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(at)]
        for first, last in zip(cuts, cuts[1:]):
            if first < last:
                found += self._around(int(at[first]), period[first:last].tolist(), low, clip)
        return found

    def _candidates(self, hashes: np.ndarray, low: int, step: int, block: int) -> tuple[np.ndarray, np.ndarray]:
        """Boundaries b and periods p for which the block after, or before, b + p is that at b."""
        n = len(self.words)
        count = -(-n // step)
        rows = count + -(-2 * low // step)
        found = []
        for shift in (0, block):
            # flat[i] is the block that begins at i - shift.
            flat = np.zeros(rows * step + 2 * low, dtype=np.uint64)
            flat[shift : shift + len(hashes)] = hashes
            known = np.zeros(count, dtype=bool)
            known[-(-shift // step) : (len(hashes) + shift - 1) // step + 1] = True
            ends = len(hashes) + shift
            boundary = flat[: count * step : step]
            if step == low:
                same = flat[low : low + count * low].reshape(count, low) == boundary[:, None]
                same[~known] = False
                b, p = np.divmod(np.flatnonzero(same), low)
                b, p = b * step, p + low
            else:
                pairs = []
                for p in range(low, 2 * low):
                    hit = (flat[p : p + count * step : step] == boundary) & known
                    b = np.flatnonzero(hit) * step
                    pairs.append((b, np.full(len(b), p)))
                b, p = (np.concatenate(x) for x in zip(*pairs))
            real = b + p < ends
            found.append((b[real] << np.int64(32)) | p[real])
        both = np.unique(np.concatenate(found))
        return both >> np.int64(32), both & np.int64(0xFFFFFFFF)

    def _around(self, b: int, periods: list[int], low: int, clip: int) -> list[tuple[int, int, int]]:
        w, n, found = self.words, len(self.words), []
        if len(periods) <= FEW_SHIFTS:
            for p in periods:
                forward = _first_mismatch(w[b : b + clip], w[b + p : b + p + clip])
                before = w[max(0, b - clip) : b]
                backward = _first_mismatch(before[::-1], w[b + p - len(before) : b + p][::-1])
                if forward + backward >= needed(p, self.least) and not any(
                    np.array_equal(w[b : b + p - d], w[b + d : b + p]) for d in proper_roots(p) if d < p
                ):
                    found.append((p, b - backward, b + p + forward))
            return found
        before, reach = w[max(0, b - clip) : b].tolist()[::-1], min(2 * low, n - b)
        forward = z_function(w[b : min(n, b + 2 * low + clip)].tolist())
        across = z_function([*before, None, *w[b - len(before) : b + reach].tolist()[::-1]])
        for p in periods:
            right = min(forward[p], clip) if p < len(forward) else 0
            left = min(across[len(before) + 1 + reach - p], clip)
            if right + left >= needed(p, self.least) and not any(forward[d] >= p - d for d in proper_roots(p) if d < p):
                found.append((p, b - left, b + p + right))
        return found


def stitch(fragments: np.ndarray) -> np.ndarray:
    """Rows (period, from, to), sorted, of fragments that overlap by a period or more."""
    if not len(fragments):
        return fragments.reshape(0, 3)
    fragments = fragments[np.lexsort((fragments[:, 1], fragments[:, 0]))]
    period, start, end = fragments.T
    _, number = np.unique(period, return_inverse=True)
    span = int(end.max()) + 1
    reach = np.maximum.accumulate(end + number * span) - number * span
    opens = np.ones(len(period), dtype=bool)
    opens[1:] = (period[1:] != period[:-1]) | (start[1:] + period[1:] > reach[:-1])
    first = np.flatnonzero(opens)
    return np.stack([period[first], start[first], np.maximum.reduceat(end, first)], axis=1)


def solve(
    words: np.ndarray, octaves: list[int], start: int = 0, end: int | None = None, least: int = MIN_WORDS
) -> np.ndarray:
    """Stitched fragments of the octaves around the boundaries in [start, end) of a tile."""
    tile, found = Tile(words, least), []
    for low in sorted(octaves):
        found += tile.octave(low, start, len(words) if end is None else end)
    return stitch(np.array(found, dtype=np.int64).reshape(-1, 3))


def octaves_of(n: int) -> list[int]:
    """All octaves with periods that fit twice into ``n`` words."""
    return [1 << k for k in range((n // 2).bit_length())]


def shared_runs(texts: list[list[bytes]], least: int = MIN_WORDS) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of several texts that lie in one tile."""
    numbers: dict[bytes, int] = {}
    ids, offsets = [], []
    for place, words in enumerate(texts):
        offsets.append(len(ids))
        ids += [numbers.setdefault(word, len(numbers)) for word in words]
        # A mark of its own, so that nothing repeats across it.
        ids.append(-1 - place)
    found = solve(np.array(ids, dtype=np.int64), octaves_of(max(map(len, texts), default=0)), least=least)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    owner = np.searchsorted(offsets, found[:, 1], side="right") - 1
    for place, (period, start, end) in zip(owner.tolist(), found.tolist()):
        runs[place].append((start - offsets[place], end - start, period))
    return runs


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by spaces, of every run no more than one period."""
    if runs:
        depth = np.zeros(len(words) + 1, dtype=np.int64)
        for start, length, period in runs:
            depth[start + period] += 1
            depth[start + length] -= 1
        kept = np.cumsum(depth[:-1]) == 0
        words = [word for word, keep in zip(words, kept.tolist()) if keep]
    return b" ".join(words)


def _run_lists(runs: list[list[tuple[int, int, int]]]) -> pa.ListArray:
    ends = pa.array(np.cumsum([0, *map(len, runs)]), pa.int32())
    flat = np.array([run for each in runs for run in each], dtype=np.int64).reshape(-1, 3)
    parts = pa.StructArray.from_arrays(
        [pa.array(flat[:, k]) for k in range(3)], fields=list(RUN_TYPE.value_type)
    )
    return pa.ListArray.from_arrays(ends, parts)


def _found(
    doc_ids: pa.Array, texts: list[list[bytes]], runs: list[list[tuple[int, int, int]]]
) -> pa.RecordBatch:
    rest = [collapsed(words, found) for words, found in zip(texts, runs)]
    columns = [pa.array(list(map(len, texts)), pa.int64()), _run_lists(runs), pa.array(rest, pa.binary())]
    return pa.RecordBatch.from_arrays([doc_ids, *columns], names=["doc_id", "n_words", "runs", "collapsed"])


def _whole(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(value.as_py() or b"").split() for value in batch.column("text")]
            # Texts of like length share a tile, so few octaves are searched in vain.
            order, runs = sorted(range(len(texts)), key=lambda i: len(texts[i])), [[]] * len(texts)
            held, size = [], 0
            for place, i in enumerate(order, 1):
                held.append(i)
                size += len(texts[i]) + 1
                if size >= SHARED_WORDS or place == len(order):
                    for j, found in zip(held, shared_runs([texts[j] for j in held], least)):
                        runs[j] = sorted(found, key=lambda r: (r[0], r[2]))
                    held, size = [], 0
            yield _found(batch.column("doc_id"), texts, runs)

    return run


def bands(n: int, core_words: int = CORE_WORDS, low_octave: int = LOW_OCTAVE) -> list[tuple[list[int], int]]:
    """The octaves of a text of ``n`` words in groups that share tiles, and the core of those."""
    octaves = octaves_of(n)
    groups = [([p for p in octaves if p <= low_octave], max(core_words, CORE_OCTAVES * low_octave))]
    high = [p for p in octaves if p > low_octave]
    groups += [([p], CORE_OCTAVES * p) for p in high if CORE_OCTAVES * p < n]
    # Beyond, one core would hold the whole text.
    groups.append(([p for p in high if CORE_OCTAVES * p >= n], 1 << n.bit_length()))
    return [(some, core) for some, core in groups if some]


def _cut(least: int, core_words: int, low_octave: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "octaves", "tile_start", "core_start", "core_end", "words"]
        for batch in batches:
            for row, value in zip(batch.column("row").to_pylist(), batch.column("text")):
                numbers: dict[bytes, int] = {}
                listed = [numbers.setdefault(word, len(numbers)) for word in (value.as_py() or b"").split()]
                ids, n = np.array(listed, dtype=np.uint32), len(listed)
                for octaves, core in bands(n, core_words, low_octave):
                    margin = max(2 * octaves[-1], least)
                    for start in range(0, n, core):
                        # The boundaries of all tiles lie on one grid.
                        first = max(0, start - margin)
                        first -= first % _floor_power(max(octaves[-1], least))
                        end = min(n, start + core)
                        part = ids[first : min(n, end + 2 * octaves[-1] + margin)]
                        columns = [[row], [octaves], [first], [start], [end], [part.tobytes()]]
                        kinds = [pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return run


def _solve_tiles(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tile in batch.to_pylist():
                words = np.frombuffer(tile["words"], dtype=np.uint32).astype(np.int64)
                shift = tile["tile_start"]
                found = solve(words, tile["octaves"], tile["core_start"] - shift, tile["core_end"] - shift, least)
                columns = [np.full(len(found), tile["row"]), found[:, 0], found[:, 1] + shift, found[:, 2] + shift]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], names=["row", "period", "start", "end"]
                )

    return run


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [(value.as_py() or b"").split() for value in batch.column("text")]
        runs = [[(r["start"], r["length"], r["period"]) for r in each or ()] for each in batch.column("runs").to_pylist()]
        yield _found(batch.column("doc_id"), texts, runs)


def stitched(fragments: DataFrame) -> DataFrame:
    """``row``, ``start``, ``length``, ``period`` from the fragments of all tiles. What one text
    and period have is bounded by the tiles of the text."""
    same = Window.partitionBy("row", "period").orderBy("start", "end")
    before = F.max("end").over(same.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce((F.col("start") + F.col("period") > before).cast("int"), F.lit(1))
    numbered = fragments.withColumn("opens", opens).withColumn("run", F.sum("opens").over(same))
    runs = numbered.groupBy("row", "period", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return runs.select("row", "start", (F.col("end") - F.col("start")).alias("length"), "period")


def find_runs(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least: int = MIN_WORDS,
    tile_bytes: int = TILE_BYTES,
    core_words: int = CORE_WORDS,
    low_octave: int = LOW_OCTAVE,
) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` (start, length, period by start and period) and the
    ``collapsed`` text (its UTF-8 bytes) of every whole text.

    A run is a stretch of words of smallest period p and at least max(``least``, 2 p) words that
    no neighbouring word extends. Null and empty texts have no words; repeated rows and null ids
    stay; other columns are not carried.
    """
    small_batches(docs.sparkSession)
    chosen = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("binary").alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, runs array<{RUN}>, collapsed binary"
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    short = chosen.where(size <= tile_bytes).mapInArrow(_whole(least), schema)

    long = chosen.where(size > tile_bytes).withColumn("row", F.monotonically_increasing_id())
    # Written, as the rows are numbered and read twice.
    long = materialize(long, "long-texts")
    tiles = long.select("row", "text").mapInArrow(
        _cut(least, core_words, low_octave),
        "row long, octaves array<long>, tile_start long, core_start long, core_end long, words binary",
    )
    dealt = tiles.repartition(F.col("row"), F.col("core_start"), F.col("octaves")[0])
    fragments = dealt.mapInArrow(_solve_tiles(least), "row long, period long, start long, end long")
    # Sorted by the fields in their order.
    each = F.array_sort(F.collect_list(F.struct("start", "period", "length")))
    ordered = F.transform(each, lambda r: F.struct(r["start"], r["length"], r["period"]).cast(RUN))
    per_text = stitched(fragments).groupBy("row").agg(ordered.alias("runs"))
    joined = look_up(long, per_text, "row", "row").select("doc_id", "text", "runs")
    return short.unionByName(joined.mapInArrow(_collapse, schema))

