"""Numpy block kernel: queries x a batch of rows -> the best K per query.

Runs inside Spark tasks on Arrow batches. A task keeps at most K rows per query, so its
output does not grow with the rows it reads.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from plumbline.functions.ranking import ASCENDING, TIE_DIGITS

QUERY_CHUNK = 512
# Rows that are scored at a time: the blocks of scores of all cores stay in the cache they share.
ROW_CHUNK = 1_024
# With a large K the first rows are more, so many per hit and this many at most: their best K bound the rest.
OPENING_PER_HIT = 64
OPENING_ROWS = 32_768
GATHER_ROWS = 65_536
# Lengths up to this keep products of single precision finite.
SINGLE_MOST = 1e15
# A screen that lets more than one in so many pairs through is no use.
SCREEN_GAIN = 16
MAX_TABLE_CELLS = 2_000_000
PRODUCT_GAIN = 250


def matrix(column: pa.Array | pa.ChunkedArray, dim: int | None = None) -> np.ndarray:
    """Rows of a list or binary column as a float64 matrix; bits become -1 / +1."""
    if len(column) == 0:
        return np.empty((0, dim or 0))
    out = doubles(stored_rows(column))
    if dim is not None and out.shape[1] != dim:
        raise ValueError(f"expected {dim} dimensions, found {out.shape[1]}")
    return out


def stored_rows(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of a list or binary column in the type they are stored in; binary ones as unsigned bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = len(column)
    if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
        values = column.to_pylist()
        if len({len(v) for v in values}) > 1:
            raise ValueError("vectors of one column must have equal dimensions")
        return np.frombuffer(b"".join(values), dtype=np.uint8).reshape(rows, -1)
    lengths = np.diff(np.asarray(column.offsets))
    if (lengths != lengths[0]).any():
        raise ValueError("vectors of one column must have equal dimensions")
    return np.asarray(column.flatten()).reshape(rows, int(lengths[0]))


def doubles(rows: np.ndarray) -> np.ndarray:
    """Stored rows as float64; the bits of unsigned bytes become -1 / +1."""
    if rows.dtype == np.uint8:
        return np.unpackbits(rows, axis=1).astype(np.float64) * 2 - 1
    return rows.astype(np.float64)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; rows without length become NaN and never rank."""
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(length > 0, rows / length, np.nan)


def values_of(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.to_numpy(zero_copy_only=False)


def set_cells(mask: np.ndarray) -> np.ndarray:
    """Numbers of the cells that are set, in order. Where few are, eight at a time are passed over."""
    flat = mask.reshape(-1)
    if flat.size % 8:
        return np.flatnonzero(flat)
    words = np.flatnonzero(flat.view(np.uint64))
    if len(words) * 32 > flat.size:
        return np.flatnonzero(flat)
    at, place = np.nonzero(flat.reshape(-1, 8)[words])
    return words[at] * 8 + place


class Keeper:
    """Running best-K per query over any number of blocks; lower cost is better."""

    MERGE_ROWS = 100_000

    def __init__(self, queries: int, k: int, ascending: bool):
        self.k, self.sign = k, 1.0 if ascending else -1.0
        self.bound = np.full(queries, np.inf)
        self.q = np.empty(0, dtype=np.int64)
        self.cost = np.empty(0)
        self.ids: np.ndarray | None = None
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.n_waiting = 0

    def near(self, cost: np.ndarray, chunk: np.ndarray, slack: float):
        """Cells of ``cost`` (queries x rows) that may still enter the best K."""
        limit = self.bound[chunk]
        if cost.shape[1] > self.k:
            limit = np.minimum(limit, np.partition(cost, self.k - 1, axis=1)[:, self.k - 1])
        room = slack * np.maximum(1.0, np.where(np.isfinite(limit), np.abs(limit), 1.0))
        return np.nonzero((cost <= (limit + room)[:, None]) & np.isfinite(cost))

    def merge(self, q: np.ndarray, cost: np.ndarray, ids: np.ndarray) -> None:
        """Add hits. They are sorted in once they are as many as those kept, so that a large
        K costs a sort per doubling and not one per block."""
        self.waiting.append((q, cost, ids))
        self.n_waiting += len(q)
        if self.n_waiting >= max(self.MERGE_ROWS, len(self.q)):
            self.settle()

    def settle(self) -> None:
        if not self.waiting:
            return
        q, cost, ids = (np.concatenate(part) for part in zip(*self.waiting))
        self.waiting, self.n_waiting = [], 0
        if self.ids is not None:
            q = np.concatenate([self.q, q])
            cost = np.concatenate([self.cost, cost])
            ids = np.concatenate([self.ids, ids])
        keep = self._hopeful(q, cost)
        self.q, self.cost, self.ids = q[keep], cost[keep], ids[keep]
        if len(self.q) > 2 * self.k * len(self.bound):
            self.rank()

    def _hopeful(self, q: np.ndarray, cost: np.ndarray) -> np.ndarray:
        """Hits that reach their query's K-th cost, which becomes its bound; ties stay."""
        counts = np.bincount(q, minlength=len(self.bound))
        widest = int(counts.max(initial=0))
        full = counts >= self.k
        if not full.any() or widest * len(counts) > 4 * len(q) + self.MERGE_ROWS:
            # Too uneven to lay out; the ranking finds the bounds.
            return self._order(q, cost, None) if full.any() else np.arange(len(q))
        number = q.astype(np.uint16) if len(counts) < 1 << 16 else q
        order = np.argsort(number, kind="stable")
        lines = np.full((len(counts), widest), np.inf)
        lines[np.arange(widest) < counts[:, None]] = cost[order]
        kth = np.partition(lines[full], self.k - 1, axis=1)[:, self.k - 1]
        self.bound[full] = np.minimum(self.bound[full], kth)
        return np.flatnonzero(cost <= self.bound[q] + 10.0 ** -TIE_DIGITS)

    def _order(self, q: np.ndarray, cost: np.ndarray, ids: np.ndarray | None) -> np.ndarray:
        """Numbers of the best K hits per query, best first; without ``ids`` also those tied with the last."""
        key = np.round(cost, TIE_DIGITS)
        if ids is None:
            order = np.lexsort((key, q))
        else:
            order = np.lexsort((ids if ids.dtype.kind in "iu" else np.unique(ids, return_inverse=True)[1], key, q))
        at, line = np.arange(len(q)), q[order]
        first = np.r_[True, line[1:] != line[:-1]] if len(q) else np.empty(0, dtype=bool)
        place = at - np.maximum.accumulate(np.where(first, at, 0)) if len(at) else at
        full = order[place == self.k - 1]
        self.bound[q[full]] = np.minimum(self.bound[q[full]], cost[full])
        if ids is None:
            return order[(place < self.k) | (key[order] <= np.round(self.bound[line], TIE_DIGITS))]
        return order[place < self.k]

    def rank(self) -> None:
        """Cut what is kept to the best K per query, ties by id."""
        self.settle()
        if self.ids is not None:
            keep = self._order(self.q, self.cost, self.ids)
            self.q, self.cost, self.ids = self.q[keep], self.cost[keep], self.ids[keep]

    def batch(self, qids: pa.Array, schema: pa.Schema) -> pa.RecordBatch:
        """What was kept, as ``(qid, id, score)``."""
        self.rank()
        ids = self.ids if self.ids is not None else np.empty(0, dtype=object)
        return pa.RecordBatch.from_arrays(
            [
                qids.take(pa.array(self.q)).cast(schema.field(0).type),
                pa.array(ids, type=schema.field(1).type),
                pa.array(self.sign * self.cost, type=pa.float64()),
            ],
            schema=schema,
        )


def opening_rows(k: int) -> int:
    """How many rows are scored at once when nothing bounds the hits yet."""
    return max(ROW_CHUNK, min(OPENING_PER_HIT * k, OPENING_ROWS))


class Best(Keeper):
    """Dense vectors: queries times a block of rows in one matrix product.

    Products of single precision tell which rows may enter the best K, give or take what rounding
    can have moved them; only those are scored, in double precision.
    """

    # Room for one block of products, taken again by the next block.
    room = np.empty(0, dtype=np.float32)

    def __init__(self, queries: np.ndarray, k: int, metric: str, max_norm2: float = 0.0):
        super().__init__(len(queries), k, ASCENDING[metric])
        self.metric, self.max_norm2 = metric, max_norm2
        self.queries = unit(queries) if metric == "cosine" else queries
        self.norms2 = np.einsum("ij,ij->i", queries, queries)
        self.single: np.ndarray | None = None

    def add(self, rows: np.ndarray, ids: np.ndarray, which: np.ndarray | None = None) -> None:
        """Score ``rows`` against all queries, or only those numbered in ``which``."""
        picks = np.arange(len(self.queries)) if which is None else which
        opening = 0
        if self.ids is None and not self.waiting:
            opening = min(opening_rows(self.k), len(rows))
        for at, part in self.row_chunks(rows, opening):
            right = self.right(part)
            step = max(1, min(QUERY_CHUNK, QUERY_CHUNK * ROW_CHUNK // len(part)))
            for start in range(0, len(picks), step):
                chunk = picks[start : start + step]
                q, r, cost = self.found(chunk, part, right)
                self.merge(q, cost, ids[at[r]])
            if len(part) > ROW_CHUNK:
                self.settle()

    def row_chunks(self, rows: np.ndarray, opening: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Numbers and vectors of the rows that can be scored, some at a time."""
        opening = max(opening, ROW_CHUNK)
        for low in (0, *range(opening, len(rows), ROW_CHUNK)):
            part = rows[low : low + (ROW_CHUNK if low else opening)]
            if self.metric == "cosine":
                part = unit(part)
            sound = np.isfinite(part).all(axis=1)
            if sound.all():
                yield np.arange(low, low + len(part)), part
            elif sound.any():
                yield low + np.flatnonzero(sound), part[sound]

    def add_pairs(self, rows: np.ndarray, ids: np.ndarray, q: np.ndarray, r: np.ndarray) -> None:
        """Score the listed (query, row) pairs only; each pair is listed once."""
        if self.metric == "cosine":
            rows = unit(rows)
        for start in range(0, len(q), GATHER_ROWS):
            part = slice(start, start + GATHER_ROWS)
            score = pair_scores(self.queries[q[part]], rows[r[part]], self.metric, self.max_norm2)
            cost = self.sign * score
            good = cost <= self.bound[q[part]] + 1e-8 * np.maximum(1.0, np.abs(cost))
            self.merge(q[part][good], cost[good], ids[r[part]][good])

    def right(self, rows: np.ndarray) -> tuple[np.ndarray, float] | None:
        """Rows in single precision and their greatest length; None where that would overflow.

        Under l2 a coordinate more makes the product the one that orders rows by distance.
        """
        norms2 = np.einsum("ij,ij->i", rows, rows)
        longest = float(np.sqrt(norms2.max()))
        if self.single is None:
            left = self.queries
            if self.metric == "l2":
                left = np.hstack([left, np.ones((len(left), 1))])
            with np.errstate(over="ignore"):
                self.single = left.astype(np.float32)
            self.lengths = np.nan_to_num(np.linalg.norm(self.queries, axis=1))
        if not longest < SINGLE_MOST:
            return None
        if self.metric == "l2":
            rows = np.hstack([rows, -norms2[:, None] / 2])
        return rows.astype(np.float32), longest

    def gain_of(self, cost: np.ndarray, chunk: np.ndarray) -> np.ndarray:
        """The product at which a row has ``cost``."""
        if self.metric == "cosine":
            return 1.0 - cost
        if self.metric == "hamming":
            return self.queries.shape[1] - 2 * cost
        if self.metric in ("l2", "mips_l2"):
            over = self.max_norm2 if self.metric == "mips_l2" else 0.0
            return (self.norms2[chunk] + over - cost * cost) / 2
        return -cost

    def cost_of(self, gain: np.ndarray, chunk: np.ndarray) -> np.ndarray:
        """The other way round."""
        if self.metric == "cosine":
            return 1.0 - gain
        if self.metric == "hamming":
            return (self.queries.shape[1] - gain) / 2
        if self.metric in ("l2", "mips_l2"):
            over = self.max_norm2 if self.metric == "mips_l2" else 0.0
            return np.sqrt(np.maximum(self.norms2[chunk] + over - 2 * gain, 0.0))
        return -gain

    def found(self, chunk, rows, right, among: np.ndarray | None = None):
        """Queries, row numbers and costs of pairs that may enter the best K; with ``among``
        (queries x rows) only of pairs set there."""
        if right is None or not self.lengths[chunk].max() < SINGLE_MOST:
            return self._candidates(chunk, rows, among)
        single, longest = right
        gain = self._products(self.single[chunk], single)
        if among is not None:
            gain[~among] = -np.inf
        # Each product of D terms is off by at most D + 3 roundings of its terms' sizes.
        size = np.maximum(self.lengths[chunk], 1e-20) * max(longest, 1e-20)
        if self.metric == "l2":
            size = size + longest * longest / 2
        off = (self.queries.shape[1] + 8) * 2.0**-23 * size
        limit = self.bound[chunk]
        if gain.shape[1] > self.k and not np.isfinite(limit).all():
            last = gain.shape[1] - self.k
            kth = np.partition(gain, last, axis=1)[:, last].astype(np.float64)
            limit = np.minimum(limit, np.where(kth == -np.inf, np.inf, self.cost_of(kth - off, chunk)))
        bounded = np.isfinite(limit)
        room = 1e-8 * np.maximum(1.0, np.where(bounded, np.abs(limit), 1.0))
        limit = limit + room
        least = np.finfo(np.float32).min
        need = np.where(bounded, self.gain_of(np.where(bounded, limit, 0.0), chunk) - off, least)
        with np.errstate(over="ignore"):
            need = np.nextafter(np.maximum(need, least).astype(np.float32), np.float32(-np.inf))
        need = np.maximum(need, least)
        # Most queries find nothing among a few rows; the others are looked at pair by pair.
        lines = np.flatnonzero(gain.max(axis=1) >= need)
        some = gain[lines] if 2 * len(lines) < len(gain) else gain
        if some is gain:
            lines = np.arange(len(gain))
        flat = set_cells(some >= need[lines, None])
        if len(flat) * SCREEN_GAIN > gain.size and gain.shape[1] > SCREEN_GAIN * self.k:
            return self._candidates(chunk, rows, among)
        q, r = np.divmod(flat, gain.shape[1])
        q = lines[q]
        cost = np.empty(len(flat))
        for start in range(0, len(flat), GATHER_ROWS):
            part = slice(start, start + GATHER_ROWS)
            cost[part] = self._exact(chunk[q[part]], rows[r[part]])
        good = np.isfinite(cost) & (cost <= limit[q])
        return chunk[q[good]], r[good], cost[good]

    @staticmethod
    def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        cells = len(left) * len(right)
        if len(Best.room) < cells:
            Best.room = np.empty(cells, dtype=np.float32)
        return np.matmul(left, right.T, out=Best.room[:cells].reshape(len(left), len(right)))

    def _exact(self, numbers: np.ndarray, rows: np.ndarray) -> np.ndarray:
        left = self.queries[numbers]
        if self.metric == "l2":
            gap = left - rows
            return np.sqrt(np.einsum("ij,ij->i", gap, gap))
        return self.cost_of(np.einsum("ij,ij->i", left, rows), numbers)

    def _candidates(self, chunk, rows, among=None):
        queries = self.queries[chunk]
        dots = queries @ rows.T
        slack = 1e-8
        if self.metric == "l2":
            row_norms = np.einsum("ij,ij->i", rows, rows)
            cost = np.sqrt(
                np.maximum(self.norms2[chunk][:, None] + row_norms[None, :] - 2 * dots, 0.0)
            )
            # The expanded square loses digits near zero; survivors are measured again below.
            slack = 1e-6 * max(1.0, float(np.sqrt(max(self.norms2[chunk].max(), row_norms.max()))))
        elif self.metric == "mips_l2":
            cost = np.sqrt(
                np.maximum(self.norms2[chunk][:, None] + self.max_norm2 - 2 * dots, 0.0)
            )
        elif self.metric == "cosine":
            cost = 1.0 - dots
        elif self.metric == "hamming":
            cost = (rows.shape[1] - dots) / 2
        else:
            cost = -dots
        cost = np.where(np.isnan(cost), np.inf, cost)
        if among is not None:
            cost = np.where(among, cost, np.inf)
        q, r = self.near(cost, chunk, slack)
        picked = cost[q, r]
        if self.metric == "l2":
            for start in range(0, len(q), GATHER_ROWS):
                part = slice(start, start + GATHER_ROWS)
                gap = queries[q[part]] - rows[r[part]]
                picked[part] = np.sqrt(np.einsum("ij,ij->i", gap, gap))
        return chunk[q], r, picked


def pair_scores(
    left: np.ndarray, right: np.ndarray, metric: str, max_norm2: float = 0.0
) -> np.ndarray:
    """Row-by-row scores of two equally long matrices; NaN where undefined."""
    if metric == "l2":
        gap = left - right
        return np.sqrt(np.einsum("ij,ij->i", gap, gap))
    dots = np.einsum("ij,ij->i", left, right)
    if metric == "cosine":
        length = np.linalg.norm(left, axis=1) * np.linalg.norm(right, axis=1)
        with np.errstate(invalid="ignore", divide="ignore"):
            return np.where(length > 0, 1.0 - dots / length, np.nan)
    if metric == "hamming":
        return (left.shape[1] - dots) / 2
    if metric == "mips_l2":
        norms2 = np.einsum("ij,ij->i", left, left)
        return np.sqrt(np.maximum(norms2 + max_norm2 - 2 * dots, 0.0))
    return dots


class SparseQueries:
    """Weighted terms of a bounded set of queries, listed by term.

    ``role`` is 0 for scored, 1 for required and scored, 2 for excluded entries.
    """

    def __init__(self, query: np.ndarray, term: np.ndarray, weight: np.ndarray, role: np.ndarray, terms: int, queries: int):
        order = np.argsort(term, kind="stable")
        self.query, self.weight, self.role = query[order], weight[order], role[order]
        self.start = np.searchsorted(term[order], np.arange(terms + 1))
        self.queries = queries
        self.required = np.bincount(query[role == 1], minlength=queries)
        self.strict = bool((role > 0).any())
        # Few terms and queries: a plain matrix product beats meeting entry by entry.
        self.table = None
        if not self.strict and 0 < terms * queries <= MAX_TABLE_CELLS:
            self.table = np.zeros((terms, queries))
            np.add.at(self.table, (term, query), weight)
            self.there = np.zeros((terms, queries), dtype=np.float32)
            self.there[term, query] = 1


class SparseBest(Keeper):
    """Sparse rows: each entry meets the queries that hold its term."""

    CELLS = 4_000_000
    # Matches of entries with query terms that are laid out at a time; one row may have more.
    MATCHES = 4_000_000

    def __init__(self, queries: SparseQueries, k: int):
        super().__init__(queries.queries, k, ascending=False)
        self.held = queries
        self.all = np.arange(queries.queries)

    def add(self, row: np.ndarray, term: np.ndarray, value: np.ndarray, ids: np.ndarray) -> None:
        """Entries ``(row number, term number, value)``, rows ascending; ``ids`` per row."""
        widest = self.held.queries
        if self.held.table is not None:
            widest = max(self.held.table.shape)
        step = max(1, self.CELLS // max(1, widest))
        for start in range(0, len(ids), step):
            low, high = np.searchsorted(row, [start, start + step])
            if low < high:
                part = slice(low, high)
                self._block(row[part] - start, term[part], value[part], ids[start : start + step])

    def _block(self, row, term, value, ids):
        held, rows = self.held, len(ids)
        fan = held.start[term + 1] - held.start[term]
        if held.table is not None and rows * held.table.size < PRODUCT_GAIN * fan.sum():
            dense = np.zeros((rows, len(held.table)))
            np.add.at(dense, (row, term), value)
            seen = np.zeros((rows, len(held.table)), dtype=np.float32)
            seen[row, term] = 1
            cost = np.where(seen @ held.there > 0, -(dense @ held.table), np.inf).T
            q, r = self.near(cost, self.all, 1e-8)
            self.merge(q, cost[q, r], ids[r])
            return
        if fan.sum() > self.MATCHES and rows > 1:
            # Cut where half of the matches are met, between two rows.
            half = int(np.searchsorted(np.cumsum(fan), fan.sum() / 2))
            middle = min(max(int(row[half]), 1), rows - 1)
            at = int(np.searchsorted(row, middle))
            self._block(row[:at], term[:at], value[:at], ids[:middle])
            self._block(row[at:] - middle, term[at:], value[at:], ids[middle:])
            return
        entry = np.repeat(np.arange(len(term)), fan)
        if len(entry) == 0:
            return
        offset = np.arange(len(entry)) - np.repeat(np.cumsum(fan) - fan, fan)
        at = held.start[term][entry] + offset
        query, cell_row = held.query[at], row[entry]
        cell, size = query * rows + cell_row, held.queries * rows
        thin = len(entry) * 8 < size
        if thin:
            cells, cell = np.unique(cell, return_inverse=True)
            size = len(cells)
        else:
            cells = np.arange(size)
        scored = held.role[at] < 2 if held.strict else slice(None)
        score = np.bincount(cell[scored], value[entry][scored] * held.weight[at][scored], size)
        met = np.bincount(cell[scored], minlength=size) > 0
        if held.strict:
            needed = held.required[cells // rows]
            met &= np.bincount(cell[held.role[at] == 1], minlength=size) == needed
            met &= np.bincount(cell[held.role[at] == 2], minlength=size) == 0
        if thin:
            q, r, cost = cells // rows, cells % rows, -score
            good = met & (cost <= self.bound[q] + 1e-8 * np.maximum(1.0, np.abs(cost)))
            self.merge(q[good], cost[good], ids[r[good]])
        else:
            cost = np.where(met, -score, np.inf).reshape(held.queries, rows)
            q, r = self.near(cost, self.all, 1e-8)
            self.merge(q, cost[q, r], ids[r])


class SparseStripe:
    """Entries of many sparse rows, listed by index; queries pass and take their best K rows."""

    # Products of query and row entries that are laid out at a time; one query may have more.
    PRODUCTS = 2_000_000

    def __init__(self, ids: pa.ChunkedArray, index: pa.ChunkedArray, value: pa.ChunkedArray):
        coded = ids.combine_chunks().dictionary_encode()
        self.ids = values_of(coded.dictionary)
        index = values_of(index)
        order = np.argsort(index, kind="stable")
        index = index[order]
        self.start = np.flatnonzero(np.r_[True, index[1:] != index[:-1]])
        self.index, self.start = index[self.start], np.append(self.start, len(index))
        self.row, self.value = np.asarray(coded.indices)[order], values_of(value)[order]

    def best(self, lists: pa.ListArray, weights: pa.ListArray, k: int) -> Iterator[tuple[Keeper, int, int]]:
        """Some queries at a time, given by the indices and weights of each: their best ``k``, the number of
        the first and the one behind the last."""
        index, weight = values_of(lists.flatten()), values_of(weights.flatten())
        query = np.repeat(np.arange(len(lists)), np.diff(np.asarray(lists.offsets)))
        at = np.minimum(np.searchsorted(self.index, index), len(self.index) - 1)
        met = self.index[at] == index
        at, weight, query = at[met], weight[met], query[met]
        fan = self.start[at + 1] - self.start[at]
        made = np.bincount(query, fan, len(lists)).cumsum()
        low = 0
        while low < len(lists):
            before = made[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(made, before + self.PRODUCTS, side="right")))
            part = slice(*np.searchsorted(query, [low, high]))
            best = Keeper(high - low, k, ascending=False)
            best.merge(*self._scores(query[part] - low, at[part], weight[part], fan[part]))
            yield best, low, high
            low = high

    def _scores(self, query, at, weight, fan) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Queries, costs and ids of all pairs that share an index."""
        entry = np.repeat(np.arange(len(at)), fan)
        place = np.arange(len(entry)) + np.repeat(self.start[at] - (np.cumsum(fan) - fan), fan)
        cell = query[entry] * len(self.ids) + self.row[place]
        # Four-byte factors are exact, their product takes eight.
        score = weight[entry].astype(np.float64) * self.value[place]
        order = np.argsort(cell)
        cell, score = cell[order], score[order]
        first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else np.empty(0, dtype=np.int64)
        score = np.add.reduceat(score, first) if len(first) else np.empty(0)
        q, r = np.divmod(cell[first], len(self.ids))
        return q, -score, self.ids[r]
