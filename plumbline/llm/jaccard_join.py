"""Self-join of texts by the Jaccard similarity of their word n-grams: a chosen-path join.

Every text becomes a set of n-word shingles and a row of min-hash coordinates (each
coordinate is a random token of the set; two sets agree on one with the probability of their
similarity). A run descends from the root: at each node it picks ``BRANCHES`` coordinates by
hashing the path so far, and a set follows the branch named by its own token there. Small
nodes are brute force, larger ones are divided again, and whole runs are repeated until a
pair at the threshold meets with the target recall. Sketches only propose; a link is decided
on the whole shingle sets.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.sizing import broadcast_if_small, discard, materialize
from plumbline.llm.common import binary_rows, mix, small_batches
from plumbline.llm.linking import BUCKET_ROW, LEAF_ROWS, Sketching, in_batches, link_items

WORDS = 5
# The threshold is a fraction, so that links are decided in integers.
THRESHOLD = (4, 5)
COORDINATES = 64
BRANCHES = 2
RECALL = 0.999

WORD = re.compile(r"\w+")
CACHED_WORDS = 50_000
STEP = 8192

ITEM = pa.schema(
    [
        ("id", pa.int64()),
        ("class_key", pa.binary()),
        ("units", pa.int64()),
        ("coordinates", pa.binary()),
        ("payload", pa.binary()),
    ]
)


def runs_needed(similarity: float, recall: float = RECALL, branches: int = BRANCHES) -> int:
    """Repeats after which a pair of this similarity has met with the asked probability.

    A pair survives a node if it agrees on one of the sampled coordinates and survives below
    it; the fixed point of that recursion bounds every depth.
    """
    survive = 1.0
    for _ in range(200):
        survive = 1 - (1 - similarity * survive) ** branches
    if survive <= 0 or survive >= 1:
        return 1
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - survive)))


def _rng(*seed: int) -> np.random.Generator:
    return np.random.default_rng(seed)


def shingle_set(text: str | None, hashes: dict[str, int], words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of lower-cased words; a text with fewer words
    has one shingle of all of them, a text without words none."""
    found = WORD.findall((text or "").lower())
    if not found:
        return np.empty(0, dtype=np.uint64)
    for word in set(found):
        if word not in hashes:
            if len(hashes) >= CACHED_WORDS:
                hashes.clear()
            hashes[word] = xxhash.xxh3_64_intdigest(word)
    try:
        w = np.fromiter(map(hashes.__getitem__, found), dtype=np.uint64, count=len(found))
    except KeyError:  # the cache was emptied between the words of this text
        w = np.fromiter(map(xxhash.xxh3_64_intdigest, found), dtype=np.uint64, count=len(found))
    n = min(words, len(w))
    return np.unique(mix(*[w[k : len(w) - n + 1 + k] for k in range(n)]))


def min_hashes(shingles: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """One 32-bit value per coordinate, that of the shingle with the smallest hash."""
    rng = _rng(8, coordinates)
    factors = rng.integers(0, 2**63, coordinates, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    lowest = np.full(coordinates, np.iinfo(np.uint64).max, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for start in range(0, len(shingles), STEP):
            hashed = shingles[start : start + STEP, None] * factors[None, :]
            np.minimum(lowest, hashed.min(axis=0), out=lowest)
    return (mix(lowest) >> np.uint64(32)).astype(np.uint32)


def _items(words: int, coordinates: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes: dict[str, int] = {}

        def rows():
            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    found = shingle_set(text.as_py(), hashes, words)
                    if not len(found):
                        yield doc_id, None, 0, None, None
                        continue
                    load = found.tobytes()
                    key = hashlib.blake2b(load, digest_size=16).digest()
                    yield doc_id, key, len(found), min_hashes(found, coordinates).tobytes(), load

        yield from in_batches(ITEM, rows())

    return run


def _start_rows(runs: int, branches: int, coordinates: int):
    """The first level: each run samples its coordinates at the root."""
    picks = [_rng(9, run).choice(coordinates, size=branches, replace=False) for run in range(runs)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = binary_rows(batch.column("coordinates"), np.uint32, coordinates)
            sketch = pa.array([bytes(row) for row in values.astype(np.uint8)], type=pa.binary())
            for number, chosen in enumerate(picks):
                for at in chosen:
                    key = mix(np.full(len(values), number), np.full(len(values), at), values[:, at])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(key.astype(np.int64)),
                            batch.column("id"),
                            pa.array(np.ones(len(values), dtype=bool)),
                            sketch,
                        ],
                        names=["key", "id", "open", "sketch"],
                    )

    return run


def _children(branches: int, coordinates: int):
    """Deeper levels: the path (the key) picks the coordinates, the token there the branch."""

    def run(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at, child = [], []
        index = np.arange(len(keys))
        first = mix(keys) % np.uint64(coordinates)
        for branch in range(branches):
            stride = mix(keys, np.full(len(keys), branch)) % np.uint64(coordinates - 1)
            chosen = first if not branch else (first + np.uint64(1) + stride) % np.uint64(coordinates)
            chosen = chosen.astype(np.int64)
            at.append(index)
            child.append(mix(keys, chosen, rows[index, chosen]).astype(np.int64))
        return np.concatenate(at), np.concatenate(child)

    return run


def _agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=-1)


def linked_sets(left: list[bytes], right: list[bytes], same: bool, threshold=THRESHOLD) -> np.ndarray:
    """True where two shingle sets reach the threshold; exact, in integers.

    Shingles that occur once cannot be shared and are dropped before the product.
    """
    sets = [np.frombuffer(x, dtype=np.uint64) for x in (left if same else left + right)]
    sizes = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    owner, column = owner[shared], column[shared]
    n = len(left)
    cols = slice(0, n) if same else slice(n, None)
    common = np.zeros((n, n if same else len(right)))
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], np.unique(column[order], return_inverse=True)[1]
    width = int(column[-1]) + 1 if len(column) else 0
    for start in range(0, width, STEP):
        a, b = np.searchsorted(column, [start, min(start + STEP, width)])
        dense = np.zeros((len(sets), min(STEP, width - start)), dtype=np.float32)
        dense[owner[a:b], column[a:b] - start] = 1
        common += dense[:n] @ dense[cols].T
    above, below = threshold
    either = sizes[:n, None] + sizes[cols][None, :] - common
    return below * common >= above * either


def sketching(coordinates: int = COORDINATES, branches: int = BRANCHES) -> Sketching:
    """Bounds for the agreement of one-byte min-hashes at a threshold of 0.8: it deviates by
    about 0.05, so links at 0.6 miss a pair at the threshold once in some ten thousand."""
    return Sketching(
        width=coordinates,
        similarity=_agreement,
        children=_children(branches, coordinates),
        link=0.6,
        pivot_link=0.5,
        near=0.95,
    )


def jaccard_links(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    recall: float = RECALL,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """One row per document: ``doc_id``, ``class_id`` (smallest id with the same shingles),
    ``component_id`` (smallest id reachable by links), ``n_links`` (other documents linked, copies included),
    ``n_class_links`` (other classes linked) and ``kept`` (``doc_id = component_id``).

    Texts without a word, null texts and rows with a null id link with nothing and are
    kept. Rows that repeat an id and its text count as one document. Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    chosen = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    schema = "id long, class_key binary, units long, coordinates binary, payload binary"
    items = materialize(chosen.mapInArrow(_items(WORDS, COORDINATES), schema), "shingle-sets")
    runs = runs_needed(THRESHOLD[0] / THRESHOLD[1], recall)
    start = _start_rows(runs, BRANCHES, COORDINATES)
    found = link_items(
        items,
        lambda heads: heads.select("id", "coordinates").mapInArrow(start, BUCKET_ROW),
        sketching(),
        linked_sets,
        leaf_rows,
    )
    alone = items.where("class_key is null or id is null").select("id").distinct()
    alone = alone.select(
        "id",
        F.col("id").alias("class_id"),
        F.col("id").alias("component_id"),
        F.lit(0).cast("long").alias("n_links"),
        F.lit(0).cast("long").alias("n_class_links"),
    )
    alone = materialize(alone, "unlinked")
    discard(items)
    every = found.select(*alone.columns).union(alone).withColumnRenamed("id", "doc_id")
    return every.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _numbered(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Add ``__row``: the id, or a number of its own for each text of an id that has several."""
    text = (F.xxhash64(text_column), F.xxhash64(F.lit(1), text_column))
    key = F.col(id_column).cast("long")
    pairs = docs.select(key.alias("__id"), F.struct(*text).alias("__text")).where("__id is not null")
    several = F.min("__text") != F.max("__text")
    mixed = materialize(pairs.groupBy("__id").agg(several.alias("several")).where("several").drop("several"), "mixed")
    if mixed.isEmpty():
        return docs.withColumn("__row", key)
    last = pairs.agg(F.max("__id")).first()[0]
    texts = pairs.join(broadcast_if_small(mixed)[0], "__id", "left_semi").distinct()
    own = materialize(texts.withColumn("__own", F.lit(last) + 1 + F.monotonically_increasing_id()), "own-rows")
    known = docs.withColumns({"__id": key, "__text": F.struct(*text)})
    joined = known.join(broadcast_if_small(own)[0], ["__id", "__text"], "left")
    return joined.withColumn("__row", F.coalesce("__own", "__id")).drop("__id", "__text", "__own")


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents with one of each linked group left, that with the smallest id; all columns as
    they are.

    An id with several texts is several documents, each judged by its text; they stay only where
    no document with an id of its own does. Rows that repeat an id and its text are cut to one.
    Null ids, null texts and texts without a word stay.
    """
    numbered = _numbered(docs, id_column, text_column)
    verdict = materialize(jaccard_links(numbered, "__row", text_column), "jaccard")
    gone, _ = broadcast_if_small(
        materialize(verdict.where("not kept").select(F.col("doc_id").alias("__row")), "dropped")
    )
    stay = numbered.join(gone, "__row", "left_anti")
    rows = stay.select("__row").where("__row is not null")
    again = materialize(rows.groupBy("__row").count().where("count > 1").select("__row"), "repeated")
    if not again.isEmpty():
        again, _ = broadcast_if_small(again)
        once = stay.join(again, "__row", "left_semi").dropDuplicates(["__row"])
        stay = stay.join(again, "__row", "left_anti").unionByName(once)
    return stay.select(*docs.columns)
