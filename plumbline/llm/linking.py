"""From candidate buckets to exact links, shared by the two near-duplicate operators.

Items that are equal collapse into classes first. Buckets then only have to *connect* similar
classes: they emit at most one edge per row, never all pairs. The connected candidates form
clusters, and inside a cluster all pairs are compared exactly, block against block, so that
every link is counted once and a cluster of any size spreads over many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.sizing import broadcast_if_small, discard, materialize
from plumbline.llm.common import BATCH_BYTES, binary_rows, sorted_groups

# A bucket up to this size is compared pair by pair in one task, so many rows at a time.
LEAF_ROWS = 1024
LEAF_STEP = 128

# A block of a cluster holds about this many members and units of payload.
BLOCK_MEMBERS = 384
BLOCK_UNITS = 1 << 18


@dataclass(frozen=True)
class Sketching:
    """How rows of a bucket are compared and how a large bucket is divided.

    ``similarity`` takes two broadcastable byte matrices. Members of a leaf are connected from
    ``link`` on. In a large bucket everything from ``pivot_link`` on is connected to the
    pivot, and what is at least ``near`` leaves the bucket; by the triangle inequality
    whatever is similar to such a row is connected to the pivot too.
    """

    width: int
    similarity: Callable[[np.ndarray, np.ndarray], np.ndarray]
    children: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
    link: float
    pivot_link: float
    near: float


def smallest_reachable(linked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For a symmetric boolean matrix: the smallest id reachable from each row."""
    labels = ids.copy()
    while True:
        around = np.where(linked, labels[None, :], np.iinfo(np.int64).max).min(axis=1)
        lower = np.minimum(labels, around)
        if (lower == labels).all():
            return labels
        labels = lower


# Components ---------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """``id``, ``root`` (smallest id reachable) of every node of the edges ``a``, ``b``.

    Alternating stars: each round hangs the neighbours of a node under the smallest of
    them, larger ones first, then smaller ones. Only the written edge list passes from
    round to round; joins run against materialized sides, so a node with very many
    neighbours is split by the join.
    """
    hi, lo = F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")
    stars = materialize(edges.where("a <> b").select(hi, lo).distinct(), "edges")
    before = None
    while True:
        both = stars.union(stars.select("lo", "hi")).toDF("u", "v")
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        lowest = materialize(lowest, "lowest")
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large = materialize(large.distinct(), "large-star")
        under = materialize(large.groupBy("hi").agg(F.min("lo").alias("m")), "under")
        small = large.join(under, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        hung = under.select("hi", F.col("m").alias("lo")).union(small.where("hi <> lo"))
        hung = materialize(hung.distinct(), "edges")
        discard(stars, lowest, large, under)
        stars = hung
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
    roots = stars.select(F.col("lo").alias("id")).distinct()
    return stars.toDF("id", "root").union(roots.select("id", F.col("id").alias("root")))


# Candidate buckets --------------------------------------------------------------------


def _leaf_edges(s: Sketching) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        a: list[np.ndarray] = []
        b: list[np.ndarray] = []
        for group in sorted_groups(batches, ["key"]):
            if group.num_rows < 2 or not any(group.column("open").to_pylist()):
                continue
            group = group.combine_chunks()
            ids = group.column("id").to_numpy()
            rows = binary_rows(group.column("sketch"), np.uint8, s.width)
            steps = range(0, len(rows), LEAF_STEP)
            linked = np.vstack([s.similarity(rows[k : k + LEAF_STEP, None], rows[None]) >= s.link for k in steps])
            roots = smallest_reachable(linked, ids)
            hung = roots != ids
            if hung.any():
                a.append(ids[hung])
                b.append(roots[hung])
        if a:
            arrays = [pa.array(np.concatenate(a)), pa.array(np.concatenate(b))]
            yield pa.RecordBatch.from_arrays(arrays, names=["a", "b"])

    return run


def _pivot_step(s: Sketching) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("id").to_numpy()
            keys = batch.column("key").to_numpy()
            pivots = batch.column("pivot").to_numpy()
            rows = binary_rows(batch.column("sketch"), np.uint8, s.width)
            alike = s.similarity(rows, binary_rows(batch.column("pivot_sketch"), np.uint8, s.width))
            linked = (alike >= s.pivot_link) | (ids == pivots)
            hung = linked & (ids != pivots)
            left = np.flatnonzero((alike < s.near) & (ids != pivots))
            at, child = s.children(keys[left], rows[left])
            at = left[at]
            n, m = int(hung.sum()), len(at)
            empty = lambda size, kind: pa.nulls(size, kind)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([pa.array(ids[hung]), empty(m, pa.int64())]),
                    pa.concat_arrays([pa.array(pivots[hung]), empty(m, pa.int64())]),
                    pa.concat_arrays([empty(n, pa.int64()), pa.array(child)]),
                    pa.concat_arrays([empty(n, pa.int64()), pa.array(ids[at])]),
                    pa.concat_arrays([empty(n, pa.bool_()), pa.array(~linked[at])]),
                    pa.concat_arrays([empty(n, pa.binary()), batch.column("sketch").take(pa.array(at))]),
                ],
                names=["a", "b", "key", "id", "open", "sketch"],
            )

    return run


BUCKET_ROW = "key long, id long, open boolean, sketch binary"


def bucket_edges(rows: DataFrame, s: Sketching, limit: int = LEAF_ROWS) -> DataFrame:
    """Written edges ``a``, ``b`` that connect similar rows of the same bucket.

    ``rows`` has the columns of ``BUCKET_ROW``. Buckets of up to ``limit`` rows are brute
    force. A larger one is connected to a pivot and divided further; it is done when no row
    is left that its pivot did not reach.
    """
    edges, scratch, level = [], [], 0
    while True:
        sizes = rows.groupBy("key").agg(F.count("*").alias("n"), F.max("open").alias("open"))
        large = materialize(sizes.where(F.col("n") > limit).select("key", "open"), "large-buckets")
        scratch.append(large)
        done = large.isEmpty()
        small = rows
        if not done:
            hinted, _ = broadcast_if_small(large.select("key"))
            small = rows.join(hinted, "key", "left_anti")
        leaf = small.repartition("key").sortWithinPartitions("key").mapInArrow(_leaf_edges(s), "a long, b long")
        if done:
            edges.append(leaf)
            break
        edges.append(materialize(leaf, "leaf-edges"))
        hinted, _ = broadcast_if_small(large.where("open").select("key"))
        first = F.min(F.struct("id", "sketch")).alias("p")
        pivots = rows.join(hinted, "key").groupBy("key").agg(first)
        pivots = pivots.select("key", F.col("p.id").alias("pivot"), F.col("p.sketch").alias("pivot_sketch"))
        pivots = materialize(pivots, "pivots")
        hinted, _ = broadcast_if_small(pivots)
        step = rows.join(hinted, "key").mapInArrow(_pivot_step(s), f"a long, b long, {BUCKET_ROW}")
        step = materialize(step, f"bucket-level-{level}")
        scratch += [edges[-1], pivots, step]
        edges.append(step.where("a is not null").select("a", "b"))
        rows = step.where("key is not null").select("key", "id", "open", "sketch")
        level += 1
    found = materialize(reduce(DataFrame.union, edges), "candidates")
    discard(*scratch)
    return found


# Exact links --------------------------------------------------------------------------


def block_links(
    members: DataFrame,
    linked: Callable[[list[bytes], list[bytes], bool], np.ndarray],
    block_members: int = BLOCK_MEMBERS,
    block_units: int = BLOCK_UNITS,
) -> DataFrame:
    """Exact links inside clusters: ``id``, ``n_classes``, ``n_copies``, ``root``.

    ``members`` has ``cluster``, ``id``, ``copies``, ``units`` and ``payload``. A row comes
    out per member and block pair in which it has a link; the counts add up, and ``root`` is an
    edge towards the smallest member reached.
    """
    sizes = members.groupBy("cluster").agg(F.count("*").alias("n"), F.sum("units").alias("u"))
    parts = F.greatest(F.ceil(F.col("n") / block_members), F.ceil(F.col("u") / block_units))
    cut = materialize(sizes.select("cluster", parts.cast("int").alias("parts")).where("parts > 1"), "cut-clusters")
    cut, _ = broadcast_if_small(cut)
    parts = F.coalesce("parts", F.lit(1))
    dealt = members.join(cut, "cluster", "left").withColumn("block", F.pmod(F.xxhash64("id"), parts).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    dealt = dealt.select(
        "cluster",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        "block",
        "id",
        "copies",
        "payload",
    )
    keys = ["cluster", "i", "j"]

    def run(batches):
        for group in sorted_groups(batches, keys):
            group = group.combine_chunks()
            if group.num_rows == 1:
                continue
            at = np.unique(group.column("id").to_numpy(), return_index=True)[1]
            group = group.take(at)  # a repeated row is the same member
            ids = group.column("id").to_numpy()
            copies = group.column("copies").to_numpy()
            block = group.column("block").to_numpy()
            load = group.column("payload").to_pylist()
            i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
            left = np.flatnonzero(block == i)
            right = np.flatnonzero(block == j)
            if not len(left) or not len(right):
                continue
            pick = lambda at: [load[k] for k in at]
            hit = linked(pick(left), pick(right), i == j)
            if i == j:
                np.fill_diagonal(hit, False)
            full = np.zeros((len(ids), len(ids)), dtype=bool)
            full[np.ix_(left, right)] = hit
            full |= full.T
            classes = full.sum(axis=1)
            on = classes > 0
            if not on.any():
                continue
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[on]),
                    pa.array(classes[on].astype(np.int64)),
                    pa.array((full @ copies)[on].astype(np.int64)),
                    pa.array(smallest_reachable(full, ids)[on]),
                ],
                names=["id", "n_classes", "n_copies", "root"],
            )

    return (
        dealt.repartition(*keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(run, "id long, n_classes long, n_copies long, root long")
    )


def link_items(
    items: DataFrame,
    bucket_rows: Callable[[DataFrame], DataFrame],
    sketching: Sketching,
    linked: Callable[[list[bytes], list[bytes], bool], np.ndarray],
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """Classes, exact links and components of written items.

    ``items`` is a stored table of ``id``, ``class_key`` (NULL: links with nothing),
    ``units``, ``payload`` and what ``bucket_rows`` needs. Returns one row per distinct id
    and class: ``id``, ``class_id``, ``component_id``, ``n_links`` (other items linked,
    copies included) and ``n_class_links`` (other classes linked).
    """
    keyed = items.where("class_key is not null and id is not null")
    ids = materialize(keyed.groupBy("id", "class_key").agg(F.lit(1).alias("one")).drop("one"), "class-ids")
    classes = ids.groupBy("class_key").agg(F.min("id").alias("class_id"), F.count("*").alias("copies"))
    classes = materialize(classes, "classes")
    own = classes.select("class_key", F.col("class_id").alias("id"), "copies")
    heads = keyed.drop("payload").join(own.drop("copies"), ["class_key", "id"])
    heads = materialize(heads.drop("class_key"), "heads")

    edges = bucket_edges(bucket_rows(heads), sketching, leaf_rows)
    clusters = components(edges).toDF("id", "cluster")
    clusters = materialize(own.join(clusters, "id"), "cluster-members")
    wanted, _ = broadcast_if_small(clusters)
    members = keyed.select("id", "class_key", "units", "payload").join(wanted, ["class_key", "id"])
    found = materialize(block_links(members, linked), "links")
    counts = found.groupBy("id").agg(F.sum("n_classes").alias("n_classes"), F.sum("n_copies").alias("n_copies"))
    roots = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    judged = classes.join(counts.withColumnRenamed("id", "class_id"), "class_id", "left").join(
        roots.toDF("class_id", "root"), "class_id", "left"
    )
    judged = materialize(
        judged.select(
            "class_key",
            "class_id",
            F.coalesce("root", "class_id").alias("component_id"),
            (F.coalesce("n_copies", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
            F.coalesce("n_classes", F.lit(0)).cast("long").alias("n_class_links"),
        ),
        "judged-classes",
    )
    discard(heads, edges, clusters, found, classes)
    return ids.join(judged, "class_key").drop("class_key")


def in_batches(schema: pa.Schema, rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of about ``BATCH_BYTES``; binary and text values set the size."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += 32 + sum(len(x) for x in row if isinstance(x, (bytes, str)))
        if size >= BATCH_BYTES:
            yield _batch(schema, held)
            held, size = [], 0
    if held:
        yield _batch(schema, held)


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    arrays = [pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
