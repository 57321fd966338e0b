"""Indexes stored beside a table: build one, record it on its field, open it again."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.errors import InvalidArgument, NotFound
from plumbline.functions.ranking import ASCENDING, top_k
from plumbline.functions.sizing import broadcast_if_small, materialize
from plumbline.operators import fulltext, fusion, ivf, knn, lsh, quantize, reads, sparse
from plumbline.operators.fusion import SubResult
from plumbline.plans.search import SubQuery
from plumbline.sources.schema import index_settings
from plumbline.sources.table import StoredIndex, Table

POSTINGS = "bucket int, term string, id string, tf long, dl int"

VECTOR_KINDS = ("flat", "ivf", "approximate")


def create_index(table: Table, name: str, settings: dict) -> Table:
    """Build the index ``settings`` describe on field ``name``, replacing an earlier one.

    ``flat`` and ``inverted`` indexes need no side table: the first is the exact scan, the
    second is what Parquet statistics give a table compacted by id. A quantized ``flat``
    index stores the codes.
    """
    item, kind = table.schema[name], settings["kind"]
    dense, text = item.vtype.startswith("vector"), item.vtype == "string"
    if kind in VECTOR_KINDS and not dense or kind == "fulltext" and not text:
        raise InvalidArgument(f"a {kind} index does not fit field {name!r}")
    if settings.get("metric", "l2") not in ASCENDING:
        raise InvalidArgument(f"unknown metric {settings['metric']!r}")
    side = f"{table.path}/index-{uuid.uuid4().hex}"
    docs = table.scan()
    if kind == "ivf":
        built = ivf.build_ivf(
            docs,
            vector=name,
            metric=settings["metric"],
            cells=settings["cells"],
            iterations=settings["iterations"],
            spill=settings["spill"],
            path=f"{side}/rows",
        )
        _store_centers(table, side, built)
        stored = f"{side}/rows"
    elif kind == "approximate":
        built = lsh.build_lsh(docs, vector=name, metric=settings["metric"], path=f"{side}/rows")
        _store_numbers(table, side, built.max_norm2)
        stored = f"{side}/rows"
    elif kind == "flat" and settings["quantization"] != "none":
        held = docs.select("id", name).where(F.col(name).isNotNull())
        codes = quantize.quantize(held, settings["quantization"], vector=name)
        codes.select("id", "code", "scale").write.mode("errorifexists").parquet(f"{side}/rows")
        stored = f"{side}/rows"
    elif kind == "fulltext":
        analyzer = _analyzer(settings)
        built = fulltext.build_text_index(docs, name, analyzer, path=side)
        _store_numbers(table, side, float(built.n_docs), built.avg_length, float(built.buckets))
        stored = f"{side}/postings"
    else:
        return table.set_index(name, settings)
    return table.set_index(name, settings, stored)


def open_index(table: Table, name: str):
    """The stored index of a field as it was built, ready for its search function."""
    settings, stored = table.schema[name].index, table.stored_index(name)
    if settings is None or stored is None:
        raise NotFound(f"no stored index on {name!r}")
    side, spark = stored.path.rsplit("/", 1)[0], table.spark
    if settings["kind"] == "fulltext":
        n_docs, avg_length, buckets = _numbers(table, side)
        return fulltext.TextIndex(
            spark.read.schema(POSTINGS).parquet(stored.path),
            spark.read.schema(fulltext.TERMS).parquet(f"{side}/terms"),
            int(n_docs),
            avg_length,
            _analyzer(settings),
            int(buckets),
        )
    vector = table.schema[name].struct_field().dataType.simpleString()
    if settings["kind"] == "ivf":
        rows = _rows(table, stored, f"id string, `{stored.column}` {vector}, gap double, cell int")
        lines = spark.read.schema("cell int, center array<double>").parquet(f"{side}/centers")
        centers = np.array([line["center"] for line in lines.orderBy("cell").collect()])
        bound = _numbers(table, side)[0]
        centers = centers if len(centers) else np.empty((0, 0))
        return ivf.CellIndex(rows, centers, name, settings["metric"], bound, settings["spill"])
    if settings["kind"] == "approximate":
        rows = _rows(table, stored, f"id string, `{stored.column}` {vector}, cells array<bigint>")
        bound = _numbers(table, side)[0]
        return lsh.BucketIndex(rows, name, settings["metric"], bound)
    return spark.read.parquet(stored.path)


def _rows(table: Table, stored: StoredIndex, schema: str) -> DataFrame:
    rows = table.spark.read.schema(schema).parquet(stored.path)
    return rows.withColumnRenamed(stored.column, stored.name)


def rebuild_indexes(table: Table) -> Table:
    """Build every stored index again, so that rows written since are searched through it too."""
    for stored in table.version.indexes:
        table = create_index(table, stored.name, table.schema[stored.name].index)
    return table


@dataclass(frozen=True)
class _Live:
    """What an index still answers for: ``kept`` cuts its rows to those unchanged and passing
    the filter; ``fresh`` are the rows to search exactly."""

    kept: Callable[[DataFrame], DataFrame]
    fresh: DataFrame | None
    changed: DataFrame | None


def _live(table: Table, name: str, where: str | None) -> _Live | None:
    """None when no stored index covers the table's files: then the scan answers."""
    stored = table.stored_index(name)
    if stored is None or not table.covers(stored):
        return None
    changed = table.changed_since(stored)
    if changed is not None:
        changed = materialize(changed, "changed-ids")
    filtering = bool(where and where.strip())
    passing = table.scan().where(where) if filtering else table.scan()

    def kept(rows: DataFrame) -> DataFrame:
        if changed is not None:
            rows = rows.join(broadcast_if_small(changed)[0], "id", "left_anti")
        if filtering:
            rows = rows.join(passing.select("id"), "id", "left_semi")
        return rows

    fresh = None
    if changed is not None:
        fresh = passing.join(broadcast_if_small(changed)[0], "id", "left_semi")
    return _Live(kept, fresh, changed)


def search_stored(
    table: Table,
    name: str,
    queries: DataFrame,
    k: int,
    *,
    effort: int = lsh.DEFAULT_EFFORT,
    where: str | None = None,
    radius: float | None = None,
    linear: bool = False,
    output: list[str] | None = None,
) -> DataFrame:
    """Top ``k`` live rows through whichever vector index the field has.

    Rows written since the build are searched exactly and rows removed since are left out, so
    a search is never behind the table; a compaction changes nothing in that. The exact scan
    answers without an index and when ``linear`` asks for it. Probed cells for ``ivf`` and
    least candidates for ``approximate`` follow ``effort``.
    """
    settings = table.schema[name].index or index_settings("flat")
    metric, ascending = settings["metric"], ASCENDING[settings["metric"]]
    live = None if linear else _live(table, name, where)
    if live is None:
        hits = knn.knn(table.scan(), queries, k, vector=name, metric=metric, where=where, radius=radius)
        return knn.attach(hits, table.scan(), list(output or []))
    index = open_index(table, name)
    if settings["kind"] == "ivf":
        rows = live.kept(index.rows)
        fill = live.changed is not None or bool(where and where.strip())
        found = ivf.search_ivf(replace(index, rows=rows), queries, k, probes=effort, fill=fill)
    elif settings["kind"] == "approximate":
        rows = materialize(live.kept(index.rows), "live-rows") if live.changed is not None or where else index.rows
        found = lsh.search_lsh(replace(index, rows=rows), queries, k, effort=effort)
    else:
        factor = max(1.0, effort / k)
        found = quantize.refined_knn(
            table.scan(), live.kept(index), queries, k, vector=name, metric=metric, scale_factor=factor
        )
    if live.fresh is not None:
        fresh = knn.knn(live.fresh, queries, k, vector=name, metric=metric)
        found = found.drop("rank").unionByName(fresh.drop("rank"))
        found = top_k(found, k, ascending=ascending)
    return knn.attach(knn.within(found, metric, radius), table.scan(), list(output or []))


def search_text_stored(
    table: Table,
    name: str,
    queries: DataFrame,
    k: int = fulltext.DEFAULT_K,
    *,
    mode: str = "match",
    operator: str = "or",
    where: str | None = None,
    output: list[str] | None = None,
) -> DataFrame:
    """Top ``k`` live rows by text, with the statistics of the table as it is now."""
    live = _live(table, name, None)
    settings = table.schema[name].index or index_settings("fulltext")
    if live is None:
        hits = fulltext.search_scan(
            table.scan(), queries, k, text=name, analyzer=_analyzer(settings), mode=mode, operator=operator, where=where
        )
        return knn.attach(hits, table.scan(), list(output or []))
    index = open_index(table, name)
    if live.fresh is not None:
        index = _refreshed(table, name, index, live)
    allowed = table.scan().where(where).select("id") if where and where.strip() else None
    hits = fulltext.search_index(index, queries, k, mode=mode, operator=operator, allowed=allowed)
    return knn.attach(hits, table.scan(), list(output or []))


def hybrid_stored(
    table: Table,
    parts: list[SubQuery],
    k: int,
    *,
    effort: int = lsh.DEFAULT_EFFORT,
    where: str | None = None,
    weights: list[float] | None = None,
    constant: int = fusion.RANK_CONSTANT,
    output: list[str] | None = None,
) -> DataFrame:
    """``hybrid_search`` over the live rows of a table, each part through the index of its field.

    Metric and analyzer are those of the field's index; a part that names another metric is an
    error. ``effort`` is that of ``search_stored``. Sparse fields and fields without a stored index are scanned.
    """
    if len(parts) < 2:
        raise InvalidArgument("a hybrid query needs at least two sub-queries")
    if weights is not None and len(weights) != len(parts):
        raise InvalidArgument("one weight per sub-query is needed")
    results = [_part(table, part, effort, where) for part in parts]
    if weights is None:
        hits = fusion.fuse_rrf(results, k, constant=constant)
    else:
        hits = fusion.fuse_weighted(results, k, weights)
    return knn.attach(hits, table.scan(), list(output or []))


def _part(table: Table, part: SubQuery, effort: int, where: str | None) -> SubResult:
    if part.kind == "dense":
        metric = (table.schema[part.field].index or index_settings("flat"))["metric"]
        if metric != part.metric:
            raise InvalidArgument(f"field {part.field!r} is searched by {metric!r}")
        hits = search_stored(table, part.field, part.queries, part.k, effort=effort, where=where)
        return SubResult(hits, metric)
    if part.kind == "text":
        hits = search_text_stored(
            table, part.field, part.queries, part.k, mode=part.mode, operator=part.operator, where=where
        )
        return SubResult(hits, "text")
    if part.kind == "sparse":
        rows = reads.filtered(table.scan(), where)
        return SubResult(sparse.sparse_scan(rows, part.queries, part.k, vector=part.field), "sparse")
    raise InvalidArgument(f"unknown sub-query kind {part.kind!r}")


def _refreshed(table: Table, name: str, index: fulltext.TextIndex, live: _Live) -> fulltext.TextIndex:
    """The index without the postings of changed rows and with those of their new texts."""
    hinted, _ = broadcast_if_small(live.changed)
    gone = materialize(index.postings.join(hinted, "id", "left_semi"), "gone-postings")
    added = materialize(fulltext.bucketed_postings(live.fresh, name, index.analyzer, index.buckets), "new-postings")
    left = fulltext.term_statistics(gone).withColumn("df", -F.col("df"))
    terms = index.terms.unionByName(left).unionByName(fulltext.term_statistics(added))
    # Bounds may stay wider than the postings that are left.
    bounds = (F.max("max_tf").alias("max_tf"), F.min("min_dl").alias("min_dl"))
    terms = terms.groupBy("term").agg(F.sum("df").alias("df"), *bounds).where("df > 0")
    length = lambda rows: rows.agg(F.sum("tf")).first()[0] or 0
    total = index.avg_length * index.n_docs - length(gone) + length(added)
    n_docs = table.scan().count()
    postings = index.postings.join(hinted, "id", "left_anti").unionByName(added)
    return replace(
        index, postings=postings, terms=terms, n_docs=n_docs, avg_length=total / n_docs if n_docs else 0.0
    )


def _analyzer(settings: dict) -> fulltext.Analyzer:
    return fulltext.Analyzer(
        settings["tokenizer"], tuple(settings["filters"]), dict(settings["options"])
    )


def _store_centers(table: Table, side: str, built: ivf.CellIndex) -> None:
    """One row per centre."""
    lines = [(n, [float(x) for x in c]) for n, c in enumerate(built.centers)]
    frame = table.spark.createDataFrame(lines, "cell int, center array<double>")
    frame.coalesce(1).write.mode("errorifexists").parquet(f"{side}/centers")
    _store_numbers(table, side, built.max_norm2)


def _store_numbers(table: Table, side: str, *numbers: float) -> None:
    frame = table.spark.range(1).select(F.array(*[F.lit(float(n)) for n in numbers]).alias("numbers"))
    frame.coalesce(1).write.mode("errorifexists").parquet(f"{side}/numbers")


def _numbers(table: Table, side: str) -> list[float]:
    return table.spark.read.parquet(f"{side}/numbers").first()["numbers"]
