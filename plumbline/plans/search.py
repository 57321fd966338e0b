"""Searches put together from the operators, with the choice between exact and indexed."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.errors import InvalidArgument, positive_int32
from plumbline.operators import fulltext, fusion, ivf, knn, quantize, reads, sparse
from plumbline.operators.fusion import SubResult
from plumbline.operators.together import Scorer, scan_together


@dataclass(frozen=True)
class VectorSearch:
    """A dense search over ``docs`` and how to run it."""

    docs: DataFrame
    k: int
    vector: str = "embedding"
    metric: str = "cosine"
    where: str | None = None
    radius: float | None = None
    index: ivf.CellIndex | None = None
    probes: int = ivf.DEFAULT_PROBES
    linear: bool = False
    codes: DataFrame | None = None
    scale_factor: float = 1.0
    scan_share: float = 0.0
    output: list[str] = field(default_factory=list)


def vector_search(plan: VectorSearch, queries: DataFrame) -> DataFrame:
    """Ranked hits ``(qid, id, score, rank, *output)``.

    The index is used when there is one and the search is not ``linear``. A caller who
    prefers a scan for narrow filters sets ``scan_share``: the index is then used only if the
    filter leaves more than that share of the rows. ``codes`` ask for a coarse pass on
    quantized vectors, refined exactly.
    """
    use_index = plan.index is not None and not plan.linear
    if use_index and plan.where and plan.scan_share > 0:
        kept = F.count(F.when(F.expr(plan.where), 1)) / F.greatest(F.count("*"), F.lit(1))
        use_index = plan.docs.agg(kept.alias("share")).first()["share"] > plan.scan_share
    if use_index:
        if plan.index.metric != plan.metric or plan.index.vector != plan.vector:
            raise InvalidArgument("the index was built for another field or metric")
        hits = ivf.search_ivf(
            plan.index, queries, plan.k, probes=plan.probes, where=plan.where, radius=plan.radius
        )
    elif plan.codes is not None and not plan.linear:
        docs = reads.filtered(plan.docs, plan.where)
        codes = plan.codes
        if plan.where:
            codes = codes.join(docs.select("id"), "id", "left_semi")
        hits = quantize.refined_knn(
            docs,
            codes,
            queries,
            plan.k,
            vector=plan.vector,
            metric=plan.metric,
            scale_factor=plan.scale_factor,
            radius=plan.radius,
        )
    else:
        hits = knn.knn(
            plan.docs,
            queries,
            plan.k,
            vector=plan.vector,
            metric=plan.metric,
            where=plan.where,
            radius=plan.radius,
        )
    return knn.attach(hits, plan.docs, plan.output)


@dataclass(frozen=True)
class SubQuery:
    """One part of a hybrid search: ``dense``, ``sparse`` or ``text`` over one field.

    ``queries`` holds ``(qid, qvec)``, ``(qid, idx, val)`` or ``(qid, text)``.
    """

    kind: str
    field: str
    queries: DataFrame
    k: int
    metric: str = "cosine"
    mode: str = "match"
    operator: str = "or"
    analyzer: fulltext.Analyzer = fulltext.Analyzer()


def hybrid_search(
    docs: DataFrame,
    parts: list[SubQuery],
    k: int,
    *,
    where: str | None = None,
    weights: list[float] | None = None,
    constant: int = fusion.RANK_CONSTANT,
    output: list[str] | None = None,
) -> DataFrame:
    """Fuse the candidates of at least two sub-queries, by weights or reciprocal ranks.

    The shared filter applies before each candidate cut. Sub-queries small enough to travel are all
    scored in one scan of ``docs``, after the pass that measures a text field;
    with others each runs on its own.
    """
    if len(parts) < 2:
        raise InvalidArgument("a hybrid query needs at least two sub-queries")
    if weights is not None and len(weights) != len(parts):
        raise InvalidArgument("one weight per sub-query is needed")
    positive_int32(k, "k")
    scorers = _scorers(docs, parts)
    if scorers is not None:
        hits = scan_together(reads.filtered(docs, where), scorers)
        kinds = [part.metric if part.kind == "dense" else part.kind for part in parts]
        lists = fusion.stacked(hits, kinds)
        hits = fusion.fuse_stacked(lists, k, weights=weights, constant=constant)
        return knn.attach(hits, docs, list(output or []))
    results = [_run(docs, part, where) for part in parts]
    if weights is None:
        hits = fusion.fuse_rrf(results, k, constant=constant)
    else:
        hits = fusion.fuse_weighted(results, k, weights)
    return knn.attach(hits, docs, list(output or []))


def _scorers(docs: DataFrame, parts: list[SubQuery]) -> list[Scorer] | None:
    """A scorer for every part, or None where one of them needs a search of its own."""
    if len({part.queries.schema["qid"].dataType for part in parts}) > 1:
        return None
    found = []
    for part in parts:
        positive_int32(part.k, "k")
        if part.kind == "dense":
            scorer = knn.dense_scorer(docs, part.queries, part.k, vector=part.field, metric=part.metric)
        elif part.kind == "sparse":
            scorer = sparse.sparse_scorer(part.queries, part.k, vector=part.field)
        elif part.kind == "text":
            scorer = fulltext.text_scorer(
                docs, part.queries, part.k, text=part.field, analyzer=part.analyzer, mode=part.mode, operator=part.operator
            )
        else:
            raise InvalidArgument(f"unknown sub-query kind {part.kind!r}")
        if scorer is None:
            return None
        found.append(scorer)
    return found


def _run(docs: DataFrame, part: SubQuery, where: str | None) -> SubResult:
    positive_int32(part.k, "k")
    if part.kind == "dense":
        hits = knn.knn(
            docs, part.queries, part.k, vector=part.field, metric=part.metric, where=where
        )
        return SubResult(hits, part.metric)
    if part.kind == "sparse":
        rows = reads.filtered(docs, where)
        hits = sparse.sparse_scan(rows, part.queries, part.k, vector=part.field)
        return SubResult(hits, "sparse")
    if part.kind == "text":
        hits = fulltext.search_scan(
            docs,
            part.queries,
            part.k,
            text=part.field,
            analyzer=part.analyzer,
            mode=part.mode,
            operator=part.operator,
            where=where,
        )
        return SubResult(hits, "text")
    raise InvalidArgument(f"unknown sub-query kind {part.kind!r}")
