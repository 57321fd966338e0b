"""Full-text search ranked by BM25."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from plumbline.errors import InvalidArgument, positive_int32
from plumbline.functions.joins import salted_join
from plumbline.functions.ranking import top_k
from plumbline.functions.sizing import broadcast_if_small, materialize
from plumbline.functions.text import tokenize
from plumbline.operators.blocks import SparseBest, values_of
from plumbline.operators.knn import hit_schema
from plumbline.operators.sparse import TermBlock, rank_entries, small_terms, term_block
from plumbline.operators.together import Scorer

# Usual BM25 constants and result size.
K1 = 1.2
B = 0.75
DEFAULT_K = 10

# So many asked words are pushed into the scan of the postings.
PUSHED_WORDS = 256

# Where the frequent words of a search have fewer postings than this, all are moved at once.
PHASE_ROWS = 200_000
# Words whose largest worth sums up to no more than this share of a query's are left for later.
LATER_SHARE = 0.5

# The columns of the stored table of terms.
TERMS = "term string, df long, max_tf long, min_dl int"

# A bucket of terms holds the postings of about so many bytes of text.
BUCKET_BYTES = 64 << 20

# Role numbers of query terms in the scoring block.
ROLES = ["should", "must", "not"]


@dataclass(frozen=True)
class Analyzer:
    """How a text column becomes terms; queries use the same settings."""

    tokenizer: str = "standard"
    filters: tuple[str, ...] = ()
    options: dict[str, str] = field(default_factory=dict)

    def terms(self, text: F.Column) -> F.Column:
        return tokenize(text, self.tokenizer, self.filters, self.options)


@dataclass(frozen=True)
class TextIndex:
    """``postings (bucket, term, id, tf, dl)``, ``terms (term, df, max_tf, min_dl)`` and corpus size.

    ``max_tf`` and ``min_dl`` bound what a posting of the term can be worth under any average length.
    """

    postings: DataFrame
    terms: DataFrame
    n_docs: int
    avg_length: float
    analyzer: Analyzer
    buckets: int = 1


def tokens(docs: DataFrame, text: str, analyzer: Analyzer = Analyzer()) -> DataFrame:
    """``(id, pos, term)``: every token of every document."""
    # The outer form keeps Catalyst from adding a filter that tokenizes a second time.
    listed = F.posexplode_outer(analyzer.terms(F.col(text))).alias("pos", "term")
    return docs.select("id", listed).where(F.col("term").isNotNull())


def _postings(docs: DataFrame, text: str, analyzer: Analyzer, *keep: str) -> DataFrame:
    """One row per token with the length of its document."""
    listed = docs.select("id", *keep, analyzer.terms(F.col(text)).alias("_terms"))
    flat = listed.select(
        "id", *keep, F.size("_terms").alias("dl"), F.explode_outer("_terms").alias("term")
    )
    return flat.where(F.col("term").isNotNull())


def postings(docs: DataFrame, text: str, analyzer: Analyzer = Analyzer()) -> DataFrame:
    """``(term, id, tf, dl)``."""
    return (
        _postings(docs, text, analyzer)
        .groupBy("term", "id", "dl")
        .agg(F.count("*").alias("tf"))
        .select("term", "id", "tf", "dl")
    )


def bucketed_postings(docs: DataFrame, text: str, analyzer: Analyzer, buckets: int) -> DataFrame:
    """``(bucket, term, id, tf, dl)``, placed by term and id: a term present in much of the
    corpus is cut over several tasks by the id."""
    flat = _postings(docs, text, analyzer).select(_bucket(buckets), "term", "id", "dl")
    return (
        flat.repartitionByRange(F.col("bucket"), F.col("term"), F.col("id"))
        .groupBy("bucket", "term", "id")
        .agg(F.count("*").alias("tf"), F.first("dl").alias("dl"))
        .sortWithinPartitions("bucket", "term", "id")
    )


def build_text_index(
    docs: DataFrame, text: str, analyzer: Analyzer = Analyzer(), *, path: str | None = None
) -> TextIndex:
    """Store postings partitioned by term bucket and sorted by term."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    counted = bucketed_postings(docs, text, analyzer, buckets)
    if path is None:
        stored = materialize(counted, "postings", partition_by=["bucket"])
        frequency = materialize(term_statistics(stored), "terms")
    else:
        counted.write.mode("errorifexists").partitionBy("bucket").parquet(f"{path}/postings")
        stored = spark.read.parquet(f"{path}/postings")
        term_statistics(stored).write.mode("errorifexists").parquet(f"{path}/terms")
        frequency = spark.read.parquet(f"{path}/terms")
    n_docs = docs.count()
    total = stored.agg(F.sum("tf")).first()[0] or 0
    return TextIndex(stored, frequency, n_docs, total / n_docs if n_docs else 0.0, analyzer, buckets)


def term_statistics(stored: DataFrame) -> DataFrame:
    """``(term, df, max_tf, min_dl)`` from postings."""
    return stored.groupBy("term").agg(
        F.count("*").alias("df"), F.max("tf").alias("max_tf"), F.min("dl").cast("int").alias("min_dl")
    )


def bm25(tf: F.Column, dl: F.Column, df: F.Column, n_docs: float, avg_length: float) -> F.Column:
    idf = F.log(1 + (F.lit(float(n_docs)) - df + 0.5) / (df + 0.5))
    length = 1 - B + B * dl / F.lit(float(avg_length))
    return idf * tf * (K1 + 1) / (tf + K1 * length)


def _check_operator(operator: str) -> str:
    if operator not in ("or", "and"):
        raise InvalidArgument("the default operator is 'or' or 'and'")
    return "must" if operator == "and" else "should"


def _check_blank(queries: DataFrame) -> None:
    blank = F.col("text").isNull() | (F.trim(F.regexp_replace("text", r"\s+", " ")) == "")
    if queries.where(blank).select(F.lit(1)).first() is not None:
        raise InvalidArgument("a full-text query must not be blank")


def match_terms(queries: DataFrame, analyzer: Analyzer, operator: str = "or") -> DataFrame:
    """``(qid, term, role)`` for natural-language queries ``(qid, text)``."""
    role = _check_operator(operator)
    _check_blank(queries)
    return (
        queries.select("qid", F.explode(analyzer.terms(F.col("text"))).alias("term"))
        .distinct()
        .withColumn("role", F.lit(role))
    )


def expression_terms(queries: DataFrame, analyzer: Analyzer, operator: str = "or") -> DataFrame:
    """``(qid, term, role)`` for ``+required -excluded optional`` queries."""
    bare = _check_operator(operator)
    _check_blank(queries)
    words = queries.select("qid", F.explode(F.split(F.trim("text"), r"\s+")).alias("word"))
    mark = F.substring("word", 1, 1)
    role = F.when(mark == "+", "must").when(mark == "-", "not").otherwise(bare)
    body = F.regexp_replace("word", r"^[+-]", "")
    return (
        words.select("qid", role.alias("role"), F.explode(analyzer.terms(body)).alias("term"))
        .distinct()
        # A term named twice keeps its strictest role: not < must < should in this order.
        .groupBy("qid", "term")
        .agg(F.min(F.when(F.col("role") == "not", 0).when(F.col("role") == "must", 1).otherwise(2)).alias("r"))
        .select(
            "qid",
            "term",
            F.when(F.col("r") == 0, "not").when(F.col("r") == 1, "must").otherwise("should").alias("role"),
        )
    )


def _rank(
    found: DataFrame, terms: DataFrame, n_docs: float, avg_length: float, k: int
) -> DataFrame:
    """Score matched postings ``found (term, id, tf, dl)``; ``terms`` carries ``df``."""
    needed = terms.where(F.col("role") == "must").groupBy("qid").agg(F.count("*").alias("n_must"))
    part = bm25(F.col("tf"), F.col("dl"), F.col("df"), n_docs, avg_length)
    scored = (
        salted_join(found, terms.where(F.col("df").isNotNull()), "term", "id")
        .groupBy("qid", "id")
        .agg(
            F.sum(F.when(F.col("role") != "not", part)).alias("score"),
            F.count(F.when(F.col("role") == "must", 1)).alias("met"),
            F.count(F.when(F.col("role") == "not", 1)).alias("barred"),
        )
    )
    needed, _ = broadcast_if_small(needed)
    kept = scored.join(needed, "qid", "left").where(
        F.col("score").isNotNull()
        & (F.col("barred") == 0)
        & (F.col("met") == F.coalesce(F.col("n_must"), F.lit(0)))
    )
    return top_k(kept.select("qid", "id", "score"), k, ascending=False)


def _query_terms(queries, analyzer, mode, operator):
    if mode == "match":
        return match_terms(queries, analyzer, operator)
    if mode == "query":
        return expression_terms(queries, analyzer, operator)
    raise InvalidArgument("mode is 'match' or 'query'")


def search_index(
    index: TextIndex,
    queries: DataFrame,
    k: int = DEFAULT_K,
    *,
    mode: str = "match",
    operator: str = "or",
    allowed: DataFrame | None = None,
    phase_rows: int = PHASE_ROWS,
) -> DataFrame:
    """Top ``k`` per query from a stored index, ``(qid, id, score, rank)``.

    Only the buckets of the asked terms are read. ``allowed (id)`` restricts the results;
    corpus statistics stay those of the whole table. Lists of frequent words, from ``phase_rows``
    postings on, are only moved for documents that can still be among the hits.
    """
    positive_int32(k, "k")
    terms = _query_terms(queries, index.analyzer, mode, operator)
    head = small_terms(terms)
    if head is None:
        terms = materialize(terms, "query-terms")
        weighted = index.terms.join(terms, "term", "right")
        return _rank(_allowed(index.postings, allowed), weighted, index.n_docs, index.avg_length, k)
    words = pc.unique(head["term"])
    wanted = asked_words(index, words)
    frequency, most, shortest = (np.zeros(len(words)) for _ in range(3))
    # One row per asked word.
    for at, *found in index.terms.join(F.broadcast(wanted), "term").select("at", "df", "max_tf", "min_dl").collect():
        frequency[at], most[at], shortest[at] = found
    buckets = [r["bucket"] for r in wanted.select(_bucket(index.buckets)).distinct().collect()]
    # Files are sorted by term, so their statistics skip what lies between a few asked words;
    # many words leave nothing to skip, and the join below drops what none of them asks for.
    named = F.col("bucket").isin(buckets)
    if len(words) <= PUSHED_WORDS:
        named = named & F.col("term").isin(words.to_pylist())
    found = _allowed(index.postings.where(named), allowed)
    average = float(index.avg_length or 1.0)
    value = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / F.lit(average)))
    entries = found.select("id", "term", value.alias("val"))
    qid_type = queries.schema["qid"].dataType
    block = lambda some: _weighted_block(some, qid_type, words, frequency, index.n_docs)
    worth = most * (K1 + 1) / np.maximum(most + K1 * (1 - B + B * shortest / average), 1e-9)
    worth *= np.log(1 + (index.n_docs - frequency + 0.5) / (frequency + 0.5))
    reached = lambda some: rank_entries(entries, block(some), k)
    entries = within_reach(entries, head, words, frequency, worth, k, reached, phase_rows)
    return rank_entries(entries, block(head), k)


def word_phases(
    head: pa.Table, words: pa.Array, frequency: np.ndarray, worth: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every entry of the query terms: is it read first, what can the others of its query add at
    most, and must its query's hits hold its word.

    Of a query with required words the rarest of those comes first. Of others the frequent words
    wait as long as they are worth no more than a share; with excluded words none waits.
    """
    _, query = np.unique(pc.index_in(head["qid"], pc.unique(head["qid"])).to_numpy(), return_inverse=True)
    word = pc.index_in(head["term"], words).to_numpy()
    role = pc.index_in(head["role"], pa.array(ROLES)).to_numpy()
    must, barred = role == ROLES.index("must"), role == ROLES.index("not")
    n = int(query.max()) + 1 if len(query) else 0
    required, excluded = (np.bincount(query[x], minlength=n)[query] > 0 for x in (must, barred))
    order = np.lexsort((word, -frequency[word], query))
    total = np.bincount(query, weights=np.where(barred, 0, worth[word]), minlength=n)
    # From the most frequent word on, what all up to each one are worth together.
    running = np.cumsum(worth[word][order])
    start = np.searchsorted(query[order], np.arange(n))
    running -= (running[start] - worth[word][order][start])[query[order]]
    later = np.empty(len(word), dtype=bool)
    later[order] = running <= LATER_SHARE * total[query[order]]
    later &= ~excluded
    rarest = np.zeros(len(word), dtype=bool)
    ranked = np.lexsort((word, frequency[word], ~must, query))
    rarest[ranked[start]] = True
    first = np.where(required, rarest & must, ~later)
    rest = np.bincount(query, weights=np.where(first | barred, 0, worth[word]), minlength=n)[query]
    return first, rest, required


def within_reach(
    entries: DataFrame,
    head: pa.Table,
    words: pa.Array,
    frequency: np.ndarray,
    worth: np.ndarray,
    k: int,
    reached: Callable[[pa.Table], DataFrame],
    phase_rows: int,
) -> DataFrame:
    """The entries without those that cannot matter: of the words that wait, only the postings of
    documents that some query has met among its first words.

    That loses no hit where the words that wait are worth less together than the ``k``-th score by
    the first ones alone; other queries have all their words read.
    """
    if not head.num_rows:
        return entries
    first, rest, required = word_phases(head, words, frequency, worth)
    word = pc.index_in(head["term"], words).to_numpy()
    open_ = ~first & ~required
    if open_.any():
        some = head.filter(pa.array(first & ~required))
        scores = reached(some).where(F.col("rank") == k).select("qid", "score").toArrow()
        at = pc.index_in(head["qid"], scores["qid"].combine_chunks())
        score = np.append(scores["score"].to_numpy(), -np.inf)[at.fill_null(len(scores)).to_numpy()]
        first |= ~required & (rest >= score - 1e-6)
    whole = np.zeros(len(words), dtype=bool)
    whole[word[first]] = True
    if frequency[~whole].sum() < phase_rows:
        return entries
    # Where all words of a query are read, its documents need not be met.
    waits = np.zeros(len(words), dtype=bool)
    queries = pc.index_in(head["qid"], pc.unique(head["qid"])).to_numpy()
    pending = np.bincount(queries[~first], minlength=queries.max() + 1) > 0
    waits[word[first & pending[queries]]] = True
    listed = entries.sparkSession.createDataFrame(
        pa.table({"term": words, "whole": pa.array(whole), "meets": pa.array(waits)})
    )
    marked = entries.join(F.broadcast(listed), "term")
    met = materialize(marked.where("meets").select("id").distinct(), "met-ids")
    small, hinted = broadcast_if_small(met)
    if not hinted:
        return entries
    late = marked.where("NOT whole").join(small, "id", "left_semi")
    return marked.where("whole").unionByName(late).select(*entries.columns)


def asked_words(index: TextIndex, words: pa.Array) -> DataFrame:
    """The bounded list of asked words as ``(term, at)``."""
    table = pa.table({"term": words, "at": pa.array(np.arange(len(words)))})
    return index.terms.sparkSession.createDataFrame(table)


def _allowed(postings: DataFrame, allowed: DataFrame | None) -> DataFrame:
    if allowed is None:
        return postings
    return postings.join(allowed.select("id"), "id", "left_semi")


def _bucket(buckets: int) -> F.Column:
    return F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int").alias("bucket")


def _weighted_block(head, qid_type, words, frequency, n_docs) -> TermBlock:
    """Query terms weighted by how rare they are in the corpus."""
    idf = np.log(1 + (n_docs - frequency + 0.5) / (frequency + 0.5))
    weight = idf[pc.index_in(head["term"], words).to_numpy()]
    role = pc.index_in(head["role"], pa.array(ROLES)).to_numpy()
    return term_block(head["qid"], qid_type, head["term"], weight, role)


def search_scan(
    docs: DataFrame,
    queries: DataFrame,
    k: int = DEFAULT_K,
    *,
    text: str = "text",
    analyzer: Analyzer = Analyzer(),
    mode: str = "match",
    operator: str = "or",
    where: str | None = None,
) -> DataFrame:
    """The same ranking without an index: two passes over ``text``, next to no shuffle.

    The first pass counts documents per query term and measures the corpus. The second
    scores whole documents where they are read, after the filter ``where``, and each task
    returns its best ``k`` per query. Query tables too large to travel are joined instead.
    """
    positive_int32(k, "k")
    terms = _query_terms(queries, analyzer, mode, operator)
    head = small_terms(terms)
    if head is None:
        return _search_join(docs, terms, k, text=text, analyzer=analyzer, where=where)
    schema = hit_schema(queries.schema["qid"].dataType, docs.schema["id"].dataType)
    if head.num_rows == 0:
        return top_k(docs.sparkSession.createDataFrame([], schema), k, ascending=False)
    scorer = _text_scorer(docs, head, schema["qid"].dataType, k, text, analyzer)
    start, feed, qids, arrow = scorer.start, scorer.feed, scorer.qids, to_arrow_schema(schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = start()
        for batch in batches:
            feed(best, [batch.column(1)], values_of(batch.column(0)))
        yield best.batch(qids, arrow)

    passing = docs.where(where) if where and where.strip() else docs
    held_text = passing.where(F.col(text).isNotNull())
    hits = held_text.select("id", analyzer.terms(F.col(text)).alias("terms")).mapInArrow(scan, schema)
    return top_k(hits, k, ascending=False)


def _text_scorer(docs, head, qid_type, k, text, analyzer) -> Scorer:
    words = pc.unique(head["term"])
    terms = analyzer.terms(F.col(text))
    frequency, n_docs, total = _measure(docs.select("id", terms.alias("terms")), words)
    block = _weighted_block(head, qid_type, words, frequency, n_docs)
    held, avg_length = block.held, total / max(n_docs, 1)

    def feed(best: SparseBest, arrays: list[pa.Array], ids: np.ndarray) -> None:
        row, at, tf, length = _counts(arrays[0], words)
        part = tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[row] / avg_length))
        best.add(row, at, part, ids)

    return Scorer([terms], lambda: SparseBest(held, k), feed, block.qids, qid_type, k, False)


def text_scorer(
    docs: DataFrame,
    queries: DataFrame,
    k: int,
    *,
    text: str = "text",
    analyzer: Analyzer = Analyzer(),
    mode: str = "match",
    operator: str = "or",
) -> Scorer | None:
    """``search_scan`` as a part of a common scan, with the statistics of ``docs``; None for query
    tables without words or too large to travel."""
    head = small_terms(_query_terms(queries, analyzer, mode, operator))
    if head is None or head.num_rows == 0:
        return None
    return _text_scorer(docs, head, queries.schema["qid"].dataType, k, text, analyzer)


def _counts(lists: pa.ListArray, words: pa.Array):
    """``(row, word, count)`` for the known words of each row, and all row lengths."""
    length = np.diff(np.asarray(lists.offsets))
    at = pc.index_in(lists.flatten(), words)
    row = np.repeat(np.arange(len(lists)), length)
    hit = np.asarray(at.is_valid())
    key = row[hit] * len(words) + at.fill_null(0).to_numpy(zero_copy_only=False)[hit]
    cell, count = np.unique(key, return_counts=True)
    return cell // len(words), cell % len(words), count, length


def _measure(listed: DataFrame, words: pa.Array) -> tuple[np.ndarray, int, int]:
    """Documents per word, number of documents, number of tokens; a task emits one row per
    word it met, two more for the totals."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met, rows, total = np.zeros(len(words), np.int64), 0, 0
        for batch in batches:
            _, at, _, length = _counts(batch.column(0), words)
            met += np.bincount(at, minlength=len(words))
            rows, total = rows + len(length), total + int(length.sum())
        seen = np.nonzero(met)[0]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.r_[seen, -1, -2].astype(np.int64)),
                pa.array(np.r_[met[seen], rows, total].astype(np.int64)),
            ],
            names=["word", "n"],
        )

    filled = listed.select(F.coalesce("terms", F.array().cast("array<string>")).alias("terms"))
    sums = filled.mapInArrow(scan, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = {r["word"]: r["n"] for r in sums.collect()}
    frequency = np.zeros(len(words))
    for word, n in found.items():
        if word >= 0:
            frequency[word] = n
    return frequency, found.get(-1, 0), found.get(-2, 0)


def _search_join(docs, terms, k, *, text, analyzer, where) -> DataFrame:
    """Scan search for a large query table: tokens and query terms meet in a join."""
    terms = materialize(terms, "query-terms")
    size = docs.agg(
        F.count("*").alias("n"), F.sum(F.size(analyzer.terms(F.col(text)))).alias("total")
    ).first()
    n_docs, avg_length = size["n"], (size["total"] or 0) / max(size["n"], 1)
    passes = F.expr(where) if where and where.strip() else F.lit(True)
    flagged = docs.withColumn("_pass", F.coalesce(passes, F.lit(False)))
    asked, _ = broadcast_if_small(terms.select("term").distinct())
    counted = (
        _postings(flagged, text, analyzer, "_pass")
        .join(asked, "term", "left_semi")
        .groupBy("id", "term", "dl", "_pass")
        .agg(F.count("*").alias("tf"))
    )
    found = materialize(counted, "matches")
    frequency = found.groupBy("term").agg(F.count("*").alias("df"))
    weighted = frequency.join(terms, "term", "right")
    return _rank(found.where("_pass").drop("_pass"), weighted, n_docs, avg_length, k)
