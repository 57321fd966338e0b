"""Full-text, sparse and hybrid search."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog.common import SQL_MEANS, label_means, load, shown, spread, vectors
from plumbline.functions.sizing import shared_dir
from plumbline.operators import fulltext
from plumbline.operators.fulltext import Analyzer, build_text_index, search_index, search_scan
from plumbline.operators.sparse import sparse_knn
from plumbline.plans.indexes import create_index, hybrid_stored, rebuild_indexes, search_text_stored
from plumbline.plans.search import SubQuery, hybrid_search
from plumbline.sources.schema import Field, Schema, index_settings
from plumbline.sources.table import Table

K = 10
CANDIDATES = 20

# Letters drawn as Han characters, to give the CJK tokenizer text to cut.
LATIN = "abcdefghijklm"
HAN = "天地玄黄宇宙洪荒日月盈昃辰"


def documents(spark, sf_dir):
    return spread(load(spark, sf_dir, "documents")).withColumnRenamed("doc_id", "id")


def parts(spark, sf_dir):
    return load(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("text"))


def benchmark(spark, sf_dir):
    return load(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), "text")


def name_queries(spark, sf_dir):
    """Every distinct part name as a query."""
    return parts(spark, sf_dir).select(F.col("text").alias("qid"), "text").distinct()


def minus_queries(spark, sf_dir):
    """``+first -last`` for every distinct part name."""
    words = F.split("text", " ")
    text = F.concat(F.lit("+"), words[0], F.lit(" -"), words[1])
    return name_queries(spark, sf_dir).select("qid", text.alias("text"))


def _term_counts(frame, column, analyzer):
    def run(spark, sf_dir):
        found = fulltext.tokens(frame(spark, sf_dir), column, analyzer)
        return found.groupBy("term").agg(F.count("*").alias("n"), F.max("pos").alias("last_pos"))

    return run


def _han(spark, sf_dir):
    return documents(spark, sf_dir).select("id", F.translate(F.lower("text"), LATIN, HAN).alias("text"))


def fts_postings(spark, sf_dir):
    return fulltext.postings(documents(spark, sf_dir), "text")


def fts_or(spark, sf_dir):
    return shown(search_scan(documents(spark, sf_dir), benchmark(spark, sf_dir), K))


def fts_indexed(spark, sf_dir):
    index = build_text_index(documents(spark, sf_dir), "text")
    return shown(search_index(index, benchmark(spark, sf_dir), K))


def fts_bounded(spark, sf_dir):
    """The lists of frequent words are only moved for documents that can still be hits."""
    index = build_text_index(documents(spark, sf_dir), "text")
    return shown(search_index(index, benchmark(spark, sf_dir), K, phase_rows=0))


def fts_and(spark, sf_dir):
    queries = name_queries(spark, sf_dir)
    return shown(search_scan(parts(spark, sf_dir), queries, K, operator="and"))


def fts_expr(spark, sf_dir):
    index = build_text_index(parts(spark, sf_dir), "text")
    return shown(search_index(index, minus_queries(spark, sf_dir), K, mode="query"))


def fts_filtered(spark, sf_dir):
    docs, queries = documents(spark, sf_dir), benchmark(spark, sf_dir)
    return shown(search_scan(docs, queries, K, where="lang = 'en' AND n_chars >= 500"))


def sparse_topk(spark, sf_dir):
    """Orders closest to each supplier's whole delivery history."""
    items = load(spark, sf_dir, "lineitem")
    quantity = F.sum("l_quantity").alias("val")
    rows = items.groupBy(F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("idx")).agg(quantity)
    asked = items.groupBy(F.col("l_suppkey").alias("qid"), F.col("l_partkey").alias("idx")).agg(quantity)
    return shown(sparse_knn(rows, asked, K))


def _hybrid(spark, sf_dir, **options):
    stored = load(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    docs = documents(spark, sf_dir).join(stored, "id", "left")
    texts = benchmark(spark, sf_dir)
    asked = texts.join(stored, F.col("qid") == F.col("id")).select("qid", F.col("embedding").alias("qvec"))
    subs = [
        SubQuery("dense", "embedding", asked, CANDIDATES),
        SubQuery("text", "text", texts, CANDIDATES),
    ]
    return shown(hybrid_search(docs, subs, K, **options))


def hybrid_sparse(spark, sf_dir):
    """Vectors and delivery profiles: suppliers' parts by quantity beside each vector."""
    items = load(spark, sf_dir, "lineitem")
    sold = items.groupBy("l_suppkey", F.col("l_partkey").cast("long").alias("i")).agg(
        F.sum("l_quantity").cast("float").alias("v")
    )
    listed = F.array_sort(F.collect_list(F.struct("i", "v"))).alias("p")
    profiles = sold.groupBy(F.col("l_suppkey").alias("id")).agg(listed).select(
        "id", F.struct(F.col("p.i").alias("indices"), F.col("p.v").alias("values")).alias("profile")
    )
    docs = vectors(spark, sf_dir).select("id", "embedding").join(profiles, "id", "left")
    nations = load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    asked = sold.join(nations, "l_suppkey").groupBy(F.col("s_nationkey").cast("long").alias("qid"), F.col("i").alias("idx"))
    subs = [
        SubQuery("dense", "embedding", label_means(spark, sf_dir).withColumn("qid", F.col("qid").cast("long")), CANDIDATES),
        SubQuery("sparse", "profile", asked.agg(F.sum("v").alias("val")), CANDIDATES),
    ]
    return shown(hybrid_search(docs, subs, K))


TEXT_SCHEMA = Schema("texts", (Field("text", "string", nullable=True), Field("lang", "string", nullable=True)))


def _changed_texts(spark, sf_dir):
    """A text index, then writes: German goes, Spanish is prefixed, French comes twice."""
    path = f"{shared_dir(spark).rstrip('/')}/plumbline/table-{uuid.uuid4().hex}"
    docs = documents(spark, sf_dir)
    table = create_index(Table.create(spark, path, TEXT_SCHEMA, docs), "text", index_settings("fulltext"))
    table = table.delete_where("lang = 'de'")
    longer = docs.where("lang = 'es'").select(
        F.col("id").alias("pos"),
        F.col("id").cast("string").alias("id"),
        F.concat(F.lit("alpha the "), F.col("text")).alias("text"),
        F.array(F.lit("text")).alias("_set"),
    )
    table, _ = table.update(longer)
    more = docs.where("lang = 'fr'").select(
        F.col("id").alias("pos"), F.concat(F.lit("n"), F.col("id")).alias("id"), "text", "lang"
    )
    return table.insert(more)[0]


def fts_live(spark, sf_dir):
    return shown(search_text_stored(_changed_texts(spark, sf_dir), "text", benchmark(spark, sf_dir), K))


def fts_rebuilt(spark, sf_dir):
    table = rebuild_indexes(_changed_texts(spark, sf_dir).compact())
    return shown(search_text_stored(table, "text", benchmark(spark, sf_dir), K))


def hybrid_rrf(spark, sf_dir):
    return _hybrid(spark, sf_dir)


HYBRID_SCHEMA = Schema(
    "texts and vectors",
    (
        Field("text", "string", nullable=True),
        Field("lang", "string", nullable=True),
        Field("embedding", "vectorFloat32", nullable=True, dim=64),
    ),
)
CELLS = 16


def hybrid_indexes(spark, sf_dir):
    """Both parts through stored indexes, with German gone since they were built."""
    stored = load(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    docs = documents(spark, sf_dir).select("id", "text", "lang").join(stored, "id", "left")
    path = f"{shared_dir(spark).rstrip('/')}/plumbline/table-{uuid.uuid4().hex}"
    table = create_index(Table.create(spark, path, HYBRID_SCHEMA, docs), "text", index_settings("fulltext"))
    table = create_index(table, "embedding", index_settings("ivf", metric="cosine", cells=CELLS))
    table = table.delete_where("lang = 'de'")
    texts = benchmark(spark, sf_dir)
    asked = texts.join(stored, F.col("qid") == F.col("id")).select("qid", F.col("embedding").alias("qvec"))
    subs = [SubQuery("dense", "embedding", asked, CANDIDATES), SubQuery("text", "text", texts, CANDIDATES)]
    return shown(hybrid_stored(table, subs, K, effort=CELLS))


def hybrid_weighted(spark, sf_dir):
    return _hybrid(spark, sf_dir, where="lang = 'en'", weights=[0.4, 0.6])


QUERIES = {
    "tokens_standard": _term_counts(documents, "text", Analyzer()),
    "tokens_whitespace": _term_counts(documents, "text", Analyzer("whitespace")),
    "tokens_filtered": _term_counts(
        documents, "text", Analyzer("whitespace", ("lowercase", "stop"), {"stopwords": "the,and,de,la"})
    ),
    "tokens_cjk": _term_counts(_han, "text", Analyzer("cjk")),
    "fts_postings": fts_postings,
    "fts_or": fts_or,
    "fts_indexed": fts_indexed,
    "fts_bounded": fts_bounded,
    "fts_and": fts_and,
    "fts_expr": fts_expr,
    "fts_filtered": fts_filtered,
    "sparse_topk": sparse_topk,
    "fts_live": fts_live,
    "fts_rebuilt": fts_rebuilt,
    "hybrid_sparse": hybrid_sparse,
    "hybrid_rrf": hybrid_rrf,
    "hybrid_stored": hybrid_indexes,
    "hybrid_weighted": hybrid_weighted,
}

_STANDARD = "list_filter(regexp_split_to_array(lower({0}), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')"
_WHITE = "list_filter(regexp_split_to_array({0}, '\\s+'), lambda x: x <> '')"


def _sql_counts(source: str) -> str:
    return f"""
        WITH t AS (SELECT unnest(w) AS term, generate_subscripts(w, 1) - 1 AS pos FROM ({source}))
        SELECT term, count(*) AS n, max(pos)::INT AS last_pos FROM t GROUP BY term"""


def _sql_corpus(docs: str) -> str:
    """Postings and sizes of ``docs (id, text, ...)``."""
    return f"""
        d AS ({docs}),
        w AS (SELECT id, {_STANDARD.format('text')} AS ws FROM d),
        c AS (SELECT count(*)::DOUBLE AS n, sum(len(ws)) / count(*) AS avgdl FROM w),
        u AS (SELECT id, len(ws) AS dl, unnest(ws) AS term FROM w),
        p AS (SELECT term, id, dl, count(*) AS tf FROM u GROUP BY ALL),
        f AS (SELECT term, count(*) AS df FROM p GROUP BY term)"""


_BM25 = (
    "ln(1 + (c.n - f.df + 0.5) / (f.df + 0.5)) * p.tf * 2.2 "
    "/ (p.tf + 1.2 * (0.25 + 0.75 * p.dl / c.avgdl))"
)


def _sql_roles(queries: str, role: str = "'should'") -> str:
    return (
        f"q AS ({queries}), t AS (SELECT DISTINCT qid, unnest({_STANDARD.format('text')}) AS term, "
        f"{role} AS role FROM q)"
    )


def _sql_scored(keep: str = "TRUE") -> str:
    return f"""
        s AS (SELECT t.qid, p.id, sum({_BM25}) FILTER (t.role <> 'not') AS s,
                count(*) FILTER (t.role = 'must') AS met, count(*) FILTER (t.role = 'not') AS barred
              FROM t JOIN p ON t.term = p.term JOIN f ON f.term = p.term JOIN d ON d.id = p.id, c
              WHERE {keep} GROUP BY t.qid, p.id),
        n AS (SELECT qid, count(*) FILTER (role = 'must') AS n_must FROM t GROUP BY qid),
        k AS (SELECT s.qid, s.id, s.s FROM s JOIN n ON s.qid = n.qid
              WHERE s.s IS NOT NULL AND barred = 0 AND met = n_must),
        r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(s, 9) DESC, id)::INT AS rank FROM k)"""


_SHOW = f"SELECT qid, id, round(s, 6) AS score, rank FROM r WHERE rank <= {K}"
_DOCS = "SELECT doc_id AS id, text, lang, n_chars FROM documents"
_PARTS = "SELECT p_partkey AS id, p_name AS text FROM part"
_BENCH = "SELECT item_id AS qid, text FROM benchmark"
_NAMES = "SELECT DISTINCT p_name AS qid, p_name AS text FROM part"
_MUST = "'must'"
_ENGLISH = "d.lang = 'en' AND d.n_chars >= 500"
_OR = f"WITH {_sql_corpus(_DOCS)}, {_sql_roles(_BENCH)}, {_sql_scored()} {_SHOW}"


_BOTH = (
    "SELECT doc_id AS id, text, lang, embedding::DOUBLE[] AS v "
    "FROM documents LEFT JOIN embeddings ON doc_id = vec_id"
)
_RRF = "SELECT qid, id, 1.0::DOUBLE / (60 + rank) AS s FROM x UNION ALL SELECT qid, id, 1.0::DOUBLE / (60 + rank) FROM y"


def _sql_hybrid(fused: str, keep: str = "TRUE", docs: str = _BOTH) -> str:
    return f"""
        WITH {_sql_corpus(docs)}, {_sql_roles(_BENCH)}, {_sql_scored(keep)},
        x AS (SELECT qid, id, s, rank FROM r WHERE rank <= {CANDIDATES}),
        a AS (SELECT item_id AS qid, embedding::DOUBLE[] AS v FROM benchmark JOIN embeddings ON item_id = vec_id),
        e AS (SELECT a.qid, d.id, 1 - list_cosine_similarity(a.v, d.v) AS s FROM a, d WHERE {keep} AND d.v IS NOT NULL),
        y AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(s, 9), id) AS rank
              FROM e) WHERE rank <= {CANDIDATES}),
        b AS (SELECT qid, id, sum(s) AS s FROM ({fused}) GROUP BY qid, id),
        z AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(s, 9) DESC, id)::INT AS rank FROM b)
        SELECT qid, id, round(s, 6) AS score, rank FROM z WHERE rank <= {K}"""


_CHANGED = """
    SELECT doc_id::VARCHAR AS id, CASE WHEN lang = 'es' THEN 'alpha the ' || text ELSE text END AS text
    FROM documents WHERE lang <> 'de' UNION ALL SELECT 'n' || doc_id, text FROM documents WHERE lang = 'fr'"""
_LIVE = f"WITH {_sql_corpus(_CHANGED)}, {_sql_roles(_BENCH)}, {_sql_scored()} {_SHOW}"

ORACLES = {
    "fts_live": _LIVE,
    "fts_rebuilt": _LIVE,
    "hybrid_sparse": f"""
        WITH d AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v, label FROM embeddings), {SQL_MEANS},
        e AS (SELECT q.qid, d.id, 1 - list_cosine_similarity(q.v, d.v) AS s FROM q, d),
        y AS (SELECT qid, id, row_number() OVER (PARTITION BY qid ORDER BY round(s, 9), id) AS rank FROM e),
        p AS (SELECT l_suppkey AS id, l_partkey AS idx, sum(l_quantity) AS val FROM lineitem GROUP BY ALL),
        n AS (SELECT s_nationkey AS qid, idx, sum(val) AS val FROM p JOIN supplier ON id = s_suppkey GROUP BY ALL),
        t AS (SELECT qid, id, sum(n.val * p.val) AS s FROM n JOIN p USING (idx)
              WHERE id IN (SELECT id FROM d) GROUP BY qid, id),
        x AS (SELECT qid, id, row_number() OVER (PARTITION BY qid ORDER BY round(s, 9) DESC, id) AS rank FROM t),
        b AS (SELECT qid, id, sum(1.0::DOUBLE / (60 + rank)) AS s FROM (
              SELECT * FROM x WHERE rank <= {CANDIDATES} UNION ALL SELECT * FROM y WHERE rank <= {CANDIDATES})
              GROUP BY qid, id),
        r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(s, 9) DESC, id)::INT AS rank FROM b)
        SELECT qid::BIGINT AS qid, id, round(s, 6) AS score, rank FROM r WHERE rank <= {K}""",
    "tokens_standard": _sql_counts(f"SELECT {_STANDARD.format('text')} AS w FROM documents"),
    "tokens_whitespace": _sql_counts(f"SELECT {_WHITE.format('text')} AS w FROM documents"),
    "tokens_filtered": _sql_counts(
        f"SELECT list_filter({_WHITE.format('lower(text)')}, "
        "lambda x: x NOT IN ('the', 'and', 'de', 'la')) AS w FROM documents"
    ),
    "tokens_cjk": _sql_counts(
        "SELECT flatten(list_transform(regexp_extract_all(t, '\\p{Han}+|[^\\P{L}\\p{Han}]+|\\p{N}+'), "
        "lambda r: CASE WHEN regexp_matches(r, '^\\p{Han}') AND length(r) > 1 "
        "THEN list_transform(range(1, length(r)), lambda i: substr(r, i, 2)) ELSE [r] END)) AS w "
        f"FROM (SELECT translate(lower(text), '{LATIN}', '{HAN}') AS t FROM documents)"
    ),
    "fts_postings": f"WITH {_sql_corpus(_DOCS)} SELECT term, id, tf, dl::INT AS dl FROM p",
    "fts_or": _OR,
    "fts_indexed": _OR,
    "fts_bounded": _OR,
    "fts_and": f"WITH {_sql_corpus(_PARTS)}, {_sql_roles(_NAMES, _MUST)}, "
    f"{_sql_scored()} {_SHOW}",
    "fts_expr": f"""
        WITH {_sql_corpus(_PARTS)}, q AS ({_NAMES}),
        t AS (SELECT qid, split_part(text, ' ', 1) AS term, 'must' AS role FROM q
              WHERE split_part(text, ' ', 1) <> split_part(text, ' ', 2)
              UNION ALL SELECT qid, split_part(text, ' ', 2), 'not' FROM q),
        {_sql_scored()} {_SHOW}""",
    "fts_filtered": f"WITH {_sql_corpus(_DOCS)}, {_sql_roles(_BENCH)}, "
    f"{_sql_scored(_ENGLISH)} {_SHOW}",
    "sparse_topk": f"""
        WITH d AS (SELECT l_orderkey AS id, l_partkey AS idx, sum(l_quantity) AS val FROM lineitem GROUP BY ALL),
        q AS (SELECT l_suppkey AS qid, l_partkey AS idx, sum(l_quantity) AS val FROM lineitem GROUP BY ALL),
        s AS (SELECT qid, id, sum(d.val * q.val) AS s FROM d JOIN q ON d.idx = q.idx GROUP BY qid, id),
        r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(s, 9) DESC, id)::INT AS rank FROM s)
        {_SHOW}""",
    "hybrid_rrf": _sql_hybrid(_RRF),
    "hybrid_stored": _sql_hybrid(
        _RRF,
        docs="SELECT doc_id::VARCHAR AS id, text, lang, embedding::DOUBLE[] AS v "
        "FROM documents LEFT JOIN embeddings ON doc_id = vec_id WHERE lang IS DISTINCT FROM 'de'",
    ),
    "hybrid_weighted": _sql_hybrid(
        "SELECT qid, id, 0.6 * 2 * atan(s) / pi() AS s FROM x UNION ALL SELECT qid, id, 0.4 * (1 - s / 2) FROM y",
        "d.lang = 'en'",
    ),
}
