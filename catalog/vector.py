"""Dense vector search, grouped search, approximate search, quantization."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import functions as F

from catalog.common import (
    SQL_DOCS,
    SQL_MEANS,
    SQL_QUERIES,
    SQL_SCALED,
    SQL_SCORE,
    as_queries,
    label_means,
    load,
    scaled,
    shown,
    sql_top,
    vectors,
)
from plumbline.functions.ranking import ASCENDING, top_k
from plumbline.functions.sizing import shared_dir
from plumbline.operators.cells import exact_join
from plumbline.operators.grouped import grouped_knn
from plumbline.operators.ivf import build_ivf, completeness, search_ivf
from plumbline.operators.knn import attach, knn, queries_by_id
from plumbline.operators.lsh import build_lsh, search_lsh
from plumbline.operators.quantize import half, quantize, refined_knn
from plumbline.plans.indexes import create_index, rebuild_indexes, search_stored
from plumbline.plans.search import VectorSearch, vector_search
from plumbline.sources.schema import Field, Schema, index_settings
from plumbline.sources.table import Table

K = 10


def _self(metric, frame=scaled):
    def run(spark, sf_dir):
        docs = frame(spark, sf_dir)
        return shown(knn(docs, as_queries(vectors(spark, sf_dir)), K, metric=metric))

    return run


def knn_filtered(spark, sf_dir):
    docs = vectors(spark, sf_dir)
    hits = knn(docs, as_queries(docs), K, where="label >= 2 AND label <= 7")
    return shown(attach(hits, docs, ["label"]), "label")


def knn_radius(spark, sf_dir):
    docs = scaled(spark, sf_dir)
    return shown(knn(docs, as_queries(docs), K, metric="l2", radius=3.0))


def knn_by_id(spark, sf_dir):
    """Neighbours of every stored vector that a document of the same id exists for."""
    docs = vectors(spark, sf_dir)
    ids = load(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    return shown(knn(docs, queries_by_id(docs, ids), K))


def knn_join(spark, sf_dir):
    docs = scaled(spark, sf_dir)
    hits = exact_join(docs, as_queries(docs), K, vector="embedding", metric="l2")
    return shown(top_k(hits, K, ascending=True))


def knn_linear(spark, sf_dir):
    docs = vectors(spark, sf_dir)
    index = build_ivf(docs, cells=16)
    return shown(vector_search(VectorSearch(docs, K, index=index, linear=True), as_queries(docs)))


def _codes(factor, kind):
    def frame(spark, sf_dir):
        x = F.col("embedding").cast("array<double>")
        codes = F.transform(x, lambda v: F.round(v * factor).cast(kind))
        return vectors(spark, sf_dir).withColumn("embedding", codes)

    return frame


def _coded(frame, metric):
    def run(spark, sf_dir):
        docs = frame(spark, sf_dir)
        return shown(knn(docs, as_queries(docs), K, metric=metric))

    return run


def _halves(spark, sf_dir):
    return vectors(spark, sf_dir).withColumn("embedding", half(F.col("embedding")))


def _doubles(spark, sf_dir):
    return vectors(spark, sf_dir).withColumn("embedding", F.col("embedding").cast("array<double>"))


def _bits(spark, sf_dir):
    signs = F.transform("embedding", lambda v: F.when(v > 0, "1").otherwise("0"))
    word = F.lpad(F.conv(F.array_join(signs, ""), 2, 16), 16, "0")
    return vectors(spark, sf_dir).withColumn("embedding", F.unhex(word))


def _label_centers(spark, sf_dir):
    """Cell centres fixed to the label means: one row per label."""
    lines = label_means(spark, sf_dir).orderBy("qid").collect()
    return np.array([line["qvec"] for line in lines])


def ivf_full_probe(spark, sf_dir):
    docs = vectors(spark, sf_dir)
    index = build_ivf(docs, cells=16)
    return shown(search_ivf(index, as_queries(docs), K, probes=len(index.centers)))


def ivf_fixed_centroids(spark, sf_dir):
    docs = vectors(spark, sf_dir)
    index = build_ivf(docs, metric="l2", centers=_label_centers(spark, sf_dir), keep=("label",))
    return shown(search_ivf(index, as_queries(docs), K, probes=2, where="label >= 1"))


# Few rows pass, so the nearest cells alone do not hold K of them.
NARROW = "label = 3 AND id % 4 = 1"


def ivf_narrow(spark, sf_dir):
    """A filter that few rows pass; cells are asked until they hold K passing rows."""
    docs = vectors(spark, sf_dir)
    index = build_ivf(docs, metric="l2", centers=_label_centers(spark, sf_dir), keep=("label",))
    return shown(search_ivf(index, as_queries(docs), K, probes=1, where=NARROW))


def ivf_spill_assign(spark, sf_dir):
    docs = vectors(spark, sf_dir)
    index = build_ivf(docs, metric="l2", centers=_label_centers(spark, sf_dir), spill=True)
    return index.rows.select("id", "cell", F.round("gap", 6).alias("gap"))


def ivf_spill_search(spark, sf_dir):
    docs = vectors(spark, sf_dir)
    index = build_ivf(docs, metric="l2", centers=_label_centers(spark, sf_dir), spill=True)
    return shown(search_ivf(index, as_queries(docs), K, probes=3))


# Share of the exact hits that an approximate search must find over all queries.
RECALL_FLOOR = 0.9
# Of 32 cells.
RECALL_PROBES = 20


def _met(spark, sf_dir, search):
    """The exact hits of every query; ``met`` is set on those that the search finds too."""
    docs = vectors(spark, sf_dir)
    best = knn(docs, as_queries(docs), K).select("qid", "id")
    met = search(docs).select("qid", "id").withColumn("met", F.lit(1))
    return best.join(met, ["qid", "id"], "left")


def _ivf(docs):
    return search_ivf(build_ivf(docs, cells=32), as_queries(docs), K, probes=RECALL_PROBES)


def _lsh(docs):
    return search_lsh(build_lsh(docs), as_queries(docs), K)


def _recall(search):
    """How many queries there are, and whether their common recall reaches the floor."""

    def run(spark, sf_dir):
        reached = F.count("met") / F.count("*") >= RECALL_FLOOR
        return _met(spark, sf_dir, search).agg(F.countDistinct("qid").alias("queries"), reached.alias("recall_reached"))

    return run


def _recall_each(search):
    """The recall of every query, as measured."""

    def run(spark, sf_dir):
        return _met(spark, sf_dir, search).groupBy("qid").agg((F.count("met") / F.count("*")).alias("recall"))

    return run


def _quantized(kind):
    def run(spark, sf_dir):
        coded = quantize(vectors(spark, sf_dir), kind)
        flat = coded.select("id", F.round("scale", 9).alias("scale"), F.posexplode("code"))
        return flat.select("id", "scale", "pos", F.col("col").cast("double").alias("code"))

    return run


def knn_refined(spark, sf_dir):
    docs = vectors(spark, sf_dir)
    return shown(refined_knn(docs, quantize(docs, "int8"), as_queries(docs), K, scale_factor=4.0))


def knn_refined_int4(spark, sf_dir):
    """Coarse codes and no factor; the error bound makes it exact all the same."""
    docs = vectors(spark, sf_dir)
    return shown(refined_knn(docs, quantize(docs, "int4"), as_queries(docs), K))


def knn_grouped(spark, sf_dir):
    docs = vectors(spark, sf_dir)
    names = load(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang", "source")
    groups = grouped_knn(
        docs.join(names, "id", "left"), label_means(spark, sf_dir), "lang", groups=3, per_group=4, output=["source"]
    )
    return groups.withColumn("score", F.round("score", 6))


def knn_grouped_ceiling(spark, sf_dir):
    """Groups among the first 100 hits only."""
    names = load(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang", "source")
    docs = vectors(spark, sf_dir).join(names, "id", "left")
    groups = grouped_knn(
        docs, label_means(spark, sf_dir), "lang", groups=3, per_group=4, output=["source"], ceiling=100
    )
    return groups.withColumn("score", F.round("score", 6))


def knn_radius_zero(spark, sf_dir):
    """A bound of zero is a bound: no negative inner products."""
    docs = scaled(spark, sf_dir)
    return shown(knn(docs, as_queries(docs), 500, metric="ip", radius=0.0))


def knn_grouped_float(spark, sf_dir):
    balance = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), "c_acctbal")
    groups = grouped_knn(
        vectors(spark, sf_dir).join(balance, "id", "left"),
        label_means(spark, sf_dir),
        "c_acctbal",
        groups=20,
        per_group=2,
        metric="l2",
    )
    return groups.withColumn("score", F.round("score", 6))


VECTOR_SCHEMA = Schema("vectors", (Field("embedding", "vectorFloat32", dim=64), Field("label", "int32")))


def index_reopen(spark, sf_dir):
    """A stored index opened from its table; as many probes as cells, so exact."""
    path = f"{shared_dir(spark).rstrip('/')}/plumbline/table-{uuid.uuid4().hex}"
    docs = vectors(spark, sf_dir)
    table = Table.create(spark, path, VECTOR_SCHEMA, docs)
    create_index(table, "embedding", index_settings("ivf", cells=16))
    hits = search_stored(Table.open(spark, path), "embedding", as_queries(docs), K, effort=16)
    return shown(hits.withColumn("id", F.col("id").cast("long")))


def _changed_table(spark, sf_dir, kind, **settings):
    """An index, then writes: label 3 goes, label 5 turns around, label 7 comes twice."""
    path = f"{shared_dir(spark).rstrip('/')}/plumbline/table-{uuid.uuid4().hex}"
    docs = vectors(spark, sf_dir)
    table = Table.create(spark, path, VECTOR_SCHEMA, docs)
    table = create_index(table, "embedding", index_settings(kind, **settings))
    table = table.delete_where("label = 3")
    turned = docs.where("label = 5").select(
        F.col("id").alias("pos"),
        F.col("id").cast("string").alias("id"),
        F.transform("embedding", lambda x: -x).alias("embedding"),
        F.array(F.lit("embedding")).alias("_set"),
    )
    table, _ = table.update(turned)
    more = docs.where("label = 7").select(
        F.col("id").alias("pos"), F.concat(F.lit("n"), F.col("id")).alias("id"), "embedding", "label"
    )
    table, _ = table.insert(more)
    return table


def _live(kind, **settings):
    def run(spark, sf_dir):
        table = _changed_table(spark, sf_dir, kind, **settings)
        return shown(search_stored(table, "embedding", as_queries(vectors(spark, sf_dir)), K, effort=1_000_000))

    return run


def index_rebuilt(spark, sf_dir):
    """The same after a compaction, by the index built again and by none."""
    table = rebuild_indexes(_changed_table(spark, sf_dir, "ivf", cells=16).compact())
    return shown(search_stored(table, "embedding", as_queries(vectors(spark, sf_dir)), K, effort=16))


def index_compacted(spark, sf_dir):
    """After writes, a compaction and more writes the index still answers, built only once."""
    table = _changed_table(spark, sf_dir, "ivf", cells=16).compact()
    table = table.delete_where("label = 8").compact()
    gone = vectors(spark, sf_dir).where("label = 9").select(F.col("id").cast("string").alias("id"))
    table, _ = table.delete(gone.withColumn("pos", F.monotonically_increasing_id()))
    return shown(search_stored(table, "embedding", as_queries(vectors(spark, sf_dir)), K, effort=16))


def ivf_filtered_stored(spark, sf_dir):
    """Filter, bound and output through a stored index whose field was renamed."""
    table = _changed_table(spark, sf_dir, "ivf", cells=16).alter_column("embedding", new_name="vector")
    asked = as_queries(vectors(spark, sf_dir))
    hits = search_stored(table, "vector", asked, K, effort=16, where="label >= 2", radius=0.9, output=["label"])
    return shown(hits, "label")


def insert_invalid(spark, sf_dir):
    """Rows without an id, with too short a vector or with a stored id fail one by one."""
    path = f"{shared_dir(spark).rstrip('/')}/plumbline/table-{uuid.uuid4().hex}"
    docs = vectors(spark, sf_dir)
    table = Table.create(spark, path, VECTOR_SCHEMA, docs)
    name = F.when(F.col("label") == 9, F.col("id").cast("string")).when(
        F.col("label") != 4, F.concat(F.lit("n"), F.col("id"))
    )
    cut = F.when(F.col("label") == 3, F.slice("embedding", 1, 60)).otherwise(F.col("embedding"))
    batch = docs.select(F.col("id").alias("pos"), name.alias("id"), cut.alias("embedding"), "label")
    return table.insert(batch)[1].select("pos", "id", "ok", "error_code")


def index_completeness(spark, sf_dir):
    """Coverage of an index built before the rows of the last labels arrived."""
    docs = vectors(spark, sf_dir)
    index = build_ivf(docs.where("label < 7"), cells=16)
    return completeness(docs, index.rows, "embedding")


def _sql_codes(factor):
    return (
        "d AS (SELECT vec_id AS id, list_transform(embedding::DOUBLE[], "
        f"lambda x: round(x * {factor})) AS v FROM embeddings), "
        "q AS (SELECT id AS qid, v FROM d)"
    )


_HALF = (
    "list_transform(embedding::DOUBLE[], lambda x: CASE WHEN x = 0 THEN 0 ELSE "
    "round_even(x / pow(2.0, greatest(floor(log2(abs(x))), -14) - 10), 0) "
    "* pow(2.0, greatest(floor(log2(abs(x))), -14) - 10) END)"
)
_SELF = "q AS (SELECT id AS qid, v FROM d)"
_CENTERS = SQL_MEANS.replace("q AS (SELECT label AS qid", "c AS (SELECT label AS cell")
_CELLS = (
    f"{SQL_DOCS}, {_CENTERS}, "
    "e AS (SELECT d.id, d.v, d.label, c.cell, c.v AS cv, list_distance(d.v, c.v) AS gap FROM d, c), "
    "f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY gap, cell) AS n FROM e) "
    "WHERE n = 1)"
)
_SPILL = (
    f"{_CELLS}, "
    "g AS (SELECT e.id, e.v, e.cell, e.gap, pow(e.gap, 2) + pow("
    "list_inner_product(list_transform(list_zip(e.v, e.cv), lambda p: p[1] - p[2]), "
    "list_transform(list_zip(f.v, f.cv), lambda p: p[1] - p[2])) / f.gap, 2) AS loss "
    "FROM e JOIN f ON e.id = f.id WHERE e.cell <> f.cell), "
    "h AS (SELECT id, v, cell, gap FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY loss) AS n "
    "FROM g) WHERE n = 1), "
    "a AS (SELECT id, v, cell, gap FROM f UNION ALL SELECT id, v, cell, gap FROM h)"
)


def _sql_probed(assigned: str, probes: int, where: str = "TRUE") -> str:
    ctes = (
        f"{assigned}, "
        "q AS (SELECT qid, v, cell FROM (SELECT d.id AS qid, d.v, c.cell, row_number() OVER "
        f"(PARTITION BY d.id ORDER BY list_distance(d.v, c.v), c.cell) AS n FROM d, c) WHERE n <= {probes}), "
        "s AS (SELECT DISTINCT q.qid, t.id, round(list_distance(q.v, t.v), 12) AS s "
        f"FROM q JOIN t ON q.cell = t.cell WHERE {where}), "
        "r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(s, 9), id)::INT AS rank FROM s)"
    )
    return f"WITH {ctes} SELECT qid, id, round(s, 6) AS score, rank FROM r WHERE rank <= {K}"


def _sql_filled(assigned: str, where: str) -> str:
    """The nearest cell, and further ones as long as those before hold fewer than K passing rows."""
    ctes = (
        f"{assigned}, p AS (SELECT id, v, cell FROM f WHERE {where}), "
        "n AS (SELECT c.cell, c.v, count(p.id) AS held FROM c LEFT JOIN p ON p.cell = c.cell GROUP BY ALL), "
        "o AS (SELECT d.id AS qid, d.v, n.cell, n.held, row_number() OVER nearest AS place, "
        "coalesce(sum(n.held) OVER (nearest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before "
        "FROM d, n WINDOW nearest AS (PARTITION BY d.id ORDER BY list_distance(d.v, n.v), n.cell)), "
        "s AS (SELECT qid, p.id, round(list_distance(o.v, p.v), 12) AS s FROM o JOIN p USING (cell) "
        f"WHERE place = 1 OR before < {K}), "
        "r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(s, 9), id)::INT AS rank FROM s)"
    )
    return f"WITH {ctes} SELECT qid, id, round(s, 6) AS score, rank FROM r WHERE rank <= {K}"


def _sql_grouped(docs: str, score: str, groups: int, per_group: int, more: str = "", cut: str = "TRUE") -> str:
    return f"""
        WITH {docs}, {SQL_MEANS},
        s AS (SELECT q.qid, d.id, d.g{more}, {score} AS s FROM q, d),
        r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(s, 9), id) AS n FROM s),
        b AS (SELECT *, min(n) OVER (PARTITION BY qid, g) AS best,
              row_number() OVER (PARTITION BY qid, g ORDER BY n)::INT AS rank_in_group
              FROM r WHERE g IS NOT NULL AND {cut}),
        t AS (SELECT *, dense_rank() OVER (PARTITION BY qid ORDER BY best)::INT AS group_rank FROM b)
        SELECT qid, g AS group_value, group_rank, rank_in_group, id, round(s, 6) AS score{more}
        FROM t WHERE group_rank <= {groups} AND rank_in_group <= {per_group}"""


QUERIES = {
    "knn_l2": _self("l2"),
    "knn_ip": _self("ip"),
    "knn_cosine": _self("cosine"),
    "knn_mips": _self("mips_l2"),
    "knn_int8": _coded(_codes(127, "tinyint"), "l2"),
    "knn_int16": _coded(_codes(32767, "smallint"), "l2"),
    "knn_int4": _coded(_codes(7, "tinyint"), "l2"),
    "knn_f16": _coded(_halves, "l2"),
    "knn_f64": _coded(_doubles, "cosine"),
    "knn_hamming": _coded(_bits, "hamming"),
    "knn_filtered": knn_filtered,
    "knn_radius": knn_radius,
    "knn_by_id": knn_by_id,
    "knn_join": knn_join,
    "knn_linear": knn_linear,
    "ivf_full_probe": ivf_full_probe,
    "ivf_fixed_centroids": ivf_fixed_centroids,
    "ivf_narrow": ivf_narrow,
    "ivf_soar_assign": ivf_spill_assign,
    "ivf_soar_search": ivf_spill_search,
    "ivf_recall": _recall(_ivf),
    "lsh_recall": _recall(_lsh),
    "ivf_recall_each": _recall_each(_ivf),
    "lsh_recall_each": _recall_each(_lsh),
    "quant_int8": _quantized("int8"),
    "quant_int4": _quantized("int4"),
    "quant_f16": _quantized("float16"),
    "knn_refined": knn_refined,
    "knn_refined_int4": knn_refined_int4,
    "knn_grouped": knn_grouped,
    "knn_grouped_float": knn_grouped_float,
    "knn_grouped_ceiling": knn_grouped_ceiling,
    "knn_radius_zero": knn_radius_zero,
    "ivf_live": _live("ivf", cells=16),
    "approximate_live": _live("approximate"),
    "quantized_live": _live("flat", quantization="int8"),
    "index_rebuilt": index_rebuilt,
    "index_compacted": index_compacted,
    "ivf_filtered_stored": ivf_filtered_stored,
    "insert_invalid": insert_invalid,
    "index_reopen": index_reopen,
    "index_completeness": index_completeness,
}

_CHANGED = """
    w AS (
      SELECT vec_id::VARCHAR AS id, label, CASE WHEN label = 5 THEN list_transform(embedding::DOUBLE[], lambda x: -x)
        ELSE embedding::DOUBLE[] END AS v FROM embeddings WHERE label <> 3
      UNION ALL SELECT 'n' || vec_id, label, embedding::DOUBLE[] FROM embeddings WHERE label = 7),
    d AS (SELECT * FROM w)"""
_LIVE = sql_top(f"{_CHANGED}, {SQL_QUERIES}", SQL_SCORE["cosine"], K)
_COSINE = sql_top(f"{SQL_DOCS}, {SQL_QUERIES}", SQL_SCORE["cosine"], K)

ORACLES = {
    "knn_l2": sql_top(f"{SQL_SCALED}, {SQL_QUERIES}", SQL_SCORE["l2"], K),
    "knn_ip": sql_top(f"{SQL_SCALED}, {SQL_QUERIES}", SQL_SCORE["ip"], K, order="DESC"),
    "knn_cosine": sql_top(f"{SQL_SCALED}, {SQL_QUERIES}", SQL_SCORE["cosine"], K),
    "knn_mips": sql_top(
        f"{SQL_SCALED}, {SQL_QUERIES}, b AS (SELECT max(list_inner_product(v, v)) AS m FROM d)",
        "sqrt(greatest(list_inner_product(q.v, q.v) + b.m - 2 * list_inner_product(q.v, d.v), 0))",
        K,
        pairs="q, d, b",
    ),
    "knn_int8": sql_top(_sql_codes(127), SQL_SCORE["l2"], K),
    "knn_int16": sql_top(_sql_codes(32767), SQL_SCORE["l2"], K),
    "knn_int4": sql_top(_sql_codes(7), SQL_SCORE["l2"], K),
    "knn_f16": sql_top(
        f"d AS (SELECT vec_id AS id, {_HALF} AS v FROM embeddings), {_SELF}", SQL_SCORE["l2"], K
    ),
    "knn_f64": _COSINE,
    "knn_hamming": sql_top(
        "d AS (SELECT vec_id AS id, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1.0::DOUBLE "
        f"ELSE 0.0::DOUBLE END) AS v FROM embeddings), {_SELF}",
        "round(pow(list_distance(q.v, d.v), 2))",
        K,
    ),
    "knn_filtered": sql_top(
        "d AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v, label FROM embeddings "
        f"WHERE label >= 2 AND label <= 7), {SQL_QUERIES}",
        SQL_SCORE["cosine"] + " AS s, d.label AS label",
        K,
        more=", label",
    ).replace(" AS s, d.label AS label AS s", " AS s, d.label AS label"),
    "knn_radius": sql_top(f"{SQL_SCALED}, {_SELF}", SQL_SCORE["l2"], K, cut="s <= 3.0"),
    "knn_by_id": sql_top(
        f"{SQL_DOCS}, q AS (SELECT vec_id AS qid, embedding::DOUBLE[] AS v FROM embeddings "
        "WHERE vec_id IN (SELECT doc_id FROM documents))",
        SQL_SCORE["cosine"],
        K,
    ),
    "knn_join": sql_top(f"{SQL_SCALED}, {_SELF}", SQL_SCORE["l2"], K),
    "knn_linear": _COSINE,
    "ivf_full_probe": _COSINE,
    "ivf_fixed_centroids": _sql_probed(
        f"{_CELLS}, t AS (SELECT id, v, cell, label FROM f)", 2, "t.label >= 1"
    ),
    "ivf_narrow": _sql_filled(_CELLS, NARROW),
    "ivf_soar_assign": f"WITH {_SPILL} SELECT id, cell, round(gap, 6) AS gap FROM a",
    "ivf_soar_search": _sql_probed(f"{_SPILL}, t AS (SELECT id, v, cell FROM a)", 3),
    "quant_int8": """
        WITH d AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v,
          list_max(list_transform(embedding::DOUBLE[], lambda x: abs(x))) / 127.0 AS scale FROM embeddings)
        SELECT id, round(scale, 9) AS scale, (generate_subscripts(v, 1) - 1)::INT AS pos,
          round(unnest(v) / scale) AS code FROM d""",
    "quant_int4": """
        WITH d AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v,
          list_max(list_transform(embedding::DOUBLE[], lambda x: abs(x))) / 7.0 AS scale FROM embeddings)
        SELECT id, round(scale, 9) AS scale, (generate_subscripts(v, 1) - 1)::INT AS pos,
          round(unnest(v) / scale) AS code FROM d""",
    "quant_f16": f"""
        WITH d AS (SELECT vec_id AS id, {_HALF} AS v FROM embeddings)
        SELECT id, 1.0::DOUBLE AS scale, (generate_subscripts(v, 1) - 1)::INT AS pos, unnest(v) AS code
        FROM d""",
    "knn_refined": _COSINE,
    "knn_refined_int4": _COSINE,
    "index_reopen": _COSINE,
    "knn_grouped": _sql_grouped(
        "d AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v, lang AS g, source "
        "FROM embeddings LEFT JOIN documents ON vec_id = doc_id)",
        SQL_SCORE["cosine"],
        3,
        4,
        ", source",
    ),
    "knn_grouped_ceiling": _sql_grouped(
        "d AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v, lang AS g, source "
        "FROM embeddings LEFT JOIN documents ON vec_id = doc_id)",
        SQL_SCORE["cosine"],
        3,
        4,
        ", source",
        "n <= 100",
    ),
    "knn_radius_zero": sql_top(f"{SQL_SCALED}, {_SELF}", SQL_SCORE["ip"], 500, order="DESC", cut="s >= 0"),
    "ivf_live": _LIVE,
    "approximate_live": _LIVE,
    "quantized_live": _LIVE,
    "index_rebuilt": _LIVE,
    "index_compacted": sql_top(
        f"{_CHANGED.replace('FROM w', 'FROM w WHERE label < 8')}, {SQL_QUERIES}", SQL_SCORE["cosine"], K
    ),
    "ivf_filtered_stored": sql_top(
        f"{_CHANGED.replace('FROM w', 'FROM w WHERE label >= 2')}, {SQL_QUERIES}",
        SQL_SCORE["cosine"] + " AS s, d.label AS label",
        K,
        cut="s <= 0.9",
        more=", label",
    ).replace(" AS s, d.label AS label AS s", " AS s, d.label AS label"),
    "insert_invalid": """
        SELECT vec_id AS pos, CASE WHEN label = 9 THEN vec_id::VARCHAR WHEN label <> 4 THEN 'n' || vec_id END AS id,
          label NOT IN (3, 4, 9) AS ok,
          CASE WHEN label = 9 THEN 'alreadyExists' WHEN label IN (3, 4) THEN 'invalidArgument' END AS error_code
        FROM embeddings""",
    "ivf_recall": "SELECT count(*) AS queries, true AS recall_reached FROM embeddings",
    "lsh_recall": "SELECT count(*) AS queries, true AS recall_reached FROM embeddings",
    "knn_grouped_float": _sql_grouped(
        "d AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v, printf('%.6f', c_acctbal) AS g "
        "FROM embeddings LEFT JOIN customer ON vec_id = c_custkey)",
        SQL_SCORE["l2"],
        20,
        2,
    ),
    "index_completeness": """
        SELECT count(*) AS eligible, count(*) FILTER (label < 7) AS indexed,
          count(*) FILTER (label < 7) / count(*) AS completeness FROM embeddings""",
}
