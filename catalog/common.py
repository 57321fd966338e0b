"""Table loading and shared frames for the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """Deal a small file scan out to all cores. A scan that already has as many tasks as
    the cluster has cores is left alone."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "id")


def scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors stretched by label, so that the metrics rank differently."""
    stretch = (F.col("label") + 1).cast("double")
    x = F.col("embedding").cast("array<double>")
    return vectors(spark, sf_dir).withColumn("embedding", F.transform(x, lambda v: v * stretch))


def as_queries(docs: DataFrame, vector: str = "embedding") -> DataFrame:
    return docs.select(F.col("id").alias("qid"), F.col(vector).alias("qvec"))


def label_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query per label: the mean vector of its rows."""
    flat = vectors(spark, sf_dir).select("label", F.posexplode("embedding").alias("pos", "x"))
    means = flat.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    line = F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda p: p["x"])
    return means.groupBy("label").agg(line.alias("qvec")).withColumnRenamed("label", "qid")


def shown(hits: DataFrame, *more: str) -> DataFrame:
    return hits.select("qid", "id", F.round("score", 6).alias("score"), "rank", *more)


# SQL fragments -----------------------------------------------------------------------

SQL_DOCS = "d AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v, label FROM embeddings)"
SQL_SCALED = (
    "d AS (SELECT vec_id AS id, "
    "list_transform(embedding::DOUBLE[], lambda x: x * (label + 1)::DOUBLE) AS v, label "
    "FROM embeddings)"
)
SQL_QUERIES = "q AS (SELECT vec_id AS qid, embedding::DOUBLE[] AS v FROM embeddings)"
SQL_MEANS = (
    "m AS (SELECT label, pos, avg(x) AS x FROM (SELECT label, "
    "unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) "
    "GROUP BY label, pos), "
    "q AS (SELECT label AS qid, list(x ORDER BY pos) AS v FROM m GROUP BY label)"
)

SQL_SCORE = {
    "l2": "list_distance(q.v, d.v)",
    "ip": "list_inner_product(q.v, d.v)",
    "cosine": "1 - list_cosine_similarity(q.v, d.v)",
}


def sql_top(
    ctes: str, score: str, k: int, *, order: str = "ASC", pairs: str = "q, d", cut: str = "TRUE", more: str = ""
) -> str:
    return f"""
        WITH {ctes},
        s AS (SELECT q.qid, d.id, {score} AS s FROM {pairs}),
        r AS (SELECT *, row_number() OVER (
            PARTITION BY qid ORDER BY round(s, 9) {order}, id)::INT AS rank FROM s)
        SELECT qid, id, round(s, 6) AS score, rank{more} FROM r WHERE rank <= {k} AND {cut}"""
