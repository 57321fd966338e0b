"""From raw documents to packed training sequences, stage by stage.

Each stage takes what its predecessor kept, whole rows with the columns of ``documents``; the
last one returns the pieces of the packed sequences. Between stages the rows are written as
Parquet to the shared folder and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from plumbline.functions.sizing import materialize
from plumbline.llm import jaccard_join, packing, quality_rules, toxicity
from plumbline.llm.common import load

# The vocabulary whose tokens fill the sequences.
RANKS = "byte_bpe_multi_50k.tiktoken"
# Few chunks, and given back after each task: workers of a long job share memory with other stages.
REMEMBERED = 50_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current quality policy."""
    return quality_rules.keep_passing(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic by a classifier fitted on the documents at hand."""
    return toxicity.keep_clean(docs, toxicity.train(docs, load(spark, sf_dir, "labels")))


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts linked by their word n-grams."""
    return jaccard_join.keep_one(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document and the sequences they lie in, by exact token counts."""
    ranks, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    return packing.pack_tokens(docs, ranks, pattern, remembered=REMEMBERED, release=True)


STAGES = [
    ("quality_rules", quality),
    ("toxicity", clean),
    ("jaccard_join", distinct_texts),
    ("best_fit_packing", packed),
]

# A trained classifier, sampled joins and a packing heuristic have no SQL form; the tests
# hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
