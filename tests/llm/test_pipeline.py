import base64
import os

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from plumbline.llm import jaccard_join, packing, quality_rules, registry, toxicity

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def data():
    if not os.path.isdir(DATA):
        pytest.skip("no test data here")
    return DATA


def test_stages_follow_each_other(spark, data):
    """run() against the operators' own verdicts, applied by hand."""
    docs = spark.read.parquet(f"{data}/documents.parquet")
    labels = spark.read.parquet(f"{data}/labels.parquet")
    entries = quality_rules.apply_policy(quality_rules.ledger(docs))
    ids = {r.doc_id for r in entries.where("kept").collect()}
    left = docs.where(docs.doc_id.isin(list(ids)))
    scored = toxicity.score(left, toxicity.train(left, labels))
    ids &= {r.doc_id for r in scored.where("predicted = 0").collect()}
    left = docs.where(docs.doc_id.isin(list(ids)))
    texts = {r.doc_id: r.text for r in left.collect()}
    sets = {i: set(jaccard_join.shingle_set(t, {}).tolist()) for i, t in texts.items()}
    root = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if a < b and sets[a] and root[a] != root[b]:
                    if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                        low = min(root[a], root[b])
                        high = max(root[a], root[b])
                        root = {i: low if r == high else r for i, r in root.items()}
                        changed = True
    expected = {i for i in sets if root[i] == i}
    rows = corpus_pipeline.run(spark, data).collect()
    assert {r.doc_id for r in rows} == expected
    words = {}
    for r in rows:
        words[r.doc_id] = words.get(r.doc_id, 0) + r.length
    path = public_tokenizers.path(corpus_pipeline.RANKS)
    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert words == {i: len(library.encode_ordinary(texts[i])) + packing.SEPARATOR for i in expected}


def test_long_texts_without_white_space_fill_their_sequences(spark, data):
    text = "".join(chr(0x4E00 + (i * i) % 20_000) for i in range(12_000))
    docs = spark.createDataFrame([(1, text, "zh", "web", len(text))], "doc_id long, text string, lang string, source string, n_chars long")
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, data).collect()
    assert sum(r.length for r in rows) > 12_000
    assert all(r.bin_used <= r.bin_capacity <= 8192 for r in rows)


def test_stages_keep_columns_and_take_odd_rows(spark, odd_docs, no_docs, data):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, data)
            assert out.columns == docs.columns, name
            out.collect()
        corpus_pipeline.STAGES[-1][1](spark, docs, data).collect()


def test_every_query_has_a_name_of_its_operator():
    numbers = {name.split("_")[0] for name in registry.QUERIES if name.startswith("op")}
    assert numbers == {f"op{n}" for n in range(1, 14)}
    assert set(registry.ORACLES) <= set(registry.QUERIES)
