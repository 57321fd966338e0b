import math
import random

import numpy as np
import pytest

from plumbline.llm import toxicity
from plumbline.llm.common import held_out

BAD = ["grumble", "snarl", "sneer", "scoff"]


def make_corpus(spark, seed, count):
    """Every ninth text is toxic, three of four are labelled; words are drawn from the seed alone."""
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(count):
        words = ["".join(rng.choice("abcd") for _ in range(rng.randint(2, 7))) for _ in range(60)]
        toxic = i % 9 == 0
        if toxic:
            for _ in range(3):
                words[rng.randrange(60)] = rng.choice(BAD)
        rows.append((i, " ".join(words)))
        if i % 4 != 3:
            labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int"), set(range(0, count, 9))


@pytest.fixture(scope="module")
def corpus(spark):
    return make_corpus(spark, 2, 4500)


@pytest.mark.parametrize("seed, count", [(2, 4500), (11, 4500), (12, 4500), (13, 4500), (3, 900), (4, 900), (5, 900)])
def test_toxic_texts_are_found_beyond_the_labels(spark, seed, count):
    docs, labels, toxic = make_corpus(spark, seed, count)
    rows = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    found = {r.doc_id for r in rows if r.predicted == 1}
    assert len(found & toxic) >= 0.95 * len(toxic)
    assert len(found - toxic) <= 5
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_chance_is_the_exact_tail():
    for total, marked, drawn in ((30, 7, 9), (12, 12, 4), (50, 3, 20), (9, 0, 5)):
        for found in range(0, 12):
            ways = sum(math.comb(marked, k) * math.comb(total - marked, drawn - k) for k in range(found, drawn + 1))
            tail = ways / math.comb(total, drawn)
            assert math.exp(toxicity.log_tail(found, drawn, marked, total)) == pytest.approx(tail, abs=1e-12)


def brute_risk(w, positive, unlabelled, prior):
    """Both parts of the risk, text by text, from the definition."""
    loss = lambda z: math.log1p(math.exp(-z))
    odds = lambda text: sum(w[k] for k in text) + w[-1]
    mean = lambda values: sum(values) / len(values)
    toxic = prior * mean([loss(odds(t)) for t in positive])
    return toxic, mean([loss(-odds(t)) for t in unlabelled]) - prior * mean([loss(-odds(t)) for t in positive])


def test_risk_and_gradient_by_definition():
    rng = random.Random(8)
    seen = set()
    for _ in range(60):
        positive = [sorted(rng.sample(range(5), rng.randint(1, 4))) for _ in range(6)]
        unlabelled = [sorted(rng.sample(range(5), rng.randint(0, 3))) for _ in range(9)]
        w, prior = [rng.gauss(0, 2) for _ in range(6)], rng.uniform(0.05, 0.9)
        p, u = (
            toxicity.Presence.of([np.array(t, dtype=np.int64) for t in texts], np.arange(5))
            for texts in (positive, unlabelled)
        )
        parts = brute_risk(w, positive, unlabelled, prior)
        assert toxicity.risk(p.log_odds(np.array(w)), u.log_odds(np.array(w)), prior) == pytest.approx(parts)
        turned = parts[1] < 0
        seen.add(turned)
        for k, got in enumerate(toxicity.slope(np.array(w), p, u, prior)):
            ends = []
            for step in (1e-5, -1e-5):
                moved = list(w)
                moved[k] += step
                toxic, other = brute_risk(moved, positive, unlabelled, prior)
                ends.append(-toxicity.TURN * other if turned else toxic + other)
            assert got == pytest.approx((ends[0] - ends[1]) / 2e-5, abs=1e-6)
    assert seen == {True, False}


def test_labels_without_a_document_take_no_place(spark, corpus):
    docs, labels, _ = corpus
    # Ids that no document has, and more of them than the bounds allow.
    more = spark.range(100_000, 101_000).selectExpr("id AS doc_id", "1 AS toxic")
    model = toxicity.train(docs, labels.union(more), max_positive=300, max_unlabelled=1500)
    assert {toxicity.bucket(w) for w in BAD} <= set(model.weights)


def test_words_are_counted_over_all_documents(spark):
    """A word of confirmed texts that is common in unlabelled ones tells nothing."""
    rows = [(i, f"grumble common t{i}" if i < 120 else f"common u{i}" if i < 4000 else f"v{i}") for i in range(5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 120)) for i in [*range(120), *range(4000, 4200)]], "doc_id long, toxic int")
    weights = toxicity.train(docs, labels).weights
    assert toxicity.bucket("grumble") in weights and len(weights) <= 2


def test_an_id_with_several_texts_is_one_example(spark, corpus):
    docs, labels, _ = corpus
    twice = docs.union(docs.where("doc_id % 9 = 0")).union(docs.selectExpr("doc_id", "'zz yy' AS text").where("doc_id < 50"))
    assert toxicity.train(twice, labels) == toxicity.train(twice.repartition(5), labels)


def test_labels_of_held_out_rows_are_never_read(spark, corpus):
    docs, labels, _ = corpus
    wrong = labels.withColumn("toxic", held_out(labels.doc_id).cast("int"))
    right = labels.withColumn("toxic", (~held_out(labels.doc_id)).cast("int") * labels.toxic)
    assert toxicity.train(docs, right) == toxicity.train(docs, labels)
    assert toxicity.train(docs, wrong).weights == {}


def test_negative_risk_stays_near_zero():
    """With every unlabelled text positive the plain risk would be far below zero."""
    positive = [np.array([1, 2]), np.array([1, 3])] * 30
    model = toxicity.fit(positive, [np.array([2, 9])] * 400 + positive[:20], 0.3)
    assert np.isfinite(list(model.weights.values())).all()
    assert model.weights[1] > 0


def test_odd_documents_and_missing_labels(spark, odd_docs, no_docs, corpus):
    docs, labels, _ = corpus
    model = toxicity.train(docs, labels)
    rows = toxicity.score(odd_docs, model).collect()
    assert len(rows) == odd_docs.count()
    assert len({r.score for r in rows if r.doc_id in (0, 1, 2)}) == 1
    assert all(r.predicted == 0 for r in rows)
    assert toxicity.score(no_docs, model).count() == 0
    kept = toxicity.keep_clean(odd_docs, model)
    assert kept.schema == odd_docs.schema and kept.count() == odd_docs.count()
    unlabelled = spark.createDataFrame([(None, 1), (3, None)], "doc_id long, toxic int")
    for frame in (unlabelled, unlabelled.limit(0)):
        model = toxicity.train(odd_docs, frame)
        assert model.weights == {} and toxicity.score(odd_docs, model).where("predicted = 1").count() == 0
    assert toxicity.train(no_docs, labels).weights == {}
