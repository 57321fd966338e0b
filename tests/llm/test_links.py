import itertools
import random

import numpy as np
import pytest

from plumbline.llm import jaccard_join, linking, near_vectors


def union(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_match_union_find(spark):
    rng = random.Random(5)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    pairs += [(i, i + 1) for i in range(1000, 1040)] + [(2000, i) for i in range(2001, 2200)] + [(7, 7)]
    nodes = {n for p in pairs if p[0] != p[1] for n in p}
    expected = union([p for p in pairs if p[0] != p[1]], nodes)
    got = {r.id: r.root for r in linking.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == expected


def test_components_of_nothing(spark):
    assert linking.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.fixture(scope="module")
def near_texts(prose):
    """Unrelated texts, families of near copies, exact copies, and a passage many share."""
    rng = random.Random(11)
    texts = [prose(rng.randint(1, 80)) for _ in range(120)]
    for size in (2, 3, 40):
        base = prose(120).split()
        for _ in range(size):
            words = list(base)
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = prose(1)
            texts.append(" ".join(words))
    passage = prose(60)
    texts += [passage + " " + prose(40) for _ in range(60)]
    texts += [texts[3]] * 30 + [texts[125].upper() + "!"] * 2
    return texts


def brute(texts):
    sets = [set(jaccard_join.shingle_set(t, {}).tolist()) for t in texts]
    pairs = [
        (a, b)
        for a, b in itertools.combinations(range(len(sets)), 2)
        if sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])
    ]
    links = dict.fromkeys(range(len(sets)), 0)
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    return links, union(pairs, range(len(sets)))


@pytest.mark.parametrize("leaf_rows", [64, 4])
def test_jaccard_matches_brute_force(spark, near_texts, leaf_rows):
    links, roots = brute(near_texts)
    docs = spark.createDataFrame(list(enumerate(near_texts)), "doc_id long, text string")
    rows = jaccard_join.jaccard_links(docs, leaf_rows=leaf_rows).collect()
    assert {r.doc_id: r.n_links for r in rows} == links
    assert {r.doc_id: r.component_id for r in rows} == roots
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_odd_documents_link_with_nothing(odd_docs, no_docs):
    rows = {r.doc_id: r for r in jaccard_join.jaccard_links(odd_docs).collect()}
    assert set(rows) == {*range(11), None}
    for alone in (None, 0, 1, 2, 3, 7):
        assert rows[alone].kept and rows[alone].n_links == 0
    assert (rows[5].component_id, rows[5].n_links, rows[5].kept) == (4, 1, False)
    assert jaccard_join.jaccard_links(no_docs).count() == 0


def test_keep_one_of_each_group(spark, odd_docs, no_docs):
    kept = jaccard_join.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [0, 1, 2, 3, 4, 6, 7, 8, 9, 10]
    assert kept.where("doc_id is null").count() == 1
    assert jaccard_join.keep_one(no_docs).count() == 0
    twice = spark.createDataFrame([(1, "one two three four five six")] * 3 + [(2, "other")], "doc_id long, text string")
    assert sorted(r.doc_id for r in jaccard_join.keep_one(twice).collect()) == [1, 2]


def test_texts_under_one_id_are_judged_each(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    near = a + " more"
    rows = [(1, a), (1, b), (1, b), (2, near), (3, c), (4, None), (4, "word"), (None, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(((r.doc_id, r.text) for r in jaccard_join.keep_one(docs).collect()), key=str)
    assert kept == sorted([(1, b), (2, near), (3, c), (4, None), (4, "word"), (None, a)], key=str)
    alone = sorted(tuple(r) for r in jaccard_join.keep_one(docs.where("doc_id = 1")).collect())
    assert alone == [(1, a), (1, b)]


def test_runs_reach_the_recall():
    assert jaccard_join.runs_needed(0.8, 0.999) == 3
    assert jaccard_join.runs_needed(0.6, 0.999) > 3


def test_blocks_count_each_link_once(spark):
    """One cluster over many blocks gives the counts of one block."""
    rng = np.random.default_rng(2)
    x = rng.standard_normal((60, 8)) * 0.15 + 1
    x /= np.linalg.norm(x, axis=1)[:, None]
    rows = [(0, i, 1, 8, x[i].tobytes()) for i in range(60)]
    members = spark.createDataFrame(rows, "cluster long, id long, copies long, units long, payload binary")
    linked = (x @ x.T >= 0.95) & ~np.eye(60, dtype=bool)
    for block in (512, 7):
        found = linking.block_links(members, near_vectors.linked_vectors(0.95), block_members=block)
        got = {r.id: r.n for r in found.groupBy("id").agg({"n_classes": "sum"}).toDF("id", "n").collect()}
        assert got == {i: int(n) for i, n in enumerate(linked.sum(axis=1)) if n}


def vectors_frame(spark, vectors):
    rows = [(i, v) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


@pytest.mark.parametrize("leaf_rows", [64, 5])
def test_vectors_match_brute_force(spark, leaf_rows):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((150, 24))
    near = base[3] + rng.standard_normal((80, 24)) * 0.12
    x = np.vstack([base, near, base[:20], base[20:40] * 3, base[40:60] + rng.standard_normal((20, 24)) * 0.1])
    x = x.astype(np.float32)
    y = x.astype(np.float64)
    y /= np.linalg.norm(y, axis=1)[:, None]
    linked = (y @ y.T >= 0.95) & ~np.eye(len(y), dtype=bool)
    roots = union([tuple(sorted(p)) for p in np.argwhere(linked).tolist()], range(len(y)))
    frame = vectors_frame(spark, [v.tolist() for v in x])
    rows = near_vectors.vector_links(frame, leaf_rows=leaf_rows).collect()
    assert {r.vec_id: r.n_links for r in rows} == {i: int(n) for i, n in enumerate(linked.sum(axis=1))}
    assert {r.vec_id: r.component_id for r in rows} == roots


def test_odd_vectors_link_with_nothing(spark):
    odd = [None, [0.0, 0.0], [1.0, None], [float("nan"), 1.0], [float("inf"), 1.0], [], [1.0, 1.0], [1.0, 1.0], [1.0, 1.0, 1e-9], [3e38, 3e38]]
    rows = {r.vec_id: r for r in near_vectors.vector_links(vectors_frame(spark, odd)).collect()}
    assert len(rows) == len(odd)
    assert all(rows[i].n_links == 0 and rows[i].kept for i in (0, 1, 2, 3, 4, 5, 8))
    assert [(rows[i].n_links, rows[i].component_id) for i in (6, 7, 9)] == [(2, 6)] * 3
    nothing = spark.createDataFrame([], "vec_id long, embedding array<float>, id string")
    assert near_vectors.vector_links(nothing).count() == 0


def test_plan_of_tables_reaches_the_recall():
    for rows in (100, 10_000, 10**9):
        k, tables = near_vectors.table_plan(rows)
        missed = (1 - near_vectors.agreement(0.1**0.5) ** k) ** tables
        assert missed <= near_vectors.MISSED
        assert rows * near_vectors.agreement(near_vectors.FAR) ** k <= max(near_vectors.STRANGERS, rows * 0.5)
