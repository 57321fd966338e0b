import itertools
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from plumbline.errors import InvalidArgument
from plumbline.functions import joins
from plumbline.functions.text import tokenize
from plumbline.operators import blocks, fulltext, sparse
from plumbline.operators.fulltext import Analyzer, build_text_index, search_index, search_scan
from plumbline.operators.fusion import SubResult, fuse_rrf, fuse_weighted
from plumbline.operators.sparse import sparse_knn, sparse_scan, valid_sparse
from plumbline.plans import search
from plumbline.plans.search import SubQuery, hybrid_search

TITLES = [
    ("swift", "swift vector database", 3, [1.0, 0.0]),
    ("server", "swift server", 2, [0.9, 0.1]),
    ("weather", "weather report", 1, [0.0, 1.0]),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(TITLES, "id string, title string, rank_no long, embedding array<float>")


def ask(spark, text):
    return spark.createDataFrame([(1, text)], "qid int, text string")


def ids(hits):
    return [r["id"] for r in hits.orderBy("rank").collect()]


def scan(spark, docs, text, **options):
    return ids(search_scan(docs, ask(spark, text), 3, text="title", **options))


def indexed(spark, docs, text, **options):
    index = build_text_index(docs, "title", options.pop("analyzer", Analyzer()))
    return ids(search_index(index, ask(spark, text), 3, **options))


@pytest.mark.parametrize("run", [scan, indexed])
def test_expressions(spark, docs, run):
    assert run(spark, docs, "+swift -database", mode="query") == ["server"]
    assert run(spark, docs, "swift weather", mode="query", operator="and") == []
    assert run(spark, docs, "+swift server", mode="query") == ["server", "swift"]
    assert run(spark, docs, "-database", mode="query") == []
    assert run(spark, docs, "+swift +absent", mode="query") == []


@pytest.mark.parametrize("run", [scan, indexed])
def test_match_operators(spark, docs, run):
    assert set(run(spark, docs, "swift weather")) == {"swift", "server", "weather"}
    assert run(spark, docs, "SWIFT database", operator="and") == ["swift"]


@pytest.mark.parametrize("run", [scan, indexed])
def test_chinese(spark, run):
    rows = [("swift", "Swift 向量数据库桥接"), ("weather", "上海今天有阵雨")]
    docs = spark.createDataFrame(rows, "id string, title string")
    assert run(spark, docs, "向量 数据库", operator="and", analyzer=Analyzer("cjk")) == ["swift"]


def test_bm25_value(spark, docs):
    hit = search_scan(docs, ask(spark, "database"), 3, text="title").first()
    idf = math.log(1 + (3 - 1 + 0.5) / 1.5)
    length = 0.25 + 0.75 * 3 / (7 / 3)
    assert hit["score"] == pytest.approx(idf * 2.2 / (1 + 1.2 * length))


def test_filter_keeps_corpus_statistics(spark, docs):
    plain = search_scan(docs, ask(spark, "swift"), 3, text="title").collect()
    cut = search_scan(docs, ask(spark, "swift"), 3, text="title", where="rank_no <= 2").collect()
    assert [r["id"] for r in cut] == ["server"]
    assert cut[0]["score"] == pytest.approx({r["id"]: r["score"] for r in plain}["server"])
    index = build_text_index(docs, "title")
    allowed = docs.where("rank_no <= 2").select("id")
    assert ids(search_index(index, ask(spark, "swift"), 3, allowed=allowed)) == ["server"]


def test_blank_and_bad_arguments(spark, docs):
    for mode, text in [("match", "  \n"), ("query", ""), ("match", None)]:
        with pytest.raises(InvalidArgument):
            search_scan(docs, ask(spark, "x").withColumn("text", F.lit(text)), 3, text="title", mode=mode)
    with pytest.raises(InvalidArgument):
        search_scan(docs, ask(spark, "swift"), 0, text="title")
    with pytest.raises(InvalidArgument):
        search_scan(docs, ask(spark, "swift"), 3, text="title", operator="xor")
    with pytest.raises(InvalidArgument):
        tokenize(F.lit("x"), "unknown")


def test_three_routes_agree(spark, monkeypatch):
    """Scan, index and the join for large query tables, over whole documents."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumnRenamed("doc_id", "id")
    queries = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").withColumnRenamed("item_id", "qid")
    index = build_text_index(docs, "text")

    def rows(hits):
        return sorted((r["qid"], r["rank"], r["id"], round(r["score"], 6)) for r in hits.collect())

    by_scan = rows(search_scan(docs, queries, 5))
    assert by_scan == rows(search_index(index, queries, 5))
    monkeypatch.setattr(sparse, "MAX_QUERY_ENTRIES", 3)
    monkeypatch.setattr(joins, "SALT_ROWS", 20)
    assert by_scan == rows(search_scan(docs, queries, 5))
    assert by_scan == rows(search_index(index, queries, 5))


def test_tokenizers(spark):
    row = spark.createDataFrame([("Añb, C3\tx 向量库y",)], "t string")
    get = lambda *a: row.select(tokenize(F.col("t"), *a)).first()[0]
    assert get("standard") == ["añb", "c3", "x", "向量库y"]
    assert get("whitespace") == ["Añb,", "C3", "x", "向量库y"]
    assert get("cjk") == ["añb", "c3", "x", "向量", "量库", "y"]
    assert get("whitespace", ("lowercase", "stop"), {"stopwords": "x,c3"}) == ["añb,", "向量库y"]


def test_empty_text_still_counts(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, ""), (3, None), (4, "a")], "id int, title string")
    found = search_scan(docs, ask(spark, "b"), 3, text="title").first()
    idf = math.log(1 + (4 - 1 + 0.5) / 1.5)
    assert found["score"] == pytest.approx(idf * 2.2 / (1 + 1.2 * (0.25 + 0.75 * 2 / 0.75)))


SPARSE = [("near", [1, 5], [1.0, 0.5]), ("far", [2, 9], [1.0, 0.5]), ("mixed", [1, 2], [0.5, 0.25])]


@pytest.fixture(scope="module")
def sparse_docs(spark):
    rows = [(i, [float(n == 0), float(n == 1)], (x, v)) for n, (i, x, v) in enumerate(SPARSE)]
    kind = "struct<indices: array<bigint>, values: array<float>>"
    return spark.createDataFrame(rows, f"id string, dense array<float>, sparse {kind}")


def test_sparse_routes_agree(spark, sparse_docs, monkeypatch):
    queries = spark.createDataFrame([("q", 1, 1.0), ("q", 5, 0.5), ("p", 2, 2.0)], "qid string, idx long, val double")
    expected = [("p", 1, "far", 2.0), ("p", 2, "mixed", 0.5), ("q", 1, "near", 1.25), ("q", 2, "mixed", 0.5)]
    rows = sparse.explode_sparse(sparse_docs, "sparse", "id")

    def found(hits):
        return sorted((r["qid"], r["rank"], r["id"], r["score"]) for r in hits.collect())

    assert found(sparse_scan(sparse_docs, queries, 5, vector="sparse")) == expected
    assert found(sparse_knn(rows, queries, 5)) == expected
    monkeypatch.setattr(sparse, "MAX_QUERY_ENTRIES", 1)
    monkeypatch.setattr(joins, "SALT_ROWS", 1)
    assert found(sparse_knn(rows, queries, 5)) == expected


def test_sparse_entries_across_batches(spark):
    """One id spanning several Arrow batches is scored once."""
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = spark.range(300).select(
            (F.col("id") % 3).alias("id"), (F.col("id") / 3).cast("long").alias("idx"), F.lit(1.0).alias("val")
        )
        queries = spark.range(100).select(F.lit("q").alias("qid"), F.col("id").alias("idx"), F.lit(2.0).alias("val"))
        got = [(r["id"], r["score"]) for r in sparse_knn(rows, queries, 3).orderBy("rank").collect()]
        assert got == [(0, 200.0), (1, 200.0), (2, 200.0)]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


@pytest.mark.parametrize("factor", [1.0, 0.1, float(1 << 40)])
def test_two_large_sparse_tables_meet_in_stripes(spark, monkeypatch, factor):
    rng = random.Random(11)
    far = 1 if factor < 2 else 1 << 35
    draw = lambda n: [(f"i{rng.randrange(60)}", rng.randrange(40) * far, rng.randrange(-9, 9) * factor) for _ in range(n)]
    rows, asked = draw(500), draw(400)
    monkeypatch.setattr(sparse, "MAX_QUERY_ENTRIES", 1)
    monkeypatch.setattr(sparse, "LEAST_ENTRIES", 100)
    monkeypatch.setattr(blocks.SparseStripe, "PRODUCTS", 300)
    frame = spark.createDataFrame(rows, "id string, idx long, val double").repartition(3)
    queries = spark.createDataFrame(asked, "qid string, idx long, val double").repartition(3)

    def expected(rows, asked, k):
        sums = {}
        for (i, p, v), (q, t, w) in itertools.product(rows, asked):
            if p == t and p is not None:
                products = sums.setdefault((q, i), [])
                products.append(None if v is None or w is None else v * w)
        best = {}
        for (q, i), products in sums.items():
            known = [x for x in products if x is not None]
            best.setdefault(q, []).append((round(-sum(known), 9) if known else float("inf"), i or ""))
        return {(q, i) for q, hits in best.items() for _, i in sorted(hits)[:k]}

    found = sparse_knn(frame, queries, 7)
    assert {(r.qid, r.id) for r in found.collect()} == expected(rows, asked, 7)
    # Every stripe returns its best only, not all pairs.
    weights = queries.select("qid", "idx", F.col("val").alias("weight"))
    assert sparse._both_large(frame, weights, 1).count() <= 60 * sparse.STRIPES
    # Values and keys that are null, and indices that are, as before.
    monkeypatch.setattr(sparse, "LONGEST_QUERY", max(Counter(q for q, *_ in asked).values()) - 1)
    odd = [("i1", 3 * far, None), (None, 4 * far, 2 * factor), ("i2", None, 1.0), ("new", 5 * far, None)]
    more = [(None, 3 * far, factor), ("i3", 4 * far, None)]
    frame = frame.union(spark.createDataFrame(odd, "id string, idx long, val double"))
    queries = queries.union(spark.createDataFrame(more, "qid string, idx long, val double"))
    found = sparse_knn(frame, queries, 7)
    assert {(r.qid, r.id or "") for r in found.collect()} == expected(rows + odd, asked + more, 7)


def test_sparse_validity(spark):
    kind = "v struct<indices: array<bigint>, values: array<float>>"
    rows = [(([1, 3, 8], [1.0, 2.0, 3.0]),), (([1, 1], [1.0, 2.0]),), (([1], [1.0, 2.0]),), (([], []),)]
    got = spark.createDataFrame(rows, kind).select(valid_sparse(F.col("v"))).collect()
    assert [r[0] for r in got] == [True, False, False, True]


def test_sparse_and_dense_fused(spark, sparse_docs):
    dense = spark.createDataFrame([("q", [1.0, 0.0])], "qid string, qvec array<float>")
    terms = spark.createDataFrame([("q", 1, 1.0), ("q", 5, 0.5)], "qid string, idx long, val double")
    parts = [SubQuery("dense", "dense", dense, 2), SubQuery("sparse", "sparse", terms, 2)]
    assert ids(hybrid_search(sparse_docs, parts, 2))[0] == "near"


def test_weighted_dense_and_chinese_text(spark):
    rows = [("swift", "Swift 向量数据库桥接", [1.0, 0.0]), ("weather", "上海今天有阵雨", [0.0, 1.0])]
    docs = spark.createDataFrame(rows, "id string, title string, embedding array<float>")
    dense = spark.createDataFrame([(1, [1.0, 0.0])], "qid int, qvec array<float>")
    parts = [
        SubQuery("dense", "embedding", dense, 2),
        SubQuery("text", "title", ask(spark, "数据库"), 2, analyzer=Analyzer("cjk")),
    ]
    found = hybrid_search(docs, parts, 2, weights=[0.4, 0.6], output=["title"])
    assert found.orderBy("rank").first()["title"] == "Swift 向量数据库桥接"
    with pytest.raises(InvalidArgument):
        hybrid_search(docs, parts, 2, weights=[1.0])
    with pytest.raises(InvalidArgument):
        hybrid_search(docs, parts[:1], 2)


def test_fusion_order_does_not_matter(spark):
    kind = "qid int, id string, score double, rank int"
    a = SubResult(spark.createDataFrame([(1, "x", 0.1, 1), (1, "y", 0.2, 2)], kind), "cosine")
    b = SubResult(spark.createDataFrame([(1, "y", 9.0, 1), (1, "z", 3.0, 2)], kind), "text")
    left = [(r["id"], r["score"]) for r in fuse_rrf([a, b], 3).collect()]
    right = [(r["id"], r["score"]) for r in fuse_rrf([b, a], 3).collect()]
    assert left == right and left[0] == ("y", pytest.approx(1 / 61 + 1 / 62))
    top = fuse_weighted([a, b], 1, [0.5, 0.5]).first()
    assert top["id"] == "y"
    assert top["score"] == pytest.approx(0.5 * 0.9 + 0.5 * 2 * math.atan(9.0) / math.pi)


def test_sparse_kernel_cuts_by_matches(monkeypatch):
    """Any limit on matches gives the same hits, and no step lays out more than it."""
    import numpy as np

    from plumbline.operators import blocks

    rng = np.random.default_rng(3)
    query, term = np.repeat(np.arange(40), 30), rng.integers(0, 50, 1200)
    pairs = np.unique(query * 50 + term)
    query, term = pairs // 50, pairs % 50
    weight, role = rng.random(len(query)), (rng.random(len(query)) < 0.05).astype(int)
    held = blocks.SparseQueries(query, term, weight, role, 50, 40)
    row = np.repeat(np.arange(200), 8)
    at = np.unique(row * 50 + rng.integers(0, 50, len(row)))
    row, at = at // 50, at % 50
    value, ids = rng.random(len(row)), np.arange(200)
    seen = []

    def run(limit):
        best = blocks.SparseBest(held, 5)
        monkeypatch.setattr(blocks.SparseBest, "MATCHES", limit)
        plain = np.repeat
        monkeypatch.setattr(blocks.np, "repeat", lambda a, n: seen.append(np.sum(n)) or plain(a, n))
        best.add(row, at, value, ids)
        monkeypatch.setattr(blocks.np, "repeat", plain)
        best.settle()
        order = np.lexsort((best.ids, best.q))
        return list(zip(best.q[order], best.ids[order], np.round(best.cost[order], 9)))

    whole = run(10**9)
    seen.clear()
    assert run(2_000) == whole
    widest = max(int((held.start[at[row == r] + 1] - held.start[at[row == r]]).sum()) for r in range(200))
    assert max(seen) <= 2_000 + widest


def test_kept_hits_are_sorted_once_per_doubling(monkeypatch):
    import numpy as np

    from plumbline.operators import blocks

    monkeypatch.setattr(blocks.Keeper, "MERGE_ROWS", 10)
    rng, keeper = np.random.default_rng(1), blocks.Keeper(3, 40, True)
    hits = [(rng.integers(0, 3, 25), rng.random(25), np.arange(k * 25, k * 25 + 25)) for k in range(20)]
    for q, cost, ids in hits:
        keeper.merge(q, cost, ids)
    keeper.settle()
    q, cost, ids = (np.concatenate(part) for part in zip(*hits))
    for number in range(3):
        mine = np.flatnonzero(q == number)
        best = mine[np.argsort(cost[mine], kind="stable")][:40]
        assert set(keeper.ids[keeper.q == number]) == set(ids[best])


def test_asked_terms_reach_the_scan(spark, docs):
    index = build_text_index(docs, "title")
    plan = search_index(index, ask(spark, "swift"), 3)._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "term" in pushed and "swift" in pushed


@pytest.fixture(scope="module")
def listed(spark):
    """400 texts of common and rare words."""
    import random

    rng = random.Random(3)
    common, rare = [f"c{i}" for i in range(8)], [f"r{i}" for i in range(150)]
    texts = [
        (i, " ".join(rng.choices(common, k=rng.randint(3, 30)) + rng.choices(rare, k=rng.randint(0, 4))))
        for i in range(400)
    ]
    docs = spark.createDataFrame(texts, "id long, text string").cache()
    return docs, build_text_index(docs, "text")


BOUNDED = [
    ("match", "or", ["r1 c0", "r1 r2 r3 c0 c1", "c0 c1 c2", "r5", "r7 r8 c3 c3", "absent c1", "absent r9 c1"]),
    ("match", "and", ["r1 c0", "c0 c1 c2 c3", "r2 r3", "absent c0", "r4 c0 c1 c2"]),
    ("query", "or", ["+r1 c0 -c1", "r1 r2 -c0", "+c0 +c1 r3", "-c0", "+r6 -c2 c3", "c4 r9"]),
]


@pytest.mark.parametrize("mode, operator, texts", BOUNDED)
def test_waiting_words_change_no_hit(spark, listed, mode, operator, texts):
    docs, index = listed
    asked = spark.createDataFrame(list(enumerate(texts)), "qid int, text string")
    flat = lambda hits: sorted((r["qid"], r["rank"], r["id"], round(r["score"], 6)) for r in hits.collect())
    for k in (1, 3, 50):
        expected = flat(search_scan(docs, asked, k, mode=mode, operator=operator))
        for rows in (0, 10**9):
            assert flat(search_index(index, asked, k, mode=mode, operator=operator, phase_rows=rows)) == expected
    # Each query alone, so that others do not bring in its documents.
    for text in texts:
        alone = asked.where(F.col("text") == text)
        expected = flat(search_scan(docs, alone, 2, mode=mode, operator=operator))
        assert flat(search_index(index, alone, 2, mode=mode, operator=operator, phase_rows=0)) == expected
    allowed = docs.where("id % 3 = 0").select("id")
    expected = flat(search_scan(docs, asked, 3, mode=mode, operator=operator, where="id % 3 = 0"))
    found = search_index(index, asked, 3, mode=mode, operator=operator, allowed=allowed, phase_rows=0)
    assert flat(found) == expected


def test_postings_out_of_reach_stay_where_they_are(spark, listed, monkeypatch):
    docs, index = listed
    moved = []
    plain = fulltext.rank_entries
    monkeypatch.setattr(fulltext, "rank_entries", lambda e, b, k: (moved.append(e.count()), plain(e, b, k))[1])
    asked = spark.createDataFrame([(1, "+r1 c0 c1 c2 c3")], "qid int, text string")
    for rows, mode in ((10**9, "query"), (0, "query")):
        search_index(index, asked, 1, mode=mode, phase_rows=rows).collect()
    assert moved[1] < 0.1 * moved[0]


def mixed_rows(spark):
    """Rows where any of the three fields may be missing, with repeated vectors and words."""
    kind = "id long, lang string, t string, v array<float>, s struct<indices: array<bigint>, values: array<float>>"
    rows = []
    for n in range(60):
        text = None if n % 7 == 0 else "" if n % 7 == 1 else " ".join(["red", "green", "blue"][: n % 3 + 1] * (n % 4 + 1))
        vector = None if n % 5 == 0 else [float(n % 6) - 2, 1.0]
        sparse = None if n % 4 == 0 else ([n % 3, 5 + n % 2], [1.0 + n % 8, 2.0])
        rows.append((n, "a" if n % 2 else "b", text, vector, sparse))
    return spark.createDataFrame(rows, kind).repartition(5)


def mixed_parts(spark, metric="l2"):
    dense = spark.createDataFrame([(1, [1.0, 0.5]), (2, [-1.0, 2.0]), (3, None)], "qid int, qvec array<float>")
    texts = spark.createDataFrame([(1, "green"), (2, "blue red"), (4, "nowhere")], "qid int, text string")
    terms = spark.createDataFrame([(1, 0, 1.0), (1, 5, 0.5), (2, 6, 1.0)], "qid int, idx long, val double")
    return [
        SubQuery("dense", "v", dense, 9, metric=metric),
        SubQuery("text", "t", texts, 5),
        SubQuery("sparse", "s", terms, 7),
    ]


@pytest.mark.parametrize("metric", ["l2", "ip", "cosine", "mips_l2"])
@pytest.mark.parametrize("weights", [None, [0.2, 0.5, 0.3]])
def test_one_scan_fuses_like_several(spark, monkeypatch, metric, weights):
    docs, parts = mixed_rows(spark), mixed_parts(spark, metric)
    ask_all = lambda: [
        (r["qid"], r["id"], round(r["score"], 9), r["rank"])
        for where in (None, "lang = 'a'", "lang = 'none'")
        for r in hybrid_search(docs, parts, 8, where=where, weights=weights).orderBy("qid", "rank").collect()
    ]
    together = ask_all()
    monkeypatch.setattr(search, "_scorers", lambda *_: None)
    assert together == ask_all() and together


def test_scoring_reads_the_rows_once(spark, tmp_path, capsys):
    path = str(tmp_path / "rows")
    mixed_rows(spark).write.parquet(path)
    hybrid_search(spark.read.parquet(path), mixed_parts(spark), 8).explain("formatted")
    plan = capsys.readouterr().out.split("\n\n")[0]
    assert plan.count("MapInArrow") == 1 and plan.count("Scan parquet") == 1


def test_parts_with_other_ids_run_on_their_own(spark):
    docs, parts = mixed_rows(spark), mixed_parts(spark)
    named = SubQuery("text", "t", spark.createDataFrame([("1", "green")], "qid string, text string"), 5)
    assert search._scorers(docs, [parts[0], named]) is None
    assert search._scorers(docs, parts) is not None
