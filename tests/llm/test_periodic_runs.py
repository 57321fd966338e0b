import hashlib
import random
import zlib

import numpy as np
import pytest

from plumbline.llm import periodic_runs as pr
from plumbline.llm import queries

# Sizes at which every text is cut into many tiles, and those of the query.
TILES = {"tile_bytes": -1, "core_words": 16, "low_octave": 2}
ROUTES = [{}, TILES, {"tile_bytes": -1}]


def brute_runs(words, least=pr.MIN_WORDS):
    """Every maximal stretch of equal words p apart, without those of a smaller period."""
    n, found = len(words), {}
    for p in range(1, n // 2 + 1):
        start = None
        for i in range(n - p + 1):
            if i < n - p and words[i] == words[i + p]:
                start = i if start is None else start
            elif start is not None:
                length = i - start + p
                if length >= max(least, 2 * p) and (start, i + p) not in found:
                    found[start, i + p] = p
                start = None
    return sorted((s, e - s, p) for (s, e), p in found.items())


def brute_collapsed(words, runs):
    dropped = {i for s, length, p in runs for i in range(s + p, s + length)}
    return b" ".join(w for i, w in enumerate(words) if i not in dropped)


def texts_with_runs(seed, count, longest=150):
    rng = random.Random(seed)
    texts = []
    for _ in range(count):
        letters = rng.choice(["a", "ab", "abc", "abcdefgh"])
        words = [rng.choice(letters) for _ in range(rng.randrange(longest))]
        for _ in range(rng.randrange(3)):
            period = [rng.choice(letters) for _ in range(rng.randint(1, 25))]
            at = rng.randrange(len(words) + 1)
            words[at:at] = (period * 9)[: rng.randrange(len(period) * 6)]
        texts.append(" ".join(words))
    fib = ["a", "b"]
    for _ in range(9):
        fib.append(fib[-1] + fib[-2])
    return [*texts, " ".join(fib[-1]), " ".join("a" * 200), " ".join("ab" * 77), "", " x ", None]


def test_z_function():
    rng = random.Random(1)
    for _ in range(50):
        s = [rng.randrange(2) for _ in range(rng.randrange(30))]
        common = lambda i: next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i)
        assert pr.z_function(s) == [common(i) for i in range(len(s))]


@pytest.mark.parametrize("few", [0, 1000])
def test_both_ways_at_a_boundary(few, monkeypatch):
    monkeypatch.setattr(pr, "FEW_SHIFTS", few)
    texts = [(t or "").encode().split() for t in texts_with_runs(2, 60)]
    assert [sorted(r) for r in pr.shared_runs(texts)] == [brute_runs(t) for t in texts]


@pytest.mark.parametrize("route", ROUTES)
def test_runs_and_rests_as_by_definition(spark, route):
    texts = texts_with_runs(3, 80)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in pr.find_runs(docs, **route).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        words = (text or "").encode().split()
        expected = brute_runs(words)
        assert [tuple(r) for r in rows[i].runs] == sorted(expected, key=lambda r: (r[0], r[2]))
        assert bytes(rows[i].collapsed) == brute_collapsed(words, expected)
        assert rows[i].n_words == len(words)


@pytest.mark.parametrize("least", [2, 5, 40])
def test_other_least_lengths(spark, least):
    texts = texts_with_runs(4, 40)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for route in ROUTES[:2]:
        for r in pr.find_runs(docs, least=least, **route).collect():
            words = (texts[r.doc_id] or "").encode().split()
            assert [tuple(x) for x in r.runs] == sorted(brute_runs(words, least), key=lambda x: (x[0], x[2]))


def test_the_query_plants_runs_by_the_hash_of_the_id(spark, tmp_path):
    texts = texts_with_runs(5, 90)
    rows = list(enumerate(texts)) + [(None, "a null id " * 9), (7, texts[7])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op11_periodic_runs(spark, str(tmp_path)).collect()
    expected = []
    for i, text in rows:
        words = (text or "").encode().split()
        n, h = len(words), zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
        runs = sorted(brute_runs(words), key=lambda r: (r[0], r[2]))
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        milli = 1000 * best[1] // best[2] if runs else None
        digests = [hashlib.sha256(x).hexdigest() for x in (lines.encode(), brute_collapsed(words, runs))]
        expected.append((i, len(runs), *best, milli, *digests))
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
    assert sum(1 for r in found if zlib.crc32(str(r.doc_id).encode()) % 10 == 0) >= 5


@pytest.mark.parametrize("route", ROUTES)
def test_odd_documents(odd_docs, no_docs, route):
    texts = {r.doc_id: r.text for r in odd_docs.collect()}
    rows = pr.find_runs(odd_docs, **route).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        words = (texts[r.doc_id] or "").encode().split()
        assert r.n_words == len(words)
        if len(words) == 8000:
            assert [tuple(x) for x in r.runs] == [(0, 8000, 20)]
        else:
            assert [tuple(x) for x in r.runs] == brute_runs(words)
    assert pr.find_runs(no_docs, **route).count() == 0


def test_a_very_long_text_is_cut_and_stitched(spark):
    rng = random.Random(6)
    head = [f"w{rng.randrange(50_000)}" for _ in range(90_000)]
    period = [f"p{rng.randrange(50_000)}" for _ in range(70_001)]
    words = [*head, *period, *period, *period[:11], *["na"] * 120_000, "end"]
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    row = pr.find_runs(docs).first()
    found = {tuple(r) for r in row.runs}
    assert (90_000, 2 * 70_001 + 11, 70_001) in found
    assert (90_000 + 2 * 70_001 + 11, 120_000, 1) in found
    assert bytes(row.collapsed).count(b"na") == 1
    assert np.all([length >= max(12, 2 * p) for _, length, p in found])
