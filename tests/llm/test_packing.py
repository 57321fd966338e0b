import random
from collections import defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from plumbline.llm import byte_bpe, packing, queries


def check(rows, capacities=packing.CAPACITIES):
    bins = defaultdict(list)
    for r in rows:
        bins[r.bin_id].append(r)
    for held in bins.values():
        held.sort(key=lambda r: r.bin_offset)
        at = 0
        for r in held:
            assert r.bin_offset == at
            at += r.length
        assert {r.bin_used for r in held} == {at}
        fitting = [c for c in capacities if c >= at]
        assert {r.bin_capacity for r in held} == {min(fitting)}
    return bins


def test_every_token_is_packed_once(spark):
    rng = random.Random(1)
    lengths = [rng.choice([1, 5, 40, 300, 900, 3000, 8192, 20000]) for _ in range(500)]
    docs = spark.createDataFrame([(i, n, "x") for i, n in enumerate(lengths)], "doc_id long, n int, piece string")
    rows = packing.pack(docs, F.col("n"), shard_pieces=150).collect()
    check(rows)
    spans = defaultdict(list)
    for r in rows:
        spans[r.doc_id].append((r.start, r.length))
    for i, n in enumerate(lengths):
        at = 0
        for start, length in sorted(spans[i]):
            assert start == at
            at += length
        assert at == n


def test_best_fit_takes_the_fullest_open_bin():
    assert packing.best_fit([6, 5, 4, 3, 2], [10], float) == ([0, 1, 0, 1, 1], [10, 10])
    # The last bin shrinks to what it holds.
    assert packing.best_fit([6, 6, 3], [4, 10], float)[1] == [10, 10]
    assert packing.best_fit([3], [4, 10], float) == ([0], [4])


def test_openings_are_chosen_by_cost():
    lengths = sorted([500] * 40 + [12] * 40, reverse=True)
    best = packing.best_packing(lengths)
    cost = sum(map(packing.sequence_cost, best[1]))
    for smallest in packing.CAPACITIES:
        assert cost <= sum(map(packing.sequence_cost, packing.best_fit(lengths, smallest=smallest)[1]))
    flat = packing.best_packing([300] * 27, cost=lambda c: 1.0)
    assert flat[1] == [8192]


def brute_minimum(lengths, capacities, cost):
    """The cheapest packing over all partitions of a few pieces."""
    def parts(items):
        if not items:
            yield []
            return
        first, rest = items[0], items[1:]
        for part in parts(rest):
            yield [[first], *part]
            for k in range(len(part)):
                yield [*part[:k], [first, *part[k]], *part[k + 1 :]]

    def price(bin_):
        fits = [cost(c) for c in capacities if c >= sum(bin_)]
        return min(fits) if fits else float("inf")

    return min(sum(map(price, p)) for p in parts(lengths))


def test_close_to_the_optimum():
    rng = random.Random(3)
    total = best = 0
    for _ in range(40):
        lengths = sorted((rng.randint(1, 30) for _ in range(7)), reverse=True)
        cost = lambda c: c * (1 + c / 64)
        total += sum(map(cost, packing.best_packing(lengths, (8, 16, 32), cost)[1]))
        best += brute_minimum(lengths, (8, 16, 32), cost)
    assert total <= 1.1 * best


@pytest.mark.parametrize("shard_pieces", [20_000, 2])
def test_odd_documents(odd_docs, no_docs, shard_pieces):
    rows = packing.pack(odd_docs, shard_pieces=shard_pieces).collect()
    check(rows)
    lengths = defaultdict(int)
    for r in rows:
        lengths[r.doc_id] += r.length
    assert lengths[0] == lengths[1] == lengths[2] == packing.SEPARATOR
    assert lengths[6] == 8000 + packing.SEPARATOR and lengths[None] == 6 + packing.SEPARATOR
    assert packing.pack(no_docs).count() == 0


def test_rows_that_repeat_are_packed_each(spark):
    docs = spark.createDataFrame([(1, "a b c")] * 4, "doc_id long, text string")
    rows = packing.pack(docs).collect()
    check(rows)
    assert len(rows) == 4


def test_the_query_counts_tokens_also_without_white_space(spark, tmp_path):
    rng = random.Random(5)
    texts = [
        "".join(rng.choice("ABCDEFGHabcdefgh0123456789+/") for _ in range(30_000)),
        "".join(chr(rng.randint(0x4E00, 0x9FA5)) for _ in range(9_000)),
        "Some ordinary prose, shorter than its tokens.",
        "",
        None,
    ]
    rows = [(i, text) for i, text in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    coder = byte_bpe.codec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    rows = queries.op10_best_fit_packing(spark, str(tmp_path)).collect()
    check(rows)
    found = defaultdict(int)
    for r in rows:
        found[r.doc_id] += r.length
    assert found == {i: len(coder.encode(t or "")) + packing.SEPARATOR for i, t in enumerate(texts)}
    assert found[0] > 8192 and found[1] > 8192


def test_counts_stay_the_same_when_memory_is_given_back(spark):
    texts = [None, "", "a", "one two three " * 400, "x" * 3000] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    kept = byte_bpe.lengths(docs, path, pattern)
    given = byte_bpe.lengths(docs, path, pattern, remembered=10, release=True)
    assert sorted(kept.collect()) == sorted(given.collect())
