import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from plumbline.functions import joins, sizing
from plumbline.llm import queries
from plumbline.llm import suffix_family as sf


def brute_force(texts, length):
    """(kept bytes, removed runs) of every text, by counting all strings."""
    raw = [(t or "").encode() for t in texts]
    counts = Counter(t[i : i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for t in raw:
        gone = np.zeros(len(t) + 1, dtype=bool)
        for i in range(len(t) - length + 1):
            if counts[t[i : i + length]] > 1:
                gone[i : i + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone]).astype(np.int8)))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((kept, list(zip(edges[::2].tolist(), edges[1::2].tolist()))))
    return out


def passages(seed, count, longest, alphabet="abcdef é中"):
    """Texts put together from new letters and passages that others have too, whole or in part."""
    rng = random.Random(seed)
    new = lambda n: "".join(rng.choice(alphabet) for _ in range(rng.randrange(n)))
    common = [new(3 * longest) + "x" for _ in range(8)]
    texts = []
    for _ in range(count):
        text = new(longest)
        for _ in range(rng.randrange(4)):
            p = rng.choice(common)
            a = rng.randrange(len(p))
            text += p[a : a + rng.randrange(2 * longest)] + new(longest)
        texts.append(text)
    return [*texts, texts[0], texts[1], "a" * 4 * longest, "ab" * 2 * longest, "", None, "short", common[0]]


def check(spark, texts, length, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in sf.remove_repeats(docs, length, **options).collect()}
    assert len(rows) == len(texts)
    for i, (kept, spans) in enumerate(brute_force(texts, length)):
        assert list(zip(rows[i].starts or [], rows[i].ends or [])) == spans, i
        assert bytes(rows[i].kept) == kept and rows[i].n_bytes == len((texts[i] or "").encode())


@pytest.mark.parametrize("batches", [1, 4, 7])
def test_repeats_go_whatever_the_batches(spark, batches):
    check(spark, passages(1, 60, 60), 24, beginning=10, batches=batches)


@pytest.mark.parametrize("beginning", [8, 23])
def test_groups_too_large_for_one_task(spark, beginning):
    check(spark, passages(2, 60, 60), 24, beginning=beginning, batches=3, group_rows=1)


def test_joins_that_shuffle(spark, monkeypatch):
    never = lambda df, limit=0: sizing.broadcast_if_small(df, -1)
    monkeypatch.setattr(joins, "SALT_ROWS", 5)
    monkeypatch.setattr(joins, "broadcast_if_small", never)
    monkeypatch.setattr(sf, "broadcast_if_small", never)
    check(spark, passages(3, 40, 60), 24, beginning=10, batches=2)


def test_edges_by_one_byte(spark):
    """Strings that share exactly, one less and one more than the length, everywhere in a text."""
    rng = random.Random(4)
    noise = lambda n: "".join(chr(rng.randrange(97, 123)) for _ in range(n))
    texts = []
    for n in (199, 200, 201, 260, 399, 400):
        shared = noise(n)
        texts += [noise(5) + shared + noise(300), noise(333) + shared, shared]
        other = shared[: n // 2] + "#" + shared[n // 2 + 1 :]
        texts.append(noise(50) + other + noise(50))
    texts += [(noise(150) + "-") * 3, noise(90) + "\x00" * 500 + noise(90), "\x00" * 201]
    check(spark, texts, 200)


def test_strings_in_memory():
    """The comparison of both arrays against all pairs of suffixes."""
    rng = random.Random(5)
    text = "".join(rng.choice("ab") for _ in range(3000)).encode()
    sample = sf.Sample([text], 30, 10)
    after, before = sample.surroundings()
    several = np.zeros(len(sample.at), dtype=bool)
    found = sf.repeated_strings(sample.beginnings(), sample.first, sample.last, after, before, several, 30)
    counts = Counter(text[i : i + 30] for i in range(len(text) - 29))
    for r, at in enumerate(sample.at.tolist()):
        for o in range(found.shape[1]):
            chosen = sample.last[r] <= o <= sample.first[r]
            assert found[r, o] == bool(chosen and counts[text[at - o : at - o + 30]] > 1)
    starts = [at - o for at, f, la in zip(sample.at, sample.first, sample.last) for o in range(la, f + 1)]
    assert sorted(starts) == list(range(len(text) - 29))


def test_levels_double(spark):
    family, seen = sf.SuffixFamily(), Counter()
    for batch in ([1, 2, 2], [3, 1], [4], [5, 5, 3], [6, 1], [7], [8]):
        fresh = spark.createDataFrame([(x,) for x in batch], "h long")
        met = {r.h for r in family.add(fresh).collect()}
        own = Counter(batch)
        assert met == {x for x in batch if own[x] > 1 or seen[x]}
        seen.update(batch)
    assert sorted(family.levels) == [0, 1, 2]
    assert {r.h for frame in family.levels.values() for r in frame.collect()} == set(seen)


def test_odd_documents(spark, odd_docs, no_docs, tmp_path):
    texts = [(r.doc_id, r.text) for r in odd_docs.collect()]
    expected = brute_force([t for _, t in texts], 200)
    found = sf.remove_repeats(odd_docs).collect()
    assert sorted((str(r.doc_id), bytes(r.kept)) for r in found) == sorted(
        (str(i), kept) for (i, _), (kept, _) in zip(texts, expected)
    )
    assert sf.remove_repeats(no_docs).count() == 0
    twice = odd_docs.union(odd_docs)
    assert sum(len(r.kept) for r in sf.remove_repeats(twice).collect()) == sum(
        2 * len((t or "").encode()) for _, t in texts if len((t or "").encode()) < 200
    )
    twice.write.parquet(str(tmp_path / "documents.parquet"))
    rows = queries.op13_suffix_family(spark, str(tmp_path)).collect()
    long = [t for _, t in texts if t and len(t.encode()) >= 200]
    assert sum(r.n_removed for r in rows) == 2 * sum(len(t.encode()) for t in long)
    assert sum(r.n_spans for r in rows) == 2 * len(long)
    nothing = hashlib.sha256(b"").hexdigest()
    assert all(r.kept_sha256 == nothing for r in rows if r.doc_id == 1 or r.n_removed)


def test_a_very_long_text(spark):
    rng = random.Random(6)
    head = "".join(chr(rng.randrange(97, 123)) for _ in range(3_000_000))
    n = len(head)
    docs = spark.createDataFrame([(1, f"{head}#{head[5000:6000]}#"), (2, f"{head[-250:]}!")], "doc_id long, text string")
    rows = {r.doc_id: r for r in sf.remove_repeats(docs).collect()}
    assert list(zip(rows[1].starts, rows[1].ends)) == [(5000, 6000), (n - 250, n), (n + 1, n + 1001)]
    assert bytes(rows[2].kept) == b"!"


def test_settings_are_checked(odd_docs):
    for beginning in (7, 200):
        with pytest.raises(ValueError):
            sf.remove_repeats(odd_docs, beginning=beginning)
