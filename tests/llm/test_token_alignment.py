import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from plumbline.functions import joins, sizing
from plumbline.llm import token_alignment as ta

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
PIECES = [
    "a", "the", "ing", " ", " ", "  ", "\n", "\t", "é", "中文", "😀", "<s>", "</s>", "<|endoftext|>", "\x00", "ß", "23",
    "!!", "un", "believ", "\r\n", "\xa0", "'s", "A", "<0x0A>", "====", " " * 17, "한국", "​", "\x1c", "　", "'",
]
ALIGNED = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def brute_force(texts):
    """Straight from the definition: whole texts, byte by byte."""
    tokenizer = Tokenizer.from_file(A_PATH)
    tokenizer.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    back = {c: b for b, c in enumerate(ta.byte_characters())}
    rows, counts = [], Counter()
    for text in texts:
        tokens_a, tokens_b = [], []
        if text:
            for i in tokenizer.encode(" " + text, add_special_tokens=False).ids:
                tokens_a.append((i, bytes(back[c] for c in tokenizer.id_to_token(i))))
            for i in model.encode(text):
                piece = model.id_to_piece(i)
                spelled = bytes([int(piece[3:5], 16)]) if model.IsByte(i) else piece.replace("▁", " ").encode()
                tokens_b.append((i, spelled))
            whole = (" " + text).encode()
            if any(b"".join(t for _, t in side) != whole for side in (tokens_a, tokens_b)):
                tokens_a, tokens_b = [], []
        spans = []
        for side in (tokens_a, tokens_b):
            at, found = 0, []
            for i, t in side:
                found.append((at, at + len(t), i))
                at += len(t)
            spans.append(found)
        ends = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, before = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(i) for s, e, i in side if before <= s and e <= end) for side in spans))
            before = end
        links = [(i, j) for s, e, i in spans[0] for t, f, j in spans[1] if s < f and t < e]
        counts.update(set(links))
        rows.append((len(tokens_a), len(tokens_b), groups, links))
    most = {}
    for (i, _), n in counts.items():
        most[i] = max(most.get(i, 0), n)
    out = []
    for n_a, n_b, groups, links in rows:
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else ""
        n_best = sum(counts[x] == most[x[0]] for x in links)
        out.append((n_a, n_b, len(groups), len(links), n_best, sum(counts[x] for x in links), digest))
    return out


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    odd = [None, "", " ", "▁", "a ▁b", " lead", "trail ", "word", "word", "a  b", "<|endoftext|>", "⁠ x"]
    return odd + ["".join(rng.choice(PIECES) for _ in range(rng.randrange(30))) for _ in range(150)]


def test_texts_align_as_by_definition(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: tuple(r[c] for c in ALIGNED) for r in ta.align_corpus(docs, A_PATH, B_PATH).collect()}
    assert rows == dict(enumerate(brute_force(texts)))


def test_groups_are_kept_when_asked_for(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in ta.align(docs, A_PATH, B_PATH, keep_groups=True).collect():
        assert r.groups_sha256 == (hashlib.sha256(r.groups.encode()).hexdigest() if r.n_a else "")
        assert sum(r.times) == r.n_links and len(r.groups.split(";")) == max(1, r.n_groups)


def test_intervals_with_gaps_coalesce():
    spans = lambda *x: (np.array([s for s, _ in x]), np.array([e for _, e in x]))
    a, b = spans((0, 2), (2, 5), (9, 10)), spans((1, 3), (5, 6), (7, 12))
    group_a, group_b = ta.coalesce(*a, *b)
    assert group_a.tolist() == [0, 0, 2]
    assert group_b.tolist() == [0, 1, 2]
    left, right = ta.overlaps(*a, *b)
    assert list(zip(left.tolist(), right.tolist())) == [(0, 0), (1, 0), (2, 2)]


def test_many_pairs_take_the_salted_join(spark, texts, monkeypatch):
    monkeypatch.setattr(joins, "SALT_ROWS", 3)
    monkeypatch.setattr(joins, "broadcast_if_small", lambda df, limit=0: sizing.broadcast_if_small(df, -1))
    docs = spark.createDataFrame(list(enumerate(texts[:40])), "doc_id long, text string")
    rows = {r.doc_id: tuple(r[c] for c in ALIGNED) for r in ta.align_corpus(docs, A_PATH, B_PATH).collect()}
    assert rows == dict(enumerate(brute_force(texts[:40])))


def test_odd_documents(spark, odd_docs, no_docs):
    texts = [r.text for r in odd_docs.collect()]
    rows = ta.align_corpus(odd_docs, A_PATH, B_PATH).collect()
    found = sorted(tuple(r[c] for c in ALIGNED) for r in rows)
    assert found == sorted(brute_force(texts))
    assert ta.align_corpus(no_docs, A_PATH, B_PATH).count() == 0


def test_a_very_long_text(spark):
    text = "una palabra y otra más " * 100_000 + "x" * 20_000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = ta.align_corpus(docs, A_PATH, B_PATH).first()
    assert row.n_a == len(Tokenizer.from_file(A_PATH).encode(" " + text).ids)
    assert row.n_b == len(sentencepiece.SentencePieceProcessor(model_file=B_PATH).encode(text))
    assert row.count_sum == row.n_links
