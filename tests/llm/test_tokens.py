import base64
import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F

from plumbline.llm import byte_bpe, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = [
    "a", "the", "ing", " ", "  ", "\n", "\t", "é", "中文", "😀", "<s>", "</s>", "▁", "\x00", "ß", "23", "!!", "un",
    "believ", "\r\n", "\xa0", "'s", "A", "<0x0A>", "====", " " * 17, "한국",
]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randrange(25))) for _ in range(400)] + ["z" * 5000]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def docs(spark, texts, odd_docs):
    rows = [(1000 + i, t) for i, t in enumerate(texts)]
    return odd_docs.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string"))


def test_every_prefix_is_exact(texts, library):
    counter = token_counts.PrefixCounter(MODEL)
    for text in texts[:120]:
        counts = counter.prefixes(text)
        assert len(counts) == len(text)
        assert counts.tolist() == [len(library.encode(text[:i])) for i in range(1, len(text) + 1)]


def test_totals_match_the_library(docs, library):
    found = token_counts.with_totals(token_counts.prefix_counts(docs, MODEL))
    joined = {(r.doc_id): r for r in found.collect()}
    assert found.count() == docs.count()
    for r in docs.collect():
        text = r.text or ""
        n = len(library.encode(text))
        assert (joined[r.doc_id].n_bytes, joined[r.doc_id].n_tokens) == (len(text.encode()), n)
        assert joined[r.doc_id].over_limit == (n > 4096)


def test_budgets_are_look_ups(spark, library):
    text = "unbelievable  things are said here"
    docs = spark.createDataFrame([(1, text), (2, ""), (3, None)], "doc_id long, text string")
    counted = token_counts.prefix_counts(docs, MODEL)
    for budget in (0, 1, 3, 5, 100):
        rows = counted.select(
            "doc_id",
            token_counts.longest_within(F.col("counts"), F.lit(budget)).alias("fits"),
            token_counts.tokens_of_prefix(F.col("counts"), F.lit(budget)).alias("tokens"),
        )
        got = {r.doc_id: (r.fits, r.tokens) for r in rows.collect()}
        fits = max([0] + [i for i in range(1, len(text) + 1) if len(library.encode(text[:i])) <= budget])
        assert got[1] == (fits, len(library.encode(text[:budget])))
        assert got[2] == got[3] == (0, 0)


def test_bytes_round_trip_and_match_tiktoken(docs):
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoded = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    rows = byte_bpe.decode(encoded, RANKS).withColumn("joined", byte_bpe.ids_text(F.col("ids"))).collect()
    assert len(rows) == docs.count()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for row in rows:
        ids = library.encode_ordinary(texts[row.doc_id])
        assert list(row.ids) == ids
        assert bytes(row.bytes) == texts[row.doc_id].encode()
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert hashlib.sha256(row.joined.encode()).hexdigest() == digest


def test_token_that_merges_do_not_build_stays_whole():
    coder = byte_bpe.Codec(RANKS, public_tokenizers.PATTERN)
    for token in coder.tokens[::997]:
        try:
            text = token.decode()
        except UnicodeDecodeError:
            continue
        if coder.split(text) == [text]:
            assert coder.encode(text) == [coder.tokens.index(token)]


def test_no_documents(no_docs):
    assert token_counts.prefix_counts(no_docs, MODEL).count() == 0
    assert byte_bpe.decode(byte_bpe.encode(no_docs, RANKS, public_tokenizers.PATTERN), RANKS).count() == 0


def test_a_batch_of_texts_is_counted_at_once():
    rng = random.Random(8)
    signs = [*"aZ9'.,_ \n\té中か½²\x1c\x7f\u3000\u00a0\u0085\u200b\u180e\ufeff\u0301", "  ", "'s", "'re", " ll", "😀", "\r\n", " the"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(30))) for _ in range(2000)] + ["", "x" * 5000, None]
    for pattern in (public_tokenizers.PATTERN, r"\s+|\S+"):
        coder, asked = byte_bpe.Codec(RANKS, pattern), []
        inner = coder._counts
        coder._counts = lambda raw: asked.append(len(raw)) or inner(raw)
        # A slice begins inside the buffers.
        found = coder.counts(pa.array(["before", *texts]).slice(1)).tolist()
        assert found == [len(coder.encode(t or "")) for t in texts]
        assert len(asked) <= sum(asked) // byte_bpe.JOINED + 1
        coder.counts(pa.array(texts[:50]))
        assert coder.counts(pa.array([], pa.string())).tolist() == [] and coder.count("") == 0
