"""Byte-level BPE through a sentencepiece model that is serialised from the vocabulary.

Each byte of a token becomes one visible character, the token's score is its negative rank,
and normalisation is the identity; the model so written merges the same pairs in the same
order as the ranks do. Texts are cut into pre-tokens by the published pattern, pre-tokens are encoded as
byte characters, and ids decode through the inverse mapping.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import Column, give_back, small_batches

CACHED_PRETOKENS = 300_000
# Chunks with their counts, in each of two generations.
CACHED_COUNTS = 340_000
# The usual pattern of byte-level vocabularies, a fixed value.
SPACED_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Chunks that are one match of it.
ONE_MATCH = re.compile(rb" ?(?:[A-Za-z]+|[0-9]+|[!-&(-/:-@\[-`{-~]+)").fullmatch
# Pre-tokens that are encoded as one string.
JOINED = 1_000
# Longer pre-tokens are rare and not worth remembering.
LONG_PRETOKEN = 64
# Texts handed over at once.
PART_ROWS = 256


def byte_characters() -> list[str]:
    """A visible character for each byte: printable Latin-1 stands for itself, the rest follows
    from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


def _varint(value: int) -> bytes:
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    return bytes([*out, value])


def _field(number: int, value: bytes | int) -> bytes:
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def _piece(text: str, score: float, kind: int) -> bytes:
    body = _field(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _field(3, kind)
    return _field(1, body)


def serialise(tokens: list[bytes]) -> bytes:
    """A sentencepiece model of the tokens, which come in order of rank.

    Fixed values of the public model format: piece kinds normal 1 and unknown 2; model type
    BPE 2; trainer fields model type 3, vocabulary size 4, unknown id 40; normaliser fields
    name 1, dummy prefix 3, extra white space 4, escaped white space 5.
    """
    characters = byte_characters()
    out = [_piece("".join(characters[b] for b in token), -float(rank), 1) for rank, token in enumerate(tokens)]
    # The unknown piece comes last, so that ids are ranks. Every byte has a piece, so it is never used.
    out.append(_piece("<unk>", 0.0, 2))
    trainer = _field(3, 2) + _field(4, len(tokens) + 1) + _field(40, len(tokens))
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(out) + _field(2, trainer) + _field(3, normaliser)


def read_ranks(path: str) -> list[bytes]:
    """Tokens in order of rank from a file of base64 tokens and ranks."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    tokens = {int(rank): base64.b64decode(token) for token, rank in pairs}
    return [tokens[rank] for rank in range(len(tokens))]


# What a byte is: a letter, a digit, an apostrophe, another visible ASCII character, a space, other
# white space; 0 where that takes more than this byte.
LETTER, DIGIT, APOSTROPHE, OTHER, SPACE, BREAK = range(1, 7)


def _byte_kinds() -> np.ndarray:
    kinds = np.zeros(256, dtype=np.uint8)
    kinds[0x21:0x7F] = OTHER
    for first, last, kind in (("A", "Z", LETTER), ("a", "z", LETTER), ("0", "9", DIGIT), ("\t", "\r", BREAK)):
        kinds[ord(first) : ord(last) + 1] = kind
    kinds[ord("'")], kinds[ord(" ")] = APOSTROPHE, SPACE
    return kinds


def _ends() -> np.ndarray:
    """Whether a match of ``SPACED_PATTERN`` always ends between bytes of two kinds: letters, digits
    and others only go on in their own kind, but for an apostrophe before letters, and none goes
    on with white space; of white space only a space may begin the next match."""
    ends = np.zeros((7, 7), dtype=bool)
    ends[LETTER : OTHER + 1, SPACE : BREAK + 1] = True
    ends[LETTER, DIGIT : OTHER + 1] = True
    ends[DIGIT, [LETTER, APOSTROPHE, OTHER]] = True
    ends[OTHER, LETTER : DIGIT + 1] = True
    ends[BREAK, LETTER : OTHER + 1] = True
    return ends


BYTE_KINDS, ENDS = _byte_kinds(), _ends().ravel()


def match_ends(data: np.ndarray) -> np.ndarray:
    """Places in UTF-8 bytes where a match of ``SPACED_PATTERN`` surely ends; not all of them."""
    kinds = BYTE_KINDS[data]
    sure = ENDS[kinds[:-1] * np.uint8(7) + kinds[1:]]
    # Before a space also behind letters and signs of two or three bytes; the leading bytes named
    # here begin no white space and none of the characters that only some Unicode versions count as such.
    at = np.flatnonzero((kinds[1:] == SPACE) & (data[:-1] >= 0x80)) + 1
    two, three = data[np.maximum(at - 2, 0)], data[np.maximum(at - 3, 0)]
    known = ((two >= 0xC3) & (two <= 0xDF)) | ((three >= 0xE4) & (three <= 0xEE))
    sure[at[known] - 1] = True
    return np.flatnonzero(sure) + 1


def _merged(places: np.ndarray, more: np.ndarray) -> np.ndarray:
    """Ascending places without repeats, of two ascending lists."""
    marked = np.zeros(int(places[-1]) + 1, dtype=bool)
    marked[places] = True
    marked[more] = True
    return np.flatnonzero(marked)


class Remembered:
    """Numbers by text in two generations: what is asked for again moves to the younger one."""

    def __init__(self, most: int) -> None:
        self.most = most
        self.young: dict[bytes, int] = {}
        self.old: dict[bytes, int] = {}
        self.long: list[bytes] = []

    def all(self, asked: list[bytes], compute: Callable[[list[bytes]], list[int]]) -> list[int]:
        """The numbers of distinct texts."""
        young, old = self.young, self.old
        missing = [text for text in asked if text not in young]
        if missing:
            new = [text for text in missing if text not in old]
            if len(new) < len(missing):
                young.update({text: old[text] for text in missing if text in old})
            if new:
                young.update(zip(new, compute(new)))
                self.long += [text for text in new if len(text) > LONG_PRETOKEN]
        found = [young[text] for text in asked]
        self._settle()
        return found

    def _settle(self) -> None:
        """Forget long texts, and the older generation when the younger is full."""
        for text in self.long:
            self.young.pop(text, None)
        self.long.clear()
        if len(self.young) > self.most:
            self.young, self.old = {}, self.young


class Codec:
    """Encodes and decodes whole texts with the ranks of one file."""

    def __init__(self, path: str, pattern: str):
        self.tokens = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(self.tokens))
        self.split = regex.compile(pattern).findall
        self.visible = str.maketrans({chr(b): c for b, c in enumerate(byte_characters())})
        # A pre-token that is a token stays whole even where merges would not build it.
        self.whole = {token: rank for rank, token in enumerate(self.tokens)}
        self.cache: dict[str, bytes] = {}
        self.spaced = pattern == SPACED_PATTERN
        self.counted = Remembered(CACHED_COUNTS)

    def _fill(self, pretokens: set[str]) -> dict[str, bytes]:
        """The ids of new pre-tokens, as the bytes of 32-bit integers."""
        new = list(pretokens)
        raw = [p.encode() for p in new]
        shown = [r.decode("latin-1").translate(self.visible) for r in raw]
        found = self.model.encode(shown, num_threads=1)
        ids = ([self.whole[r]] if r in self.whole else ids for r, ids in zip(raw, found))
        return {p: np.array(x, dtype=np.int32).tobytes() for p, x in zip(new, ids)}

    def encode_bytes(self, text: str) -> bytes:
        parts, known = self.split(text), self.cache
        missing = set(parts).difference(known)
        fresh = self._fill(missing) if missing else {}
        if len(known) + len(fresh) > CACHED_PRETOKENS:
            known.clear()
            fresh |= self._fill(set(parts).difference(fresh))
        known.update(fresh)
        ids = b"".join([known[part] for part in parts])
        for part in fresh:
            if len(part) > LONG_PRETOKEN:
                del known[part]
        return ids

    def _counts(self, raw: list[bytes]) -> list[int]:
        """How many ids each pre-token has; many are encoded together, a line each, as a line end
        is in no token and so comes back as the unknown piece."""
        shown = [r.decode("latin-1").translate(self.visible) for r in raw]
        ids = np.array(self.model.encode("\n".join(shown)), dtype=np.int32)
        ends = np.append(np.flatnonzero(ids == len(self.tokens)), len(ids))
        if len(ends) != len(raw):
            return [len(self.encode_bytes(r.decode())) // 4 for r in raw]
        sizes = np.diff(ends, prepend=-1) - 1
        return [1 if r in self.whole else n for r, n in zip(raw, sizes.tolist())]

    def _count_chunks(self, chunks: list[bytes]) -> list[int]:
        parts: list[bytes] = []
        more: list[tuple[int, int]] = []
        for number, chunk in enumerate(chunks):
            if self.spaced and ONE_MATCH(chunk):
                parts.append(chunk)
                continue
            found = self.split(chunk.decode())
            if len(found) != 1:
                more.append((number, len(found)))
            parts += [part.encode() for part in found]
        counts: list[int] = []
        for start in range(0, len(parts), JOINED):
            counts += self._counts(parts[start : start + JOINED])
        if not more:
            return counts
        # The parts of a chunk lie one after the other.
        sizes = np.ones(len(chunks), dtype=np.int64)
        for number, size in more:
            sizes[number] = size
        ends = np.concatenate([[0], np.cumsum(np.array(counts, dtype=np.int64))])
        last = np.cumsum(sizes)
        return (ends[last] - ends[last - sizes]).tolist()

    def counts(self, texts: pa.Array) -> np.ndarray:
        """The number of ids of each text, without building them. Texts are cut where matches surely
        end, and of what comes again only one is counted."""
        texts = texts.cast(pa.large_string())
        places = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        if len(texts) == 0 or places[0] == places[-1]:
            return np.zeros(len(texts), dtype=np.int64)
        data = texts.buffers()[2].slice(places[0], places[-1] - places[0])
        places = places - places[0]
        more = match_ends(np.frombuffer(data, dtype=np.uint8)) if self.spaced else places
        cuts = _merged(places, more)
        chunks = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), data])
        coded = chunks.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        counts = np.array(self.counted.all(distinct, self._count_chunks), dtype=np.int64)
        ends = np.concatenate([[0], np.cumsum(counts[np.asarray(coded.indices)])])
        return np.diff(ends[np.searchsorted(cuts, places)])

    def count(self, text: str) -> int:
        return int(self.counts(pa.array([text]))[0])

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), dtype=np.int32).tolist()


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One codec per worker and file."""
    return Codec(path, pattern)


@lru_cache(maxsize=2)
def tokens_of(path: str) -> pa.BinaryArray:
    return pa.array(read_ranks(path), pa.binary())


def encode(
    docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of every whole text; null and empty texts have no
    ids. Repeated rows and null ids stay; other columns are not carried."""
    small_batches(docs.sparkSession)
    chosen = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(text_column, F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, PART_ROWS):
                part = batch.slice(start, PART_ROWS)
                found = [coder.encode_bytes(text.as_py()) for text in part.column("text")]
                ends = np.cumsum([0, *(len(x) // 4 for x in found)]).astype(np.int32)
                flat = pa.array(np.frombuffer(b"".join(found), dtype=np.int32))
                arrays = [part.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), flat)]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "ids"])

    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"doc_id {kind}, ids array<int>")


def lengths(
    docs: DataFrame,
    path: str,
    pattern: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    remembered: int = CACHED_COUNTS,
    release: bool = False,
) -> DataFrame:
    """``doc_id`` and ``n_tokens``, the number of ids of every whole text; rows as in ``encode``.

    A worker remembers the counts of up to twice ``remembered`` chunks: fewer take less memory and
    more time. With ``release`` it gives the vocabulary and the counts back at the end of each task
    and reads the vocabulary again in the next one, for jobs whose later stages need the memory.
    """
    small_batches(docs.sparkSession)
    chosen = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(text_column, F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path, pattern)
        coder.counted.most = remembered
        for batch in batches:
            arrays = [batch.column("doc_id"), pa.array(coder.counts(batch.column("text")))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_tokens"])
        if release:
            del coder
            codec.cache_clear()
            give_back()

    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"doc_id {kind}, n_tokens long")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``ids`` and their ``bytes``, the inverse of ``encode``; null ids decode to
    no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(path)
        for batch in batches:
            for start in range(0, batch.num_rows, PART_ROWS):
                part = batch.slice(start, PART_ROWS)
                lists = part.column("ids").fill_null([])
                # Tokens taken one after the other already lie as the bytes of the texts.
                taken = tokens.take(lists.flatten())
                if not len(taken):
                    found = pa.array([b""] * len(lists), pa.binary())
                    arrays = [part.column("doc_id"), part.column("ids"), found]
                    yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "ids", "bytes"])
                    continue
                ends = np.cumsum([0, *lists.value_lengths().to_numpy()])
                cuts = np.frombuffer(taken.buffers()[1], dtype=np.int32)[ends]
                found = pa.BinaryArray.from_buffers(
                    pa.binary(), len(lists), [None, pa.py_buffer(cuts.astype(np.int32)), taken.buffers()[2]]
                )
                arrays = [part.column("doc_id"), part.column("ids"), found]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "ids", "bytes"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids array<int>, bytes binary")


def ids_text(ids: Column) -> Column:
    """Decimal ids joined by commas."""
    return F.array_join(ids.cast("array<string>"), ",")
