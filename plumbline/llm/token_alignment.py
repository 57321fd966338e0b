"""Alignment of two tokenizers over the same texts, by coalescing intervals of bytes.

Every token covers an interval of the bytes of a text. The intervals of both tokenizers are
sorted together by where they start; the running maximum of their ends tells where a group of
overlapping tokens is closed: at a start that reaches it. Inside a group every token of one
side is paired with the tokens of the other that it overlaps.

Both tokenizers work chunk by chunk: a single space between two characters that are no white
space always begins a token on both sides, so the pieces between such spaces are encoded once
and remembered.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plumbline.functions.joins import look_up
from plumbline.functions.sizing import materialize
from plumbline.llm.byte_bpe import byte_characters
from plumbline.llm.common import small_batches

SPACE = "▁"
# Characters that some Unicode versions count as white space are no place for a cut either.
CUT = re.compile("(?<=[^\\s\u180e\u200b\u2060\ufeff]) (?=[^\\s\u180e\u200b\u2060\ufeff])")
SEPARABLE = re.compile("(?s)[^\\s\u180e\u200b\u2060\ufeff](?:.*[^\\s\u180e\u200b\u2060\ufeff])?\\Z")
# How byte-level BPE files cut texts: a fixed value of the format.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHED_CHUNKS = 200_000
LONG_CHUNK = 64
# Texts are aligned together up to about so many bytes.
PART_BYTES = 1 << 20

FIELDS = (
    "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, "
    "a array<int>, b array<int>, times array<int>"
)


def coalesce(
    start_a: np.ndarray, end_a: np.ndarray, start_b: np.ndarray, end_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The group number of every A and every B interval, counted from 0 by place. Intervals that touch
    only at their ends do not share a group."""
    start, end = np.concatenate([start_a, start_b]), np.concatenate([end_a, end_b])
    side = np.repeat(np.array([0, 1], dtype=np.int8), [len(start_a), len(start_b)])
    order = np.lexsort((side, start))
    reach = np.maximum.accumulate(end[order]) if len(end) else end
    opens = np.zeros(len(order), dtype=np.int64)
    opens[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(opens)
    return group[: len(start_a)], group[len(start_a) :]


def overlaps(
    start_a: np.ndarray, end_a: np.ndarray, start_b: np.ndarray, end_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (index in A, index in B) of overlapping intervals; within a side the intervals
    follow each other without overlap."""
    first = np.searchsorted(end_b, start_a, side="right")
    last = np.searchsorted(start_b, end_a, side="left")
    n = np.maximum(last - first, 0)
    left = np.repeat(np.arange(len(start_a)), n)
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return left, np.repeat(first, n) + within


class Side:
    """One tokenizer: ids of chunks, remembered, and the bytes of ids.

    ``encode_text`` takes a text that begins with a space.
    """

    def __init__(self, encode_text: Callable[[str], list[int]], tokens: list[bytes]):
        self.encode_text = encode_text
        self.tokens = pa.array(tokens, pa.binary())
        self.lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        # Two generations: what is asked for again moves to the younger one.
        self.known: dict[str, bytes] = {}
        self.known_before: dict[str, bytes] = {}

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """The ids of each chunk and a space in front of it, as the bytes of 32-bit integers."""
        # A chunk at the edge of a text may begin or end with white space; it goes on its own.
        inner = [chunk for chunk in chunks if SEPARABLE.match(chunk)]
        ids = np.array(self.encode_text(" " + " ".join(inner)) if inner else [], dtype=np.int32)
        ends = np.cumsum(self.lengths[ids])
        expected = np.cumsum([1 + len(chunk.encode()) for chunk in inner])
        cuts = np.searchsorted(ends, expected)
        if len(inner) and (ends[-1] != expected[-1] or not np.array_equal(ends[cuts], expected)):
            # Some chunk is not spelled as it is.
            found = {chunk: array("i", self.encode_text(" " + chunk)).tobytes() for chunk in inner}
        else:
            flat, bounds = ids.tobytes(), [0, *(4 * (cuts + 1)).tolist()]
            found = {chunk: flat[a:b] for chunk, a, b in zip(inner, bounds, bounds[1:])}
        return [
            found[chunk] if chunk in found else array("i", self.encode_text(" " + chunk)).tobytes() for chunk in chunks
        ]

    def encode(self, parts: list[str]) -> np.ndarray:
        """The ids of one text from its chunks."""
        known, before = self.known, self.known_before
        missing = list(set(parts).difference(known))
        if missing:
            new = [part for part in missing if part not in before]
            known.update({part: before[part] for part in missing if part in before})
            known.update(zip(new, self.encode_chunks(new)))
        ids = b"".join([known[part] for part in parts])
        for part in missing:
            if len(part) > LONG_CHUNK:
                del known[part]
        if len(known) > CACHED_CHUNKS:
            self.known, self.known_before = {}, known
        return np.frombuffer(ids, dtype=np.int32)

    def spelled(self, ids: np.ndarray) -> bytes:
        taken = self.tokens.take(pa.array(ids))
        ends = np.frombuffer(taken.buffers()[1], dtype=np.int32)
        return taken.buffers()[2].to_pybytes()[: ends[len(ids)]] if len(ids) else b""


def _ranks(entries: dict[str, int], merges: list, back: dict[str, int]) -> dict[bytes, int] | None:
    """Tokens and ranks, where ids are in the order of merges."""
    spelled = {text: bytes(back[c] for c in text) for text in entries}
    single = sum(len(token) == 1 for token in spelled.values())
    pairs = ("".join(merge) if isinstance(merge, list) else merge.replace(" ", "") for merge in merges)
    if any(entries.get(pair) != single + k for k, pair in enumerate(pairs)) or len(entries) != single + len(merges):
        return None
    return {spelled[text]: number for text, number in entries.items()}


@lru_cache(maxsize=2)
def byte_level_side(path: str) -> Side:
    """A byte-level BPE in the format of ``tokenizers``, over a space and the chunk.

    Where the file's ids are in the order of its merges and it cuts by the usual pattern, ``tiktoken``
    encodes by the same ranks, which takes less time; all else is left to ``tokenizers``.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    back = {c: b for b, c in enumerate(byte_characters())}
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    entries, added = library.get_vocab(with_added_tokens=False), parts["added_tokens"]
    added = {token["id"]: token["content"] for token in added}
    tokens = [b""] * (max([*entries.values(), *added]) + 1)
    for text, number in entries.items():
        if number not in added:
            tokens[number] = bytes(back[c] for c in text)
    for number, text in added.items():
        tokens[number] = text.encode()

    usual = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    plain = parts["normalizer"] is None and usual.items() <= (parts["pre_tokenizer"] or {}).items()
    own = {text: number for text, number in entries.items() if number not in added}
    ranks = _ranks(own, parts["model"]["merges"], back) if plain and not parts["model"]["ignore_merges"] else None
    if ranks:
        same = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        return Side(same.encode_ordinary, tokens)
    return Side(lambda text: library.encode(text, add_special_tokens=False).ids, tokens)


@lru_cache(maxsize=2)
def piece_side(path: str) -> Side:
    """A sentencepiece model with byte fallback; it puts the space in front itself."""
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    tokens = []
    for number in range(library.get_piece_size()):
        piece = library.id_to_piece(number)
        tokens.append(bytes([int(piece[3:5], 16)]) if library.IsByte(number) else piece.replace(SPACE, " ").encode())
    return Side(lambda text: library.encode(text[1:]), tokens)


class Aligner:
    def __init__(self, a: Side, b: Side):
        self.a, self.b = a, b
        marks = [
            [f"{i}{mark}".encode() for i in range(len(side.tokens))]
            for side, mark in ((a, ","), (a, "|"), (b, ","), (b, ";"))
        ]
        self.shown = np.array([text for part in marks for text in part], dtype=object)
        self.base = np.cumsum([0, *map(len, marks)])

    def align(self, texts: list[str | None], keep_groups: bool) -> list[pa.Array]:
        """The columns of ``FIELDS``, one row per text. Texts whose bytes one side does not spell have no tokens."""
        ids_a, ids_b, whole = [], [], []
        for text in texts:
            if text:
                parts = CUT.split(text)
                one, two = self.a.encode(parts), self.b.encode(parts)
                plain = b" " + text.encode()
                if self.a.spelled(one) == plain and self.b.spelled(two) == plain:
                    ids_a.append(one)
                    ids_b.append(two)
                    whole.append(True)
                    continue
            ids_a.append(np.empty(0, np.int32))
            ids_b.append(np.empty(0, np.int32))
            whole.append(False)
        n_a, n_b = (np.array([len(i) for i in ids], dtype=np.int64) for ids in (ids_a, ids_b))
        a, b = np.concatenate(ids_a), np.concatenate(ids_b)
        # Both sides of a text have the same bytes, so the texts may simply follow each other.
        end_a, end_b = np.cumsum(self.a.lengths[a]), np.cumsum(self.b.lengths[b])
        start_a, start_b = end_a - self.a.lengths[a], end_b - self.b.lengths[b]
        group_a, group_b = coalesce(start_a, end_a, start_b, end_b)
        left, right = overlaps(start_a, end_a, start_b, end_b)
        text_a = np.repeat(np.arange(len(texts)), n_a)
        opens_a = np.diff(group_a, prepend=-1) > 0
        n_groups = np.bincount(text_a[opens_a], minlength=len(texts))
        text_of_link = text_a[left]
        n_links = np.bincount(text_of_link, minlength=len(texts))

        shown = self._in_order(a, b, group_a, group_b)
        cuts = np.cumsum(n_a + n_b)
        strings = [
            b"".join(shown[end - n : end])[:-1] if n else b"" for end, n in zip(cuts.tolist(), (n_a + n_b).tolist())
        ]
        digests = [hashlib.sha256(s).hexdigest() if ok else "" for s, ok in zip(strings, whole)]

        # Distinct pairs of each text and how often it links them.
        size_b = len(self.b.tokens)
        pair = a[left].astype(np.int64) * size_b + b[right]
        n_pairs = len(self.a.tokens) * size_b
        keys, times = np.unique(text_of_link * n_pairs + pair, return_counts=True)
        ends = np.searchsorted(keys, np.arange(len(texts) + 1) * n_pairs).astype(np.int32)
        first, second = np.divmod(keys % n_pairs, size_b)
        lists = [
            pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int32)))
            for values in (first, second, times)
        ]
        groups = [s.decode() if keep_groups else None for s in strings]
        return [*map(pa.array, (n_a, n_b, n_groups, n_links, digests)), pa.array(groups, pa.string()), *lists]

    def _in_order(self, a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray) -> list[bytes]:
        """All ids with the mark that follows them: of each group first A's, then B's."""
        if not len(a):
            return []
        n = group_a[-1] + 1
        per_a, per_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
        out = np.empty(len(a) + len(b), dtype=np.int64)
        last_a, last_b = np.diff(group_a, append=n) > 0, np.diff(group_b, append=n) > 0
        out[np.arange(len(a)) + (np.cumsum(per_b) - per_b)[group_a]] = a + self.base[last_a.astype(np.int8)]
        out[np.arange(len(b)) + np.cumsum(per_a)[group_b]] = b + self.base[2 + last_b.astype(np.int8)]
        return self.shown[out].tolist()


@lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    """One per worker and pair of files."""
    return Aligner(byte_level_side(a_path), piece_side(b_path))


def align(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep_groups: bool = False,
) -> DataFrame:
    """Every whole text under both tokenizers: ``row`` (a number of its own), ``doc_id``, ``n_a``,
    ``n_b``, ``n_groups``, ``n_links``, ``groups_sha256``, ``groups`` (null unless asked for) and the
    distinct linked id pairs ``a``, ``b`` with the ``times`` they are linked.

    Groups read ``a1,a2|b1;a3|b2,b3``. Null and empty texts, and texts whose bytes (after the space
    in front) one of the tokenizers does not give back, have no tokens: zeros, an empty string and
    empty lists. Repeated rows and null ids stay; other columns are not carried.
    """
    small_batches(docs.sparkSession)
    chosen = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column).alias("doc_id"),
        F.col(text_column).cast("string").alias("text"),
    )
    kind = chosen.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(a_path, b_path)
        names = ["row", "doc_id", *(field.split(" ")[0] for field in FIELDS.split(", "))]
        for batch in batches:
            start, size, held = 0, 0, []
            for number, text in enumerate(batch.column("text"), 1):
                held.append(text.as_py())
                size += len(held[-1] or "")
                if size >= PART_BYTES or number == batch.num_rows:
                    part = batch.slice(start, number - start)
                    columns = both.align(held, keep_groups)
                    yield pa.RecordBatch.from_arrays([part.column("row"), part.column("doc_id"), *columns], names=names)
                    start, size, held = number, 0, []

    return chosen.mapInArrow(run, f"row long, doc_id {kind}, {FIELDS}")


def linked_pairs(aligned: DataFrame) -> DataFrame:
    """``row``, ``pair`` (A id times 2^32 plus B id) and ``times``, one row per text and pair."""
    each = F.explode(F.arrays_zip("a", "b", "times")).alias("l")
    pair = F.shiftleft(F.col("l.a").cast("long"), 32) + F.col("l.b")
    return aligned.select("row", each).select("row", pair.alias("pair"), F.col("l.times").alias("times"))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair``, ``n`` (how many texts link it) and ``best`` (no pair of its A id is in more)."""
    counts = linked_pairs(aligned).groupBy("pair").agg(F.count("*").alias("n"))
    # An A id has at most one row for each B id of the vocabulary.
    same_a = Window.partitionBy(F.shiftright("pair", 32))
    return counts.withColumn("best", F.col("n") == F.max("n").over(same_a))


def align_corpus(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``align`` without its lists, with ``n_best`` and ``count_sum``: how many links of a text are
    their A id's most common ones in the corpus, and the corpus counts of all its links."""
    aligned = materialize(align(docs, a_path, b_path), "aligned")
    found = look_up(linked_pairs(aligned), pair_counts(aligned), "pair", "row")
    sums = found.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).cast("long").alias("n_best"),
        F.sum(F.col("times") * F.col("n")).cast("long").alias("count_sum"),
    )
    joined = aligned.drop("a", "b", "times", "groups").join(sums, "row", "left").drop("row")
    return joined.fillna(0, ["n_best", "count_sum"])
