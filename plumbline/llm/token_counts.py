"""Exact token counts of every prefix of a text, by dynamic programming.

The pieces a byte-fallback BPE vocabulary produces have a local property: a sequence of
pieces is the encoding of its text if and only if every piece and every two neighbours encode
to themselves. So the last piece of each prefix follows from the last pieces of shorter
prefixes,

    count(i) = count(i - |t|) + 1,   t: the piece for which (last(i - |t|), t) stays as it is,

and one pass stores the count at every prefix. Truncations and budgets are then look-ups; no
prefix is ever encoded again.

Where no piece of the vocabulary spans two characters the text falls apart into independent
segments (words, in practice), which are counted once and remembered.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import BATCH_BYTES, Column, small_batches

SPACE = "▁"
LIMIT = 4096

CACHED_SEGMENTS = 200_000
CACHED_PREFIXES = 200_000
CACHED_PAIRS = 300_000
# Longer segments are rare and not worth remembering.
LONG_SEGMENT = 64

# Letters and digits but for raised digits; those and underscores stand before other marks.
WORD = re.compile(r"[^\W_²³¹]")
SEGMENT = re.compile(
    rf"{SPACE}*[^\W_²³¹]+|{SPACE}*(?:[^\w{SPACE}\n]|[_²³¹])+[^\W_²³¹]*|{SPACE}+|\n"
)


class PrefixCounter:
    """Counts for one vocabulary file. Texts are taken as the library takes them: spaces
    become visible, one is put in front, nothing else is normalised."""

    def __init__(self, model_file: str):
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = range(model.get_piece_size())
        odd = (model.IsControl, model.IsUnknown, model.IsByte, model.IsUnused)
        plain = [i for i in ids if not any(kind(i) for kind in odd)]
        self.score = {model.id_to_piece(i): model.get_score(i) for i in plain}
        self.bytes_known = any(model.IsByte(i) for i in ids)
        # A text is cut where no piece has the two characters beside each other: in front of
        # space markers, around line ends, and between a word and what is no word.
        joined = {piece[k : k + 2] for piece in self.score for k in range(len(piece) - 1)}
        cuts = [(a, b) for a, b in joined if a != SPACE and b == SPACE or "\n" in a + b]
        cuts += [(a, b) for a, b in joined if WORD.match(a) and not WORD.match(b) and b != SPACE]
        self.segment = re.compile(r"(?s).+") if cuts else SEGMENT
        # By the last four characters: the lengths of the pieces that end so, longest first.
        ends: dict[str, set[int]] = {}
        for piece in self.score:
            if len(piece) >= 4:
                ends.setdefault(piece[-4:], set()).add(len(piece))
        self.ends = {end: sorted(found, reverse=True) for end, found in ends.items()}
        self.lengths: dict[str, tuple[int, ...]] = {}
        # Two generations each: what is asked for again moves to the younger one.
        self.known: dict[str, bytes] = {}
        self.known_before: dict[str, bytes] = {}
        self.state: dict[str, tuple[int, str]] = {}
        self.state_before: dict[str, tuple[int, str]] = {}
        self.fits: dict[tuple[str, str], bool] = {}

    def _lengths(self, end: str) -> tuple[int, ...]:
        """Lengths, from two on, of the pieces that may end in these (up to four) characters."""
        found = self.lengths.get(end)
        if found is None:
            if len(self.lengths) >= CACHED_PAIRS:
                self.lengths.clear()
            short = [n for n in (3, 2) if n <= len(end) and end[-n:] in self.score]
            found = self.lengths[end] = (*self.ends.get(end, ()), *short)
        return found

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text, by plain merging; used for pairs of pieces only."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = self.score.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _stays(self, before: str, piece: str) -> bool:
        key = (before, piece)
        answer = self.fits.get(key)
        if answer is None:
            if len(self.fits) >= CACHED_PAIRS:
                self.fits.clear()
            expected = [before, piece] if before else [piece]
            answer = self.fits[key] = self.merged(before + piece) == expected
        return answer

    def _last(self, segment: str, i: int, count: list[int], last: list[str]) -> tuple[int, str]:
        """Count and last piece of ``segment[:i]``, from those of the shorter prefixes."""
        for length in self._lengths(segment[max(0, i - 4) : i]):
            if length <= i:
                piece = segment[i - length : i]
                if piece in self.score and self._stays(last[i - length], piece):
                    return count[i - length] + 1, piece
        # A character outside the vocabulary falls back to its bytes.
        piece = segment[i - 1]
        return count[i - 1] + (1 if piece in self.score or not self.bytes_known else len(piece.encode())), piece

    def steps(self, segment: str) -> bytes:
        """By how much the count changes with each character, one signed byte each: a piece
        spans few characters, so no step is larger than their bytes.

        Words share beginnings, so what is known of a beginning is looked up.
        """
        if len(self.state) > CACHED_PREFIXES:
            self.state, self.state_before = {}, self.state
        count, last, state, before = [0], [""], self.state, self.state_before
        short = len(segment) <= LONG_SEGMENT
        for i in range(1, len(segment) + 1):
            start = segment[:i] if short else ""
            found = state.get(start)
            if found is None:
                found = before.get(start) or self._last(segment, i, count, last)
                if short:
                    state[start] = found
            count.append(found[0])
            last.append(found[1])
        return bytes([(b - a) & 0xFF for a, b in zip(count, count[1:])])

    def prefixes(self, text: str) -> np.ndarray:
        """Tokens of ``text[:i]`` for i = 1 … len(text)."""
        if not text:
            return np.empty(0, dtype=np.int32)
        parts, known = self.segment.findall(SPACE + text.replace(" ", SPACE)), self.known
        before = self.known_before
        fresh = {part: before.get(part) or self.steps(part) for part in set(parts).difference(known)}
        if fresh:
            known.update(fresh)
            steps = b"".join([known[part] for part in parts])
            for part in fresh:
                if len(part) > LONG_SEGMENT:
                    del known[part]
            if len(known) > CACHED_SEGMENTS:
                self.known, self.known_before = {}, known
        else:
            steps = b"".join([known[part] for part in parts])
        return np.frombuffer(steps, dtype=np.int8).cumsum(dtype=np.int32)[1:]


@lru_cache(maxsize=2)
def counter(model_file: str) -> PrefixCounter:
    """One counter per worker and vocabulary."""
    return PrefixCounter(model_file)


def prefix_counts(
    docs: DataFrame, model_file: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_bytes`` and ``counts``: the tokens of each prefix, by code points.

    Null and empty texts have no bytes and an empty array. Repeated rows and null ids stay;
    other columns are not carried.
    """
    small_batches(docs.sparkSession)
    chosen = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(text_column, F.lit("")).alias("text"))
    chosen = chosen.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(model_file)
        for batch in batches:
            start, size, held = 0, 0, []
            for row, text in enumerate(batch.column("text"), 1):
                held.append(count.prefixes(text.as_py()))
                size += 4 * len(held[-1])
                if size >= BATCH_BYTES or row == batch.num_rows:
                    ends = np.cumsum([0, *map(len, held)]).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(held), pa.int32()))
                    part = batch.slice(start, row - start)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id"), part.column("n_bytes"), lists], names=["doc_id", "n_bytes", "counts"]
                    )
                    start, size, held = row, 0, []

    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"doc_id {kind}, n_bytes long, counts array<int>")


def total(counts: Column) -> Column:
    """Tokens of the whole text."""
    return F.coalesce(F.get(counts, F.size(counts) - 1), F.lit(0)).cast("long")


def tokens_of_prefix(counts: Column, characters: Column) -> Column:
    """Tokens of the first ``characters`` code points; more than there are means all."""
    at = F.least(characters, F.size(counts))
    return F.when(at > 0, F.get(counts, at - 1)).otherwise(0).cast("long")


def longest_within(counts: Column, budget: Column) -> Column:
    """Code points of the longest prefix of at most ``budget`` tokens. Counts may fall from
    one prefix to the next, so the last position counts, not the first excess."""
    within = F.transform(counts, lambda n, i: F.when(n <= budget, i + 1).otherwise(0))
    return F.coalesce(F.array_max(within), F.lit(0))


def with_totals(counted: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit``."""
    counted = counted.select("doc_id", "n_bytes", total(F.col("counts")).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
