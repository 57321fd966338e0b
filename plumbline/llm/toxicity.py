"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic texts are used as examples; everything else, labelled or not, is
unlabelled. The risk of a classifier f with class prior p is

    p * E_P[l(f)] + max(0, E_U[l(-f)] - p * E_P[l(-f)])

with the logistic loss l: what the toxic part of the unlabelled texts adds to the negative
risk is taken off again, and the estimate is kept from going below zero, where a flexible
model would only overfit. The model is linear over the presence of words. A word enters it when
it is in more confirmed texts than chance explains: how common it is otherwise is counted over
all documents, chance is the exact tail of the hypergeometric distribution, corrected for the
number of words tried. The model is trained with numpy on a bounded sample of labelled rows;
scoring runs over every whole text.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import Column, held_out, small_batches

# The model is fitted on at most so many confirmed texts, and on so many labelled ones that stand
# for the unlabelled; those with the smallest hashed ids.
MAX_POSITIVE = 4_000
MAX_UNLABELLED = 8_000

BUCKETS = 1 << 20
# A word enters the model when it is in so many confirmed texts, and when chance brings no more than
# this many words, of all that are tried, into as many.
MIN_TEXTS = 3
CHANCE = 0.5

STEPS = 1000
RATE = 0.05
PENALTY = 3e-6
# How far the corrected negative risk may fall below zero before its gradient is turned.
SLACK = 0.0
TURN = 0.5

THRESHOLD = 0.7
# The score's log-odds where nothing has been learnt.
UNKNOWN = -4.0

WORD = re.compile(r"\w+")
CACHED_WORDS = 50_000


@dataclass(frozen=True)
class Model:
    weights: dict[int, float]
    bias: float
    prior: float


def bucket(word: str) -> int:
    return zlib.crc32(word.encode()) % BUCKETS


def features(text: str | None) -> list[int]:
    """Buckets of the distinct lower-cased words of a whole text."""
    return sorted({bucket(w) for w in set(WORD.findall((text or "").lower()))})


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def log_tail(found: int, drawn: int, marked: int, total: int) -> float:
    """Log of the chance that ``found`` or more of ``drawn`` texts are among the ``marked`` of
    ``total`` ones, by the hypergeometric distribution."""
    most = min(drawn, marked)
    if found <= max(0, drawn + marked - total):
        return 0.0
    if found > most:
        return -math.inf

    def choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    first = choose(marked, found) + choose(total - marked, drawn - found) - choose(total, drawn)
    ratio = tail = 1.0
    for k in range(found, most):
        ratio *= (marked - k) * (drawn - k) / ((k + 1) * (total - marked - drawn + k + 1))
        tail += ratio
        if ratio < 1e-12 * tail:
            break
    return min(0.0, first + math.log(tail))


def tried_words(positive: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
    """Buckets in enough confirmed texts, in how many of them, and how many buckets there are."""
    counts = np.bincount(np.concatenate([*positive, np.empty(0, np.int64)]).astype(np.int64), minlength=BUCKETS)
    tried = np.flatnonzero(counts >= MIN_TEXTS)
    return tried, counts[tried], int((counts > 0).sum())


def telling_words(positive: list[np.ndarray], common: dict[int, int], total: int) -> np.ndarray:
    """The buckets that are in more confirmed texts than chance explains, given in how many of
    ``total`` texts each one is."""
    tried, found, words = tried_words(positive)
    bound = math.log(CHANCE / max(1, words))
    n = len(positive)
    telling = []
    for place, k in zip(tried.tolist(), found.tolist()):
        # The confirmed texts are among all texts.
        marked = max(k, common.get(place, 0))
        if log_tail(k, n, marked, max(total, n + marked - k)) <= bound:
            telling.append(place)
    return np.array(telling, dtype=np.int64)


def counted_words(texts: list[np.ndarray]) -> dict[int, int]:
    places, counts = np.unique(np.concatenate([*texts, np.empty(0, np.int64)]), return_counts=True)
    return dict(zip(places.astype(np.int64).tolist(), counts.tolist()))


def risk(fp: np.ndarray, fu: np.ndarray, prior: float) -> tuple[float, float]:
    """The two parts of the risk at the log-odds of confirmed and unlabelled texts: that of the
    toxic class, and the corrected one of the other, which may be below zero."""
    positive = prior * np.logaddexp(0, -fp).mean()
    negative = np.logaddexp(0, fu).sum() / max(1, len(fu)) - prior * np.logaddexp(0, fp).mean()
    return float(positive), float(negative)


@dataclass(frozen=True)
class Presence:
    """Which words of a model are in which of ``n`` texts."""

    row: np.ndarray
    column: np.ndarray
    n: int

    @staticmethod
    def of(texts: list[np.ndarray], place: np.ndarray) -> Presence:
        row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        column = place[np.concatenate([*texts, np.empty(0, np.int64)]).astype(np.int64)]
        return Presence(row[column >= 0], column[column >= 0], len(texts))

    def log_odds(self, w: np.ndarray) -> np.ndarray:
        """The last weight is that of every text."""
        return np.bincount(self.row, weights=w[self.column], minlength=self.n) + w[-1]

    def mean_slope(self, each: np.ndarray, size: int) -> np.ndarray:
        """Slope of a mean over the texts, from the slope at each text."""
        each = each / max(1, self.n)
        return np.append(np.bincount(self.column, weights=each[self.row], minlength=size - 1), each.sum())


def slope(w: np.ndarray, p: Presence, u: Presence, prior: float) -> np.ndarray:
    """Where to go down from ``w``: the gradient of the risk, or, where its corrected part is
    below zero, that part's own turned around."""
    fp, fu = p.log_odds(w), u.log_odds(w)
    corrected = u.mean_slope(_sigmoid(fu), len(w)) - prior * p.mean_slope(_sigmoid(fp), len(w))
    if risk(fp, fu, prior)[1] < -SLACK:
        return -TURN * corrected
    return prior * p.mean_slope(-_sigmoid(-fp), len(w)) + corrected


def fit(
    positive: list[np.ndarray],
    unlabelled: list[np.ndarray],
    prior: float,
    chosen: np.ndarray | None = None,
    steps: int = STEPS,
) -> Model:
    """Minimise the non-negative risk by Adam over the whole sample; deterministic.

    ``chosen`` are the buckets of the model, by default those that tell the confirmed texts from
    all texts given. Without a confirmed text or a telling word the model knows nothing and
    scores low.
    """
    if chosen is None and positive:
        every = [*positive, *unlabelled]
        chosen = telling_words(positive, counted_words(every), len(every))
    if not positive or not len(chosen):
        return Model({}, UNKNOWN, prior)
    place = np.full(BUCKETS, -1, dtype=np.int64)
    place[chosen] = np.arange(len(chosen))
    p, u = (Presence.of(texts, place) for texts in (positive, unlabelled))
    w = np.append(np.zeros(len(chosen)), UNKNOWN)
    m1, m2 = np.zeros(len(w)), np.zeros(len(w))
    for step in range(1, steps + 1):
        grad = slope(w, p, u, prior)
        grad[:-1] += PENALTY * w[:-1]
        m1 = 0.9 * m1 + 0.1 * grad
        m2 = 0.999 * m2 + 0.001 * grad * grad
        w = w - RATE * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
    return Model({int(k): float(v) for k, v in zip(chosen, w)}, float(w[-1]), prior)


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [features(text.as_py()) for text in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [*batch.select(["place", "p", "u"]).columns, pa.array(found, pa.list_(pa.int32()))],
            names=["place", "p", "u", "f"],
        )


def _bucket_counts(wanted: np.ndarray):
    """How many texts of a task have each wanted bucket; bucket -1 counts the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = dict(zip(wanted.tolist(), range(len(wanted))))
        counts, texts, cache = np.zeros(len(wanted), dtype=np.int64), 0, {}
        for batch in batches:
            for text in batch.column("text"):
                texts += 1
                hit = set()
                for word in set(WORD.findall((text.as_py() or "").lower())):
                    at = cache.get(word, 0)
                    if at == 0:
                        if len(cache) >= CACHED_WORDS:
                            cache.clear()
                        at = cache[word] = place.get(bucket(word))
                    if at is not None:
                        hit.add(at)
                for at in hit:
                    counts[at] += 1
        yield pa.RecordBatch.from_pydict({"bucket": [*wanted.tolist(), -1], "n": [*counts.tolist(), texts]})

    return run


def train(
    docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED
) -> Model:
    """Fit on the rows whose labels may be learnt from (``held_out`` is false).

    The class prior is the share of toxic rows among them. How common words are is counted over
    all documents that are not held out. Null ids and null labels are passed over; an id labelled
    twice counts as toxic if one label says so, of an id with several texts the one that hashes
    least is learnt from, and labels without a document count for the prior only.
    """
    small_batches(docs.sparkSession)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
    known = known.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg((F.max("toxic") == 1).alias("toxic"))
    toxic, total = known.agg(F.count(F.when(F.col("toxic"), 1)), F.count("*")).first()
    prior = min(0.9, (toxic + 0.5) / (total + 1))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    free = rows.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    # Labels meet documents by their ids alone before the sample is cut.
    there = free.select("doc_id").join(known, "doc_id").distinct()
    there = there.select("doc_id", "toxic", F.xxhash64("doc_id").alias("place"))
    first = lambda some, most: some.select("doc_id", "place").orderBy("place", "doc_id").limit(most)
    flags = lambda p, u: (F.lit(p).alias("p"), F.lit(u).alias("u"))
    both = first(there.where("toxic"), max_positive).select("*", *flags(True, False))
    both = both.union(first(there, max_unlabelled).select("*", *flags(False, True)))
    sample = both.groupBy("doc_id", "place").agg(F.max("p").alias("p"), F.max("u").alias("u"))
    # At most max_positive + max_unlabelled ids, so this side is always small.
    chosen = free.join(F.broadcast(sample), "doc_id")
    one = chosen.groupBy("place", "p", "u", "doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    one = one.select("place", "p", "u", "text")
    table = one.mapInArrow(_feature_rows, "place long, p boolean, u boolean, f array<int>").toArrow().sort_by("place")
    found = [np.asarray(f.values.to_numpy(), dtype=np.int64) for f in table["f"]]
    positive, unlabelled = ([f for f, on in zip(found, table[c].to_pylist()) if on] for c in "pu")
    tried = tried_words(positive)[0]
    if not len(tried):
        return Model({}, UNKNOWN, prior)
    counts = free.mapInArrow(_bucket_counts(tried), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    common = {int(k): int(n) for k, n in zip(*(column.to_pylist() for column in counts.toArrow().columns))}
    telling = telling_words(positive, common, common.pop(-1, 0))
    return fit(positive, unlabelled, prior, telling)


def score_column(model: Model, text: Column) -> Column:
    """The toxicity of a whole text, 0 to 1; empty and null texts get the score of no words."""
    weights, bias = model.weights, model.bias

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cache: dict[str, tuple[int, float] | None] = {}

        def log_odds(text: str | None) -> float:
            hit = {}
            for word in set(WORD.findall((text or "").lower())):
                known = cache.get(word, 0)
                if known == 0:
                    if len(cache) >= CACHED_WORDS:
                        cache.clear()
                    place = bucket(word)
                    known = cache[word] = (place, weights[place]) if place in weights else None
                if known:
                    hit[known[0]] = known[1]
            return bias + sum(hit[k] for k in sorted(hit))

        for part in parts:
            yield pd.Series(_sigmoid(np.array([log_odds(t) for t in part], dtype=float)))

    return F.pandas_udf(run, "double")(text)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row; other columns are
    not carried, and a null id counts as not held out."""
    scored = docs.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        score_column(model, F.col("text")).alias("score"),
    )
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all columns as they are, that score below the threshold. Null and empty
    texts have the score of no words, repeated rows and null ids stay or go by their text."""
    return docs.where(score_column(model, F.col("text")) < threshold)
