"""Quality rules as a bitmask ledger.

Each rule is evaluated once per document. The ledger keeps the measurements and one bit per
failed rule; a policy is a named, versioned mask over those bits, so that policies are
applied, compared and taken apart without looking at a text again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import SPACES, Column, let, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 3

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_lines",
    "n_dup_lines",
    "n_repeat_words",
    "n_loud_words",
)


@dataclass(frozen=True)
class Rule:
    """``failed`` turns the struct of measurements into a condition."""

    bit: int
    name: str
    failed: Callable[[Column], Column]


# Comparisons are between integers, so that every engine decides alike.
RULES = (
    Rule(0, "few_words", lambda m: m["n_words"] < 50),
    Rule(1, "repeated_words", lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"]),
    Rule(2, "symbols", lambda m: 10 * m["n_symbols"] > m["n_words"]),
    Rule(3, "repeated_lines", lambda m: 10 * m["n_dup_lines"] > 3 * m["n_lines"]),
    Rule(4, "loud_words", lambda m: 10 * m["n_loud_words"] > 4 * m["n_words"]),
    Rule(5, "short_words", lambda m: m["word_chars"] < 2 * m["n_words"]),
    Rule(6, "long_words", lambda m: m["word_chars"] > 12 * m["n_words"]),
)
BIT = {rule.name: 1 << rule.bit for rule in RULES}

BASE = BIT["few_words"] | BIT["repeated_words"]

# Policies are never edited; a change gets a new version.
POLICIES = {
    ("base", 1): BASE,
    ("web", 1): BASE | BIT["symbols"] | BIT["repeated_lines"],
    ("web", 2): BASE | BIT["symbols"] | BIT["loud_words"],
    ("strict", 1): sum(BIT.values()),
}
CURRENT = ("web", 2)


def _repeat_words(words: Column) -> Column:
    """Words covered by ``WINDOW``-word windows that occur twice or more.

    Windows are sorted with their positions, so that equal ones are neighbours; the length
    of the union of the windows found follows from the gaps between their starts.
    """
    last = F.size(words) - WINDOW

    def window(i: Column) -> Column:
        text = F.concat_ws(" ", *[words[i + k] for k in range(WINDOW)])
        return F.struct(text.alias("w"), i.alias("i"))

    def repeated(found: Column) -> Column:
        def start(i: Column) -> Column:
            w = found[i]["w"]
            twin = (w == F.get(found, i - 1)["w"]) | (w == F.get(found, i + 1)["w"])
            return F.when(F.coalesce(w == F.get(found, i + 1)["w"], F.lit(False)) | twin, found[i]["i"])

        hits = F.transform(F.sequence(F.lit(0), last), start)
        return F.sort_array(F.filter(hits, lambda p: p.isNotNull()))

    def covered(starts: Column) -> Column:
        def gap(acc: Column, p: Column) -> Column:
            new = F.least(p - acc["last"], F.lit(WINDOW))
            return F.struct((acc["n"] + new).alias("n"), p.alias("last"))

        first = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
        return F.aggregate(starts, first, gap, lambda acc: acc["n"])

    windows = F.sort_array(F.transform(F.sequence(F.lit(0), last), window))
    return F.when(last >= 0, let(let(windows, repeated), covered)).otherwise(F.lit(0))


def measurements(text: Column) -> Column:
    """A struct of ``MEASURES``, all long; a null text has no words and no lines."""
    text = F.coalesce(text, F.lit(""))

    def without(value: Column, characters: str) -> Column:
        return F.translate(value, characters, "")

    lines = F.filter(F.split(text, "\n"), lambda line: without(line, SPACES) != "")

    def of(words: Column) -> Column:
        loud = F.filter(words, lambda w: (w == F.upper(w)) & (w != F.lower(w)))
        return F.struct(
            F.size(words).alias("n_words"),
            F.size(loud).alias("n_loud_words"),
            _repeat_words(words).alias("n_repeat_words"),
        )

    def line_counts(lines: Column) -> Column:
        return F.struct(
            F.size(lines).alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
        )

    def all_of(word: Column, line: Column) -> Column:
        values = {
            "n_words": word["n_words"],
            "word_chars": F.length(without(text, SPACES)),
            "n_symbols": F.length(text) - F.length(without(text, SYMBOLS)),
            "n_lines": line["n_lines"],
            "n_dup_lines": line["n_dup_lines"],
            "n_repeat_words": word["n_repeat_words"],
            "n_loud_words": word["n_loud_words"],
        }
        return F.struct(*[values[name].cast("long").alias(name) for name in MEASURES])

    return let(let(words_of(text), of), lambda w: let(let(lines, line_counts), lambda n: all_of(w, n)))


def fail_bits(m: Column, mask: int) -> Column:
    """One bit per failed rule of ``mask``, from a struct of measurements."""
    bits = F.lit(0)
    for rule in RULES:
        if mask & BIT[rule.name]:
            bits = bits.bitwiseOR(F.when(rule.failed(m), BIT[rule.name]).otherwise(0))
    return bits.cast("int")


def ledger(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: its id, the ``MEASURES`` and ``fail_bits``.

    Other columns are not carried. Empty and null texts measure zero and fail
    ``few_words``; repeated rows are judged one by one; a null id is kept.
    """
    every = sum(BIT.values())
    measured = docs.select(
        F.col(id_column).alias("doc_id"), measurements(F.col(text_column)).alias("m")
    )
    return measured.select("doc_id", "m.*", fail_bits(F.col("m"), every).alias("fail_bits"))


def passes(bits: Column, policy: tuple[str, int] = CURRENT) -> Column:
    """True where no rule of the policy failed."""
    return bits.bitwiseAND(F.lit(POLICIES[policy])) == 0


def apply_policy(entries: DataFrame, policy: tuple[str, int] = CURRENT) -> DataFrame:
    """The ledger with ``base_failed`` and ``kept``."""
    bits = F.col("fail_bits")
    return entries.withColumn("base_failed", bits.bitwiseAND(F.lit(BASE)) != 0).withColumn(
        "kept", passes(bits, ("base", 1)) & passes(bits, policy)
    )


def ablations(entries: DataFrame, policy: tuple[str, int] = CURRENT) -> DataFrame:
    """What each rule of a policy does: rows failing it, rows only it rejects, and rows kept
    without it. One pass over the bits; an empty ledger counts zero everywhere."""
    mask = POLICIES[policy]
    chosen = [rule for rule in RULES if mask & BIT[rule.name]]
    bits = F.col("fail_bits").bitwiseAND(F.lit(mask))
    sums = [F.count(F.when(bits == 0, 1)).alias("kept")]
    for rule in chosen:
        own = BIT[rule.name]
        sums.append(F.count(F.when(bits.bitwiseAND(F.lit(own)) != 0, 1)).alias(f"failed_{rule.bit}"))
        sums.append(F.count(F.when(bits == own, 1)).alias(f"alone_{rule.bit}"))
    rows = [
        F.struct(
            F.lit(rule.name).alias("rule"),
            F.col(f"failed_{rule.bit}").alias("failed"),
            F.col(f"alone_{rule.bit}").alias("failed_alone"),
            (F.col("kept") + F.col(f"alone_{rule.bit}")).alias("kept_without"),
        )
        for rule in chosen
    ]
    return entries.agg(*sums).select(F.inline(F.array(*rows)))


def keep_passing(docs: DataFrame, policy: tuple[str, int] = CURRENT, text_column: str = "text") -> DataFrame:
    """The documents, all columns as they are, that pass the policy."""
    mask = POLICIES[policy] | BASE
    return docs.where(let(measurements(F.col(text_column)), lambda m: fail_bits(m, mask)) == 0)
