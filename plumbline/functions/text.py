"""Tokenizers as column expressions: text -> array of terms."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.errors import InvalidArgument

Column = F.Column

TOKENIZERS = ("standard", "whitespace", "cjk")
FILTERS = ("lowercase", "stop")

HAN_RUN = r"\p{IsHan}+"
WORD_RUN = r"[\p{L}\p{N}&&[^\p{IsHan}]]+"


def _filled(terms: Column) -> Column:
    return F.filter(terms, lambda t: t != "")


def standard(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return _filled(F.split(F.lower(text), r"[^\p{L}\p{N}]+"))


def whitespace(text: Column) -> Column:
    """Pieces between white space, case kept."""
    return _filled(F.split(text, r"\s+"))


def cjk(text: Column) -> Column:
    """Han runs as overlapping character pairs, other runs as lower-cased words."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(f"{HAN_RUN}|{WORD_RUN}"), F.lit(0))

    def pieces(run: Column) -> Column:
        pairs = F.transform(
            F.sequence(F.lit(1), F.length(run) - 1), lambda i: F.substring(run, i, F.lit(2))
        )
        return F.when(run.rlike(f"^{HAN_RUN}$") & (F.length(run) > 1), pairs).otherwise(F.array(run))

    return F.flatten(F.transform(runs, pieces))


def tokenize(
    text: Column,
    tokenizer: str = "standard",
    filters: tuple[str, ...] = (),
    options: dict[str, str] | None = None,
) -> Column:
    """Apply a tokenizer by name, then the token filters in order.

    ``stop`` reads its words, separated by commas, from ``options["stopwords"]``.
    """
    if tokenizer not in TOKENIZERS:
        raise InvalidArgument(f"unknown tokenizer {tokenizer!r}")
    terms = {"standard": standard, "whitespace": whitespace, "cjk": cjk}[tokenizer](text)
    for name in filters:
        if name == "lowercase":
            terms = F.transform(terms, F.lower)
        elif name == "stop":
            words = [w for w in (options or {}).get("stopwords", "").split(",") if w]
            terms = F.filter(terms, lambda t: ~t.isin(words)) if words else terms
        else:
            raise InvalidArgument(f"unknown token filter {name!r}")
    return terms
