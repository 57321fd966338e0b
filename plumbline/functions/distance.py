"""Distances as column expressions.

Meant for short candidate lists (re-ranking) and checks; scans go through the block
kernel in ``operators.blocks``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

Column = F.Column


def as_doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def inner_product(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: x * y))


def norm(a: Column) -> Column:
    return F.sqrt(inner_product(a, a))


def l2(a: Column, b: Column) -> Column:
    return F.sqrt(
        _sum(F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: (x - y) * (x - y)))
    )


def cosine(a: Column, b: Column) -> Column:
    """``1 - cos``; NULL when either vector has no length."""
    length = norm(a) * norm(b)
    return F.when(length > 0, 1 - inner_product(a, b) / length)


def hamming(a: Column, b: Column) -> Column:
    """Differing bits of two equally long BINARY values."""
    def bits(x: Column, i: Column) -> Column:
        return F.conv(F.hex(F.substring(x, i, F.lit(1))), 16, 10).cast("int")

    return F.aggregate(
        F.sequence(F.lit(1), F.octet_length(a)),
        F.lit(0.0),
        lambda acc, i: acc + F.bit_count(bits(a, i).bitwiseXOR(bits(b, i))),
    )


EXPRESSIONS = {"l2": l2, "ip": inner_product, "cosine": cosine, "hamming": hamming}
