"""Exceptions raised by argument checks, before any Spark job starts."""

from __future__ import annotations


class SearchError(Exception):
    """Base class; ``code`` is the value written to per-row results."""

    code = "unknown"


class InvalidArgument(SearchError, ValueError):
    code = "invalidArgument"


class NotFound(SearchError, LookupError):
    code = "notFound"


class AlreadyExists(SearchError):
    code = "alreadyExists"


class FailedPrecondition(SearchError):
    code = "failedPrecondition"


class NotSupported(SearchError):
    code = "notSupported"


MAX_INT32 = 2**31 - 1


def positive_int32(value: int, name: str) -> int:
    """Counts such as top-K must be whole, above zero and fit 32 bits."""
    if isinstance(value, bool) or not isinstance(value, int):
        raise InvalidArgument(f"{name} must be an integer")
    if not 0 < value <= MAX_INT32:
        raise InvalidArgument(f"{name} must be between 1 and {MAX_INT32}")
    return value
