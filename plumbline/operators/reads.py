"""Projection, filter, bounded reads and key look-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.errors import InvalidArgument
from plumbline.functions.joins import look_up
from plumbline.functions.sizing import broadcast_if_small, materialize

# Bounds and default of a bounded read.
BROWSE_MIN = 1
BROWSE_MAX = 100_000
BROWSE_DEFAULT = 50


def vector_columns(docs: DataFrame, vectors: tuple[str, ...] | None = None) -> list[str]:
    """Vector columns: those named, else those the schema metadata marks."""
    if vectors is not None:
        return [v for v in vectors if v in docs.columns]
    marked = []
    for field in docs.schema.fields:
        vtype = field.metadata.get("vtype", "")
        if vtype.startswith(("vector", "sparseVector")):
            marked.append(field.name)
    return marked


def project(
    docs: DataFrame,
    output: list[str] | None = None,
    *,
    include_vector: bool = False,
    vectors: tuple[str, ...] | None = None,
) -> DataFrame:
    """``id`` plus the named columns, or all of them; vectors only on request."""
    names = list(output or [c for c in docs.columns if c != "id"])
    unknown = [n for n in names if n not in docs.columns]
    if unknown:
        raise InvalidArgument(f"unknown output fields {unknown}")
    if not include_vector:
        hidden = set(vector_columns(docs, vectors))
        names = [n for n in names if n not in hidden]
    return docs.select("id", *[n for n in names if n != "id"])


def filtered(docs: DataFrame, where: str | None) -> DataFrame:
    """Rows passing a SQL condition; a blank condition passes all."""
    return docs.where(where) if where and where.strip() else docs


def browse(
    docs: DataFrame,
    where: str | None = None,
    *,
    limit: int = BROWSE_DEFAULT,
    output: list[str] | None = None,
    include_vector: bool = False,
    vectors: tuple[str, ...] | None = None,
) -> DataFrame:
    """At most ``limit`` matching rows in id order, plus ``limit_reached``.

    The cut runs on each partition before rows meet, so no more than ``limit`` rows per
    partition move.
    """
    if isinstance(limit, bool) or not BROWSE_MIN <= limit <= BROWSE_MAX:
        raise InvalidArgument(f"limit must be between {BROWSE_MIN} and {BROWSE_MAX}")
    rows = project(
        filtered(docs, where), output, include_vector=include_vector, vectors=vectors
    )
    page = rows.orderBy("id").limit(limit)
    # The page already sits in one partition of at most ``limit`` rows.
    whole = Window.partitionBy(F.lit(1))
    return page.withColumn("limit_reached", F.count("*").over(whole) == limit)


def fetch(
    docs: DataFrame,
    ids: DataFrame,
    output: list[str] | None = None,
    *,
    include_vector: bool = True,
    vectors: tuple[str, ...] | None = None,
) -> DataFrame:
    """Documents whose id is asked for; unknown ids give no row."""
    rows = project(docs, output, include_vector=include_vector, vectors=vectors)
    wanted, _ = broadcast_if_small(materialize(ids.select("id").distinct(), "wanted-ids"))
    return rows.join(wanted, "id", "left_semi")


def fetch_ordered(
    docs: DataFrame,
    requests: DataFrame,
    output: list[str] | None = None,
    *,
    include_vector: bool = True,
    vectors: tuple[str, ...] | None = None,
) -> DataFrame:
    """One row per request ``(pos, id)``, repeats kept; unknown ids give NULL columns.

    ``found`` tells a missing document from one whose columns are NULL. The table side is
    first cut to the asked ids, so a much-repeated id meets one small row.
    """
    rows = fetch(docs, requests, output, include_vector=include_vector, vectors=vectors)
    rows = rows.withColumn("found", F.lit(True))
    joined = look_up(requests.select("pos", "id"), rows, "id", "pos")
    others = [c for c in rows.columns if c not in ("id", "found")]
    return joined.select(
        "pos", "id", F.coalesce("found", F.lit(False)).alias("found"), *others
    )
