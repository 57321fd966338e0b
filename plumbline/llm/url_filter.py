"""Page filtering by rules and by trust that spreads over the link graph of hosts.

Rules on hosts and paths decide where they apply. Elsewhere a host is judged by two
personalised PageRanks over the edges between hosts: trust starts at hosts with allowed pages
and follows links forward; distrust starts at hosts that are blocked as a whole and follows
links backward, to those who link there. A host whose distrust is high enough and above its
trust is blocked.

Mass is counted in whole units, so that results do not depend on the order of additions.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.sizing import discard, materialize
from plumbline.llm.common import Column

# (verdict, host, path)
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

ROUNDS = 12
DAMPING = 0.85
# Units of mass that one seed starts with.
UNITS = 1_000_000_000_000
# A host is blocked from this share of a blocked seed's own mass on.
DISTRUST = 0.05

LINK = r"(?i)<a\s[^>]*?href\s*=\s*[\"']?(?:https?:)?//([^/?#\"'>\s]+)"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; empty without ``://``."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    return lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits as a struct of ``rule`` and ``verdict``, or null."""
    picked = F.lit(None).cast("struct<rule: string, verdict: string>")
    # Applied from the shortest on, so that longer rules override.
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == rule_host) | F.endswith(host, F.lit(f".{rule_host}"))) & F.startswith(path, F.lit(rule_path))
        own = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        picked = F.when(fits, own).otherwise(picked)
    return picked


def judged_pages(pages: DataFrame, rules=RULES) -> DataFrame:
    """``page_id``, ``host``, ``path`` and ``picked`` (the rule's struct or null)."""
    placed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    return placed.withColumn("picked", rule_of(F.col("host"), F.col("path"), rules))


def host_edges(pages: DataFrame) -> DataFrame:
    """``src``, ``dst``, ``links``: absolute links between different hosts, counted. Links
    within a host say nothing about it and are left out."""
    found = pages.where("url is not null and html is not null").select(
        host_of(F.col("url")).alias("src"),
        F.explode(F.regexp_extract_all(F.col("html"), F.lit(LINK), F.lit(1))).alias("dst"),
    )
    found = found.select("src", lower_ascii(F.col("dst")).alias("dst")).where("src <> dst and src <> ''")
    return found.groupBy("src", "dst").agg(F.count("*").alias("links"))


def seeds(judged: DataFrame, rules=RULES) -> DataFrame:
    """``kind``, ``host``, ``seed``: hosts with an allowed page are trusted; hosts under a rule
    that blocks every path are distrusted. A rule on part of a host does not blame the host."""
    whole = [host + path for verdict, host, path in rules if verdict == "block" and path in ("", "/")]
    trusted = F.max(F.when(F.col("picked.verdict") == "allow", 1).otherwise(0)) == 1
    blocked = F.max(F.when(F.col("picked.rule").isin(whole), 1).otherwise(0)) == 1
    hosts = judged.where("picked is not null").groupBy("host").agg(trusted.alias("t"), blocked.alias("b"))
    kinds = F.array_compact(
        F.array(F.when(F.col("t"), F.lit("trust")), F.when(F.col("b") & ~F.col("t"), F.lit("distrust")))
    )
    return hosts.select(F.explode(kinds).alias("kind"), "host", F.lit(UNITS).alias("seed"))


def propagate(edges: DataFrame, seeded: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING) -> DataFrame:
    """``kind``, ``host``, ``mass`` after so many rounds from the seeds.

    Each round passes on ``damping`` of a host's mass along its edges, by their share of the
    host's links, and refills the seeds. Mass of hosts without an edge is not passed on. The
    edges are written once with their shares; each round joins the much smaller masses to them.
    """
    trust = edges.select(F.lit("trust").alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b"), "links")
    distrust = edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("a"), F.col("src").alias("b"), "links")
    both = materialize(trust.union(distrust), "host-edges")
    totals = materialize(both.groupBy("kind", "a").agg(F.sum("links").alias("total")), "host-totals")
    shares = both.join(totals, ["kind", "a"]).withColumnRenamed("a", "host")
    shares = materialize(shares, "host-shares")
    seeded = materialize(seeded, "host-seeds")
    mass = seeded.select("kind", "host", F.col("seed").alias("mass"))
    if shares.isEmpty():
        return mass
    refill = seeded.select("kind", "host", F.floor((1 - damping) * F.col("seed")).alias("mass"))
    for _ in range(rounds):
        flow = F.floor(damping * F.col("mass") * F.col("links") / F.col("total")).alias("mass")
        moved = shares.join(mass, ["kind", "host"]).select("kind", F.col("b").alias("host"), flow)
        after = moved.union(refill).groupBy("kind", "host").agg(F.sum("mass").alias("mass"))
        after = materialize(after, "host-mass")
        discard(mass)
        mass = after
    return mass


def filter_pages(pages: DataFrame, rules=RULES, distrust: float = DISTRUST) -> DataFrame:
    """One row per page: ``page_id``, ``host``, ``path``, ``rule`` (null where none fits),
    ``verdict`` (``allow`` or ``block``), ``trust`` and ``distrust`` of the host in seeds.

    Pages without a usable url have an empty host and path, which no rule fits and no link
    reaches, and are allowed. Repeated rows are judged alike; other columns are ignored.
    """
    judged = judged_pages(pages, rules)
    mass = propagate(host_edges(pages), seeds(judged, rules))
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("mass")).otherwise(0))
    hosts = mass.groupBy("host").agg(of("trust").alias("t"), of("distrust").alias("d"))
    hosts = materialize(hosts, "host-verdicts")
    joined = judged.join(hosts, "host", "left")
    t, d = F.coalesce("t", F.lit(0)), F.coalesce("d", F.lit(0))
    spread = F.when((d >= int(distrust * UNITS)) & (d > t), "block").otherwise("allow")
    return joined.select(
        "page_id",
        "host",
        "path",
        F.col("picked.rule").alias("rule"),
        F.coalesce(F.col("picked.verdict"), spread).alias("verdict"),
        (t / UNITS).alias("trust"),
        (d / UNITS).alias("distrust"),
    )
