"""Judging urls by host rules, and hosts without a rule by the link graph.

Trust starts at hosts with pages that a rule allows and follows links forward; distrust starts at
hosts with pages that a rule blocks and follows links backward, to hosts that link there. Both are
personalised PageRanks over weighted host edges, with built-in functions only, iterated until they
have converged. A host is blocked where its distrust outweighs its trust.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.common import stored
from wordloom.session import local_table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)\b(?:href|src)\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""

# host, path, verdict.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
DAMPING = 0.85
# Rounds between two written tables, so that a lost executor never repeats all of them; after each
# of these tables the ranks are compared with the table before.
ROUNDS_STORED = 6
# The ranks have converged when both together have changed by less from table to table, summed over
# all hosts; what is still to come is less than that. Scores are given to as many places.
TOLERANCE = 1e-9
# Rounds that bring the change below the tolerance on any graph. No limit: ways that are longer are
# followed to their ends.
ROUNDS = math.ceil(math.log(TOLERANCE / 4) / math.log(DAMPING))
# A host without a rule is blocked when its distrust exceeds so many times its trust.
THRESHOLD = 1.0
# Edges of a host that meet one copy of its ranks.
ENDS_PER_COPY = 10_000
# Ways in which the pages of one host are spread in a join.
SALTS = 16


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, "://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffixes(host: Column) -> Column:
    """The host and all domains above it, longest first."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )


def salted(rows: DataFrame, by: str) -> DataFrame:
    return rows.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(SALTS)))


def for_every_salt(hosts: DataFrame) -> DataFrame:
    every = F.array(*[F.lit(i).cast("long") for i in range(SALTS)])
    return hosts.withColumn("salt", F.explode(every))


def rules_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return local_table(spark, [tuple(r) for r in rules], "rule_host string, rule_path string, rule_verdict string")


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, rules``: what may apply on a host, longest rule first.

    A host has no more entries than there are rules for it and the domains above it.
    """
    rule = F.struct(
        (-F.length("rule_host") - F.length("rule_path")).alias("order"),
        F.col("rule_path").alias("path"),
        F.concat("rule_host", "rule_path").alias("rule"),
        F.col("rule_verdict").alias("verdict"),
    )
    reached = hosts.select("host", F.explode(suffixes(F.col("host"))).alias("rule_host"))
    fitting = reached.join(rules, "rule_host").groupBy("host")
    return fitting.agg(F.array_sort(F.collect_list(rule)).alias("rules"))


def ruled(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """The pages (``page_id, host, path``) with ``rule`` and ``rule_verdict``, null without one."""
    by_host = for_every_salt(host_rules(pages.select("host").distinct(), rules))
    joined = salted(pages, "path").join(by_host, ["host", "salt"], "left")
    best = F.filter("rules", lambda r: F.startswith(F.col("path"), r["path"]))
    first = F.when(F.size(best) > 0, F.element_at(best, 1))
    return joined.select(
        "page_id", "host", "path", first["rule"].alias("rule"), first["verdict"].alias("rule_verdict")
    )


def link_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``source, target, weight``: number of pages' links between different hosts.

    Links count by the address they name, with or without a scheme before ``//``; those without a
    host stay on their own and don't count.
    """
    linked = pages.select(
        host_of(F.col(f"`{url}`")).alias("source"),
        F.explode(F.regexp_extract_all(F.col(f"`{html}`"), F.lit(LINK), F.lit(1))).alias("link"),
    )
    linked = linked.select("source", F.translate("link", UPPER, LOWER).alias("target"))
    linked = linked.filter("source <> '' AND target <> '' AND source <> target")
    return linked.groupBy("source", "target").agg(F.count("*").cast("double").alias("weight"))


def family_edges(hosts: DataFrame) -> DataFrame:
    """Edges both ways between each host and the domain around it, up to domains of two labels.

    Domains are nodes of the graph whether they have pages or not, so that sister hosts meet in
    them. Numeric addresses have no domains.
    """
    named = hosts.filter("host <> ''").filter(~F.rlike("host", F.lit(r"(^|\.)[0-9]+(:[0-9]*)?$")))
    domains = suffixes(F.col("host"))
    around = F.transform(
        F.sequence(F.lit(1), F.size("domains") - 2),
        lambda i: F.struct(F.get("domains", i - 1).alias("source"), F.get("domains", i).alias("target")),
    )
    chains = named.select(F.explode(F.array(domains)).alias("domains")).filter(F.size("domains") > 2)
    up = chains.select(F.inline(around)).distinct()
    down = up.select(F.col("target").alias("source"), F.col("source").alias("target"))
    return up.unionByName(down).withColumn("weight", F.lit(1.0))


def shares(edges: DataFrame, start: str, end: str) -> DataFrame:
    """Each start's weight spread over its ends: ``here, copies, copy, there, share``.

    A start with many ends has several copies, so that no join gets all its ends at once.
    """
    total = edges.groupBy(F.col(start).alias("here")).agg(
        F.sum("weight").alias("total"), F.ceil(F.count(F.lit(1)) / ENDS_PER_COPY).cast("int").alias("copies")
    )
    copy = F.pmod(F.xxhash64(F.col(end)), F.col("copies")).cast("int")
    return edges.withColumnRenamed(start, "here").join(total, "here").select(
        "here", "copies", copy.alias("copy"), F.col(end).alias("there"), (F.col("weight") / F.col("total")).alias("share")
    )


def moved(ranks: DataFrame, before: DataFrame) -> tuple[float, int]:
    """The summed change of both ranks, and how many hosts trust or distrust has newly reached."""
    signed = ranks.withColumn("sign", F.lit(1)).unionByName(before.withColumn("sign", F.lit(-1)))
    reached = (F.col("trust") > 0).cast("int") + (F.col("distrust") > 0).cast("int")
    changes = signed.groupBy("host").agg(
        F.abs(F.sum(F.col("trust") * F.col("sign"))).alias("trust"),
        F.abs(F.sum(F.col("distrust") * F.col("sign"))).alias("distrust"),
        F.sum(reached * F.col("sign")).alias("reached"),
    )
    row = changes.agg(F.sum(F.col("trust") + F.col("distrust")), F.sum("reached")).first()
    return row[0] or 0.0, row[1] or 0


def extrapolated(ranks: DataFrame, before: DataFrame, factor: float) -> DataFrame:
    """Ranks without the part that shrinks by exactly this factor from ``before`` to ``ranks``.

    Groups of hosts that no edge leaves keep what they have, so that their share of all rank comes
    right by the damping alone, the slowest part there is, forwards as well as, where hosts and
    domains take turns, back and forth. Over an even number of rounds both have the same factor.
    """
    parts = ranks.withColumn("weight", F.lit(1.0)).unionByName(before.withColumn("weight", F.lit(-factor)))
    return parts.groupBy("host").agg(
        *[(F.sum(F.col(c) * F.col("weight")) / (1 - factor)).alias(c) for c in ("trust", "distrust")]
    )


def propagate(
    seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE
) -> DataFrame:
    """``host, trust, distrust`` from ``host, trusted, blocked`` (seed weights) and host edges.

    Each round a host keeps its part of the seeds and hands the rest on along its edges, trust
    forward, distrust backward. What a host without edges would hand on is lost, for both alike.
    Rounds go on until the ranks change by less than the tolerance and reach no further host. After
    the first table the slowest part of the error is taken out by extrapolation; from any start the
    rounds lead to the same ranks.
    Hosts that nothing reaches are not in the result.
    """
    sums = seeds.agg(F.sum("trusted").alias("t"), F.sum("blocked").alias("b"))
    total = sums.first()
    own = stored(
        seeds.select(
            "host",
            (F.col("trusted") / (total["t"] or 1.0)).alias("trust"),
            (F.col("blocked") / (total["b"] or 1.0)).alias("distrust"),
        ).filter("trust > 0 OR distrust > 0"),
        "host-seeds",
    )
    forward = shares(edges, "source", "target").withColumn("kind", F.lit("trust"))
    backward = shares(edges, "target", "source").withColumn("kind", F.lit("distrust"))
    steps = stored(forward.unionByName(backward), "host-edges")
    # Hosts with several copies; all others have one.
    hubs = steps.filter("copies > 1").groupBy(F.col("here").alias("host")).agg(F.max("copies").alias("copies"))
    hubs = stored(hubs, "host-hubs")
    every = F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1)).alias("copy")
    kept = own.select(
        "host",
        (F.col("trust") * (1 - damping) / damping).alias("trust"),
        (F.col("distrust") * (1 - damping) / damping).alias("distrust"),
    )
    ranks, first = own, True
    while True:
        before = ranks
        for _ in range(ROUNDS_STORED):
            copied = ranks.join(hubs, "host", "left").select(F.col("host").alias("here"), "trust", "distrust", every)
            handed = steps.join(copied, ["here", "copy"]).select(
                F.col("there").alias("host"),
                F.when(F.col("kind") == "trust", F.col("trust") * F.col("share")).alias("trust"),
                F.when(F.col("kind") == "distrust", F.col("distrust") * F.col("share")).alias("distrust"),
            )
            ranks = kept.unionByName(handed).groupBy("host").agg(
                F.coalesce(F.sum("trust") * damping, F.lit(0.0)).alias("trust"),
                F.coalesce(F.sum("distrust") * damping, F.lit(0.0)).alias("distrust"),
            )
        ranks = stored(ranks, "host-ranks")
        change, reached = moved(ranks, before)
        if change < tolerance and reached <= 0:
            return ranks
        if first:
            ranks, first = stored(extrapolated(ranks, before, damping**ROUNDS_STORED), "host-ranks"), False


def judge(
    pages: DataFrame,
    rules: DataFrame | None = None,
    edges: DataFrame | None = None,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row for each page: ``page_id, host, path, rule, verdict, trust, distrust``.

    The longest rule that fits decides; without one the host's scores do, and a host without
    scores is allowed. Null urls and urls without ``://`` have an empty host and path, fit no rule
    and are allowed. Repeated rows and null keys get a row each; other columns play no part. The
    edges are those of the pages' links and those between hosts and the domains around them, unless
    they are given.
    """
    spark = pages.sparkSession
    rules = rules_table(spark) if rules is None else rules
    places = pages.select(
        F.col(f"`{key}`").alias("page_id"),
        host_of(F.col(f"`{url}`")).alias("host"),
        path_of(F.col(f"`{url}`")).alias("path"),
    )
    judged = stored(ruled(places, rules), "ruled-pages")
    seeds = judged.groupBy("host").agg(
        F.count_if(F.col("rule_verdict") == "allow").cast("double").alias("trusted"),
        F.count_if(F.col("rule_verdict") == "block").cast("double").alias("blocked"),
    )
    seeds = stored(seeds.filter("host <> ''"), "host-rules")
    if edges is None:
        edges = link_edges(pages, url, html).unionByName(family_edges(seeds))
        edges = edges.groupBy("source", "target").agg(F.sum("weight").alias("weight"))
    ranks = propagate(seeds, stored(edges, "host-links"))
    scores = for_every_salt(ranks)
    joined = salted(judged, "path").join(scores, ["host", "salt"], "left")
    trust, distrust = (F.coalesce(c, F.lit(0.0)) for c in ("trust", "distrust"))
    by_graph = F.when(distrust > threshold * trust, "block").otherwise("allow")
    return joined.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("rule_verdict", by_graph).alias("verdict"),
        F.round(trust, 9).alias("trust"),
        F.round(distrust, 9).alias("distrust"),
    )
