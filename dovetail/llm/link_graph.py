"""URL filter: rules first, then trust and distrust spread over host edges.

Every host carries two scores. Trust is a personalised PageRank started at the
hosts whose pages allow rules accept; it follows links. Distrust starts at
hosts whose pages block rules refuse and follows links backwards: linking to
bad hosts is what makes a host suspect. Both are scaled to the host's share of
the seed mass per page, and a host is blocked where distrust exceeds trust by
a threshold. A page no rule fits gets the verdict of its host.

Edges: absolute and protocol-relative links between different hosts, one row
per pair with a count (relative links stay on the host and say nothing about
another one). Hosts without edges keep their seed score. A walk goes on until
what all later steps together can change is below a tolerance and below every
host's distance from the threshold: the sum of changes shrinks by the damping
with each step, so it bounds the rest. A step is two joins and one aggregation
with map-side combine, written out so that lineage stays short.

Scale: pages are cut to (page_id, url, links) at the scan; a host with a third
of the pages is one row per task after the first partial aggregation.

Defined cases: a null url, or one without ``://``, has an empty host and path;
no rule fits it and the empty host, like any without seeds, is allowed; a null
html has no links; repeated pages count as often as they come; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dovetail.llm.common import core, materialise


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the contract, in its order.
RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"),
         Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))
DAMPING = 0.85
STEPS = 8  # steps the SQL statement writes out: it agrees where they settle all scores
TOLERANCE = 1e-3  # pages
FINEST = 1e-9  # pages; a host closer to the threshold than this is on it
ROUNDING = 1e-12  # of the whole seed mass: no tolerance is below it
THRESHOLD = 0.5
LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""
A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(c: Column) -> Column:
    return F.translate(c, A_TO_Z, A_TO_Z.lower())


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (between the first :// and the next / ? #) and path (up to ? #)."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    return (lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def best_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The longest rule that fits (struct name, verdict), null if none does."""
    out = None
    for r in sorted(rules, key=lambda r: -len(r.name)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        one = F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))
        out = F.when(fits, one) if out is None else out.when(fits, one)
    return out


def judged(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    p = core(pages, ("page_id", "bigint"), ("url", "string"), ("html", "string"))
    host, path = split_url(F.coalesce("url", F.lit("")))
    p = p.select("page_id", host.alias("host"), path.alias("path"), "html")
    return p.withColumn("r", best_rule(F.col("host"), F.col("path"), rules)).select(
        "page_id", "host", "path", F.col("r.rule").alias("rule"), F.col("r.verdict").alias("verdict"), "html")


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, w): links from pages of src to other hosts."""
    links = pages.where("host <> ''").select("host", F.explode(F.regexp_extract_all(
        F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1))).alias("to"))
    return (links.select(F.col("host").alias("src"), lower_ascii(F.col("to")).alias("dst")).where("src <> dst")
            .groupBy("src", "dst").agg(F.count("*").cast("double").alias("w")))


def propagate(hosts: DataFrame, edges: DataFrame, threshold: float = THRESHOLD, damping: float = DAMPING) -> DataFrame:
    """hosts (host, n, t0, d0: seed masses) -> host, n, trust, distrust.

    ``x <- (1 - c) * seed + c * (what edges bring; all of it stays where a host
    has no edge to give it to)``, for trust along and for distrust against the
    links; hosts known only as link targets take part with no pages.

    Scores are within TOLERANCE of their limit, and on its side of the threshold."""
    steps_in = edges.select(F.col("src").alias("a"), F.col("dst").alias("b"), "w", F.lit(0).alias("kind")).unionByName(
        edges.select(F.col("dst").alias("a"), F.col("src").alias("b"), "w", F.lit(1).alias("kind")))
    total = steps_in.groupBy("a", "kind").agg(F.sum("w").alias("out"))
    moves = materialise(steps_in.join(total, ["a", "kind"]).select("a", "b", "kind", (F.col("w") / F.col("out")).alias("p")),
                        "host-moves")
    seeds = hosts.unionByName(moves.select(F.col("b").alias("host"), F.lit(0).cast("bigint").alias("n"),
                                           F.lit(0.0).alias("t0"), F.lit(0.0).alias("d0")))
    gives = moves.groupBy(F.col("a").alias("host")).agg(
        F.max(F.col("kind") == 0).alias("gives_t"), F.max(F.col("kind") == 1).alias("gives_d"))
    now = seeds.groupBy("host").agg(F.sum("n").alias("n"), F.sum("t0").alias("t0"), F.sum("d0").alias("d0"))
    now = materialise(now.join(gives, "host", "left").select(
        "host", "n", "t0", "d0", F.coalesce("gives_t", F.lit(False)).alias("gives_t"),
        F.coalesce("gives_d", F.lit(False)).alias("gives_d"), F.col("t0").alias("trust"), F.col("d0").alias("distrust")), "host-scores")
    if moves.isEmpty():  # no links between hosts: every walk stays where it starts
        return now.select("host", "n", "trust", "distrust")
    mass = now.agg(F.sum(F.col("t0") + F.col("d0"))).first()[0]
    per = F.greatest(F.col("n"), F.lit(1))
    # pages by which a host's balance misses the threshold
    margin = F.abs(F.col("distrust") - F.col("trust") - threshold * per)
    while True:
        carried = now.select(F.col("host").alias("a"), "trust", "distrust").join(moves, "a").groupBy(F.col("b").alias("host")).agg(
            F.sum(F.when(F.col("kind") == 0, F.col("p") * F.col("trust")).otherwise(0.0)).alias("in_t"),
            F.sum(F.when(F.col("kind") == 1, F.col("p") * F.col("distrust")).otherwise(0.0)).alias("in_d"))

        def score(seed: str, own: str, gives_: str, came: str) -> Column:
            stay = F.when(F.col(gives_), 0.0).otherwise(F.col(own))
            return (1 - damping) * F.col(seed) + damping * (F.coalesce(F.col(came), F.lit(0.0)) + stay)

        now = materialise(now.join(carried, "host", "left").select(
            "host", "n", "t0", "d0", "gives_t", "gives_d",
            score("t0", "trust", "gives_t", "in_t").alias("trust"),
            score("d0", "distrust", "gives_d", "in_d").alias("distrust"),
            F.col("trust").alias("old_t"), F.col("distrust").alias("old_d")), "host-scores")
        changed, nearest = now.agg(F.sum(F.abs(F.col("trust") - F.col("old_t")) + F.abs(F.col("distrust") - F.col("old_d"))),
                                   F.min(margin)).first()
        now = now.drop("old_t", "old_d")
        rest = changed * damping / (1 - damping)
        if rest <= max(TOLERANCE, ROUNDING * mass) and (nearest > rest or rest <= max(FINEST, ROUNDING * mass)):
            return now.select("host", "n", "trust", "distrust")


def host_verdicts(pages: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """host, trust and distrust per page of the host, verdict. ``pages`` as from
    :func:`judged`. Seed masses are page counts, so a score divided by the
    host's pages is 1 where rules refuse (or accept) all of them."""
    seeds = pages.where("host <> ''").groupBy("host").agg(
        F.count("*").alias("n"),
        F.sum(F.when(F.col("verdict") == "allow", 1.0).otherwise(0.0)).alias("t0"),
        F.sum(F.when(F.col("verdict") == "block", 1.0).otherwise(0.0)).alias("d0"))
    s = propagate(seeds, host_edges(pages), threshold)
    per = F.greatest(F.col("n"), F.lit(1))
    return s.select("host", (F.col("trust") / per).alias("trust"), (F.col("distrust") / per).alias("distrust")).withColumn(
        "host_verdict", F.when(F.col("distrust") - F.col("trust") >= threshold, "block").otherwise("allow"))


def filter_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule, verdict of every page, and its host's scores."""
    p = judged(pages, rules)
    hosts = host_verdicts(p, threshold)
    out = p.drop("html").join(hosts, "host", "left")
    return out.select("page_id", "host", "path", "rule",
                      F.coalesce("verdict", "host_verdict", F.lit("allow")).alias("verdict"),
                      F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
