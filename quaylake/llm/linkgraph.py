"""URL filter: explicit host rules, then trust and distrust spread over host links.

Explicit rules decide the pages they fit. For the others the host graph
decides. Its nodes are the hosts of pages and of links and every domain above
them; its edges are the links, and each node and the domain directly above it, in
both directions. Hosts with pages that a rule allows are trusted seeds, hosts with
blocked pages are distrusted seeds. Trust follows links (personalised PageRank);
distrust runs against them, from a blocked host to the hosts that link to it. A
host whose distrust outweighs its trust by ``threshold`` is blocked.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaylake.llm.common import LOWER, UPPER, materialize


@dataclass(frozen=True)
class UrlRule:
    """``host`` fits itself and its subdomains; the url's path has to start with ``path``."""

    host: str
    path: str
    action: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    UrlRule("com", "/", "allow"),
    UrlRule("example.com", "/en/", "block"),
    UrlRule("www.example.com", "/en/", "allow"),
    UrlRule("net", "/es/", "block"),
    UrlRule("net", "/fr/", "block"),
)
URL = r"://([^/?#]*)([^?#]*)"
# absolute or protocol-relative targets in attributes
LINK = r"""(?i)(?:href|src)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""
DAMPING = 0.85
# the spreading ends when no host's score changes by as much any more
TOLERANCE = 1e-3
THRESHOLD = 0.05


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty when it is null or has no ``://``."""
    url = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(url, URL, 1)), F.regexp_extract(url, URL, 2)


def host_suffixes(host: Column) -> Column:
    """The host and the domains above it: a.b.c gives [a.b.c, b.c, c]."""
    labels = F.split(host, r"\.", -1)
    return F.transform(F.sequence(F.lit(1), F.size(labels)),
                       lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (size, rule, action) of the longest rule that fits, else null.

    The rules are a parameter list held in the plan, looked up by the url's host
    suffixes, so a row costs as many probes as its host has labels.
    """
    by_host: dict[str, list[UrlRule]] = {}
    for r in rules:
        by_host.setdefault(r.host, []).append(r)
    if not by_host:
        return F.lit(None).cast("struct<size:int,rule:string,path:string,action:string>")
    entries = []
    for name, group in by_host.items():
        entries += [F.lit(name), F.array(*[F.struct(F.lit(len(r.text)).alias("size"), F.lit(r.text).alias("rule"),
                                                    F.lit(r.path).alias("path"), F.lit(r.action).alias("action"))
                                           for r in group])]
    lookup = F.create_map(*entries)
    hits = F.flatten(F.filter(F.transform(host_suffixes(host), lambda s: F.element_at(lookup, s)),
                              lambda a: a.isNotNull()))
    return F.array_max(F.filter(hits, lambda r: F.startswith(path, r["path"])))


def parent_domain(host: Column) -> Column:
    """The domain directly above a host: what follows its first dot, null without one."""
    return F.when(F.contains(host, F.lit(".")), F.regexp_replace(host, r"^[^.]*\.", ""))


def host_edges(pages: DataFrame) -> DataFrame:
    """Distinct links (src, dst) between different nodes.

    Links are the absolute targets in the page; the targets of a page are made
    distinct in its row and pairs are pre-aggregated, so a host with a third of all
    pages sends few rows. Hosts, link targets and every domain above them are linked
    with the domain directly above in both directions, whether or not it has pages.
    """
    linked = (pages.where("host <> ''")
              .select(F.col("host").alias("src"),
                      F.explode(F.array_distinct(F.transform(
                          F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1)),
                          lower_ascii))).alias("dst")).distinct())
    hosts = (pages.where("host <> ''").select("host").distinct()
             .unionByName(linked.select(F.col("dst").alias("host"))).distinct())
    nodes = hosts.select(F.explode(host_suffixes(F.col("host"))).alias("host")).distinct()
    parents = nodes.select("host", parent_domain(F.col("host")).alias("up")).where("up IS NOT NULL")
    both = (linked.unionByName(parents.select(F.col("host").alias("src"), F.col("up").alias("dst")))
            .unionByName(parents.select(F.col("up").alias("src"), F.col("host").alias("dst"))))
    return both.where("src <> dst").distinct()


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE,
              rounds: int | None = None) -> DataFrame:
    """Trust along edges and distrust against them: (host, trust, distrust).

    ``seeds`` has host, trusted and distrusted (0 or 1). A seed's score without
    any link is ``1 - damping``. What a round adds to the scores is what the round
    before added, moved along the edges and damped; the scores are the sum of all
    rounds, which end when no host gains ``tolerance`` (or after ``rounds``, if
    given). The gains shrink by ``damping`` each round, so the number of rounds
    grows with the logarithm of the seeds. Each round is one join and one
    aggregation that sums map-side, so hubs arrive pre-aggregated, and is written to
    the shared folder.
    """
    out_degree = edges.groupBy("src").agg(F.count("*").alias("n"))
    in_degree = edges.groupBy("dst").agg(F.count("*").alias("n"))
    along = edges.join(out_degree, "src").select(
        F.col("src").alias("host"), F.col("dst").alias("to"), (1.0 / F.col("n")).alias("wt"), F.lit(0.0).alias("wd"))
    against = edges.join(in_degree, "dst").select(
        F.col("dst").alias("host"), F.col("src").alias("to"), F.lit(0.0).alias("wt"), (1.0 / F.col("n")).alias("wd"))
    steps = materialize(along.unionByName(against), "host-edges")
    gains = [materialize(seeds.select("host", ((1 - damping) * F.col("trusted")).alias("trust"),
                                      ((1 - damping) * F.col("distrusted")).alias("distrust")), "host-gains")]
    while rounds is None or len(gains) <= rounds:
        moved = steps.join(gains[-1], "host").select(
            F.col("to").alias("host"), (damping * F.col("trust") * F.col("wt")).alias("trust"),
            (damping * F.col("distrust") * F.col("wd")).alias("distrust"))
        gain = materialize(moved.groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust")),
                           "host-gains")
        most = gain.agg(F.max(F.greatest("trust", "distrust")).alias("m")).first()["m"]
        if most is None or (rounds is None and most < tolerance):
            break
        gains.append(gain)
    every = reduce(DataFrame.unionByName, gains)
    return every.groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))


def judge_pages(pages: DataFrame, rules=RULES, damping: float = DAMPING, tolerance: float = TOLERANCE,
                threshold: float = THRESHOLD) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every page row.

    Pages without a rule follow their host: blocked when distrust minus trust
    (nine digits) exceeds ``threshold``, else allowed. Null urls and urls without
    ``://`` have an empty host, no links and the verdict allow. Repeated rows are
    all judged; columns other than page_id, url and html are ignored.
    """
    host, path = split_url(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"), "html")
    judged = parsed.drop("html").withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules))
    # null-safe flags: a host is a seed if any of its pages fits such a rule
    seeds = (judged.where("host <> '' AND fit IS NOT NULL").groupBy("host")
             .agg(F.max(F.when(F.col("fit.action") == "allow", 1.0).otherwise(0.0)).alias("trusted"),
                  F.max(F.when(F.col("fit.action") == "block", 1.0).otherwise(0.0)).alias("distrusted")))
    scores = propagate(host_edges(parsed.select("host", "html")), seeds, damping, tolerance)
    blocked = (scores.where(F.round(F.col("distrust") - F.col("trust"), 9) > threshold)
               .select("host", F.lit(True).alias("bad")))
    return (judged.join(blocked, "host", "left")
            .select("page_id", "host", "path", F.col("fit.rule").alias("rule"),
                    F.coalesce(F.col("fit.action"),
                               F.when(F.col("bad"), "block").otherwise("allow")).alias("verdict")))
