"""URL verdicts from rules and from trust that spreads over host edges.

A rule names a host (and with it all its subdomains) and the start of a path; of
the rules that fit a url the longest decides. Urls without a rule get the verdict
of their host:

* Host edges are the links of pages to other hosts, and the ties of a host to the
  host one label above it (pages mostly link within their own host, and who runs
  a domain runs what is under it). Top-level labels are no hosts here.
* Trust is personalised PageRank along the edges, from the hosts of allowed pages.
* Distrust is the same along the reversed edges, from the hosts of blocked pages:
  who links to a bad host is suspect.
* A host is allowed if its trust is at least ``threshold`` of trust and distrust
  together. A host that neither reaches has no evidence against it: allowed.

Seeds weigh as many pages as they have. Both walks are one table of ranks, keyed
by (walk, host): a round is one join with the edges and one sum, pre-aggregated.
Every few rounds the ranks are written to the shared folder, and the walks end when
that long has added no more than ``tolerance`` to the ranks' sum, however far they
have gone. Edges are counted
per pair of hosts before any walk, so a host with a third of all pages is one row
for each neighbour. Ranks that reach a host without edges end there.

Cases: a null url, or one without ``://``, has empty host and path, no rule and no
evidence; null html has no links; repeated rows each get their verdict and weigh
as pages; very long urls and pages are read whole; ties between rules of one length go to block, then by the rule's text;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import ascii_lower, written

DAMPING, TOLERANCE, WRITE_EVERY, THRESHOLD = 0.85, 1e-6, 5, 0.5
#: Steps that a task takes, and the least number of tasks of a round.
STEPS_PER_TASK, LEAST_TASKS = 100_000, 8
#: An address in a page: absolute, or with the page's own scheme.
LINK = r"""(?i)(?:href|src|action)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _rules(hosts: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """host, rules: those that name the host or a domain above it."""
    spark = hosts.sparkSession
    table = spark.createDataFrame(
        [(r, r.partition("/")[0].lower(), "".join(r.partition("/")[1:]), v) for v, r in rules],
        "rule string, domain string, start string, verdict string")
    above = F.expr("transform(sequence(1, size(split(host, '[.]'))), "
                   "i -> array_join(slice(split(host, '[.]'), i, 1000000), '.'))")
    return hosts.select("host", F.explode(above).alias("domain")).join(table, "domain") \
        .groupBy("host").agg(F.array_sort(F.collect_list(F.struct(
            (-F.length("rule")).alias("order"), (F.col("verdict") == "allow").alias("second"),
            "rule", "start", "verdict"))).alias("rules"))


def _ruled(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """page_id, host, path, fit (the rule that decides, or null)."""
    own = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    hosts = _rules(own.select("host").distinct(), rules)
    return own.join(hosts, "host", "left").select(
        "page_id", "host", "path", F.expr("get(filter(rules, r -> startswith(path, r.start)), 0)").alias("fit"))


def host_edges(pages: DataFrame) -> DataFrame:
    """src, dst, w: links between hosts, and the ties of hosts to those above."""
    found = pages.select(host_of(F.col("url")).alias("src"), F.explode(
        F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1))).alias("to"))
    # a link may name a user and a port
    to = ascii_lower(F.regexp_replace(F.regexp_replace("to", "^.*@", ""), ":[0-9]*$", ""))
    links = found.select("src", to.alias("dst")).where("src <> '' and dst <> '' and src <> dst") \
        .groupBy("src", "dst").agg(F.count("*").cast("double").alias("w"))
    links = written(links, "host-links")
    hosts = pages.select(host_of(F.col("url")).alias("host")).distinct() \
        .unionByName(links.select(F.col("dst").alias("host"))).distinct()
    chain = hosts.select(F.split("host", "[.]").alias("l")).where("size(l) > 2") \
        .select(F.explode(F.expr(
            "transform(sequence(1, size(l) - 2), i -> struct(array_join(slice(l, i, size(l)), '.') as a, "
            "array_join(slice(l, i + 1, size(l)), '.') as b))")).alias("e")).select("e.a", "e.b").distinct()
    one = F.lit(1.0).alias("w")
    ties = chain.select(F.col("a").alias("src"), F.col("b").alias("dst"), one) \
        .unionByName(chain.select(F.col("b").alias("src"), F.col("a").alias("dst"), one))
    return links.unionByName(ties).groupBy("src", "dst").agg(F.sum("w").alias("w"))


def spread(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """host, trust, distrust. ``seeds``: walk ('trust' or 'distrust'), host, n."""
    spark = edges.sparkSession
    both = edges.select(F.lit("trust").alias("walk"), F.col("src").alias("host"), F.col("dst").alias("next"), "w") \
        .unionByName(edges.select(F.lit("distrust").alias("walk"), F.col("dst").alias("host"),
                                  F.col("src").alias("next"), "w"))
    out = both.groupBy("walk", "host").agg(F.sum("w").alias("all"))
    steps = written(both.join(out, ["walk", "host"]).select(
        "walk", "host", "next", (damping * F.col("w") / F.col("all")).alias("p")), "host-steps")
    total = seeds.groupBy("walk").agg(F.sum("n").alias("all"))
    again = written(seeds.join(total, "walk").select(
        "walk", "host", ((1 - damping) * F.col("n") / F.col("all")).alias("r")), "seeds")
    tasks = -(-steps.count() // STEPS_PER_TASK)  # from the Parquet footers
    few = tasks < int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranks, mass, gain = again, {}, 1.0
    while gain > tolerance:
        for _ in range(WRITE_EVERY):
            moved = ranks.join(steps, ["walk", "host"]).select(
                "walk", F.col("next").alias("host"), (F.col("r") * F.col("p")).alias("r"))
            ranks = moved.unionByName(again).groupBy("walk", "host").agg(F.sum("r").alias("r"))
            if few:  # each task of a round leaves files until the walks end
                ranks = ranks.coalesce(max(LEAST_TASKS, tasks))
        ranks = written(ranks, "ranks")
        # ranks only grow, and each round adds at most ``damping`` times what the last one did
        now = dict(ranks.groupBy("walk").agg(F.sum("r")).collect())  # one row for each of two walks
        gain = max((m - mass.get(walk, 0.0) for walk, m in now.items()), default=0.0)
        mass = now
    of = lambda walk: F.coalesce(F.sum(F.when(F.col("walk") == walk, F.col("r"))), F.lit(0.0))
    return ranks.groupBy("host").agg(of("trust").alias("trust"), of("distrust").alias("distrust"))


def verdicts(pages: DataFrame, rules: list[tuple[str, str]], threshold: float = THRESHOLD,
             damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust of each page. ``rules``
    are (verdict, rule) pairs, as ("block", "example.org/es/")."""
    ruled = written(_ruled(pages, rules), "ruled-pages")
    seeds = ruled.where("fit is not null").groupBy(
        F.when(F.col("fit.verdict") == "allow", "trust").otherwise("distrust").alias("walk"), "host") \
        .agg(F.count("*").cast("double").alias("n"))
    ranks = spread(host_edges(pages), seeds, damping, tolerance)
    both = F.col("trust") + F.col("distrust")
    host = ranks.select("host", "trust", "distrust",
                        F.when(F.col("trust") >= threshold * both, "allow").otherwise("block").alias("by_host"))
    return ruled.join(host, "host", "left").select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", "by_host", F.lit("allow")).alias("verdict"), "trust", "distrust")
