"""URL filter: rules for hosts and paths, and trust propagated over the links between hosts.

Rules judge a url where one fits. The other urls are judged by their host: trust flows from
trusted seed hosts along links (personalised PageRank), distrust flows from blocked seed
hosts against the links (a host that links to blocked hosts is suspect). A host seeds trust and
distrust by the shares of its pages that the rules allow and block. A host is blocked if its
distrust is at least ``FLOOR`` of an average host's and makes up at least ``THRESHOLD`` of its
trust and distrust together (each as a share of its total); otherwise its pages are allowed.
There, what a host itself seeds counts only if the rules judge more than half of its pages that
way: a few blocked pages are no verdict on the others, but on hosts that link there.

Host edges are counted by page before they are shuffled, so a host with a third of all pages
costs one row per linked host and task. The state of a round is written to the shared
folder. Relative links stay on their host and make no edge.

Rounds go on until all ranks together move by at most ``TOLERANCE`` of their sum; it is an error
if ``MOST_ROUNDS`` do not reach that.

Defined cases: a null url, or one without ``://``, has an empty host and path, fits no rule
and is allowed, as an empty host has no links. Null html has no links; very long html is searched
whole. Of rules that are equally long the one with the longer host counts, then the one that comes
last by verdict, host and path. Repeated rows are judged alike and count as pages of their own.
Other columns are neither read nor returned. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, UPPER, written

#: verdict, host, path
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
LINK = r"""(?i)\s(?:href|src|action)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.\-]*:)?//([^/?#"'\s>]+)"""
DAMPING, TOLERANCE = 0.85, 1e-6
#: Rounds in which ranks must meet the tolerance; 0.85 ** 200 is below 1e-14.
MOST_ROUNDS = 200
#: Rounds between looks at how far the ranks moved (the first is looked at as well).
LOOK = 5
FLOOR, THRESHOLD = 0.5, 0.5


def lower(text: Column) -> Column:
    """A-Z only."""
    return F.translate(text, UPPER, LOWER)


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return lower(host), path


def ruled(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """``page_id, host, path, rule, ruled``: the longest rule that fits, and what it says."""
    url = F.coalesce("url", F.lit(""))
    host, path = parts(url)
    fit = F.lit(None).cast("struct<rule:string,ruled:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]), r)):
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        fit = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("ruled"))).otherwise(fit)
    return (
        pages.select("page_id", host.alias("host"), path.alias("path"), "html")
        .withColumn("fit", fit)
        .select("page_id", "host", "path", "fit.rule", "fit.ruled", "html")
    )


def host_edges(judged: DataFrame) -> DataFrame:
    """``src, dst, n``: how many pages of a host link to another host."""
    linked = F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)), lower))
    return (
        judged.where((F.col("host") != "") & F.col("html").contains("//"))
        .select(F.col("host").alias("src"), F.explode(linked).alias("dst"))
        .where("src != dst AND dst != ''")
        .groupBy("src", "dst")
        .agg(F.count("*").alias("n"))
    )


def propagated(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """Trust along the edges and distrust against them: ``kind, host, rank``.

    ``seeds`` is ``kind`` (trust or distrust), ``host`` and ``weight``. A host without links passes
    nothing on; returning that to the seeds would scale all ranks of a kind alike.
    """
    along = edges.select(F.lit("trust").alias("kind"), "src", "dst", "n")
    against = edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    both = along.unionByName(against)
    degree = both.groupBy("kind", "src").agg(F.sum("n").alias("of"))
    step = written(
        both.join(degree, ["kind", "src"]).select("kind", "src", "dst", (F.col("n") / F.col("of")).alias("share")), "trust-edges"
    )
    start = written(seeds.select("kind", "host", ((1 - DAMPING) * F.col("weight")).alias("rank")), "trust-seeds")
    state = start
    for nth in range(1, MOST_ROUNDS + 1):
        sent = step.join(state.withColumnRenamed("host", "src"), ["kind", "src"]).groupBy("kind", F.col("dst").alias("host"))
        new = start.unionByName(sent.agg((F.sum(F.col("share") * F.col("rank")) * DAMPING).alias("rank")))
        new = written(new.groupBy("kind", "host").agg(F.sum("rank").alias("rank")), "trust-state")
        state, before = new, state
        if nth > 1 and nth % LOOK and nth < MOST_ROUNDS:
            continue
        moved = new.join(before.withColumnRenamed("rank", "old"), ["kind", "host"], "full")
        gap = F.sum(F.abs(F.coalesce("rank", F.lit(0.0)) - F.coalesce("old", F.lit(0.0))))
        weight = F.sum(F.coalesce("rank", F.lit(0.0)))
        gap, weight = moved.agg(gap, weight).first()
        if (gap or 0.0) <= TOLERANCE * (weight or 0.0):
            return state
    raise RuntimeError(f"ranks still move after {MOST_ROUNDS} rounds")


def host_verdicts(judged: DataFrame, threshold: float = THRESHOLD, floor: float = FLOOR) -> DataFrame:
    """``host, trust, distrust, verdict`` of every host with pages or links to it."""
    said = lambda verdict: F.sum((F.coalesce("ruled", F.lit("")) == verdict).cast("long"))
    hosts = written(
        judged.where("host != ''").groupBy("host").agg(F.count("*").alias("pages"), said("allow").alias("allow"), said("block").alias("block")),
        "trust-hosts",
    )
    seed = lambda kind, of: F.struct(F.lit(kind).alias("kind"), (F.col(of) / F.col("pages")).alias("weight"))
    seeds = hosts.select("host", F.inline(F.array(seed("trust", "allow"), seed("distrust", "block")))).where("weight > 0")
    edges = written(host_edges(judged), "trust-links")
    ranks = propagated(edges, seeds)
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("rank"))), F.lit(0.0))
    each = ranks.groupBy("host").agg(of("trust").alias("trust"), of("distrust").alias("distrust"))
    everyone = hosts.select("host").union(edges.select("dst")).distinct()
    totals = written(
        ranks.agg(of("trust").alias("all_trust"), of("distrust").alias("all_distrust")).crossJoin(
            everyone.agg(F.count("*").alias("hosts"))
        ),
        "trust-totals",
    )  # one row
    all_trust, all_distrust, n = totals.first()
    share = lambda part, whole: F.round(F.coalesce(part, F.lit(0.0)) / F.lit(whole or 1.0), 12)
    trust, distrust = share(F.col("trust"), all_trust), share(F.col("distrust"), all_distrust)

    def judged_by(rank: Column, of: str, whole: float | None) -> Column:
        """The share a host is judged by: without its own seed if that is a minority of its pages."""
        minor = F.col(of) / F.col("pages")
        own = F.when(minor <= 0.5, minor * (1 - DAMPING) / F.lit(whole or 1.0)).otherwise(0.0)
        return F.round(rank - F.coalesce(own, F.lit(0.0)), 12)

    t, d = judged_by(trust, "allow", all_trust), judged_by(distrust, "block", all_distrust)
    bad = (d * n >= floor) & (d >= threshold * (t + d)) & (d > 0)
    return everyone.join(each, "host", "left").join(hosts, "host", "left").select(
        "host", trust.alias("trust"), distrust.alias("distrust"), F.when(bad, "block").otherwise("allow").alias("host_verdict")
    )


def filtered(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, trust, distrust`` of every page."""
    judged = ruled(pages, rules)
    hosts = written(host_verdicts(judged), "trust-verdicts")
    return judged.drop("html").join(hosts, "host", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("ruled", "host_verdict", F.lit("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
