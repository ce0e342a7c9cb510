"""URL verdicts by rules and, where no rule fits, by link-graph propagation.

Pages that a rule allows make their hosts trusted seeds, pages that a rule
blocks make theirs distrusted seeds. Trust flows along the host links
(personalised PageRank from the trusted seeds); distrust flows against them,
from a blocked host to the hosts that link to it. A host with more distrust
than trust is blocked.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle

#: Share of a host's score that flows on; the change (summed over hosts) below
#: which the scores hold, under what a verdict goes by; rounds after which this
#: must be so (0.85^200 is 1e-14); rounds that are planned as one.
DAMPING, ROUNDS, STILL, STEP = 0.85, 1000, 1e-13, 8
#: Hosts that a page links to, with a scheme or relative to one.
LINK = r"""(?i)\b(?:href|src|action)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""
SPLIT = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or no '://'."""
    u = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(u, SPLIT, 1)), F.regexp_extract(u, SPLIT, 2)


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null. Rules of
    one length: block goes before allow, then by code point."""
    ordered = sorted(rules, key=lambda r: (-len(r[1]), r[0] != "block", r[1]))
    out = []
    for verdict, rule in ordered:
        rule_host, slash, rule_path = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rule_path)
        out.append(F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*out) if out else F.lit(None).cast("struct<rule:string,verdict:string>")


def host_edges(pages: DataFrame) -> DataFrame:
    """(a, b, n): links of pages of host a to host b, other hosts only."""
    links = pages.select(F.col("host").alias("a"), F.explode(F.regexp_extract_all(F.col("html"), F.lit(LINK), F.lit(1))).alias("b"))
    links = links.withColumn("b", lower_ascii(F.col("b"))).filter((F.col("a") != "") & (F.col("a") != F.col("b")))
    return links.groupBy("a", "b").agg(F.count("*").alias("n"))


def propagate(seeds: DataFrame, edges: DataFrame) -> DataFrame:
    """(host, trust, distrust) from seeds (host, trust0, distrust0). What a
    host without links would pass on stays with it: as it passes nothing on,
    its own share is summed up at once. An error if the scores do not settle."""
    # sums joined back, with partial sums before the shuffle: a popular host's links stay dealt over tasks
    given = edges.groupBy(F.col("a").alias("from")).agg(F.sum("n").alias("out_n"))
    taken = edges.groupBy(F.col("b").alias("into")).agg(F.sum("n").alias("in_n"))
    total = edges.join(given, F.col("a") == F.col("from")).join(taken, F.col("b") == F.col("into"))
    flows = settle(total.select("a", "b", (F.col("n") / F.col("out_n")).alias("along"), (F.col("n") / F.col("in_n")).alias("against")), "links")
    hosts = seeds.select("host").union(flows.select("a")).union(flows.select("b")).distinct()
    zero = F.lit(0.0)
    ends = {k: flows.select(F.col(k).alias("host")).distinct().withColumn(f"has_{k}", F.lit(True)) for k in "ab"}
    base = hosts.join(seeds, "host", "left").join(ends["a"], "host", "left").join(ends["b"], "host", "left")
    base = base.select("host", F.coalesce("trust0", zero).alias("trust0"), F.coalesce("distrust0", zero).alias("distrust0"), F.coalesce("has_a", F.lit(False)).alias("has_a"), F.coalesce("has_b", F.lit(False)).alias("has_b"))
    base = settle(base, "hosts")
    arcs = flows.select(F.col("a").alias("of"), F.col("b").alias("to"), "along", zero.alias("against")).union(flows.select(F.col("b").alias("of"), F.col("a").alias("to"), zero.alias("along"), "against"))
    arcs = settle(arcs, "arcs")

    def score(start: str, got: str, passes: str) -> Column:
        came = DAMPING * F.coalesce(got, zero)
        return F.when(F.col(passes), (1 - DAMPING) * F.col(start) + came).otherwise(F.col(start) + came / (1 - DAMPING))

    now, done = base.select("host", F.col("trust0").alias("trust"), F.col("distrust0").alias("distrust")), 0
    while done < ROUNDS:
        new = now
        for _ in range(STEP if done else 1):  # without links one round tells
            got = new.join(arcs, F.col("host") == F.col("of")).groupBy(F.col("to").alias("host")).agg(F.sum(F.col("trust") * F.col("along")).alias("dt"), F.sum(F.col("distrust") * F.col("against")).alias("db"))
            new = base.join(got, "host", "left").select("host", score("trust0", "dt", "has_a").alias("trust"), score("distrust0", "db", "has_b").alias("distrust"))
            done += 1
        new = settle(new, "ranks")
        was = now.select("host", F.col("trust").alias("was_t"), F.col("distrust").alias("was_b"))
        moved = new.join(was, "host").agg(F.sum(F.abs(F.col("trust") - F.col("was_t")) + F.abs(F.col("distrust") - F.col("was_b")))).first()[0] or 0.0
        now = new
        if moved < STILL:
            return now
    raise RuntimeError(f"host scores still moved by {moved} after {done} rounds")


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """(page_id, host, path, rule, verdict, host_blocked) of every row of
    ``pages`` (page_id, url, html).

    A null url, or one without '://', has an empty host and path; no rule fits
    it and it is allowed, as is a host that no score reaches. A null html has
    no links. Repeated rows are judged row by row and count in the seeds as
    often. An empty table gives an empty result. Other columns are not read.
    """
    host, path = host_and_path(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"), "html")
    ruled = split.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules))
    known = settle(ruled.select("page_id", "host", "path", "fit"), "judged")
    of_hosts = known.filter(F.col("host") != "")
    counts = of_hosts.groupBy("host").agg(*[F.sum(F.when(F.col("fit.verdict") == v, 1).otherwise(0)).alias(v) for v in ("allow", "block")])
    n = F.lit(of_hosts.count())  # one number: shares of all pages
    seeds = counts.select("host", (F.col("allow") / n).alias("trust0"), (F.col("block") / n).alias("distrust0"))
    scores = propagate(settle(seeds, "seeds"), settle(host_edges(split), "edges"))
    # equal up to the rounding of sums in another order counts as equal
    blocked = scores.select("host", (F.col("distrust") - F.col("trust") > 1e-12).alias("host_blocked"))
    out = known.join(blocked, "host", "left")
    verdict = F.coalesce(F.col("fit.verdict"), F.when(F.coalesce("host_blocked", F.lit(False)), F.lit("block")).otherwise(F.lit("allow")))
    return out.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"), F.coalesce("host_blocked", F.lit(False)).alias("host_blocked"))
