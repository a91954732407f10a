"""URL filter: rules first, else the empirical-Bayes reputation of the host.

Labelled pages (good or bad) are counted per host.  A host's good rate is
shrunk toward its registered domain's, that one's toward its suffix's, and
the suffix's toward the rate of all labelled pages, each through a
beta-binomial prior: the parent's posterior mean times a strength ``k``
fitted per level by the method of moments.  A page is blocked when even the
upper posterior bound ``mean + z * sd`` of its host's good rate lies under
``least_good``; a host of which little is known is not blocked.

Only DataFrame functions are used.  Counts are partially aggregated, so a
host with a third of all pages is one row after the map side; the per-host
table is joined to the pages by host, and adaptive execution splits a hot
host.  Sub-domains (``m.``, ``www.``) are hosts of their own, shrunk toward
the registered domain.

Defined results: a null url or one without ``://`` has empty host and path
and no rule; the empty host is a host like any other.  A host without labelled
pages has its domain's mean with the prior strength alone.  Labels that are
null take no part; with several labels for a page each counts.  The root rate
starts from the neutral Beta(1, 1).  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import narrow

LEAST_RHO, MOST_RHO = 0.001, 0.5       # prior strengths between 999 and 1


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _last_labels(host: Column, suffixes: Sequence[str], more: int) -> Column:
    """A host's suffix with ``more`` labels before it: the longest of ``suffixes`` that fits, else
    the last label.  A short, fixed parameter that becomes one CASE."""
    out = F.substring_index(host, ".", -1 - more)
    for s in sorted(suffixes, key=len):                              # the longest is tried first
        fits = (host == s) | host.endswith("." + s)
        out = F.when(fits, F.substring_index(host, ".", -s.count(".") - 1 - more)).otherwise(out)
    return out


def registered_domain(host: Column, suffixes: Sequence[str] = ()) -> Column:
    """The suffix and the label before it (the host itself when it has no more)."""
    return _last_labels(host, suffixes, 1)


def suffix(host: Column, suffixes: Sequence[str] = ()) -> Column:
    return _last_labels(host, suffixes, 0)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest of the (verdict, host, path) rules that fits, else nulls.

    A rule fits its host and every sub-domain when the path starts with the
    rule's.  The rule list is a fixed, short parameter and becomes one CASE.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):     # the longest is tried first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def _shrunk(hosts: DataFrame, parents: DataFrame, key: str, parent: str) -> tuple[DataFrame, float]:
    """(key, mean) with every key's rate shrunk toward its parent's mean, and the
    prior strength ``k`` of the level by the method of moments:
    sum n (rate - mean)^2 = sum mean (1 - mean) (1 + (n - 1) / (k + 1)); the weakest
    prior where no key has two labelled pages."""
    seen = hosts.groupBy(key, parent).agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    both = seen.join(parents.withColumnsRenamed({parent: "_p", "mean": "up"}), F.col(parent) == F.col("_p"))
    noise = F.col("up") * (1 - F.col("up"))
    gap = F.col("good") / F.col("n") - F.col("up")
    sums = both.where(F.col("n") > 0).agg(
        F.sum(F.col("n") * gap * gap).alias("spread"), F.sum(noise).alias("noise"),
        F.sum((F.col("n") - 1) * noise).alias("room")).first()          # three numbers per level
    rho = (sums["spread"] - sums["noise"]) / sums["room"] if sums["room"] else MOST_RHO
    k = 1 / min(max(rho, LEAST_RHO), MOST_RHO) - 1
    mean = (k * F.col("up") + F.col("good")) / (k + F.col("n"))
    return both.select(key, mean.alias("mean")), k


def host_reputation(pages: DataFrame, labels: DataFrame, z: float = 1.645, suffixes: Sequence[str] = ()) -> DataFrame:
    """(host, n, good, mean, upper) for every host of ``pages`` (page_id, url), from
    ``labels`` (page_id, good 0/1).  One row per host; ``upper`` is the bound.  ``suffixes`` lists, in
    lower case, those of several labels under which strangers register (``co.uk``, ``github.io``)."""
    outcome = labels.select(F.col("page_id").alias("_i"), F.col("good").cast("double").alias("good"))
    hosts = narrow(
        pages.select("page_id", host_of(F.col("url")).alias("host"))
        .join(outcome, F.col("page_id") == F.col("_i"), "left")
        .groupBy("host").agg(F.coalesce(F.sum("good"), F.lit(0.0)).alias("good"),
                             F.count("good").cast("double").alias("n"))
        .withColumn("domain", registered_domain(F.col("host"), suffixes))
        .withColumn("suffix", suffix(F.col("host"), suffixes))
        .withColumn("root", F.lit("")))
    root = hosts.groupBy("root").agg(((F.sum("good") + 1) / (F.sum("n") + 2)).alias("mean"))
    tops, _ = _shrunk(hosts, root, "suffix", "root")
    domains, _ = _shrunk(hosts, tops, "domain", "suffix")
    means, k = _shrunk(hosts, domains, "host", "domain")
    found = hosts.select("host", "n", "good").join(means.withColumnRenamed("host", "_h"), F.col("host") == F.col("_h"))
    sd = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (k + F.col("n") + 1))
    return found.select("host", "n", "good", "mean", (F.col("mean") + z * sd).alias("upper"))


def filter_urls(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str, str]],
                least_good: float = 0.6, z: float = 1.645, suffixes: Sequence[str] = ()) -> DataFrame:
    """(page_id, host, path, rule, verdict, upper) for every row of ``pages``."""
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, decided = rule_of(F.col("host"), F.col("path"), rules)
    bound = host_reputation(pages, labels, z, suffixes).select(F.col("host").alias("_h"), "upper")
    by_method = F.when(F.col("upper") < least_good, "block").otherwise("allow")
    return (rows.join(bound, F.col("host") == F.col("_h"), "left")
            .select("page_id", "host", "path", rule.alias("rule"),
                    F.coalesce(decided, by_method).alias("verdict"), "upper"))
