"""Empirical-Bayes host reputation for URL filtering, with DataFrame functions only.

Outcomes of labelled pages (good or not) are counted per host, registered domain and suffix. Rates are shrunk
downwards: the suffix towards the global rate, the domain towards its suffix, the host towards its domain, each by
a beta prior whose weight is fitted by moments of the beta-binomial at that level. A page without a rule is
blocked when the upper bound of its host's posterior good rate lies under `least_good`.

A rule is a host with a path prefix; it fits the host and its subdomains and the longest fitting rule wins over
the reputation. Cases: a null url, or one without "://", has an empty host and path; empty hosts and hosts
without labels fall back on domain, suffix, then the global rate, whose bound is wide, so they pass; pages
without outcomes only borrow; with no outcome at all every page passes; repeated rows give a row each; an empty
table gives an empty table. Only the named columns are read, so further columns may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentimart.llm.scratch import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Suffixes of two labels; a fixed list of common ones, to be replaced by a longer list where needed.
TWO_LABEL_SUFFIXES = ("ac.uk", "co.jp", "co.nz", "co.uk", "com.au", "com.br", "com.mx", "gov.uk", "org.au", "org.uk")
#: Standard normal quantile of the posterior's upper bound (95 % one-sided).
Z = 1.645


#: Host: after the first "://" up to /, ? or #; path: what follows up to ? or #. The same in Java and RE2.
URL = "(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, URL, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def with_levels(df: DataFrame, host: str = "host") -> DataFrame:
    """Adds domain and suffix of a host."""
    suffix = F.when(F.substring_index(host, ".", -2).isin(*TWO_LABEL_SUFFIXES), F.substring_index(host, ".", -2)).otherwise(F.substring_index(host, ".", -1))
    domain = F.when(F.substring_index(host, ".", -2).isin(*TWO_LABEL_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))
    return df.withColumn("suffix", suffix).withColumn("domain", domain)


def _shrunk(level: DataFrame) -> DataFrame:
    """Adds the posterior a, b and mean of each child (n, k), whose prior mean is the column prior.

    With E[n (p - m)^2] = m (1 - m) (1 + (n - 1) rho) and rho = 1 / (weight + 1), the prior weight comes from how
    far the children's rates spread beyond binomial noise; it is kept between 1 and 1000.
    """
    off = F.col("k") / F.col("n") - F.col("prior")
    one = F.col("prior") * (1 - F.col("prior"))
    stats = level.filter("n > 0").agg(F.sum(F.col("n") * off * off).alias("spread"), F.sum(one).alias("noise"), F.sum(F.col("n") * one).alias("room"))
    rho = F.greatest(F.lit(1 / 1001.0), F.least(F.lit(0.5), (F.col("spread") - F.col("noise")) / F.greatest(F.col("room") - F.col("noise"), F.lit(1e-9))))
    weight = stats.select(F.coalesce(1 / rho - 1, F.lit(1000.0))).scalar()
    made = level.withColumn("weight", weight)
    made = made.withColumn("a", F.col("k") + F.col("weight") * F.col("prior")).withColumn("b", F.col("n") - F.col("k") + F.col("weight") * (1 - F.col("prior")))
    return made.drop("weight", "prior").withColumn("mean", F.col("a") / (F.col("a") + F.col("b")))


def reputation(hosts: DataFrame) -> DataFrame:
    """Posterior (a, b, mean) of each host of a table (host, n labelled pages, k good ones), one row per host.

    The levels are small sums of that table; each level's join is on the parent's key, and a parent with very many
    children is one row on its side.
    """
    hosts = with_levels(hosts)
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    total = suffixes.agg(((F.coalesce(F.sum("k"), F.lit(0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0)) + 2)).alias("prior"))
    suffixes = _shrunk(suffixes.withColumn("prior", total.scalar()))
    domains = _shrunk(domains.join(suffixes.select("suffix", F.col("mean").alias("prior")), "suffix"))
    return _shrunk(hosts.join(domains.select("suffix", "domain", F.col("mean").alias("prior")), ["suffix", "domain"]))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule as host and path, and its verdict; nulls where none fits. The rules are a short, given list."""
    rule = verdict = None
    for what, rule_host, rule_path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        rule = F.when(fits, rule_host + rule_path) if rule is None else rule.when(fits, rule_host + rule_path)
        verdict = F.when(fits, what) if verdict is None else verdict.when(fits, what)
    none = F.lit(None).cast("string")
    return (none if rule is None else rule), (none if verdict is None else verdict)


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]], outcome: str, url: str = "url", key: str = "page_id", least_good: float = 0.5) -> DataFrame:
    """(key, host, path, rule, verdict, good_rate, good_bound) for each row of pages; outcome: a column that is 1 for a good labelled page, 0 for a bad one, else null."""
    parts = pages.select(F.col(key).alias("__key"), F.col(outcome).cast("long").alias("__good"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    counts = parts.groupBy("host").agg(F.count("__good").alias("n"), F.coalesce(F.sum("__good"), F.lit(0)).alias("k"))
    size = F.col("a") + F.col("b")
    counts = stored(counts, "hosts")  # every level reads it, and none the pages again
    known = reputation(counts).select("host", F.col("mean").alias("good_rate"), F.least(F.lit(1.0), F.col("mean") + Z * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (size + 1))).alias("good_bound"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    # A host can hold a third of the pages: its side of the join may be split, as the other has one row for it.
    return parts.join(known, "host", "left").select(
        F.col("__key").alias(key), "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("good_bound") < least_good, "block").otherwise("allow")).alias("verdict"),
        "good_rate", "good_bound",
    )
