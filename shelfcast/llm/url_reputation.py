"""URL filter by empirical-Bayes host reputation, after explicit rules.

Labelled pages are counted per host. A host's rate of bad pages is shrunk towards its registered domain's, that towards its
suffix's and that towards the rate of all, each through a beta prior whose weight is fitted to the spread between the units of
that level. A page is blocked when the lower posterior bound of its host's rate is above a limit.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import small_enough, stored

#: Suffixes with a dot under which anyone can register a name; a host under none of them has its last label as suffix.
SUFFIXES = ("example.com", "example.net", "example.org", "co.uk")
#: Verdict and rule, a host and the start of a path.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without one."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def suffix_of(host: Column, suffixes: tuple[str, ...] = SUFFIXES) -> Column:
    known = "|".join([*(re.escape(s) for s in sorted(suffixes, key=len, reverse=True)), "[^.]*"])
    return F.regexp_extract(host, rf"(?:^|\.)({known})$", 1)


def domain_of(host: Column, suffixes: tuple[str, ...] = SUFFIXES) -> Column:
    """The suffix and one more label, or the host if it has none."""
    known = "|".join(re.escape(s) for s in sorted(suffixes, key=len, reverse=True))
    return F.regexp_extract(host, rf"((?:^|[^.]*\.)(?:{known}|[^.]*))$", 1)


def named_hosts(hosts: DataFrame, suffixes: tuple[str, ...] | DataFrame = SUFFIXES) -> DataFrame:
    """`hosts` (host, one row each) with suffix and domain.

    suffixes are those with a dot, or a table of them (suffix; nulls and repeated rows are passed over), such as a public list has. Of those
    that end a host at a label's border the longest counts, else the host's last label.
    """
    if not isinstance(suffixes, DataFrame):
        return hosts.withColumns({"domain": domain_of(F.col("host"), suffixes), "suffix": suffix_of(F.col("host"), suffixes)})
    known = suffixes.select(F.col("suffix").alias("known")).where("known is not null").distinct()
    labels = F.split("host", r"\.")
    ends = F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    held = hosts.select("host", ends.alias("known")).join(small_enough(known, 64), "known").groupBy("host").agg(F.max_by("known", F.length("known")).alias("known"))
    found = hosts.join(held, "host", "left").withColumn("suffix", F.coalesce("known", suffix_of(F.col("host"), ()))).drop("known")
    above = F.when(F.length("host") > F.length("suffix"), F.substring_index(F.expr("left(host, length(host) - length(suffix) - 1)"), ".", -1))
    return found.withColumn("domain", F.concat_ws(".", above, "suffix"))


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """The longest rule that fits the host or a domain above it and starts the path; null if none does."""
    fits = []
    for _, rule in sorted(rules, key=lambda r: -len(r[1])):
        name, slash, rest = rule.partition("/")
        fits.append(F.when(((host == name) | host.endswith("." + name)) & path.startswith(slash + rest), F.lit(rule)))
    return F.coalesce(*fits) if fits else F.lit(None).cast("string")


def _weight(units: DataFrame, n: str, bad: str) -> Column:
    """The prior's weight: 1 / rho - 1 for the intra-class correlation rho of the units, as a scalar of one aggregate."""
    p = F.col(bad) / F.col(n)
    sums = units.where(F.col(n) > 0).agg(
        F.count(F.lit(1)).cast("double").alias("k"),
        F.sum(n).cast("double").alias("s1"),
        F.sum(F.col(n) * F.col(n)).cast("double").alias("s2"),
        F.sum(bad).cast("double").alias("x"),
        F.sum(F.col(bad) * p).alias("xp"),
    )
    between = F.expr("(xp - x * x / s1) / (k - 1)")
    within = F.expr("(x - xp) / (s1 - k)")
    size = F.expr("(s1 - s2 / s1) / (k - 1)")
    rho = (between - within) / (between + (size - 1) * within)
    fitted = sums.select(F.when((F.col("k") > 1) & (F.col("s1") > F.col("k")) & (between + (size - 1) * within > 0), F.greatest(F.lit(0.001), F.least(F.lit(0.5), rho))).otherwise(F.lit(0.1)).alias("rho"))
    return fitted.select((1 / F.col("rho") - 1).alias("weight")).scalar()


def reputation(pages: DataFrame, outcomes: DataFrame, suffixes: tuple[str, ...] | DataFrame = SUFFIXES, z: float = 1.645) -> DataFrame:
    """host, n_labelled, n_bad, mean and lower: the posterior of the rate of bad pages of every host in `pages`.

    pages: page_id, host; outcomes: page_id and bad (0 or 1; null counts as not labelled). Several outcomes of a
    page each count. Counts are summed before any join, so a host with a third of all pages is one row per task.
    """
    marks = outcomes.where(F.col("bad").isNotNull()).groupBy("page_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("bad").cast("long")).alias("x"))
    counts = pages.join(marks, "page_id", "left").groupBy("host").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_labelled"), F.coalesce(F.sum("x"), F.lit(0)).alias("n_bad"))
    hosts = stored(named_hosts(counts, suffixes), "hosts")  # every prior reads it
    above = lambda *keys: hosts.groupBy(*keys).agg(F.sum("n_labelled").alias("n"), F.sum("n_bad").alias("x"))
    suffixes, domains = above("suffix"), above("suffix", "domain")
    root = hosts.agg(((F.sum("n_bad") + 0.5) / (F.sum("n_labelled") + 1)).alias("rate")).scalar()
    shrunk = lambda rate, weight: (F.col("x") + weight * rate) / (F.col("n") + weight)
    suffixes = suffixes.select("suffix", shrunk(root, _weight(suffixes, "n", "x")).alias("suffix_rate"))
    domains = domains.join(suffixes, "suffix").select("suffix", "domain", shrunk(F.col("suffix_rate"), _weight(domains, "n", "x")).alias("domain_rate"))
    weight = _weight(hosts, "n_labelled", "n_bad")
    a, b = F.col("n_bad") + weight * F.col("domain_rate"), F.col("n_labelled") - F.col("n_bad") + weight * (1 - F.col("domain_rate"))
    found = hosts.join(domains, ["suffix", "domain"]).select("host", "n_labelled", "n_bad", a.alias("a"), b.alias("b"))
    mean, spread = F.expr("a / (a + b)"), F.expr("sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))")
    return found.select("host", "n_labelled", "n_bad", mean.alias("mean"), F.greatest(F.lit(0.0), mean - z * spread).alias("lower"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules=RULES, suffixes=SUFFIXES, limit: float = 0.25) -> DataFrame:
    """page_id, host, path, rule, verdict and the host's n_labelled and n_bad, for every row of `pages` (page_id, url).

    A fitting rule decides; else a host whose lower posterior bound is above `limit` is blocked. A url that is null or has no
    `://` has an empty host and path and is judged as the host ''. Without any outcome every host keeps the prior 0.5 with its
    wide bound, so no page is blocked. `suffixes` may be a table, see `named_hosts`. Repeated page_ids are judged each; other columns are not read.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    seen = pages.select("page_id", host.alias("host"), path.alias("path"))
    known = reputation(seen.select("page_id", "host"), outcomes, suffixes)
    rule = rule_of(F.col("host"), F.col("path"), rules)
    decided = F.create_map(*(F.lit(x) for verdict, r in rules for x in (r, verdict)))[F.col("rule")] if rules else F.lit(None).cast("string")
    judged = seen.join(known, "host").withColumn("rule", rule)
    verdict = F.coalesce(decided, F.when((F.col("lower") > limit) & (F.col("n_labelled") > 0), F.lit("block")).otherwise(F.lit("allow")))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "n_labelled", "n_bad")
