"""URL filtering by hand-written rules and by host reputation (empirical Bayes).

Pages with a known outcome (bad or not) are counted per host, registered domain (last two
labels) and suffix (last label). Each level's rates are shrunk towards the level above
through a beta-binomial prior whose strength is estimated from the spread of the rates on
that level (method of moments): a host with few outcomes is judged like its domain, that one like its
suffix, that one like the whole. A host is blocked when the lower bound of its posterior rate
of bad pages, ``z`` standard deviations below the mean, exceeds ``most_bad``. A rule, if one fits, decides first.

Everything is a group-by (combined before the shuffle, so a host with a third of all pages costs one
row per task) and joins on host, domain and suffix tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, rule as host/path)
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty without ://."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ? # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def best_rule(host: Column, path: Column, rules=RULES, most: int = 1000) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null. A rule fits its host and all
    its subdomains where the path starts with the rule's. At most ``most`` rules: they are part of the plan."""
    if len(rules) > most:
        raise ValueError(f"more than {most} rules; join them as a table instead")
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the longest is asked first
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _strength(most: float = 1e6) -> Column:
    """Aggregate over rows (n, bad, up): the prior's strength, from how far the rates bad/n spread around up."""
    p, up = F.col("bad") / F.col("n"), F.col("up")
    spread = F.sum(F.col("n") * (p - up) * (p - up)) / F.sum(F.col("n") * up * (1 - up))
    groups, n, squares = F.count("*"), F.sum("n"), F.sum(F.col("n") * F.col("n"))
    # With correlation rho inside a group: E[sum n (p - up)^2] = up (1 - up) (groups + rho (n - groups)).
    rho = (spread * n - groups) / (n - groups)
    rho = F.when((n > groups) & rho.isNotNull() & ~F.isnan(rho), rho).otherwise(F.lit(0.0))
    return F.least(F.lit(most), (1 - rho) / F.greatest(rho, F.lit(1e-9))).cast("double")


def host_reputation(pages: DataFrame, outcomes: DataFrame, z: float = 2.0, most_bad: float = 0.5) -> DataFrame:
    """(host, n, bad, mean, bound, verdict) of every host of ``pages`` (page_id, host), with
    ``outcomes`` (page_id, bad 0/1). Pages without an outcome count for nothing."""
    known = outcomes.where("page_id is not null and bad is not null").groupBy("page_id").agg(F.max("bad").alias("bad"))
    hosts = pages.join(known, "page_id", "left").groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    labels = F.split("host", r"\.")
    hosts = hosts.withColumn("domain", F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")).withColumn(
        "suffix", F.element_at(labels, -1))
    hosts = written(hosts, "url-hosts")
    whole = hosts.agg(((F.sum("bad") + 0.5) / (F.sum("n") + 1.0)).alias("up")).first()["up"]
    counts = (F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = _shrunk(hosts.groupBy("suffix").agg(*counts).withColumn("up", F.lit(0.5 if whole is None else whole)))
    suffixes = suffixes.select("suffix", F.col("mean").alias("up"))
    domains = _shrunk(hosts.groupBy("domain", "suffix").agg(*counts).join(suffixes, "suffix")).select("domain", F.col("mean").alias("up"))
    level = _shrunk(hosts.join(domains, "domain"))
    a, b = F.col("bad") + F.col("strength") * F.col("up"), F.col("n") - F.col("bad") + F.col("strength") * (1 - F.col("up"))
    sd = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    bound = F.col("mean") - z * sd
    return level.select("host", "n", "bad", "mean", bound.alias("bound"), F.when(bound > most_bad, "block").otherwise("allow").alias("verdict"))


def _shrunk(level: DataFrame) -> DataFrame:
    """Adds the level's strength (one number, by way of the driver) and the posterior mean given the level above (up)."""
    strength = level.where("n > 0").agg(_strength().alias("strength")).first()["strength"]
    return level.withColumn("strength", F.lit(1.0 if strength is None else strength)).withColumn(
        "mean", (F.col("bad") + F.col("strength") * F.col("up")) / (F.col("n") + F.col("strength")))


def url_filter(pages: DataFrame, outcomes: DataFrame, rules=RULES, z: float = 2.0, most_bad: float = 0.5,
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per input row: (id_col, host, path, rule, verdict, by): block or allow, decided by rule or reputation.

    A null url or one without :// has an empty host and path; such pages are one host like any other.
    Null ids have no outcome. Repeated rows come back as often as they came; a page with several
    outcomes is bad if one is. Other columns are ignored; an empty table gives an empty result.
    """
    judged = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    hosts = host_reputation(judged.select("page_id", "host"), outcomes, z, most_bad).select("host", F.col("verdict").alias("_v"))
    judged = judged.withColumn("_rule", best_rule(F.col("host"), F.col("path"), rules))
    return judged.join(hosts, "host").select(
        F.col("page_id").alias(id_col), "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce("_rule.verdict", "_v").alias("verdict"), F.when(F.col("_rule").isNull(), "reputation").otherwise("rule").alias("by"))
