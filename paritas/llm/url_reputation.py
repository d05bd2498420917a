"""URL filters with empirical-Bayes host reputation. DataFrame functions only.

Rules come first: a rule ``host/path`` allows or blocks its host and all subdomains where
the url's path starts with the rule's path; the longest fitting rule wins (ties: block).

Other urls are judged by what is known of their host. Labelled page outcomes (bad or not)
are counted per host, registered domain and suffix. The suffix's bad rate is shrunk to the
overall rate, the domain's to its suffix, the host's to its domain, each through a
beta-binomial prior whose strength is fitted to the spread of the observed rates at that
level by the method of moments. A url is blocked when the lower bound of its host's
posterior, mean - z standard deviations, reaches ``max_bad``; a host without outcomes has
its domain's or suffix's posterior.

The counts are grouped with partial sums, so a host with a third of the rows is one row per
task; the join of pages with host posteriors is left to AQE, which broadcasts the posteriors
below its size limit and splits skewed partitions beyond it.

Defined cases: a null url, or one without ``://``, has an empty host and path, no rule, and
the overall posterior; a null outcome is not counted; repeated rows count as often as they
occur; empty tables give no rows, or a neutral prior; columns other than the key and the
url are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paritas.llm.common import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_RULES = 1000
#: Second-level labels under which names are registered.
SHARED_SECOND = ["co", "com", "net", "org", "gov", "ac", "edu"]
#: Weakest and strongest prior, in pages.
STRENGTH = (2.0, 200.0)


def host_of(url: Column) -> Column:
    rest = F.substring_index(F.regexp_extract(url, r"(?s)://(.*)$", 1), "/", 1)
    rest = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    return F.translate(F.coalesce(rest, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def domain_of(host: Column) -> Column:
    """Registered domain: the last two labels, three below a shared second-level label."""
    second = F.element_at(F.split(host, r"\."), -2)
    deep = (F.size(F.split(host, r"\.")) > 2) & (F.length(F.substring_index(host, ".", -1)) == 2) & second.isin(SHARED_SECOND)
    return F.when(deep, F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Text and verdict of the longest (verdict, host, path) that fits, else null."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    text = verdict = F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "block")):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text, verdict = F.when(fits, F.lit(h + p)).otherwise(text), F.when(fits, F.lit(v)).otherwise(verdict)
    return text, verdict


def _strength(level: DataFrame) -> Column:
    """Prior strength of a level by moments. With m the prior mean of a unit, var = m(1 - m) and s the
    squared error of its rate, E s = var (1/n + (1 - 1/n) / (k + 1)), solved for k over all units."""
    m, n = F.col("m"), F.col("n")
    var = m * (1 - m)
    spread, inner, outer = F.sum((F.col("bad") - n * m) * (F.col("bad") - n * m) / n), F.sum(var), F.sum((n - 1) * var)
    rho = (spread - inner) / outer
    k = F.when((outer > 0) & (rho > 0), F.greatest(F.lit(STRENGTH[0]), F.least(F.lit(STRENGTH[1]), 1 / rho - 1))).otherwise(F.lit(STRENGTH[1]))
    return level.agg(k.alias("k")).scalar()


def reputation(outcomes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Posteriors (a, b: pseudo-counts of bad and good) per host, domain and suffix, and the overall
    one, of ``outcomes(host, bad)`` with bad 1 or 0. The counts per host are a written table."""
    hosts = written(outcomes.filter(F.col("bad").isNotNull() & F.col("host").isNotNull())
                    .groupBy("host").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("bad").cast("double").alias("bad"))
                    .withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", F.substring_index("domain", ".", -1)))
    sums = (F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    suffixes = hosts.groupBy("suffix").agg(*sums)
    overall = hosts.agg((F.coalesce(F.sum("bad"), F.lit(0.0)) + 1).alias("a"), (F.coalesce(F.sum("n") - F.sum("bad"), F.lit(0.0)) + 1).alias("b"))
    mean = F.col("a") / (F.col("a") + F.col("b"))

    def shrunk(level: DataFrame, key: str) -> DataFrame:
        return level.withColumn("k", _strength(level)).select(
            key, (F.col("bad") + F.col("k") * F.col("m")).alias("a"), (F.col("n") - F.col("bad") + F.col("k") * (1 - F.col("m"))).alias("b"))

    by_suffix = shrunk(suffixes.withColumn("m", overall.select(mean).scalar()), "suffix")
    by_domain = shrunk(domains.join(by_suffix.select("suffix", mean.alias("m")), "suffix"), "domain")
    by_host = shrunk(hosts.join(by_domain.select("domain", mean.alias("m")), "domain"), "host")
    return by_host, by_domain, by_suffix, overall


def judge(pages: DataFrame, key: str, outcomes: DataFrame, rules: list[tuple[str, str, str]], max_bad: float = 0.5, z: float = 1.64) -> DataFrame:
    """``key, host, path, rule, verdict, bad_rate, bad_bound`` per row of ``pages(key, url)``."""
    by_host, by_domain, by_suffix, overall = reputation(outcomes)
    named = lambda df, x: df.withColumnsRenamed({"a": f"a_{x}", "b": f"b_{x}"})
    rows = (pages.select(key, host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
            .withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", F.substring_index("domain", ".", -1)))
    hosts = (rows.select("host", "domain", "suffix").distinct().join(named(by_host, "h"), "host", "left")
             .join(named(by_domain, "d"), "domain", "left").join(named(by_suffix, "s"), "suffix", "left")
             .withColumns({"a_o": overall.select("a").scalar(), "b_o": overall.select("b").scalar()}))
    a, b = (F.coalesce(*(F.col(f"{x}_{l}") for l in "hdso")) for x in "ab")
    bound = hosts.select("host", (a / (a + b)).alias("bad_rate"), (a / (a + b) - z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))).alias("bad_bound"))
    text, verdict = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bad_bound") >= max_bad, F.lit("block")).otherwise(F.lit("allow"))
    return rows.join(bound, "host", "left").select(key, "host", "path", text.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "bad_rate", "bad_bound")
