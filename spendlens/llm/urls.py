"""URL filters: rules first, then empirical-Bayes host reputation.

Labelled page outcomes (bad or not) are added up per host.  A host's bad rate is
shrunk towards its registered domain's, that towards its suffix's, that towards
the rate of all, each through a beta-binomial prior whose strength is estimated
from the data by the method of moments.  A host is blocked when the lower bound
of its posterior bad rate is above a limit: hosts with few labels are judged by
their domain, and nobody is blocked on thin evidence.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import materialise

#: Prior strengths are kept within these bounds (in pages).
WEAKEST, STRONGEST = 1.0, 1_000_000.0


@dataclass(frozen=True)
class Rule:
    """``pattern`` is a host, then a path prefix that starts with '/'."""
    pattern: str
    verdict: str

    @property
    def host(self) -> str:
        return self.pattern.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.split("/", 1)[1]


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path).  Host: after the first '://' up to '/', '?', '#' or the end, A-Z
    lower-cased; path: from there up to '?', '#' or the end.  Null or no '://': ''."""
    there = F.coalesce(F.contains(url, F.lit("://")), F.lit(False))
    rest = F.substring_index(F.substring_index(
        F.substr(url, F.locate("://", url) + 3), "#", 1), "?", 1)
    name = F.substring_index(rest, "/", 1)
    host = F.translate(name, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.substr(rest, F.char_length(name) + 1)
    return F.when(there, host).otherwise(""), F.when(there, path).otherwise("")


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits (ties: the first listed) as (pattern, verdict), or null."""
    best = F.lit(None).cast("struct<pattern:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.pattern)):
        fits = (((host == rule.host) | host.endswith("." + rule.host))
                & path.startswith(rule.path))
        best = F.when(fits, F.struct(F.lit(rule.pattern).alias("pattern"),
                                     F.lit(rule.verdict).alias("verdict"))).otherwise(best)
    return best


def registered_domain(host: Column) -> Column:
    """The last two labels."""
    return F.substring_index(host, ".", -2)


def suffix(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def _strength(level: DataFrame) -> float:
    """Prior strength of a level's groups (n, k) by the method of moments: one row."""
    s = level.agg(F.sum("n").alias("n"), F.sum("k").alias("k"), F.count("*").alias("m"),
                  F.sum(F.col("n") * F.col("n")).alias("nn"),
                  F.sum(F.col("k") * F.col("k") / F.col("n")).alias("kk")).first()
    if not s["n"] or s["m"] < 2 or s["k"] in (0, s["n"]) or s["nn"] == s["n"] * s["n"]:
        return STRONGEST
    n, k, m = float(s["n"]), float(s["k"]), s["m"]
    rate = k / n
    within = rate * (1 - rate)
    between = ((float(s["kk"]) - k * k / n) - (m - 1) * within) / (n - float(s["nn"]) / n)
    if between <= 0:
        return STRONGEST
    return min(STRONGEST, max(WEAKEST, within / between - 1))


def host_reputation(outcomes: DataFrame, z: float = 1.6449) -> DataFrame:
    """``(host, n, k, bad_rate, lower, upper)`` for every host of ``outcomes``.

    ``outcomes``: host, bad (boolean, null where the page has no label).  The bounds
    are the posterior mean plus and minus ``z`` posterior standard deviations.  A host
    without labels gets its domain's rate, with the prior's spread.
    """
    hosts = materialise(outcomes.groupBy("host").agg(
        F.count("bad").alias("n"), F.count_if("bad").alias("k")), "url-hosts")
    labelled = (hosts.withColumn("domain", registered_domain(F.col("host")))
                .withColumn("suffix", suffix(F.col("host"))))
    domains = materialise(labelled.groupBy("domain", "suffix").agg(
        F.sum("n").alias("n"), F.sum("k").alias("k")), "url-domains")
    suffixes = materialise(domains.groupBy("suffix").agg(
        F.sum("n").alias("n"), F.sum("k").alias("k")), "url-suffixes")
    whole = suffixes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
                         F.coalesce(F.sum("k"), F.lit(0)).alias("k")).first()
    base = (whole["k"] + 0.5) / (whole["n"] + 1.0)
    a, b, c = (_strength(x.where("n > 0")) for x in (suffixes, domains, hosts))

    def shrunk(strength: float, prior: Column) -> Column:
        return (F.col("k") + F.lit(strength) * prior) / (F.col("n") + F.lit(strength))

    suffixes = suffixes.select("suffix", shrunk(a, F.lit(base)).alias("_s"))
    domains = domains.join(suffixes, "suffix").select("domain", shrunk(b, F.col("_s")).alias("_d"))
    rate, size = F.col("bad_rate"), F.col("n") + c
    spread = F.sqrt(rate * (1 - rate) / (size + 1)) * z
    return (labelled.join(domains, "domain")
            .select("host", "n", "k", shrunk(c, F.col("_d")).alias("bad_rate"))
            .withColumn("lower", F.greatest(F.lit(0.0), rate - spread))
            .withColumn("upper", F.least(F.lit(1.0), rate + spread)))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: list[Rule], limit: float = 0.5,
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``(page_id, host, path, rule, verdict, bad_rate, lower)``, one row per input row.

    ``outcomes``: (page_id, bad), the labelled pages; repeated ones each count; nulls
    are ignored.  A page whose id is null or has no outcome is unlabelled.  The
    longest fitting rule decides; else a host is blocked when the lower bound of its
    bad rate is above ``limit``.  Urls that are null or without '://' share the empty
    host.  Other columns are not looked at; an empty table gives an empty table.
    """
    host, path = split_url(F.col(url_col))
    parts = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    labels = (outcomes.where("page_id is not null and bad is not null")
              .select(F.col("page_id").alias("_id"), F.col("bad").cast("boolean").alias("bad")))
    reputation = materialise(host_reputation(
        parts.select("page_id", "host").join(labels, F.col("page_id") == F.col("_id"), "left")),
        "url-reputation").select("host", "bad_rate", "lower")
    rule = longest_rule(F.col("host"), F.col("path"), rules)
    # both sides are plain tables: Spark broadcasts a small one, and can split a hot
    # host's rows in the other
    judged = parts.withColumn("_rule", rule).join(reputation, "host")
    return judged.select(
        "page_id", "host", "path", F.col("_rule.pattern").alias("rule"),
        F.coalesce("_rule.verdict", F.when(F.col("lower") > limit, "block").otherwise("allow"))
        .alias("verdict"), "bad_rate", "lower")
