"""URL filtering by explicit rules and by an empirical-Bayes reputation of hosts.

Labelled page outcomes (bad or not) are summed by host, registered domain and
suffix. Each level's bad rate is shrunk towards its parent's through a
beta-binomial prior: the corpus for suffixes, the suffix for domains, the domain for
hosts. A level's prior strength is fitted to the spread of its rates around
their parents. A page is blocked when the lower posterior bound of its host's bad rate
exceeds ``max_rate``; explicit rules come first.

Nulls and edges: a null url, or one without ``://``, has an empty host and
path and is judged as the host ''; a null outcome is no label; a host without labels takes
its domain's posterior, and so on up; repeated rows are judged one by one; input columns
with the name of an output column are replaced by it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Second-level labels under which registries register names (as in co.uk).
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")


@dataclass(frozen=True)
class Rule:
    """``target`` is a host and the start of a path; it fits the host and its subdomains."""

    action: str
    target: str

    @property
    def host(self) -> str:
        return self.target.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.target.partition("/")[2]


@dataclass(frozen=True)
class Reputation:
    """A host is blocked when its bad rate exceeds ``max_rate`` with normal quantile ``z``."""

    max_rate: float = 0.5
    z: float = 1.645
    min_strength: float = 2.0
    max_strength: float = 1_000.0


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null or a url without ``://``."""
    host = F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_for(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """The longest rule that fits, and its action; both null without one."""
    target, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.target)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        target = F.when(fits, F.lit(rule.target)).otherwise(target)
        action = F.when(fits, F.lit(rule.action)).otherwise(action)
    return target, action


def host_levels(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix of a host, without user name and port."""
    bare = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":\d*$", "")
    labels = F.split(bare, r"\.")
    n = F.size(labels)
    second = (n >= 3) & F.get(labels, n - 2).isin(*SECOND_LEVEL) & (F.length(F.get(labels, n - 1)) == 2)
    last = lambda k: F.array_join(F.slice(labels, F.greatest(n - k + 1, F.lit(1)), F.lit(k)), ".")
    numeric = bare.rlike(r"^\d+(\.\d+){3}$")
    domain = F.when(numeric, bare).when(second, last(3)).otherwise(last(2))
    suffix = F.when(numeric, F.lit("")).when(second, last(2)).otherwise(last(1))
    return domain, suffix


def _posterior(level: DataFrame, cfg: Reputation) -> DataFrame:
    """Replace a and b, the parent's posterior, by the own one. In: n, k, a, b.

    The prior is the parent's posterior without the row's own labels, which would
    count twice otherwise, and no stronger than that. Strength by moments: the spread of k/n
    around the priors' means beyond what sampling alone would give.
    """
    level = level.withColumn("held", F.col("a") + F.col("b") - F.col("n")).withColumn("up", (F.col("a") - F.col("k")) / F.col("held"))
    spread = F.col("up") * (1 - F.col("up"))
    sums = level.agg(
        F.sum((F.col("k") - F.col("n") * F.col("up")) ** 2 - F.col("n") * spread).alias("excess"),
        F.sum(F.col("n").cast("double") * (F.col("n") - 1) * spread).alias("scale"),
    ).first()
    rho = sums["excess"] / sums["scale"] if sums["scale"] else 0.0
    strength = min(max(1 / rho - 1, cfg.min_strength), cfg.max_strength) if rho > 0 else cfg.max_strength
    weight = F.least(F.lit(strength), "held")
    own = level.withColumn("a", weight * F.col("up") + F.col("k"))
    return own.withColumn("b", weight * (1 - F.col("up")) + F.col("n") - F.col("k")).drop("up", "held")


def host_reputation(labelled: DataFrame, cfg: Reputation | None = None) -> DataFrame:
    """Bad rate and its lower bound for every host of (host, bad): host, n, k, rate, lower, blocked.

    Pages are summed by host first; the levels above are sums of those sums.
    """
    cfg = cfg or Reputation()
    domain, suffix = host_levels(F.col("host"))
    hosts = labelled.groupBy("host").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0)).alias("k")
    )
    hosts = materialise(hosts.withColumn("domain", domain).withColumn("suffix", suffix), "url-hosts")
    total = hosts.agg(F.sum("n"), F.sum("k")).first()
    n, k = (total[0] or 0), (total[1] or 0)
    suffixes = hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = suffixes.withColumns({"a": F.lit(k + 1.0), "b": F.lit(n - k + 1.0)})
    suffixes = materialise(_posterior(materialise(suffixes, "url-suffixes"), cfg).select("suffix", "a", "b"), "url-suffix-rates")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    domains = materialise(materialise(domains, "url-domains").join(suffixes, "suffix"), "url-domain-priors")
    domains = materialise(_posterior(domains, cfg).select("domain", "a", "b"), "url-domain-rates")
    hosts = _posterior(materialise(hosts.join(domains, "domain"), "url-host-priors"), cfg)
    a, b = F.col("a"), F.col("b")
    rate = a / (a + b)
    lower = rate - cfg.z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return hosts.select("host", "n", "k", rate.alias("rate"), lower.alias("lower"), (lower > cfg.max_rate).alias("blocked"))


def judge_urls(pages: DataFrame, rules: list[Rule], url: str = "url", bad: str = "bad", cfg: Reputation | None = None, carry: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """Columns ``carry`` of ``pages`` with host, path, rule, rate and verdict (allow or block).

    ``bad`` is a boolean outcome, null where a page has no label. Hosts' verdicts
    join back in a join of plain scans, so a hot host can be split.
    """
    host, path = url_parts(F.col(url))
    rule, action = rule_for(rules, F.col("host"), F.col("path"))
    out = ("host", "path", "rule", "rate", "verdict", "_bad", "_action")
    kept = [c for c in carry if c.lower() not in out]
    parts = pages.select(*kept, host.alias("host"), path.alias("path"), F.col(bad).alias("_bad"))
    parts = materialise(parts.withColumn("rule", rule).withColumn("_action", action), "url-parts")
    known = materialise(host_reputation(parts.select("host", F.col("_bad").alias("bad")), cfg).select("host", "rate", "blocked"), "url-verdicts")
    verdict = F.coalesce("_action", F.when(F.col("blocked"), "block").otherwise("allow"))
    return parts.join(known, "host").select(*kept, "host", "path", "rule", "rate", verdict.alias("verdict"))


def page_outcome(html: Column, max_symbols_pct: int = 50) -> Column:
    """Label of a page from its markup-free text: bad if its symbols exceed a share of its words.

    Null where there is no text to judge.
    """
    text = F.trim(F.regexp_replace(html, r"(?s)<script\b.*?</script>|<style\b.*?</style>|<[^>]*>", " "))
    n_words = F.size(F.split(text, r"[ \t\n\x0B\f\r]+"))
    n_symbols = F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))
    return F.when(F.length(text) > 0, 100 * n_symbols > max_symbols_pct * n_words)
