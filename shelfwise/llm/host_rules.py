"""Quality rules per document and per host, in DataFrame operations only.

Each document is held against four rules. Failures are summed by host, each
host's failure rate is shrunk towards the corpus rate through a beta prior fitted
to the hosts by moments. A host whose lower posterior bound exceeds
``max_rate`` loses all its documents. Two of the rules (symbols and repeated lines) are hints only: a document
that fails one goes unless its host is trusted, that is, unless the upper posterior bound of the
host's rate is below ``trusted_rate``.

Nulls and edges: a null text has no words (and so fails the word rule); a null
host is the host ''; an empty table gives an empty result; repeated rows are
judged and returned one by one; input columns with the name of an output column
are replaced by it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import materialise

WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rules:
    """Percentages are of words, or of non-blank lines for ``max_dup_lines_pct``."""

    min_words: int = 10
    max_repeat_pct: int = 20
    max_symbols_pct: int = 50
    max_dup_lines_pct: int = 50
    #: A host goes when its failure rate exceeds this with the given normal quantile.
    max_rate: float = 0.5
    #: A host is trusted when its failure rate is below this with the same quantile.
    trusted_rate: float = 0.01
    z: float = 1.645
    #: Limits of the prior's strength, in documents.
    min_strength: float = 2.0
    max_strength: float = 10_000.0


def _length_without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts of ``COUNTS`` and ``n_lines`` (non-blank lines), all long.

    Words in repeated windows: windows are hashed to 64 bits in the row. Only a row
    with a repeated hash sorts (hash, position) pairs and sums the words its
    repeated windows cover. Nothing is exploded or shuffled.
    """
    keep = [c for c in docs.columns if c.lower() not in {*COUNTS, "n_lines"}]
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(WORD))
    step = docs.select(
        *keep,
        body.alias("_t"),
        F.regexp_extract_all(body, F.lit(WORD), F.lit(0)).alias("_w"),
        lines.alias("_l"),
    )
    step = step.select(
        *keep,
        F.size("_w").cast("long").alias("n_words"),
        _length_without(F.col("_t"), SPACES).cast("long").alias("word_chars"),
        (F.length("_t") - _length_without(F.col("_t"), SYMBOLS)).cast("long").alias("n_symbols"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.transform("_w", lambda w: F.xxhash64(w)).alias("_h"),
    )
    starts = F.when(F.size("_h") >= WINDOW, F.sequence(F.lit(0), F.size("_h") - WINDOW))
    step = step.withColumn(
        "_g",
        F.transform(starts, lambda i: F.xxhash64(*[F.get("_h", i + k) for k in range(WINDOW)])),
    ).drop("_h")
    repeats = F.size(F.array_distinct("_g")) < F.size("_g")
    step = step.withColumn(
        "_s",
        F.when(
            repeats,
            F.array_sort(F.transform("_g", lambda g, i: F.struct(g.alias("g"), i.alias("p")))),
        ),
    ).drop("_g")
    step = step.withColumn(
        "_p",
        F.array_sort(
            F.transform(
                F.filter(
                    "_s",
                    lambda x, i: (F.get("_s", i + 1)["g"] == x["g"])
                    | ((i > 0) & (F.get("_s", i - 1)["g"] == x["g"])),
                ),
                lambda x: x["p"],
            )
        ),
    ).drop("_s")
    covered = F.aggregate(
        F.transform(
            "_p", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("_p", i + 1) - p, F.lit(WINDOW)))
        ),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    return step.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("_p")


def base_failed(rules: Rules) -> Column:
    """Too few words, or too many words in repeated windows."""
    return (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_pct * F.col("n_words")
    )


def hint_failed(rules: Rules) -> Column:
    """Too many symbols for the words, or too many repeated lines."""
    return (100 * F.col("n_symbols") > rules.max_symbols_pct * F.col("n_words")) | (
        100 * F.col("n_dup_lines") > rules.max_dup_lines_pct * F.col("n_lines")
    )


def rule_failed(rules: Rules) -> Column:
    """Any of the four rules fails."""
    return base_failed(rules) | hint_failed(rules)


def host_verdicts(counted: DataFrame, rules: Rules, host: str = "source") -> DataFrame:
    """One row per host: n_docs, n_failed, failure_rate (shrunk), host_ok, host_trusted."""
    hosts = materialise(
        counted.groupBy(F.coalesce(F.col(host), F.lit("")).alias("_host")).agg(
            F.count(F.lit(1)).alias("n_docs"),
            F.count_if(rule_failed(rules)).alias("n_failed"),
        ),
        "host-failures",
    )
    sums = hosts.agg(
        F.count(F.lit(1)).alias("hosts"),
        F.sum("n_docs").cast("double").alias("n"),
        F.sum("n_failed").cast("double").alias("k"),
        F.sum(F.col("n_docs").cast("double") ** 2).alias("n2"),
        F.sum(F.col("n_failed").cast("double") ** 2 / F.col("n_docs")).alias("k2"),
    ).first()
    rate, strength = fit_prior(*sums, rules)
    a = F.lit(rate * strength) + F.col("n_failed")
    b = F.lit((1 - rate) * strength) + F.col("n_docs") - F.col("n_failed")
    mean = a / (a + b)
    sd = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return hosts.select(
        "_host",
        "n_docs",
        "n_failed",
        mean.alias("failure_rate"),
        (mean - rules.z * sd <= rules.max_rate).alias("host_ok"),
        (mean + rules.z * sd < rules.trusted_rate).alias("host_trusted"),
    )


def fit_prior(hosts: int, n: float | None, k: float | None, n2: float | None, k2: float | None, rules: Rules) -> tuple[float, float]:
    """Mean and strength of the beta prior by moments of the hosts' failure rates."""
    if not n:
        return 0.5, rules.min_strength
    rate = k / n
    spread = rate * (1 - rate)
    if hosts < 2 or spread == 0:
        return rate, rules.max_strength
    between = (k2 - k * k / n) / (hosts - 1) - spread
    scale = (n - n2 / n) / (hosts - 1) - 1
    variance = between / scale if scale > 0 else 0.0
    strength = spread / variance - 1 if variance > 0 else rules.max_strength
    return rate, min(max(strength, rules.min_strength), rules.max_strength)


def judge(docs: DataFrame, rules: Rules | None = None, text: str = "text", host: str = "source", carry: tuple[str, ...] | None = None) -> DataFrame:
    """``docs`` (or its columns ``carry``) with the counts, base_failed, host_ok, host_trusted and kept.

    kept: neither the base rules nor the host's verdict reject the document, and it fails no hint or its host is trusted. The
    counted rows are written once and read twice (for the hosts and the verdicts);
    the join with the hosts' table meets plain scans, so a hot host can be split.
    """
    rules = rules or Rules()
    counted = with_counts(docs, text)
    if carry is not None:
        counted = counted.select(*dict.fromkeys((*carry, host)), *COUNTS, "n_lines")
    counted = materialise(counted, "host-rules")
    verdicts = materialise(
        host_verdicts(counted, rules, host).select("_host", "host_ok", "host_trusted"), "host-verdicts"
    )
    failed = base_failed(rules)
    return (
        counted.drop("base_failed", "host_ok", "host_trusted", "kept")
        .withColumn("_host", F.coalesce(F.col(host), F.lit("")))
        .join(verdicts, "_host")
        .drop("_host")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & F.col("host_ok") & (~hint_failed(rules) | F.col("host_trusted")))
    )
