"""URL filters: rules by host and path, and host reputation by empirical Bayes.

Outcomes of labelled pages (1: bad) are shrunk through beta-binomial priors, from host to
registered domain to suffix to all pages. A host is blocked if even the lower bound of its
posterior rate is high.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Suffixes of two labels under which names are registered; all others have one label.
LONG_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp", "co.nz", "com.br", "co.in")
#: Standard deviations below the posterior mean, and the bad rate at which a host is blocked.
BOUND = 1.645
BLOCK_RATE = 0.5
#: Bounds of the strength of a prior, in pages, and the strength where siblings tell nothing.
WEAKEST, STRONGEST, UNKNOWN_STRENGTH = 1.0, 1000.0, 10.0

LEVELS = ("suffix", "domain", "host")


def _after_scheme(url: Column) -> Column:
    return F.when(F.contains(url, F.lit("://")), F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)).otherwise("")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #``, A-Z in lower case; empty without ``://`` or for null."""
    raw = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(raw, upper, upper.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule that fits, null if none. A rule is ``host/path``; equal lengths go by its text."""
    found = F.lit(None).cast("string")
    for rule in sorted({r for r, _ in rules}, key=lambda r: (len(r), r)):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def suffix_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*LONG_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    """The registered domain: one label before the suffix."""
    long = F.substring_index(host, ".", -2).isin(*LONG_SUFFIXES)
    return F.when(long, F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def _strength(siblings: DataFrame) -> float:
    """Prior strength by moments: ``bad, n`` of siblings around their parent's rate ``prior``.

    Their variance over what chance alone would give, summed over all siblings.
    """
    spread = F.col("prior") * (1 - F.col("prior"))
    row = siblings.where("n > 1").agg(
        F.sum(F.pow(F.col("bad") - F.col("n") * F.col("prior"), 2)).alias("seen"),
        F.sum(F.col("n") * spread).alias("chance"),
        F.sum(F.col("n") * (F.col("n") - 1) * spread).alias("pairs"),
    ).first()
    if not row["pairs"]:
        return UNKNOWN_STRENGTH
    correlation = (row["seen"] - row["chance"]) / row["pairs"]
    return STRONGEST if correlation <= 0 else min(STRONGEST, max(WEAKEST, 1 / correlation - 1))


def reputation(outcomes: DataFrame) -> DataFrame:
    """``host, n, mean, bound``: posterior mean of the bad rate and its lower bound, from ``host, bad``.

    ``bad`` is 0 or 1; other rows and null hosts count nowhere.
    """
    counts = outcomes.where("host is not null and bad in (0, 1)").groupBy("host").agg(
        F.sum("bad").alias("bad"), F.count(F.lit(1)).alias("n"))
    counts = counts.withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})
    total = counts.agg(F.sum("bad").alias("bad"), F.sum("n").alias("n")).first()
    parent = F.lit(((total["bad"] or 0) + 1) / ((total["n"] or 0) + 2))
    table = counts
    for level in LEVELS:
        if level == "host":
            grouped = table.withColumn("prior", parent)
        else:
            above = F.first(parent).alias("prior")  # the same for all of a group
            grouped = table.groupBy(level).agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"), above)
        strength = _strength(grouped)
        mean = (F.col("bad") + strength * F.col("prior")) / (F.col("n") + strength)
        if level == "host":
            deviation = F.sqrt(mean * (1 - mean) / (F.col("n") + strength + 1))
            return grouped.select("host", "n", mean.alias("mean"), (mean - BOUND * deviation).alias("bound"))
        table = table.join(grouped.select(level, mean.alias(f"{level}_mean")), level)
        parent = F.col(f"{level}_mean")


def judged(pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str]], key: str = "page_id", url: str = "url") -> DataFrame:
    """``key, host, path, rule, verdict`` for each row of ``pages``.

    The longest fitting rule decides; else the bound of the host's bad rate. Hosts without
    labelled page are allowed.
    """
    verdicts = dict(rules)
    split = pages.select(F.col(key).alias("__key"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    ruled = split.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    bad = reputation(outcomes).where(F.col("bound") >= BLOCK_RATE).select("host", F.lit(True).alias("bad_host"))
    by_rule = F.lit(None).cast("string")
    for rule, verdict in verdicts.items():
        by_rule = F.when(F.col("rule") == rule, verdict).otherwise(by_rule)
    by_host = F.when(F.col("bad_host"), "block").otherwise("allow")
    return ruled.join(bad, "host", "left").select(
        F.col("__key").alias(key), "host", "path", "rule", F.coalesce(by_rule, by_host).alias("verdict"))
