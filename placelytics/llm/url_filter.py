"""URL verdicts: allow and block rules first, else the reputation of the host.

Reputation is an empirical-Bayes estimate of the share of bad pages. Labelled outcomes of a host are
shrunk towards its registered domain, the domain towards its suffix, the suffix towards the whole
table, each through a beta prior whose mean is the parent's posterior mean and whose strength is
estimated, per level, from the spread between siblings. A host is blocked when the lower bound of
its posterior, which also holds what is uncertain about its parents, exceeds a threshold, so a host
with few labels is not judged by chance.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placelytics.llm.shared import cut, require

#: Verdict and rule; the rule's host ends at its first slash. The longest fitting rule wins.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
#: Suffixes of two labels under which names are registered; any other suffix is one label.
LONG_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "com.br", "co.jp", "co.in", "co.nz")
THRESHOLD = 0.5
#: Standard deviations between posterior mean and bound: a one-sided 95 % bound.
Z = 1.645
#: Bounds of a prior's strength, in labelled pages.
STRENGTH = (1.0, 1000.0)
LEVELS = ("suffix", "domain", "host")


def host(url: Column) -> Column:
    rest = F.substring_index(url, "://", 1)
    after = F.substr(url, F.length(rest) + F.lit(4))
    return F.when(F.instr(url, "://") > 0, F.translate(F.regexp_extract(after, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise("")


def path(url: Column) -> Column:
    rest = F.substring_index(url, "://", 1)
    after = F.substr(url, F.length(rest) + F.lit(4))
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def _names(host: str) -> dict[str, Column]:
    """Registered domain and suffix; a user part and a port do not count, an address is its own domain."""
    bare = F.regexp_replace(F.regexp_replace(F.col(host), r"^.*@", ""), r":\d*$", "")
    address = bare.rlike(r"^[\d.]+$|^\[")
    two = F.substring_index(bare, ".", -2)
    long = two.isin(*LONG_SUFFIXES)
    return {
        "suffix": F.when(address, F.lit("")).when(long, two).otherwise(F.substring_index(bare, ".", -1)),
        "domain": F.when(address, bare).when(long, F.substring_index(bare, ".", -3)).otherwise(two),
    }


def reputations(hosts: DataFrame) -> DataFrame:
    """``hosts(host, n, bad)`` with ``mean`` and ``bound`` of the posterior share of bad pages.

    ``n`` counts the labelled pages, ``bad`` the bad ones among them. Without any label the
    whole table's mean is that of one good and one bad page.
    """
    table = cut(hosts.withColumns(_names("host")))
    total = table.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    top = ((total.bad or 0) + 1.0) / ((total.n or 0) + 2.0)
    parents = None
    for depth, level in enumerate(LEVELS):
        keys = list(LEVELS[: depth + 1])
        groups = table.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        if parents is None:
            groups = groups.withColumn("prior", F.lit(top)).withColumn("doubt", F.lit(0.0))
        else:
            groups = groups.join(parents, keys[:-1])
        groups = cut(groups)
        spread = F.col("prior") * (1 - F.col("prior"))
        sums = groups.agg(
            F.sum(F.pow(F.col("bad") - F.col("n") * F.col("prior"), 2)).alias("seen"),
            F.sum(F.col("n") * spread).alias("chance"),
            F.sum(F.col("n") * (F.col("n") - 1) * spread).alias("pairs"),
        ).first()
        extra = ((sums.seen or 0.0) - (sums.chance or 0.0)) / sums.pairs if sums.pairs else 0.0
        strength = min(max(1 / extra - 1, STRENGTH[0]), STRENGTH[1]) if extra > 0 else STRENGTH[1]
        weight = F.col("n") + strength
        mean = (F.col("bad") + strength * F.col("prior")) / weight
        own = F.col("mean") * (1 - F.col("mean")) / (weight + 1)
        groups = groups.withColumn("mean", mean).withColumn("variance", own + F.pow(strength / weight, 2) * F.col("doubt"))
        parents = groups.select(*keys, F.col("mean").alias("prior"), F.col("variance").alias("doubt"))
    return groups.select("host", "n", "bad", "mean", (F.col("mean") - Z * F.sqrt("variance")).alias("bound"))


def judge(
    pages: DataFrame, labels: DataFrame, *, id: str = "page_id", url: str = "url",
    rules: Sequence[tuple[str, str]] = RULES, threshold: float = THRESHOLD,
) -> DataFrame:
    """``(id, host, path, rule, verdict, mean, bound)`` of every page.

    ``labels(key, bad)`` says for the number that ends a url's path whether that page is bad; a key
    that repeats is bad if any of its rows is. Null or unlabelled pages add no evidence. A null
    url, or one without ``://``, has the empty host, which is judged like any other. Of fitting rules
    of one length a block wins. An empty table gives an empty result.
    """
    require(pages, id, url)
    require(labels, "key", "bad")
    at = pages.select(
        F.col(id).alias("id"), F.coalesce(host(F.col(url)), F.lit("")).alias("host"), F.coalesce(path(F.col(url)), F.lit("")).alias("path")
    )
    known = labels.where("key IS NOT NULL AND bad IS NOT NULL").groupBy("key").agg(F.max(F.col("bad").cast("int")).alias("bad"))
    number = F.regexp_extract("path", r"(\d{1,18})(?:\.\w+)?/?$", 1)
    counted = (
        at.select("host", F.when(number != "", number.cast("long")).alias("key"))
        .groupBy("host", "key")
        .agg(F.count("*").alias("n"))
        .join(known, "key", "left")
        .groupBy("host")
        .agg(
            F.coalesce(F.sum(F.when(F.col("bad").isNotNull(), F.col("n"))), F.lit(0)).alias("n"),
            F.coalesce(F.sum(F.col("n") * F.col("bad")), F.lit(0)).alias("bad"),
        )
    )
    listed = pages.sparkSession.createDataFrame(
        [(v, r, r.split("/", 1)[0], "/" + r.split("/", 1)[1] if "/" in r else "") for v, r in rules],
        "verdict string, rule string, rule_host string, rule_path string",
    )
    reputation = cut(reputations(counted))
    labels_of = F.split("host", r"\.")
    parents = F.transform(
        F.sequence(F.lit(1), F.size(labels_of)), lambda i: F.array_join(F.slice(labels_of, i, F.size(labels_of)), ".")
    )
    per_host = (
        reputation.select("host", F.explode(parents).alias("rule_host"))
        .join(listed, "rule_host")
        .groupBy("host")
        .agg(F.collect_list(F.struct(F.length("rule").alias("length"), F.col("verdict"), "rule", "rule_path")).alias("rules"))
    )
    fitting = F.array_max(F.filter("rules", lambda r: F.startswith(F.col("path"), r["rule_path"])))
    own = F.when(F.col("bound") > threshold, "block").otherwise("allow")
    return (
        at.join(reputation.join(per_host, "host", "left"), "host")
        .withColumn("fits", fitting)
        .select(
            F.col("id").alias(id),
            "host",
            "path",
            F.col("fits.rule").alias("rule"),
            F.coalesce("fits.verdict", own).alias("verdict"),
            "mean",
            "bound",
        )
    )
