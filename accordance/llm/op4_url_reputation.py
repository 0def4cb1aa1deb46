"""URL filters: empirical-Bayes host reputation, with rules that go before it.

Labelled pages of a host are k bad ones of n.  The bad rate of a suffix is shrunk towards that of
all pages, that of a registered domain towards its suffix and that of a host towards its domain:
with a beta prior of mean m and strength s the posterior mean is (k + s m) / (n + s).  The strength
of each level comes from the variance between its groups beyond what binomial draws explain
(method of moments), but is never more than the evidence that the parent's own rate rests on.  A host is blocked if the lower bound of its posterior bad rate is above
``lift`` times the rate of all pages, so that few labels never block a host, and a host is held against what is usual here.

Everything is built-in functions.  Outcomes are summed by host before any other shuffle, and
the join of pages with hosts has plain shuffles on both sides, which Spark splits for a hot host.

Defined results: a null url, or one without ``://``, has an empty host and path and is judged as
the host ``''``.  Repeated pages are judged alike and all returned.  A null or unlabelled page_id
has no outcome.  Several outcomes of one page_id count as one, bad if any of them is; each row
of a repeated page counts.  Other columns of the pages stay out of the result.  Without any outcome every host is allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accordance.llm.tables import keep, lower_ascii

ALLOW, BLOCK = "allow", "block"

#: Suffixes of two labels under which names are registered.
DOUBLE_SUFFIXES = ("ac.uk", "co.jp", "co.nz", "co.uk", "com.au", "com.br", "gov.uk", "org.uk")


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column, doubles=DOUBLE_SUFFIXES) -> Column:
    """The public suffix: two labels for the listed ones, else the last label."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*doubles), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column, doubles=DOUBLE_SUFFIXES) -> Column:
    """The registered domain: the suffix and one more label."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*doubles), F.substring_index(host, ".", -3)).otherwise(two)


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits, else null; a rule is a host and the start of a path."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def _shrunk(groups: DataFrame, parents: DataFrame, on: list[str], least: float, most: float):
    """Groups with k and n, and rate m and evidence w of their parents, give the posterior ``a`` and ``b``."""
    joined = groups.join(parents, on) if on else groups.crossJoin(F.broadcast(parents))
    labelled = joined.where("n > 0")
    spread = labelled.agg(
        F.sum(F.col("n")).alias("all_n"),
        F.count("*").alias("g"),
        F.sum(F.col("n") * F.pow(F.col("k") / F.col("n") - F.col("m"), 2)).alias("v"),
        F.sum(F.col("m") * (1 - F.col("m"))).alias("drawn"),
        F.sum(F.col("n") * F.col("m") * (1 - F.col("m"))).alias("whole"),
        F.sum(F.pow(F.col("n").cast("double"), 2)).alias("squares"),
    )
    between = (F.col("v") - F.col("drawn")) / (F.col("all_n") - F.col("squares") / F.col("all_n"))
    rate = F.col("whole") / F.col("all_n")
    strength = spread.select(
        F.when(
            (F.col("g") > 1)
            & (F.col("all_n") * F.col("all_n") > F.col("squares"))
            & (F.col("v") > F.col("drawn")),
            F.greatest(F.lit(least), F.least(F.lit(most), rate / between - 1)),
        )
        .otherwise(F.lit(most))
        .alias("s")
    )  # one row
    s = F.least("s", "w")
    return joined.crossJoin(F.broadcast(strength)).select(
        *groups.columns,
        (F.col("k") + s * F.col("m")).alias("a"),
        (F.col("n") - F.col("k") + s * (1 - F.col("m"))).alias("b"),
    )


def overall_rate(groups: DataFrame, base_rate: float, least: float) -> DataFrame:
    """One row: the rate m of all pages and the evidence w behind it."""
    k, n = (F.coalesce(F.sum(c), F.lit(0)) for c in ("k", "n"))
    return groups.agg(((k + least * base_rate) / (n + least)).alias("m"), (n + least).alias("w"))


def host_reputation(
    hosts: DataFrame, base_rate: float = 0.1, strength: tuple[float, float] = (2.0, 200.0)
) -> DataFrame:
    """Hosts with ``k`` bad of ``n`` labelled pages get the posterior ``a`` and ``b``.

    base_rate and the smaller strength are the prior of the rate of all pages.
    """
    least, most = strength
    hosts = hosts.select(
        "host", "k", "n", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix")
    )
    sums = (F.sum("k").alias("k"), F.sum("n").alias("n"))
    domains = keep(hosts.groupBy("domain", "suffix").agg(*sums), "domains")
    suffixes = keep(domains.groupBy("suffix").agg(*sums), "suffixes")
    top = overall_rate(suffixes, base_rate, least)
    weight = F.col("a") + F.col("b")
    known = ((F.col("a") / weight).alias("m"), weight.alias("w"))
    suffix_rate = _shrunk(suffixes, top, [], least, most).select("suffix", *known)
    domain_rate = _shrunk(domains, suffix_rate, ["suffix"], least, most).select("domain", *known)
    return _shrunk(hosts, domain_rate, ["domain"], least, most).select("host", "k", "n", "a", "b")


def lower_bound(a: Column, b: Column, z: float) -> Column:
    """z standard deviations below the mean of a beta distribution."""
    mean = a / (a + b)
    return mean - z * F.sqrt(mean * (1 - mean) / (a + b + 1))


def filter_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: dict[str, str],
    lift: float = 1.0,
    z: float = 1.645,
    base_rate: float = 0.1,
    strength: tuple[float, float] = (2.0, 200.0),
) -> DataFrame:
    """page_id, host, path, rule, verdict of each page; outcomes are page_id and bad (boolean)."""
    judged = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    outcomes = outcomes.where("page_id IS NOT NULL").groupBy("page_id").agg(F.max("bad").alias("bad"))
    hosts = (
        judged.select("page_id", "host")
        .join(outcomes, "page_id", "left")
        .groupBy("host")
        .agg(
            F.sum(F.when(F.col("bad"), 1).otherwise(0)).cast("long").alias("k"),
            F.count("bad").alias("n"),
        )
    )
    hosts = keep(hosts, "hosts")
    verdicts = keep(
        host_reputation(hosts, base_rate, strength)
        .crossJoin(F.broadcast(overall_rate(hosts, base_rate, strength[0])))  # one row
        .select(
            F.col("host"),
            F.when(lower_bound(F.col("a"), F.col("b"), z) > lift * F.col("m"), BLOCK).otherwise(ALLOW).alias("judged"),
        ),
        "reputation",
    )
    rule = rule_of(F.col("host"), F.col("path"), rules)
    of_rule = F.lit(None).cast("string")
    for text, verdict in rules.items():
        of_rule = F.when(F.col("rule") == text, verdict).otherwise(of_rule)
    return (
        judged.join(verdicts, "host", "left")
        .withColumn("rule", rule)
        .select("page_id", "host", "path", "rule", F.coalesce(of_rule, F.col("judged"), F.lit(ALLOW)).alias("verdict"))
    )
