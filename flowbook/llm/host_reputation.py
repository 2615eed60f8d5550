"""Empirical-Bayes reputation of hosts: labelled page outcomes shrunk from host to registered domain to suffix.

The share of good pages has a beta prior at every level, centred on the level above (suffix on all pages, domain on
the rest of its suffix, host on the rest of its domain: a group's own pages are not counted twice).  How strong a prior is comes from the spread between the groups of that level
(method of moments).  A host is blocked when the upper bound of its posterior lies below the corpus's share.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ADDRESS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
Z = 1.645
STRONGEST = 1e6


def address(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null url or one without ``://``."""
    url = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(url, ADDRESS, 1), UPPER, LOWER), F.regexp_extract(url, ADDRESS, 2)


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, else nulls.  A rule fits its host, all subdomains, and paths that start with its own.

    ``rules`` is the caller's list of (rule, verdict); of equally long ones the first wins.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, what in sorted(rules, key=lambda r: len(r[0])) if len({len(r[0]) for r in rules}) == len(rules) else sorted(reversed(rules), key=lambda r: len(r[0])):
        at, _, below = text.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + below)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


IPV4 = r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"


def site(host: Column) -> Column:
    """The name of a host as the levels take it: without user part and port."""
    return F.regexp_replace(F.regexp_replace(host, r"(?s)^.*@", ""), r":[0-9]*$", "")


def _last_labels(name: Column, count: Column) -> Column:
    return F.call_function("substring_index", name, F.lit("."), -count)


def levels(hosts: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """The hosts with ``domain`` and ``suffix``: the public suffix of the name, and one label more.

    ``suffixes`` is a table of public suffixes of several labels (``suffix``: ``co.uk``, ``github.io``, ...); the longest
    one that a name ends in counts, without one the last label.  A name that is itself a suffix is its own domain.
    Addresses (IPv4, or in brackets) have no suffix above them: both levels are the address.
    """
    named = hosts.withColumn("_site", site(F.col("host")))
    address_ = F.col("_site").rlike(IPV4) | F.col("_site").startswith("[")
    if suffixes is None:
        named = named.withColumn("_labels", F.lit(1))
    else:
        known = suffixes.select(F.translate(F.col("suffix"), UPPER, LOWER).alias("_tail")).where("_tail IS NOT NULL").distinct()
        tails = named.select("host", F.posexplode(F.transform(
            F.sequence(F.lit(1), F.size(F.split("_site", "\\."))), lambda k: _last_labels(F.col("_site"), k))).alias("_at", "_tail"))
        longest = tails.join(known, "_tail").groupBy(F.col("host").alias("_host")).agg((F.max("_at") + 1).alias("_found"))
        named = named.join(longest, F.col("host") == F.col("_host"), "left").withColumn("_labels", F.coalesce("_found", F.lit(1))).drop("_host", "_found")
    return named.withColumns({
        "domain": F.when(address_, F.col("_site")).otherwise(_last_labels(F.col("_site"), F.col("_labels") + 1)),
        "suffix": F.when(address_, F.col("_site")).otherwise(_last_labels(F.col("_site"), F.col("_labels"))),
    }).drop("_site", "_labels")


def _strength(groups: DataFrame, prior: str) -> DataFrame:
    """One row: the prior strength of a level from ``n`` and ``good`` of its groups with outcomes (method of moments)."""
    live = groups.where("n > 0").agg(
        F.count("*").cast("double").alias("m"), F.sum("n").cast("double").alias("total"), F.sum(F.col("n").cast("double") * F.col("n")).alias("squares"),
        F.sum("good").cast("double").alias("good"), F.sum(F.col("good").cast("double") * F.col("good") / F.col("n")).alias("parts"),
    )
    p = F.col("good") / F.col("total")
    noise = p * (1 - p)
    between = F.col("parts") - F.col("good") * F.col("good") / F.col("total")
    excess = between - noise * (F.col("m") - 1)
    room = noise * (F.col("total") - F.col("squares") / F.col("total") - (F.col("m") - 1))
    spread = F.when(F.col("total").isNull() | (F.col("m") < 2), 0.0).when(room <= 0, 0.0).otherwise(F.try_divide(excess, room))
    strength = F.when(spread <= 1 / STRONGEST, STRONGEST).otherwise(F.greatest(1 / F.greatest(spread, F.lit(1e-12)) - 1, F.lit(1.0)))
    return live.select(strength.alias(prior))


def reputation(outcomes: DataFrame, z: float = Z, public_suffixes: DataFrame | None = None) -> DataFrame:
    """``host, domain, suffix, n, good, mean, upper, lower, corpus`` for every host from ``host, good`` rows.

    ``good`` is true, false or null (a page without an outcome counts for no level, its host still gets a posterior).
    With no outcome at all every host has the mean 1/2.  Sums are exact integers, so the result does not depend on
    the order of rows.  Each level is one aggregation of the one below, started by one partial aggregation per task,
    which a hot host does not skew.
    """
    hosts = levels(outcomes.groupBy("host").agg(
        F.sum(F.when(F.col("good").isNotNull(), 1).otherwise(0)).alias("n"), F.sum(F.when(F.col("good"), 1).otherwise(0)).alias("good"),
    ), public_suffixes)
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    strengths = [_strength(hosts, "k"), _strength(domains, "k"), _strength(suffixes, "k")]
    corpus = suffixes.agg(F.coalesce(F.sum("good"), F.lit(0)).alias("g"), F.coalesce(F.sum("n"), F.lit(0)).alias("t")).select(
        F.when(F.col("t") > 0, F.try_divide(F.col("g").cast("double"), F.col("t"))).otherwise(0.5).alias("corpus"),
    )

    def one_row(frame: DataFrame) -> DataFrame:
        return F.broadcast(frame)  # an aggregate without keys: exactly one row

    # The single-row sides are joined once each to tables of hosts, domains and suffixes.
    above = suffixes.join(one_row(strengths[2])).join(one_row(corpus)).select(
        "suffix", F.col("good").alias("s_good"), F.col("n").alias("s_n"), F.col("k").alias("s_k"), "corpus")
    middle = domains.join(above, "suffix").join(one_row(strengths[1])).select(
        "domain", F.col("good").alias("d_good"), F.col("n").alias("d_n"), F.col("k").alias("d_k"), "corpus",
        ((F.col("s_good") - F.col("good") + F.col("s_k") * F.col("corpus")) / (F.col("s_n") - F.col("n") + F.col("s_k"))).alias("s_mean"),
    )
    prior = (F.col("d_good") - F.col("good") + F.col("d_k") * F.col("s_mean")) / (F.col("d_n") - F.col("n") + F.col("d_k"))
    scored = hosts.join(middle, "domain").join(one_row(strengths[0])).withColumn("weight", F.col("n") + F.col("k")).withColumn(
        "mean", (F.col("good") + F.col("k") * prior) / F.col("weight"),
    )
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("weight") + 1))
    return scored.select(
        "host", "domain", "suffix", "n", "good", "mean", (F.col("mean") + z * deviation).alias("upper"),
        (F.col("mean") - z * deviation).alias("lower"), "corpus",
    )


def judge(
    pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str]], z: float = Z, public_suffixes: DataFrame | None = None,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, host_mean, host_upper`` for every page.

    Needs ``page_id, url`` of pages and ``page_id, good`` of outcomes; other columns are ignored.  The longest fitting
    rule decides; without one, the page is blocked if its host's upper bound lies below the corpus's share of good
    pages, else allowed.  Pages without a host are judged together as the host ``''``.  Repeated page rows are judged
    each; outcomes of a page id count for each page row and outcome row that meet.  Null outcomes count for nothing.
    A page with a null ``page_id`` is judged and has no outcome; a very long url is one value like any other; an empty
    table gives no rows.  ``public_suffixes`` are described at ``levels``.
    """
    host, path = address(F.col("url"))
    seen = pages.select("page_id", host.alias("host"), path.alias("path"))
    known = outcomes.where("page_id IS NOT NULL AND good IS NOT NULL").select(F.col("page_id").alias("id_"), F.col("good").alias("good_"))
    joined = seen.join(known, F.col("page_id") == F.col("id_"), "left").select("host", F.col("good_").alias("good"))
    scores = reputation(joined, z, public_suffixes).select(F.col("host").alias("host_"), "mean", "upper", "corpus")
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    by_host = F.when(F.col("upper") < F.col("corpus"), "block").otherwise("allow")
    return seen.join(scores, F.col("host") == F.col("host_")).select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_host).alias("verdict"),
        F.col("mean").alias("host_mean"), F.col("upper").alias("host_upper"),
    )
