"""URL filter by rules and by the reputation of hosts.

Labelled pages count as trials of their host, a bad page as a success. The rate of
bad pages is shrunk level by level: the suffix towards all pages, the registered
domain towards its suffix, the host towards its domain. How strongly each level
shrinks is fitted to the data, from the spread of its rates beyond what chance
explains (moments of the beta-binomial). A host is blocked when the lower bound of
its posterior rate is above the limit, so a host with few labelled pages is not.

All of it is DataFrame expressions. Counting reduces per task before the shuffle,
so a host with a third of all pages is one counter per task; what the driver sees
are rows of totals.

Defined cases: a missing url or one without ``://`` has an empty host and path, no
rule, and the reputation of the empty host; a port or user name stays in the host as
shown but not in the domain; a host without labelled pages has its domain's rate;
rows with equal page ids are judged each for itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.llm.common import stored

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Registered domains have one label more below these suffixes of two labels.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.nz", "co.in", "com.cn")


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: str = "url") -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), CAPITALS, SMALL)


def path_of(url: str = "url") -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def matching_rule(rules: Sequence[Rule], host: Column, path: Column, field: str, none: Column) -> Column:
    """A field of the longest rule that fits; a written list, so a chain of conditions."""
    chosen = none
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        chosen = F.when(fits, F.lit(getattr(rule, field))).otherwise(chosen)
    return chosen


def suffix_of(host: Column) -> Column:
    bare = F.regexp_replace(host, r"^[^@]*@|:[0-9]*$", "")
    two = F.substring_index(bare, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(bare, ".", -1))


def domain_of(host: Column) -> Column:
    bare = F.regexp_replace(host, r"^[^@]*@|:[0-9]*$", "")
    two = F.substring_index(bare, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), F.substring_index(bare, ".", -3)).otherwise(two)


def _strength(level: DataFrame, parent: list[str]) -> float:
    """Pseudo-pages of a level's prior, between 1 and 10,000, by the method of moments.

    Compares the spread of the units' rates around their parent's rate with what chance alone gives.
    """
    pages, bad = F.col("pages").cast("double"), F.col("bad").cast("double")
    within = level.filter("pages > 0").groupBy(*parent).agg(
        (F.count("*") - 1).alias("free"), F.sum(bad * bad / pages).alias("bad2"), F.sum(pages * pages).alias("pages2"),
        F.sum(pages).alias("n"), F.sum(bad).alias("k"),
    )
    rate = (F.col("k") + 1) / (F.col("n") + 2)
    within = within.withColumn("chance", rate * (1 - rate))
    row = within.agg(
        F.sum(F.col("bad2") - F.col("k") * F.col("k") / F.col("n") - F.col("free") * F.col("chance")).alias("over"),
        F.sum(F.col("chance") * (F.col("n") - F.col("pages2") / F.col("n") - F.col("free"))).alias("room"),
    ).first()
    if not row.room or row.room <= 0 or row.over <= 0:
        return 10_000.0
    return min(max(row.room / row.over - 1, 1.0), 10_000.0)


def reputation(outcomes: DataFrame, others: DataFrame | None = None, z: float = 1.645, limit: float = 0.5) -> DataFrame:
    """(host, bad boolean) of labelled pages -> (host, pages, bad, rate, bound, blocked) of their hosts.

    Hosts of ``others`` are judged too, by their domain where they have no labelled page.
    """
    seen = outcomes.select("host", F.col("bad").cast("long").alias("bad"))
    if others is not None:
        seen = seen.unionByName(others.select("host", F.lit(None).cast("long").alias("bad")))
    hosts = stored(
        seen.groupBy("host").agg(F.count("bad").alias("pages"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
        .withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host"))),
        "host-outcomes",
    )
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("pages").alias("pages"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("pages").alias("pages"), F.sum("bad").alias("bad"))
    totals = suffixes.agg(F.coalesce(F.sum("pages"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("k")).first()
    overall = (totals.k + 1) / (totals.n + 2)
    fitted = {
        "host": _strength(hosts, ["suffix", "domain"]), "domain": _strength(domains, ["suffix"]), "suffix": _strength(suffixes, []),
    }
    # A level cannot lend more pseudo-pages than it has labelled pages.
    lent = lambda name, of: F.least(F.lit(fitted[name]), of + 1)
    post = lambda prior, weight: (F.col("bad") + weight * prior) / (F.col("pages") + weight)
    suffixes = suffixes.select(
        "suffix", F.col("pages").alias("suffix_pages"), post(F.lit(overall), lent("suffix", F.lit(totals.n))).alias("suffix_rate")
    )
    domains = domains.join(suffixes, "suffix").select(
        "suffix", "domain", lent("host", F.col("pages")).alias("weight"),
        post(F.col("suffix_rate"), lent("domain", F.col("suffix_pages"))).alias("domain_rate"),
    )
    rate = post(F.col("domain_rate"), F.col("weight"))
    bound = F.col("rate") - z * F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("pages") + F.col("weight") + 1))
    return (
        hosts.join(domains, ["suffix", "domain"])
        .withColumn("rate", rate).withColumn("bound", bound)
        .select("host", "pages", "bad", "rate", "bound", (F.col("bound") > limit).alias("blocked"))
    )


def judge(pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule], z: float = 1.645, limit: float = 0.5) -> DataFrame:
    """Adds host, path, rule, verdict and the labelled and bad pages of the host to every row of ``pages``.

    ``pages`` has ``url``; ``outcomes`` has ``host`` and a boolean ``bad``. Columns of these names are replaced.
    """
    rows = pages.drop("host", "path", "rule", "verdict", "host_pages", "host_bad", "host_blocked")
    rows = rows.withColumn("host", host_of()).withColumn("path", path_of())
    known = stored(reputation(outcomes, rows, z, limit).filter("host is not null"), "host-reputation")
    known = known.select("host", F.col("pages").alias("host_pages"), F.col("bad").alias("host_bad"), F.col("blocked").alias("host_blocked"))
    host, path = F.col("host"), F.col("path")
    by_host = F.when(F.col("host_blocked"), "block").otherwise("allow")
    return (
        rows.join(known, "host", "left")
        .withColumn("rule", matching_rule(rules, host, path, "text", F.lit(None).cast("string")))
        .withColumn("verdict", matching_rule(rules, host, path, "verdict", by_host))
        .withColumn("host_pages", F.coalesce("host_pages", F.lit(0))).withColumn("host_bad", F.coalesce("host_bad", F.lit(0)))
        .select(*rows.columns, "rule", "verdict", "host_pages", "host_bad")
    )
