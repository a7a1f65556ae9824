"""Line removal by site-relative frequency.

Pages are grouped by site. A line's share is the number of the site's pages that
hold it, divided by all pages of the site. Lines on at least ``min_pages`` pages
whose share is above ``ratio`` are boilerplate there and are dropped, all their
occurrences. A line that is common on one site and rare on another is dropped on
the first only.

All DataFrame expressions. Only 96-bit line keys are shuffled, counted per task
first. A site has at most (lines per page) / ``ratio`` boilerplate lines, so they
come back as one short array per site; texts are filtered where they are read, and
are only shuffled when the sites are too many to broadcast by measured size, in
which case Spark splits a hot site.

Defined cases: a missing text stays missing and counts as a page without lines; a
missing site is a site of its own; blank lines are never boilerplate; a line
repeated on one page counts once; a page all of whose lines are dropped becomes an
empty text; other columns are kept. Rows of one site with equal texts count as separate
pages, or with ``distinct`` as one page, so that no number of copies of a page makes its
lines boilerplate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.llm.common import stored, unused
from tillmart.llm.hosts import host_of


def _lines(text: str) -> Column:
    return F.split(F.col(text), "\n", -1)


def _key(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.hash(line).alias("b"))


def boilerplate(pages: DataFrame, site: str, text: str, ratio: float, min_pages: int, distinct: bool = False) -> DataFrame:
    """(site, keys): for each site with boilerplate, the keys of those lines."""
    rows = pages.select(F.col(site).alias("site"), F.col(text).alias("text"))
    page = ["page"] if distinct else []
    if distinct:
        rows = rows.withColumn("page", _key(F.col("text")))
    counted = rows.select("site", *page)
    lines = rows.select("site", *page, F.explode(F.array_distinct(F.filter(_lines("text"), lambda x: F.trim(x) != ""))).alias("line"))
    lines = lines.select("site", *page, _key(F.col("line")).alias("key"))
    if distinct:
        counted, lines = counted.distinct(), lines.distinct()
    totals = counted.groupBy("site").agg(F.count("*").alias("total"))
    held = (
        lines.groupBy("site", "key").agg(F.count("*").alias("held"))
        .filter(F.col("held") >= min_pages)
    )
    common = held.join(totals, held["site"].eqNullSafe(totals["site"])).filter(F.col("held") > ratio * F.col("total"))
    return common.groupBy(held["site"]).agg(F.collect_set("key").alias("keys"))


def drop_site_lines(
    pages: DataFrame, site: str = "source", text: str = "text", ratio: float = 0.1, min_pages: int = 5,
    distinct: bool = False,
) -> DataFrame:
    """The pages with boilerplate lines taken out of their texts, plus ``n_lines`` and ``n_dropped``."""
    found = stored(boilerplate(pages, site, text, ratio, min_pages, distinct), "site-lines")
    rows = pages.drop("n_lines", "n_dropped")
    site_name, keys, kept = unused(rows, "line_site", "line_keys", "line_kept")
    found = found.select(F.col("site").alias(site_name), F.col("keys").alias(keys))
    joined = rows.join(found, F.col(site).eqNullSafe(F.col(site_name)), "left")
    keep = F.when(F.col(keys).isNull(), _lines(text)).otherwise(
        F.filter(_lines(text), lambda x: ~F.array_contains(F.col(keys), _key(x)))
    )
    joined = joined.withColumn(kept, keep)
    n_lines = F.when(F.col(text).isNull(), 0).otherwise(F.size(_lines(text)))
    n_kept = F.when(F.col(text).isNull(), 0).otherwise(F.size(kept))
    return joined.select(
        *[F.array_join(kept, "\n").alias(c) if c == text else F.col(c) for c in rows.columns],
        n_lines.cast("long").alias("n_lines"), (n_lines - n_kept).cast("long").alias("n_dropped"),
    )


def drop_host_lines(pages: DataFrame, url: str = "url", text: str = "html", **limits) -> DataFrame:
    """:func:`drop_site_lines` of web pages, whose site is the host of their url.

    Pages without a host, such as those without a url, are one site.
    """
    (host,) = unused(pages, "line_host")
    return drop_site_lines(pages.withColumn(host, host_of(url)), host, text, **limits).drop(host)
