"""Download listings as tables: quarters of an index page, release archives, freshness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def discover_quarters(pages: DataFrame, html: str = "html", base_url: str = "") -> DataFrame:
    """`(quarter, url)` of the quarterly archives linked in pages, each quarter once (by least link)."""
    link = F.explode(F.regexp_extract_all(F.col(html), F.lit(r"""(?i)href\s*=\s*["']([^"']*?faers_ascii_\d{4}q[1-4]\.zip)["']"""), F.lit(1)))
    rows = pages.select(link.alias("href"))
    year, q = F.regexp_extract("href", r"(?i)faers_ascii_(\d{4})q([1-4])", 1), F.regexp_extract("href", r"(?i)faers_ascii_(\d{4})q([1-4])", 2)
    url = F.when(F.col("href").rlike("^https?://"), F.col("href")).otherwise(F.concat(F.lit(base_url.rstrip("/") + "/"), F.regexp_replace("href", "^/+", "")))
    return rows.select(F.concat(F.substring(year, 3, 2), F.lit("Q"), q).alias("quarter"), url.alias("url")).groupBy("quarter").agg(F.min("url").alias("url"))


def newest(rows: DataFrame, n: int | None, by: str = "quarter") -> DataFrame:
    """The n newest rows, newest first (all for null)."""
    ordered = rows.orderBy(F.desc(by))
    return ordered if n is None else ordered.limit(n)


def release_archives(pages: DataFrame, heading: str, html: str = "html") -> DataFrame:
    """`(at, url)` of the ZIP links after a heading, each once, in page order."""
    at = F.instr(F.col(html), heading)
    tail = F.when(at > 0, F.substring(F.col(html), at, F.length(html)))
    links = F.array_distinct(F.regexp_extract_all(tail, F.lit(r"""(?i)href\s*=\s*["']([^"']+\.zip)["']"""), F.lit(1)))
    return pages.select(F.posexplode(links).alias("at", "url"))


def is_fresh(fetched_at: Column, now: Column, days: int = 7) -> Column:
    """Whether a download is younger than so many days; false for null."""
    return F.coalesce(F.timestamp_diff("SECOND", fetched_at, now) < days * 86400, F.lit(False))
