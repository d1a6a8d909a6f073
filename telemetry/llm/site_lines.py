"""Line dedup by site-relative frequency.

Pages are grouped by host; a line that stands on more than ``ratio`` of the pages of its
host, and on two of them at least, is boilerplate of that site and is dropped from all its
pages (``min_pages`` asks for more pages).

Edge cases: the host is the lower-case name in the URL, without user and port. A page
whose URL is null or has no host forms no site and keeps all lines. A null text has no
lines (result: empty text). Lines are trimmed, empty ones dropped; a line counts once a page. Rows are pages:
repeated rows count as often as they occur. Other columns are carried along.

Scale: lines travel as 64-bit hashes, counted per (host, line) with map-side combination,
so a hot host is no hot task. A host has at most (mean lines a page / ratio) boilerplate
lines, so one short array per host is joined back (``frames.attach``: broadcast if counted
small, salted otherwise) and lines are dropped row by row; texts are never shuffled if the
lookup is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry.llm.frames import attach, fresh, materialise

RATIO = 0.1
MIN_PAGES = 2


def host_of(url: Column) -> Column:
    """Host name of a URL; null without one."""
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def html_lines(html: Column) -> Column:
    """Lines of a raw page: text between block tags, without scripts, styles and comments."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->", "\n")
    text = F.regexp_replace(text, r"(?i)<(/?(p|div|li|ul|ol|h[1-6]|br|nav|footer|header|article|section|aside|table|tr|title|body|head|html)\b[^>]*)>", "\n")
    return plain_lines(F.regexp_replace(text, r"<[^>]*>", ""))


def plain_lines(text: Column) -> Column:
    """Trimmed lines of a text that are not empty."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.trim(F.regexp_replace(x, r"[ \t\r\f\x0B]+", " ")))
    return F.filter(parts, lambda x: x != "")


def boilerplate(pages: DataFrame, host: str, lines: str, ratio: float, min_pages: int) -> DataFrame:
    """(host, hashes): per site the hashes of its boilerplate lines."""
    known = pages.filter(F.col(host).isNotNull())
    totals = known.groupBy(F.col(host).alias("host")).agg(F.count(F.lit(1)).alias("pages"))
    each = known.select(F.col(host).alias("host"), F.explode(
        F.array_distinct(F.transform(F.col(lines), lambda x: F.xxhash64(x)))).alias("line"))
    counts = each.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_pages)
    often = attach(materialise(counts, "site-lines"), materialise(totals, "site-pages"), "host") \
        .filter(F.col("n") > ratio * F.col("pages"))
    return often.groupBy("host").agg(F.collect_list("line").alias("hashes"))


def drop_site_lines(pages: DataFrame, lines: Column, url: str = "url", ratio: float = RATIO, min_pages: int = MIN_PAGES,
                    result: str = "text") -> DataFrame:
    """``pages`` with host, n_lines, n_dropped and ``result``, the text of the lines that stay (columns replaced if there)."""
    h, all_lines, hashes, k = fresh("host"), fresh("lines"), fresh("hashes"), fresh("kept")
    split = pages.withColumns({h: host_of(F.col(url)), all_lines: lines})
    table = materialise(boilerplate(split, h, all_lines, ratio, min_pages), "boilerplate") \
        .select(F.col("host").alias(h), F.col("hashes").alias(hashes))
    joined = attach(split, table, h)
    stay = F.when(F.col(hashes).isNull(), F.col(all_lines)).otherwise(
        F.filter(all_lines, lambda x: ~F.array_contains(F.col(hashes), F.xxhash64(x))))
    return joined.withColumn(k, stay).withColumns({
        "host": F.col(h), "n_lines": F.size(all_lines).cast("long"),
        "n_dropped": (F.size(all_lines) - F.size(k)).cast("long"),
        result: F.array_join(k, "\n")}).drop(h, all_lines, hashes, k)
