"""Boilerplate lines by their frequency within a site, with column functions only.

A page's lines are its runs of text between block tags or line ends, trimmed; comments,
scripts and styles are left out and inline tags removed.  For every host the pages that
hold a line are counted (once a page) and divided by the host's pages; lines on at least
``MIN_PAGES`` pages whose share exceeds ``RATIO`` are dropped from the host's pages.

Counts are combined before the shuffle, so a line that a third of all pages share costs one
row a task.  A host's boilerplate has at most mean lines a page / RATIO entries, whatever its
number of pages; pages meet that one row in a join that Spark may split by host.  Lines
are compared by a 64-bit hash within a host.

Pages without a host (null or malformed address) keep all lines; a null page has none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.session import cut_lineage

RATIO = 0.3
MIN_PAGES = 2
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
UNSEEN = (
    r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
    r"|</?(?:a|abbr|b|bdi|bdo|cite|code|em|font|i|img|kbd|mark|q|s|samp|small|span|strong|sub|sup|u|var)\b[^>]*>"
)
BREAK = r"<[^>]*>|[\r\n\t]"
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&copy;": "©", "&middot;": "·", "&amp;": "&"}


def host(url: Column) -> Column:
    """Lower-cased host of an address, null if there is none."""
    found = F.lower(F.regexp_extract(url, HOST, 1))
    return F.when(found != "", found)


def page_lines(html: Column) -> Column:
    """Trimmed text lines that are not empty."""
    parts = F.split(F.regexp_replace(F.coalesce(html, F.lit("")), UNSEEN, ""), BREAK)
    return F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")


def decoded(text: Column) -> Column:
    for name, sign in ENTITIES.items():
        text = F.replace(text, F.lit(name), F.lit(sign))
    return text


def drop_boilerplate(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", ratio: float = RATIO) -> DataFrame:
    """``key, host, n_lines, n_dropped, text``: the lines that stay, one below the other."""
    parsed = pages.select(F.col(key), host(F.col(url)).alias("host"), page_lines(F.col(html)).alias("lines"))
    stored = cut_lineage(parsed, "page-lines")
    hashes = F.array_distinct(F.transform("lines", lambda x: F.xxhash64(x)))
    sited = stored.filter(F.col("host").isNotNull())
    counts = sited.select("host", F.explode(hashes).alias("line")).groupBy("host", "line").agg(F.count("*").alias("n"))
    totals = sited.groupBy("host").agg(F.count("*").alias("pages"))
    common = counts.filter(F.col("n") >= MIN_PAGES).join(totals, "host").filter(F.col("n") > ratio * F.col("pages"))
    listed = common.groupBy("host").agg(F.collect_list("line").alias("common"))
    met = stored.join(listed, "host", "left")
    kept = F.filter("lines", lambda x: ~F.array_contains("common", F.xxhash64(x)))
    marked = met.withColumn("kept", F.when(F.col("common").isNull(), F.col("lines")).otherwise(kept))
    return marked.select(
        key,
        "host",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
        decoded(F.array_join("kept", "\n")).alias("text"),
    )
