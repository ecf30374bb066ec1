"""Line dedup by frequency within a site: lines on too large a share of a host's pages are boilerplate."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagetrail.llm.common import own_text, stored
from stagetrail.llm.urls import url_host

#: Patterns that turn HTML into lines; the oracle SQL uses the same.
COMMENT = r"(?s)<!--.*?-->"
HIDDEN = r"(?is)<(?:script|style)[^>]*>.*?</(?:script|style)[^>]*>"
BLOCK_TAG = (
    r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|main|nav"
    r"|ol|p|pre|section|table|tbody|td|th|thead|title|tr|ul)(?:[ \t\r\n/][^>]*)?>"
)
TAG = r"<[^>]*>"
EDGES = r"^[ \t\r\f]+|[ \t\r\f]+$"
RATIO = 0.1


def page_lines(html: F.Column) -> F.Column:
    """Text lines of a page: block-level tags end a line, other tags go, edges are trimmed, empty lines dropped."""
    text = F.coalesce(html, F.lit(""))
    for pattern, by in ((COMMENT, ""), (HIDDEN, ""), (BLOCK_TAG, "\n"), (TAG, "")):
        text = F.regexp_replace(text, pattern, by)
    return F.filter(F.transform(F.split(text, "\n"), lambda line: F.regexp_replace(line, EDGES, "")), lambda line: line != "")


def _key(line: F.Column) -> F.Column:
    """16 bytes that stand for a line wherever lines are counted and compared."""
    return F.unhex(F.md5(line))


def drop_site_lines(pages: DataFrame, ratio: float = RATIO) -> DataFrame:
    """(page_id, host, lines, dropped, text) of every row of pages; text is the lines that stay.

    A line is dropped from all pages of a host if its pages divided by the host's pages, N, exceed
    ratio + (1 - ratio) / N: that is, if more than `ratio` of the other pages have it too. For large hosts this is
    `ratio`; two pages of two agree by repeating a line, and on a host of one page nothing can repeat. The dropped lines of one
    host number at most (mean lines of its pages) / ratio, so their set stays small however many pages it has; counts are combined before the shuffle, and a hot host's pages are
    split by AQE in the joins. Null html has no lines, null urls and such without a host share the empty host, repeated
    rows count as pages, an empty table gives no rows, other columns are ignored.
    """
    parsed = pages.select("page_id", url_host(F.col("url").cast("string")).alias("host"), page_lines(F.col("html").cast("string")).alias("all_lines"))
    parsed = stored(parsed, "page-lines")
    totals = parsed.groupBy("host").agg(F.count("*").alias("total")).where("total > 1")
    keys = F.array_distinct(F.transform("all_lines", _key))
    seen = parsed.select("host", F.explode(keys).alias("line")).groupBy("host", "line").agg(F.count("*").alias("n"))
    seen = seen.where("n > 1")
    common = seen.join(totals.select(own_text("host").alias("h"), "total"), F.col("host") == F.col("h"))
    common = common.where(F.col("n") - 1 > (F.col("total") - 1) * F.lit(Decimal(str(ratio))))
    # Written first, so that its size is known: pages are only moved if the lines of all hosts are too many to send around.
    common = stored(common.groupBy("host").agg(F.collect_set("line").alias("common")), "common-lines").select(own_text("host").alias("h"), "common")
    joined = parsed.join(common, F.col("host") == F.col("h"), "left")
    kept = F.when(F.col("common").isNull(), F.col("all_lines")).otherwise(F.filter("all_lines", lambda line: ~F.array_contains(F.col("common"), _key(line))))
    out = joined.select("page_id", "host", "all_lines", kept.alias("kept"))
    return out.select(
        "page_id",
        "host",
        F.size("all_lines").cast("long").alias("lines"),
        (F.size("all_lines") - F.size("kept")).cast("long").alias("dropped"),
        F.array_join("kept", "\n").alias("text"),
    )
