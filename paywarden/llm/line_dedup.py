"""Site-relative line dedup: drop lines that stand on too large a share of a host's pages.

Pages are grouped by host. A line, normalised and hashed, is boilerplate if the
pages of the host that contain it, divided by the host's pages, exceed
``MAX_RATIO``; it must stand on ``MIN_PAGES`` pages at least, so that a host of
one page keeps its text. The texts that remain are returned whole.

The pages are read once: their texts and line hashes go to a written table, so
that counting, marking and the result do not take tags out again each.

Nulls: a null text has no lines, a null host is a host of its own. Repeated
rows are pages of their own. Blank lines are kept. An empty table gives an
empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paywarden.llm.lines import lines_of, rows_per_line, with_line_hashes, with_removed_lines
from paywarden.llm.storage import saved

MAX_RATIO = 0.2
MIN_PAGES = 3

# What ends a line of a page's text, and what is no text of it.
UNSEEN = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
BREAKS = r"(?i)</?(p|div|li|ul|ol|br|hr|h[1-6]|tr|td|th|table|article|section|nav|header|footer|title|body|head)\b[^>]*>"
TAG = r"<[^>]*>"


def host_of(url: Column) -> Column:
    """The host of a URL in lower case, null if there is none."""
    host = F.lower(F.regexp_extract(url, r"(?i)^[a-z][a-z0-9+.-]*://([^/?#:]+)", 1))
    return F.when(host != "", host)


def page_text(html: Column) -> Column:
    """A page's text with a line for each block; tags, scripts, styles and comments are taken out."""
    seen = F.regexp_replace(html, UNSEEN, "")
    return F.regexp_replace(F.regexp_replace(seen, BREAKS, "\n"), TAG, "")


def boilerplate(hashed: DataFrame, max_ratio: float, min_pages: int) -> DataFrame:
    """``host`` and ``hash`` of the lines above the ratio, as a written table."""
    counted = rows_per_line(hashed, "host").where(F.col("n") >= min_pages)
    totals = hashed.groupBy(F.col("host").alias("_host")).agg(F.count(F.lit(1)).alias("_pages"))
    compared = counted.join(totals, F.col("host").eqNullSafe(F.col("_host")))
    return saved(compared.where(F.col("n") > F.col("_pages") * max_ratio).select("host", "hash"), "boilerplate")


def drop_boilerplate(pages: DataFrame, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """Pages of ``page_id``, ``host`` and ``text`` without boilerplate, with line counts."""
    given = with_line_hashes(pages.select("page_id", "host", "text"), "text")
    lined = saved(given.drop("lines"), "page-lines")
    removals = boilerplate(lined, max_ratio, min_pages)
    marked = with_removed_lines(lined, lined.select("page_id", "text_hash", "host", "text"), "host", "page_id", removals)
    marked = marked.withColumn("lines", lines_of(F.col("text")))
    every = F.when(F.size("lines") > 0, F.sequence(F.lit(0), F.size("lines") - 1)).otherwise(
        F.array().cast("array<int>")
    )
    left = F.transform(F.array_except(every, F.col("removed")), lambda i: F.get(F.col("lines"), i))
    return marked.select(
        "page_id",
        "host",
        F.size("lines").cast("bigint").alias("n_lines"),
        F.size("removed").cast("bigint").alias("n_removed"),
        F.when(F.col("text").isNotNull(), F.array_join(left, "\n")).alias("text"),
    )
