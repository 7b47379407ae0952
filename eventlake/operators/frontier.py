"""Listing frontier: which pages of a listing its own links lead to.

The original read a listing's page links from the live base page.  Here stored pages and the links
in their HTML are a graph: :func:`listing_frontier` follows page links from every listing's base
page to the reachable set, level by level, and reports linked pages that are not stored.  Each
level is one join of the newly reached pages with the link table, written to the shared folder;
there are as many levels as the longest shortest way through a listing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.operators.joins import first_by_order
from eventlake.session import staged
from eventlake.sources.html import paginate, pagination_links


def listing_frontier(pages: DataFrame, param: str = "p", max_levels: int | None = None) -> DataFrame:
    """listing, url, page_no, level (0: the base page), stored, position.

    ``position`` orders a listing's pages by number: the base page, or one without a number, first; equal numbers by
    URL.  ``max_levels`` bounds how far links are followed (1: the base page's own links only)."""
    edges = staged(pagination_links(pages, param).select(F.col("url").alias("from_url"), F.col("link").alias("to_url")).distinct(), "frontier-edges")
    stored = staged(pages.select("url").distinct(), "frontier-stored")
    reached = staged(paginate(stored, "url", param).where(F.col("url") == F.col("listing")).select("url", F.lit(0).alias("level")), "frontier-level")
    new, level = reached, 0
    while level != max_levels and not new.isEmpty():
        level += 1
        found = edges.join(new, F.col("from_url") == F.col("url"), "left_semi").select(F.col("to_url").alias("url")).distinct()
        new = staged(found.join(reached, "url", "left_anti").select("url", F.lit(level).alias("level")), "frontier-level")
        reached = reached.unionByName(new)
    out = paginate(reached, "url", param).join(stored.withColumn("stored", F.lit(True)), "url", "left")
    return _positions(out.withColumn("stored", F.coalesce("stored", F.lit(False))))


def _positions(pages: DataFrame) -> DataFrame:
    """Numbers of the pages of each listing.  A listing's rows are ordered over several tasks
    (running count in ranges), so one very long listing does not land in one."""
    from eventlake.operators.sequence import with_running_sum
    counted = with_running_sum(pages.withColumn("_one", F.lit(1)), "listing", ["page_no", "url"], "_one", "position")
    return counted.select("listing", "url", "page_no", "level", "stored", F.col("position").cast("long").alias("position"))


def missing_pages(frontier: DataFrame) -> DataFrame:
    """Pages that are linked but not stored."""
    return frontier.where(~F.col("stored"))


def next_missing(frontier: DataFrame) -> DataFrame:
    """The first missing page of every listing: where a crawl goes on."""
    return first_by_order(missing_pages(frontier), ["listing"], [F.col("position")])
