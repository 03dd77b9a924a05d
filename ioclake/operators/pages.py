"""Page side: URL-keyed fetch reuse (A3), link -> page lookup (C1) and
HTML -> (title, text, links) extraction (B1, B4, B5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ioclake.functions.html import html_tokens, token_content, token_hrefs, token_text, token_title
from ioclake.functions.text import project_once


def without_fragment(url) -> F.Column:
    """The part of a URL that is fetched."""
    return F.substring_index(url, "#", 1)


def _landed(pages: DataFrame) -> DataFrame:
    """One landed page per fetched URL: the first by page_id."""
    return (pages.filter(F.col("url").isNotNull()).groupBy(without_fragment("url").alias("fetch_url"))
            .agg(F.min("page_id").alias("page_id")))


def fetch_frontier(links: DataFrame, pages: DataFrame) -> DataFrame:
    """Distinct link URLs, as fetched, with whether a landed page already
    exists (A3).  Each URL is looked up once however many links point at it;
    the `cached = false` rows are the work still to fetch."""
    wanted = links.select(without_fragment("abs_url").alias("url")).distinct()
    have = _landed(pages).select(F.col("fetch_url").alias("url"), F.lit(True).alias("cached"))
    return (wanted.join(have, "url", "left")
            .select("url", F.coalesce(F.col("cached"), F.lit(False)).alias("cached")))


def lookup_pages(links: DataFrame, pages: DataFrame) -> DataFrame:
    """Links with the page_id of their landed page, fragments aside: links
    whose page is missing vanish, as failed fetches did."""
    return links.withColumn("fetch_url", without_fragment("abs_url")) \
        .join(_landed(pages), "fetch_url").drop("fetch_url")


def join_links_to_pages(links: DataFrame, pages: DataFrame) -> DataFrame:
    """Links with their landed page's id and html (C1); a narrow lookup
    decides the page, its html follows by page_id."""
    return lookup_pages(links, pages).join(pages.select("page_id", "html"), "page_id")


def links_without_page(links: DataFrame, pages: DataFrame) -> DataFrame:
    """Links whose page is missing (C1 complement, left anti join)."""
    return links.withColumn("fetch_url", without_fragment("abs_url")) \
        .join(_landed(pages), "fetch_url", "left_anti").drop("fetch_url")


def tokenize_pages(pages: DataFrame, keep) -> DataFrame:
    """(keep..., tokens) per page, the tokens made once."""
    return project_once(pages, list(keep), {"tokens": html_tokens(F.col("html"))})


def parse_pages(pages: DataFrame, keep=("page_id", "url")) -> DataFrame:
    """(keep..., title, text, hrefs) per page from one pass over its html.
    Pure column work: no shuffle."""
    t = F.col("tokens")
    return project_once(tokenize_pages(pages, keep), list(keep), {
        "title": token_title(t), "text": token_text(t), "hrefs": token_hrefs(t)})


def page_text(pages: DataFrame, keep=("page_id", "url")) -> DataFrame:
    """(keep..., title, text) per page; pages whose text is empty are
    dropped (B4, B5)."""
    t = F.col("tokens")
    out = project_once(tokenize_pages(pages, keep), list(keep), {"title": token_title(t), "text": token_text(t)})
    return out.filter(F.col("text") != "")


def page_content(pages: DataFrame, keep=("page_id",)) -> DataFrame:
    """(keep..., blocks, first, last, text): the part of each page whose
    blocks are long and not links, whatever its elements are called (B4)."""
    return tokenize_pages(pages, keep).select(*keep, F.inline(F.array(token_content(F.col("tokens")))))
