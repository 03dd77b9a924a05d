"""Link discovery on index pages: extract (B1), resolve (B2), keep article
links (B3) and the first N per page in document order (E1, F2, G1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ioclake import config
from ioclake.functions.html import href_value, token_hrefs
from ioclake.functions.urls import with_resolved_url
from ioclake.operators.pages import tokenize_pages


def page_links(parsed: DataFrame, page_key: str = "page_id") -> DataFrame:
    """(page_key, page_url, link_pos, href) from pages whose raw ``hrefs``
    are at hand: decoded, empty ones dropped after they are numbered."""
    found = parsed.select(F.col(page_key), F.col("url").alias("page_url"), F.posexplode("hrefs").alias("link_pos", "_raw"))
    return found.withColumn("href", href_value(F.col("_raw"))).drop("_raw").filter(F.col("href") != "")


def extract_links(pages: DataFrame, page_key: str = "page_id") -> DataFrame:
    """(page_key, page_url, link_pos, href): every non-empty href of an <a>
    element, in document order, entities decoded.  ``link_pos`` numbers the
    <a> elements that carry an href."""
    tokens = tokenize_pages(pages, (page_key, "url"))
    return page_links(tokens.select(page_key, "url", token_hrefs(F.col("tokens")).alias("hrefs")), page_key)


def resolve_links(links: DataFrame) -> DataFrame:
    """Add abs_url (B2) and resolve_error; bad references keep their row
    with a null abs_url so they can be reported."""
    return with_resolved_url(links, "page_url", "href", out="abs_url", error="resolve_error")


def article_link_predicate(markers=None) -> F.Column:
    markers = config.ARTICLE_LINK_MARKERS if markers is None else markers
    cond = F.lit(False)
    for m in markers:
        cond = cond | F.col("abs_url").contains(m)
    return cond


def filter_article_links(resolved: DataFrame, markers=None) -> DataFrame:
    """Links whose absolute URL contains any marker."""
    return resolved.filter(F.col("resolve_error").isNull() & article_link_predicate(markers))


def first_n_links(article_links: DataFrame, n: int = config.LINKS_PER_SITE,
                  page_key: str = "page_id") -> DataFrame:
    """First n article links per page by position, duplicates counted.
    ``row_number() <= n`` lets Spark plan a partial WindowGroupLimit before
    the shuffle, so at most n rows per page and map task move."""
    w = Window.partitionBy(page_key).orderBy("link_pos")
    return (article_links.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") <= n).drop("_rn"))


def link_rejects(resolved: DataFrame, page_key: str = "page_id") -> DataFrame:
    """References that could not be resolved, as reject rows."""
    return (resolved.filter(F.col("resolve_error").isNotNull())
            .select(F.lit("link_resolve").alias("stage"),
                    F.concat_ws("#", F.col(page_key).cast("string"), F.col("link_pos").cast("string")).alias("key"),
                    F.col("resolve_error").alias("reason")))
