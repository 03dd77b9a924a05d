"""How the landed tables feed the operators.

* ``pages``      -> links (index-page side) and articles (article side):
                    every landed page is an article fetched at position
                    ``page_id``; its key ``doc`` is the normalised URL.
* ``documents``  -> text-level operators keyed by ``doc`` = ``doc_id``;
                    the first line of a document is its title.
* replies        -> ``stub_replies`` derives a deterministic reply table
                    from the chunks so every reply class occurs; a real run
                    lands the model's replies in the same shape instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ioclake import config
from ioclake.functions.text import WS, py_strip
from ioclake.functions.urls import with_normalized_url
from ioclake.operators import articles as art
from ioclake.operators import links as lk
from ioclake.operators import mentions as mn
from ioclake.operators import pages as pg
from ioclake.operators.text import split_sentences
from ioclake.sources.tables import page_scan, read_text_table


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """(doc, pos, title, text) from ``documents``."""
    d = read_text_table(spark, sf, "documents")
    return d.select(F.col("doc_id").alias("doc"), F.col("doc_id").alias("pos"),
                    py_strip(F.substring_index("text", "\n", 1)).alias("title"), "text")


def dealt_documents(spark: SparkSession, sf: str) -> DataFrame:
    """``documents`` with each text moved once, to where its document's rows
    are gathered: a landed file of few row groups keeps few tasks busy, and
    finding mentions is what takes the time.  The sentences' groups then need
    no further shuffle.  The number is given, as small shuffles are merged by
    their bytes, which say little about the work on them."""
    many = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return documents(spark, sf).repartition(many, "doc")


def resolved_links(spark: SparkSession, sf: str) -> DataFrame:
    return lk.resolve_links(lk.extract_links(page_scan(spark, sf)))


def first_links(spark: SparkSession, sf: str, markers=None) -> DataFrame:
    markers = config.TESTDATA_LINK_MARKERS if markers is None else markers
    return lk.first_n_links(lk.filter_article_links(resolved_links(spark, sf), markers))


def site_links(spark: SparkSession, sf: str) -> DataFrame:
    """(site_pos, link_pos, abs_url): the first article links of each site.

    No landed link points at a landed page, so links are bound to pages by a
    rule: number (7 * site + 13 * link + 1) modulo twice the number of pages;
    where that is a page_id, the link's target is that page's URL, else it
    keeps its own and its page is missing."""
    pages = page_scan(spark, sf)
    twice = pages.agg((F.max("page_id") + 1) * 2).scalar()
    links = first_links(spark, sf).select(F.col("page_id").alias("site_pos"), "link_pos", "abs_url").withColumn(
        "page_id", (F.col("site_pos") * 7 + F.col("link_pos") * 13 + 1) % twice)
    return links.join(pages.select("page_id", "url"), "page_id", "left") \
        .select("site_pos", "link_pos", F.coalesce("url", "abs_url").alias("abs_url"))


def flow_articles(spark: SparkSession, sf: str) -> DataFrame:
    """(site_pos, link_pos, page_id, doc, title, text): articles reached from
    the sites' links.  URLs are checked and deduplicated before any html
    moves; equal URLs have one page, so the order of steps does not matter."""
    pages = page_scan(spark, sf)
    found = pg.lookup_pages(site_links(spark, sf), pages)
    named = with_normalized_url(found, "abs_url", out="doc", reason="_reject").filter("_reject IS NULL")
    once = art.dedup_by_url(named.select("site_pos", "link_pos", "page_id", "doc"), "doc", ["site_pos", "link_pos"])
    html = once.join(pages.select("page_id", "html"), "page_id")
    texts = pg.page_text(html, keep=("site_pos", "link_pos", "page_id", "doc"))
    return art.validate(texts.withColumnRenamed("doc", "url")).withColumnRenamed("url", "doc")


def doc_mentions(spark: SparkSession, sf: str, docs: DataFrame | None = None) -> DataFrame:
    docs = dealt_documents(spark, sf) if docs is None else docs
    gaz = mn.gazetteer_table(spark)
    return mn.find_mentions(docs, gaz, key="doc")


def doc_sentences(spark: SparkSession, sf: str, docs: DataFrame | None = None) -> DataFrame:
    docs = documents(spark, sf) if docs is None else docs
    return split_sentences(docs, "doc")


def stub_replies(chunks: DataFrame) -> DataFrame:
    """(doc, chunk_no, attempt, status, content): three attempts per chunk,
    content derived from the chunk's tokens; the class of a chunk's replies
    is chosen by (pos + chunk_no) mod 7:

    0 object of strings            1 first attempt errors, then as 0
    2 object with missing keys     3 plain text (not JSON)
    4 JSON array twice, then as 0  5 list value not a string, every time
    6 summary is a number (passes the parse, ends in rejects)
    """
    toks = F.split(py_strip("chunk"), WS + "+")

    def words(start, n, sep):
        return F.array_join(F.slice(toks, start, n), sep)

    full = F.to_json(F.struct(
        words(1, 12, " ").alias("Executive_Summary"), words(1, 3, ", ").alias("Threat_Actors"),
        words(4, 2, ", ").alias("TTPs"), words(6, 1, ", ").alias("IOCs"),
        words(7, 6, " ").alias("Global_Impact"), words(13, 2, ", ").alias("Recommendations")))
    partial = F.to_json(F.struct(words(2, 5, " ").alias("Executive_Summary"),
                                 words(2, 2, ", ").alias("TTPs")))
    plain = F.concat(F.lit("Summary: "), words(1, 8, " "))
    bad_list = F.to_json(F.struct(words(1, 4, " ").alias("Executive_Summary"),
                                  F.col("chunk_no").alias("TTPs")))
    bad_text = F.to_json(F.struct(F.col("chunk_no").alias("Executive_Summary"),
                                  words(1, 2, ", ").alias("TTPs")))
    k = (F.col("pos") + F.col("chunk_no")) % 7
    a = F.col("attempt")
    content = (F.when(k == 0, full)
               .when(k == 1, F.when(a == 1, F.lit(None).cast("string")).otherwise(full))
               .when(k == 2, partial)
               .when(k == 3, plain)
               .when(k == 4, F.when(a < 3, F.lit("[1]")).otherwise(full))
               .when(k == 5, bad_list)
               .otherwise(bad_text))
    status = F.when((k == 1) & (a == 1), F.lit("error")).otherwise(F.lit("ok"))
    return (chunks.select("doc", "pos", "chunk_no", "chunk",
                          F.explode(F.sequence(F.lit(1), F.lit(config.MAX_ATTEMPTS))).alias("attempt"))
            .select("doc", "pos", "chunk_no", "attempt", status.alias("status"), content.alias("content")))
