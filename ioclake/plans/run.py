"""One run from landed pages to the report, every stage written once.

parsed -> links -> first links            (sites)
parsed -> built -> deduped -> validated   (articles; dedup moves no text)
validated -> chunks -> replies -> chosen -> combined -> analysed

A page is parsed in the first stage and nowhere else.  Each stage observes its
own counts while it is written (A6), and rejects are read off the stages (H15).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ioclake import config
from ioclake.operators import analysis as an
from ioclake.operators import articles as art
from ioclake.operators import links as lk
from ioclake.operators import pages as pg
from ioclake.operators.text import chunk_tokens
from ioclake.plans import bindings as b
from ioclake.sources.staging import Stages
from ioclake.sources.tables import page_scan

#: order in which stage counts are told
COUNTS = ["pages", "links", "link_rejects", "article_links", "kept_links", "page_text", "articles_built", "build_rejects",
          "deduped", "duplicates_skipped", "validated", "validate_rejects", "chunks", "chunk_analysis", "analysed_articles"]


class Run:
    """``keep``: names of the stages to write; None writes all of them.
    ``chunker`` and ``replies`` make the chunks and the replies to them."""

    def __init__(self, spark: SparkSession, sf: str, keep: set[str] | None = None,
                 max_tokens: int = config.CHUNK_TOKENS, replies=b.stub_replies, chunker=chunk_tokens):
        self.spark, self.sf, self.max_tokens, self.replies_of, self.chunker = spark, sf, max_tokens, replies, chunker
        self.stages = Stages(keep)

    @property
    def parsed(self) -> DataFrame:
        """(page_id, url, title, text, hrefs, has_text, has_title)."""
        def build():
            p = pg.parse_pages(page_scan(self.spark, self.sf))
            return p.withColumn("has_text", F.col("text") != "").withColumn("has_title", F.col("title") != "")
        return self.stages.stage("parsed", build, pages=F.count(F.lit(1)), page_text=F.count_if("has_text"))

    @property
    def links(self) -> DataFrame:
        """(page_id, page_url, link_pos, href, abs_url, resolve_error, article)."""
        def build():
            found = lk.resolve_links(lk.page_links(self.parsed.select("page_id", "url", "hrefs")))
            return found.withColumn("article", F.col("resolve_error").isNull()
                                    & lk.article_link_predicate(config.TESTDATA_LINK_MARKERS))
        return self.stages.stage("links", build, links=F.count(F.lit(1)), article_links=F.count_if("article"),
                                 link_rejects=F.count_if(F.col("resolve_error").isNotNull()))

    @property
    def first_links(self) -> DataFrame:
        return self.stages.stage("first_links", lambda: lk.first_n_links(
            self.links.filter("article").select("page_id", "link_pos", "abs_url")), kept_links=F.count(F.lit(1)))

    @property
    def built(self) -> DataFrame:
        """(pos, raw_url, url, reject, invalid): article records without text."""
        def build():
            texts = self.parsed.filter("has_text").select("page_id", "url", "has_title")
            return art.build_narrow(texts, pos="page_id")
        ok = F.col("reject").isNull()
        return self.stages.stage("built", build, articles_built=F.count_if(ok), build_rejects=F.count_if(~ok))

    @property
    def deduped(self) -> DataFrame:
        return self.stages.stage("deduped", lambda: art.dedup_by_url(art.accepted(self.built)), deduped=F.count(F.lit(1)),
                                 validated=F.count_if(F.col("invalid").isNull()),
                                 validate_rejects=F.count_if(F.col("invalid").isNotNull()))

    @property
    def validated(self) -> DataFrame:
        """(doc, pos, url, title, text): the texts follow their records by pos."""
        def build():
            records = self.deduped.filter("invalid IS NULL").select("pos", "url")
            texts = self.parsed.filter("has_text").select(F.col("page_id").alias("pos"), "title", "text")
            return records.join(texts, "pos").select(F.col("url").alias("doc"), "pos", "url", "title", "text")
        return self.stages.stage("articles", build)

    @property
    def chunks(self) -> DataFrame:
        return self.stages.stage("chunks", lambda: self.chunker(
            self.validated, key=["doc", "pos"], max_tokens=self.max_tokens), chunks=F.count(F.lit(1)))

    @property
    def classified(self) -> DataFrame:
        return self.stages.stage("classified", lambda: an.classify_replies(self.replies_of(self.chunks)))

    @property
    def chosen(self) -> DataFrame:
        return self.stages.stage("chosen", lambda: an.choose_attempt(self.classified), chunk_analysis=F.count_if(
            F.col("reply_class").isin("a", "b", "c")))

    @property
    def combined(self) -> DataFrame:
        return self.stages.stage("combined", lambda: an.combine_articles(an.chunk_analysis(self.chosen)),
                                 analysed_articles=F.count(F.lit(1)))

    @property
    def analysed(self) -> DataFrame:
        return an.analysed_articles(self.validated, self.combined)

    @property
    def unanalysed(self) -> DataFrame:
        return an.unanalysed_articles(self.validated, self.combined)

    def counts(self) -> DataFrame:
        """(stage, n_rows) of a whole run; the rows were counted while the
        stages were written."""
        for stage in ("parsed", "links", "first_links", "built", "deduped", "chunks", "classified", "chosen", "combined"):
            getattr(self, stage)
        seen = self.stages.counts
        seen["duplicates_skipped"] = seen["articles_built"] - seen["deduped"]
        return self.spark.createDataFrame([(c, seen[c]) for c in COUNTS], "stage string, n_rows long")

    def rejects(self) -> DataFrame:
        """(stage, key, reason) of everything that fell out on the way."""
        build = self.built.filter(F.col("reject").isNotNull()).select(
            F.lit("build").alias("stage"), F.col("raw_url").alias("key"), F.col("reject").alias("reason"))
        invalid = self.deduped.filter(F.col("invalid").isNotNull()).select(
            F.lit("validate").alias("stage"), F.col("url").alias("key"), F.col("invalid").alias("reason"))
        return build.unionByName(invalid).unionByName(lk.link_rejects(self.links)).unionByName(an.reply_rejects(self.classified))
