"""The query catalog: one callable per SURVEY §2 query name.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole landed tables.  Array-valued outputs are rendered with ``to_json``
so results compare as plain strings.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from ioclake import config
from ioclake.operators import actors as ac
from ioclake.operators import analysis as an
from ioclake.operators import articles as art
from ioclake.operators import iocs as io
from ioclake.operators import links as lk
from ioclake.operators import mentions as mn
from ioclake.operators import pages as pg
from ioclake.operators import report as rp
from ioclake.operators import ledger, related as rel, seen
from ioclake.operators.bpe import chunk_bpe
from ioclake.operators.text import chunk_tokens, tokenize
from ioclake.plans import bindings as b
from ioclake.plans.run import Run
from ioclake.sources.staging import shared_dir, written
from ioclake.sources.tables import page_scan, read_table, seeds_from_pages
from ioclake.functions.urls import with_normalized_url


# --------------------------------------------------------------- link side

def q_seed_scan(spark, sf):
    return seeds_from_pages(page_scan(spark, sf))


def q_page_scan(spark, sf):
    return page_scan(spark, sf).select("page_id", "url", F.length("html").alias("html_chars"))


def q_link_extract(spark, sf):
    return lk.extract_links(page_scan(spark, sf)).select("page_id", "link_pos", "href")


def q_link_resolve(spark, sf):
    return b.resolved_links(spark, sf).select("page_id", "link_pos", "href", "abs_url", "resolve_error")


def q_link_filter(spark, sf):
    return (lk.filter_article_links(b.resolved_links(spark, sf), config.TESTDATA_LINK_MARKERS)
            .select("page_id", "link_pos", "abs_url"))


def q_links_first_n(spark, sf):
    return b.first_links(spark, sf).select("page_id", "link_pos", "abs_url")


def _site_counts(spark, sf):
    """Per site: links found, links that could not be resolved, article
    links, and how many of those are kept (A6)."""
    marked = b.resolved_links(spark, sf).withColumn("_article", F.col("resolve_error").isNull()
                                                    & lk.article_link_predicate(config.TESTDATA_LINK_MARKERS))
    return marked.groupBy("page_id").agg(
        F.count(F.lit(1)).alias("links"), F.count_if(F.col("resolve_error").isNotNull()).alias("link_rejects"),
        F.count_if("_article").alias("article_links"),
        F.least(F.count_if("_article"), F.lit(config.LINKS_PER_SITE)).alias("kept_links"))


def q_site_link_counts(spark, sf):
    return _site_counts(spark, sf).withColumnRenamed("page_id", "site_pos")


def q_fetch_frontier(spark, sf):
    return pg.fetch_frontier(b.site_links(spark, sf), page_scan(spark, sf))


def q_link_page_join(spark, sf):
    return (pg.join_links_to_pages(b.site_links(spark, sf), page_scan(spark, sf))
            .select("site_pos", "link_pos", "abs_url", "page_id"))


def q_link_page_missing(spark, sf):
    return (pg.links_without_page(b.site_links(spark, sf), page_scan(spark, sf))
            .select("site_pos", "link_pos", "abs_url"))


# ------------------------------------------------------------ article side

def q_page_text(spark, sf):
    return pg.page_text(page_scan(spark, sf))


def q_page_content(spark, sf):
    return pg.page_content(page_scan(spark, sf))


def q_url_normalize(spark, sf):
    pages = page_scan(spark, sf).select(F.lit("page").alias("src"), F.col("page_id").alias("id"),
                                        F.lit(-1).cast("int").alias("link_pos"), "url")
    links = b.resolved_links(spark, sf).filter(F.col("abs_url").isNotNull()).select(
        F.lit("link").alias("src"), F.col("page_id").alias("id"), F.col("link_pos").cast("int"),
        F.col("abs_url").alias("url"))
    return with_normalized_url(pages.unionByName(links), "url")


def _articles(spark, sf):
    """A run that writes its parsed pages and plans the rest."""
    return Run(spark, sf, keep={"parsed"})


def q_dedup_by_url(spark, sf):
    return _articles(spark, sf).deduped.select("pos", "url")


def q_dedup_by_text(spark, sf):
    """First document per text: the copies in ``documents`` make E2 bite."""
    d = b.documents(spark, sf).select("pos", F.sha2("text", 256).alias("text_sha256"))
    return art.dedup_by_url(d, "text_sha256")


def q_validate_articles(spark, sf):
    return _articles(spark, sf).validated.select("pos", "url", "title")


def q_validate_rejects(spark, sf):
    return _articles(spark, sf).deduped.filter("invalid IS NOT NULL").select(
        F.lit("validate").alias("stage"), F.col("url").alias("key"), F.col("invalid").alias("reason"), "pos")


def q_articles_ordered(spark, sf):
    """The connected flow: sites -> first links -> landed pages -> text ->
    dedup -> validation, in (site, link) order (F1)."""
    return b.flow_articles(spark, sf).select("site_pos", "link_pos", "doc", "title").orderBy("site_pos", "link_pos")


def q_risk_range_check(spark, sf):
    d = read_table(spark, sf, "documents").select(
        "doc_id", (F.col("n_chars") / F.lit(100.0)).alias("risk_score"))
    return art.risk_in_range(d)


# ------------------------------------------------------------- text side

def q_doc_tokens(spark, sf):
    return tokenize(b.documents(spark, sf), "doc")


def q_sentence_split(spark, sf):
    return b.doc_sentences(spark, sf)


def q_chunk_tokens(spark, sf):
    return chunk_tokens(b.documents(spark, sf), "doc")


#: words a chunk in the queries whose texts should fall into several chunks
SMALL_CHUNK = 60


def q_chunk_tokens_small(spark, sf):
    return chunk_tokens(b.documents(spark, sf), "doc", max_tokens=SMALL_CHUNK)


def q_chunk_bpe(spark, sf):
    return chunk_bpe(b.documents(spark, sf), config.BPE_RANKS, "doc", max_tokens=config.TESTDATA_BPE_CHUNK)


def q_iocs_patterns(spark, sf):
    return io.pattern_iocs(b.documents(spark, sf), "doc")


def q_iocs_url_email(spark, sf):
    return io.url_email_iocs(b.documents(spark, sf), "doc")


def q_gazetteer_mentions(spark, sf):
    return b.doc_mentions(spark, sf)


def q_ttps(spark, sf):
    return mn.ttps(b.doc_mentions(spark, sf))


def q_iocs_from_mentions(spark, sf):
    return io.mention_iocs(b.doc_mentions(spark, sf))


def _doc_iocs(spark, sf, docs=None, ments=None):
    docs = b.dealt_documents(spark, sf) if docs is None else docs
    ments = b.doc_mentions(spark, sf, docs) if ments is None else ments
    return io.all_iocs(io.mention_iocs(ments), io.token_iocs(docs, "doc"))


def q_iocs_all(spark, sf):
    return _doc_iocs(spark, sf)


def _actors(spark, sf, ments=None):
    return ac.merge_actors(b.doc_mentions(spark, sf) if ments is None else ments)


def q_actors_merged(spark, sf):
    return _actors(spark, sf).select("doc", "actor_key", F.to_json("names").alias("names"),
                                     "first_text", "sent", "pos")


# Finding mentions reads every token of the table; a query that uses them, or
# the indicators, several times writes them once and reads them back.

def _mentions(spark, sf, docs=None):
    return written(b.doc_mentions(spark, sf, docs), "mentions")


def q_actor_targets(spark, sf):
    ments = _mentions(spark, sf)
    return ac.actor_targets(_actors(spark, sf, ments), ments)


def q_actor_tactics(spark, sf):
    ments = _mentions(spark, sf)
    return ac.actor_tactics(_actors(spark, sf, ments), ments)


def q_actor_techniques(spark, sf):
    ments = _mentions(spark, sf)
    return ac.actor_techniques(_actors(spark, sf, ments), ments)


def _actor_context(spark, sf):
    docs = b.dealt_documents(spark, sf)
    actors = written(_actors(spark, sf, b.doc_mentions(spark, sf, docs)), "actors")
    return ac.actor_context(actors, b.doc_sentences(spark, sf, docs), docs)


def q_actor_summary(spark, sf):
    return _actor_context(spark, sf).select("doc", "actor_key", "description", "summary")


def q_actor_motivation(spark, sf):
    return _actor_context(spark, sf).select("doc", "actor_key", "motivation")


def q_actor_related_iocs(spark, sf):
    docs = b.dealt_documents(spark, sf)
    ments = _mentions(spark, sf, docs)
    iocs = written(_doc_iocs(spark, sf, docs, ments), "iocs")
    return ac.actor_related_iocs(_actors(spark, sf, ments), iocs).select(
        "doc", "actor_key", "src_rank", "sent", "pos", "pat_rank", "type", "value")


# ------------------------------------------- declared fields (extensions)

def q_indicator_classes(spark, sf):
    return rel.indicator_classes(_doc_iocs(spark, sf))


def q_related_articles(spark, sf):
    return rel.related_articles(written(_doc_iocs(spark, sf).select("doc", "type", "value").distinct(), "iocs"))


def q_ttp_links(spark, sf):
    ments = _mentions(spark, sf)
    return rel.ttp_links(mn.ttps(ments), ments).withColumn("related_actors", F.to_json("related_actors"))


def q_ioc_links(spark, sf):
    docs = b.dealt_documents(spark, sf)
    ments = _mentions(spark, sf, docs)
    iocs = written(_doc_iocs(spark, sf, docs, ments), "iocs")
    out = rel.ioc_links(iocs, _actors(spark, sf, ments), mn.ttps(ments))
    return out.select("doc", "type", "value", *[F.to_json(c).alias(c) for c in ("related_actors", "related_ttps")])


def q_ioc_seen(spark, sf):
    """Indicators of three runs (document number modulo 3, a day apart each,
    and an hour for each number modulo 7), the first one replayed."""
    iocs = _doc_iocs(spark, sf).withColumn("seen_at", F.timestamp_seconds(
        F.unix_seconds(F.lit(SEEN_FROM).cast("timestamp")) + F.col("doc") % 3 * 86_400 + F.col("doc") % 7 * 3600))
    iocs = written(iocs.select("doc", "type", "value", "seen_at"), "seen-at")
    path = f"{shared_dir(spark)}/seen-{uuid.uuid4().hex}"
    for run in (0, 1, 2, 0):
        state = seen.update_seen(spark, path, seen.sightings(iocs.filter(F.col("doc") % 3 == run), "seen_at"), f"run{run}")
    return state.select("type", "value", *[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("first_seen", "last_seen")])


def _enriched(spark, sf, docs):
    """``docs`` (doc, title, text, ...) with actors, TTPs and IOCs."""
    ments = _mentions(spark, sf, docs)
    actors = written(_actors(spark, sf, ments), "actors")
    iocs = written(_doc_iocs(spark, sf, docs, ments), "iocs")
    context = ac.actor_context(actors, b.doc_sentences(spark, sf, docs), docs)
    return ac.enriched(docs, actors, ments, iocs, mn.ttps(ments), context)


def q_articles_enriched(spark, sf):
    return _enriched(spark, sf, b.dealt_documents(spark, sf)).select("doc", "title", "threat_actors", "ttps", "iocs")


# --------------------------------------------------------- analysis side

def _analysis(spark, sf, max_tokens=config.CHUNK_TOKENS):
    """A run that writes pages, chunks and classified replies, which several
    branches of a query read, and plans the rest."""
    return Run(spark, sf, {"parsed", "chunks", "classified"}, max_tokens)


def _json_lists(df):
    return df.select(*[F.to_json(c).alias(c) if c in an.LIST_KEYS else F.col(c) for c in df.columns])


def q_analysis_requests(spark, sf):
    return an.build_requests(_articles(spark, sf).chunks).drop("request")


def q_response_parse(spark, sf):
    return _json_lists(_articles(spark, sf).classified.select(
        "doc", "chunk_no", "attempt", "reply_class", *an.KEYS))


def q_response_salvage(spark, sf):
    s = an.salvage_replies(b.stub_replies(_articles(spark, sf).chunks))
    return s.select("doc", "chunk_no", "attempt", "salvaged", *[F.to_json(k).alias(k) for k in an.KEYS])


def q_response_attempts(spark, sf):
    return _articles(spark, sf).chosen.select("doc", "chunk_no", "attempt", "reply_class")


def q_attempt_ledger(spark, sf):
    """Rounds of asking until every chunk has an answer or three attempts."""
    chunks = written(_articles(spark, sf).chunks.select("doc", "pos", "chunk_no", "chunk"), "requests")

    def ask(todo):
        return b.stub_replies(todo).join(todo.select("doc", "chunk_no", "attempt"), ["doc", "chunk_no", "attempt"])

    return ledger.ask_all(chunks, ask).select("doc", "chunk_no", "attempt", "reply_class", "asked_ms")


def q_article_combine(spark, sf):
    return _json_lists(_articles(spark, sf).combined)


def q_article_combine_small(spark, sf):
    """Articles of several chunks folded into one analysis (D3)."""
    return _json_lists(Run(spark, sf, {"parsed"}, SMALL_CHUNK).combined)


def q_reply_parse_landed(spark, sf):
    """Landed texts as replies: event properties are JSON objects,
    conversation texts are prose (H10-H12)."""
    events = read_table(spark, sf, "events").select(
        F.concat(F.lit("event "), "event_id").alias("doc"), F.col("props").alias("content"))
    talks = read_table(spark, sf, "conversations").select(
        F.concat(F.lit("turn "), "conv_id", F.lit(" "), "turn").alias("doc"), F.col("text").alias("content"))
    replies = events.union(talks).select("doc", F.lit(0).alias("chunk_no"), F.lit(1).alias("attempt"),
                                         F.lit("ok").alias("status"), "content")
    return _json_lists(an.classify_replies(replies).select("doc", "reply_class", *an.KEYS))


def q_analysed_articles(spark, sf):
    return _analysis(spark, sf).analysed.select("doc", "pos", "title")


def q_unanalysed_articles(spark, sf):
    return _analysis(spark, sf).unanalysed.select("doc", "pos", "title")


def q_rejects(spark, sf):
    return Run(spark, sf).rejects()


# ----------------------------------------------------------- report side

def _analysed(spark, sf):
    return _analysis(spark, sf).analysed


def q_report_summary(spark, sf):
    return rp.report_summary(_analysed(spark, sf))


def q_report_landscape(spark, sf):
    return rp.report_landscape(_analysed(spark, sf))


def q_report_threats(spark, sf):
    return rp.report_threats(_analysed(spark, sf))


def q_report_recommendations(spark, sf):
    return rp.report_recommendations(_analysed(spark, sf))


#: time of the first run of ``q_ioc_seen``
SEEN_FROM = "2024-01-01 00:00:00"
#: a run names its report; the query's is fixed so that it can be compared
REPORT_ID, REPORT_TIME = "00000000-0000-0000-0000-000000000000", datetime(2024, 1, 2, 3, 4, 5)


def q_report_json(spark, sf):
    run = Run(spark, sf)
    return rp.report_lines(_enriched(spark, sf, run.validated), run.analysed, REPORT_ID, REPORT_TIME)


def q_report_published(spark, sf):
    """The report's tables written as ordered files, published, and read by
    the manifest: sections with their lines and first and last positions."""
    run = _analysis(spark, sf)
    lines = rp.report_lines(run.validated.select("doc", "pos", "title", "url", "text", *[
        F.lit("[]").alias(c) for c in ("threat_actors", "ttps", "iocs")]), run.analysed, REPORT_ID, REPORT_TIME)
    path, stamp = f"{shared_dir(spark)}/reports-{uuid.uuid4().hex}", REPORT_TIME.strftime("%Y%m%d_%H%M%S")
    rp.write_report(lines, path, stamp)
    return rp.read_report(spark, path, stamp).groupBy("run_ts", "section").agg(
        F.count(F.lit(1)).alias("n_lines"), F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"))


def q_stage_counts(spark, sf):
    """(stage, n_rows) per stage of the article flow (A6), observed while a
    whole run writes its stages."""
    return Run(spark, sf).counts()


QUERIES = {
    "report_published": q_report_published,
    "attempt_ledger": q_attempt_ledger,
    "ioc_seen": q_ioc_seen,
    "ioc_links": q_ioc_links,
    "ttp_links": q_ttp_links,
    "related_articles": q_related_articles,
    "indicator_classes": q_indicator_classes,
    "chunk_bpe": q_chunk_bpe,
    "seed_scan": q_seed_scan,
    "page_scan": q_page_scan,
    "site_link_counts": q_site_link_counts,
    "dedup_by_text": q_dedup_by_text,
    "chunk_tokens_small": q_chunk_tokens_small,
    "article_combine_small": q_article_combine_small,
    "reply_parse_landed": q_reply_parse_landed,
    "fetch_frontier": q_fetch_frontier,
    "report_json": q_report_json,
    "stage_counts": q_stage_counts,
    "link_extract": q_link_extract,
    "link_resolve": q_link_resolve,
    "link_filter": q_link_filter,
    "page_text": q_page_text,
    "page_content": q_page_content,
    "url_normalize": q_url_normalize,
    "validate_articles": q_validate_articles,
    "validate_rejects": q_validate_rejects,
    "risk_range_check": q_risk_range_check,
    "ttps": q_ttps,
    "iocs_from_mentions": q_iocs_from_mentions,
    "link_page_join": q_link_page_join,
    "link_page_missing": q_link_page_missing,
    "actor_targets": q_actor_targets,
    "actor_tactics": q_actor_tactics,
    "actor_techniques": q_actor_techniques,
    "actor_related_iocs": q_actor_related_iocs,
    "analysed_articles": q_analysed_articles,
    "unanalysed_articles": q_unanalysed_articles,
    "gazetteer_mentions": q_gazetteer_mentions,
    "actors_merged": q_actors_merged,
    "article_combine": q_article_combine,
    "report_summary": q_report_summary,
    "report_landscape": q_report_landscape,
    "report_threats": q_report_threats,
    "report_recommendations": q_report_recommendations,
    "links_first_n": q_links_first_n,
    "dedup_by_url": q_dedup_by_url,
    "articles_ordered": q_articles_ordered,
    "iocs_all": q_iocs_all,
    "actor_motivation": q_actor_motivation,
    "actor_summary": q_actor_summary,
    "iocs_patterns": q_iocs_patterns,
    "iocs_url_email": q_iocs_url_email,
    "sentence_split": q_sentence_split,
    "chunk_tokens": q_chunk_tokens,
    "doc_tokens": q_doc_tokens,
    "analysis_requests": q_analysis_requests,
    "response_parse": q_response_parse,
    "response_salvage": q_response_salvage,
    "response_attempts": q_response_attempts,
    "rejects": q_rejects,
    "articles_enriched": q_articles_enriched,
}
