"""Threat actors from mentions: merge by case-folded name (D1), attributes
of the first mention's sentence (D2, H3, H4), same-sentence targets /
tactics / techniques (C2-C4) and related IOCs by substring (C5), plus the
nested article view (H17).

Every step is a grouped aggregate or an equi-join; nothing emits all
pairs of a document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ioclake import config
from ioclake.operators.mentions import actor_mentions

QGRAM = 3


def merge_actors(mentions: DataFrame, key: str = "doc") -> DataFrame:
    """(key, actor_key, names, first_text, sent, pos): one row per distinct
    case-folded actor name; ``names`` = surface forms in first-seen order,
    (sent, pos) = the first mention.

    Two aggregates: per surface form first (partial aggregation bounds the
    shuffle by the number of distinct forms, so a name mentioned a million
    times in one document still ships one row per form and task), then per
    folded name over the few forms."""
    am = actor_mentions(mentions).withColumn("actor_key", F.lower("text"))
    forms = (am.groupBy(key, "actor_key", "text")
             .agg(F.min(F.struct("sent", "pos")).alias("first")))
    merged = (forms.groupBy(key, "actor_key")
              .agg(F.sort_array(F.collect_list(F.struct("first", "text"))).alias("_f")))
    return merged.select(
        key, "actor_key",
        F.transform("_f", lambda x: x["text"]).alias("names"),
        F.col("_f")[0]["text"].alias("first_text"),
        F.col("_f")[0]["first"]["sent"].alias("sent"),
        F.col("_f")[0]["first"]["pos"].alias("pos"))


def _first_sentence_mentions(actors: DataFrame, mentions: DataFrame, labels, key: str) -> DataFrame:
    m = (mentions.filter(F.col("label").isin(labels))
         .select(key, "sent", F.col("pos").alias("m_pos"), F.col("text").alias("m_text")))
    return actors.select(key, "actor_key", "sent").join(m, [key, "sent"], "inner")


def actor_targets(actors: DataFrame, mentions: DataFrame, key: str = "doc") -> DataFrame:
    """(key, actor_key, m_pos, target): GPE/ORG/PRODUCT mentions in the
    actor's first sentence other than the actor itself, ignoring case (C2)."""
    j = _first_sentence_mentions(actors, mentions, config.TARGET_LABELS, key)
    return (j.filter(F.lower("m_text") != F.col("actor_key"))
            .select(key, "actor_key", "m_pos", F.col("m_text").alias("target")))


def actor_tactics(actors: DataFrame, mentions: DataFrame, key: str = "doc") -> DataFrame:
    """(key, actor_key, m_pos, tactic): EVENT/WORK_OF_ART mentions of the
    actor's first sentence (C3)."""
    j = _first_sentence_mentions(actors, mentions, config.TACTIC_LABELS, key)
    return j.select(key, "actor_key", "m_pos", F.col("m_text").alias("tactic"))


def actor_techniques(actors: DataFrame, mentions: DataFrame, key: str = "doc") -> DataFrame:
    """(key, actor_key, m_pos, technique): WORK_OF_ART/LAW mentions of the
    actor's first sentence (C4)."""
    j = _first_sentence_mentions(actors, mentions, config.TECHNIQUE_LABELS, key)
    return j.select(key, "actor_key", "m_pos", F.col("m_text").alias("technique"))


def actor_context(actors: DataFrame, sentences: DataFrame, titles: DataFrame,
                  key: str = "doc") -> DataFrame:
    """(key, actor_key, description, summary, motivation).

    description names the article title, summary quotes the first
    mention's sentence, motivation is that sentence when it holds one of
    the motivation phrases, else null."""
    phrases = "|".join(config.MOTIVATION_PHRASES)
    s = sentences.select(key, "sent", "sent_text")
    j = (actors.select(key, "actor_key", "first_text", "sent")
         .join(s, [key, "sent"], "left")
         .join(titles.select(key, "title"), key, "left"))
    title_str = F.coalesce(F.col("title"), F.lit("None"))
    return j.select(
        key, "actor_key",
        F.concat(F.lit("Extracted from article: "), title_str).alias("description"),
        F.concat(F.lit("Potential threat actor '"), F.col("first_text"),
                 F.lit("' identified in the context: '"), F.col("sent_text"), F.lit("'")).alias("summary"),
        F.when(F.lower("sent_text").rlike(phrases), F.col("sent_text")).alias("motivation"))


def actor_related_iocs(actors: DataFrame, iocs: DataFrame, key: str = "doc") -> DataFrame:
    """(key, actor_key, ioc ordering columns..., value): IOC values that
    contain the actor's folded name, ignoring case (C5).

    A substring test is a theta join.  Each distinct value of a document is
    tested once, and only against the distinct name starts (QGRAM characters)
    of that document; names are paired with a value through the starts found in
    it and verified with ``contains``; the occurrences join the links last."""
    a = actors.select(key, "actor_key", F.substring("actor_key", 1, QGRAM).alias("q"))
    starts = a.groupBy(key).agg(F.collect_set("q").alias("_qs"))
    v = iocs.select(key, F.lower("value").alias("_lv")).distinct().join(starts, key)
    v = v.select(key, "_lv", F.explode(F.filter("_qs", lambda q: F.col("_lv").contains(q))).alias("q"))
    links = (v.join(a, [key, "q"]).filter(F.col("_lv").contains(F.col("actor_key")))
             .select(key, "_lv", "actor_key"))
    return iocs.withColumn("_lv", F.lower("value")).join(links, [key, "_lv"]).drop("_lv")


def _json(**fields) -> F.Column:
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]), {"ignoreNullFields": "false"})


def _none() -> F.Column:
    return F.lit(None).cast("string")


def _empty() -> F.Column:
    return F.array().cast("array<string>")


def enriched(docs: DataFrame, actors: DataFrame, mentions: DataFrame, iocs: DataFrame, ttps: DataFrame,
             context: DataFrame, key: str = "doc") -> DataFrame:
    """(docs..., threat_actors, ttps, iocs): each document with its entities
    as JSON arrays in first-seen order (H17).  Declared fields that nothing
    fills are null or empty.

    The children of a document are one union and one aggregate; an actor's own
    lists are made the same way before."""
    none = F.lit(0).cast("long")

    def place(*cols):
        return F.array(*[F.col(c).cast("long") for c in cols], *[none] * (4 - len(cols)))

    in_all = place("src_rank", "sent", "pos", "pat_rank")
    kinds = [
        actor_targets(actors, mentions, key).select(key, "actor_key", F.lit(0).alias("k"), place("m_pos").alias("o"),
                                                    F.col("target").alias("v")),
        actor_tactics(actors, mentions, key).select(key, "actor_key", F.lit(1), place("m_pos"), "tactic"),
        actor_techniques(actors, mentions, key).select(key, "actor_key", F.lit(2), place("m_pos"), "technique"),
        actor_related_iocs(actors, iocs, key).select(key, "actor_key", F.lit(3), in_all, "value"),
    ]
    parts = kinds[0]
    for more in kinds[1:]:
        parts = parts.union(more)
    lists = parts.groupBy(key, "actor_key").agg(F.sort_array(F.collect_list(F.struct("k", "o", "v"))).alias("_p"))

    def values(k):
        return F.coalesce(F.transform(F.filter("_p", lambda x: x.k == k), lambda x: x.v), _empty())

    one = actors.join(lists, [key, "actor_key"], "left").join(context, [key, "actor_key"], "left").select(
        key, F.lit(0).alias("k"), place("sent", "pos").alias("o"), F.col("actor_key").alias("tie"),
        _json(names=F.col("names"), aliases=_empty(), description=F.col("description"), summary=F.col("summary"),
              motivation=F.col("motivation"), targets=values(0), tactics=values(1), techniques=values(2),
              procedures=_empty(), related_iocs=values(3)).alias("j"))
    two = ttps.select(key, F.lit(1), place("sent", "pos"), "tactic",
                      _json(tactic=F.col("tactic"), technique=F.col("technique"), procedure=_none(), mitre_id=_none(),
                            related_actors=_empty()))
    three = iocs.select(key, F.lit(2), in_all, "type",
                        _json(type=F.col("type"), value=F.col("value"), first_seen=_none(), last_seen=_none(),
                              related_actors=_empty(), related_ttps=_empty()))
    children = one.union(two).union(three).groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct("k", "o", "tie", "j"))).alias("_c"))

    def array_of(k):
        held = F.transform(F.filter("_c", lambda x: x.k == k), lambda x: x.j)
        return F.concat(F.lit("["), F.coalesce(F.array_join(held, ","), F.lit("")), F.lit("]"))

    return docs.join(children, key, "left").select(
        *docs.columns, array_of(0).alias("threat_actors"), array_of(1).alias("ttps"), array_of(2).alias("iocs"))
