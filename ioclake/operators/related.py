"""What belongs together: articles by shared indicators, indicators and
TTPs by actors and by each other.  Extensions: the declared fields
related_articles, related_actors and related_ttps, which the original never
fills.

Nothing lists pairs.  Articles that share an indicator are one class with its
members; a class that a third of the articles share has one row per member.
Inside a document the distinct entities of a sentence are gathered once and
handed to what stands in that sentence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ioclake.functions.joins import join_counted
from ioclake.operators.actors import actor_related_iocs
from ioclake.operators.mentions import actor_mentions

INDICATOR = ["type", "value"]


def indicator_classes(iocs: DataFrame, key: str = "doc") -> DataFrame:
    """(type, value, n_articles, first_article): one row per indicator that
    several articles hold."""
    return (iocs.select(key, *INDICATOR).distinct().groupBy(*INDICATOR)
            .agg(F.count(F.lit(1)).alias("n_articles"), F.min(key).alias("first_article")).filter("n_articles > 1"))


def related_articles(iocs: DataFrame, key: str = "doc") -> DataFrame:
    """(key, type, value, n_articles, first_article, n_links): the classes
    that each article is in; it has ``n_links`` = n_articles - 1 partners in one.
    Two articles are related if they meet in a class."""
    held = iocs.select(key, *INDICATOR).distinct()
    classes = indicator_classes(iocs, key)
    counted = classes.withColumn("held", F.col("n_articles"))
    total = classes.agg(F.coalesce(F.sum("n_articles"), F.lit(0))).scalar()
    return join_counted(held, counted, INDICATOR, "held", total).select(
        key, *INDICATOR, "n_articles", "first_article", (F.col("n_articles") - 1).alias("n_links"))


def _of_sentence(df: DataFrame, key: str, col: str, out: str) -> DataFrame:
    return df.groupBy(key, "sent").agg(F.sort_array(F.collect_set(col)).alias(out))


def ttp_links(ttps: DataFrame, mentions: DataFrame, key: str = "doc") -> DataFrame:
    """(key, sent, pos, tactic, technique, related_actors): each TTP with the
    folded names of the actors of its sentence, sorted."""
    near = _of_sentence(actor_mentions(mentions).withColumn("a", F.lower("text")), key, "a", "related_actors")
    none = F.array().cast("array<string>")
    return ttps.join(near, [key, "sent"], "left").withColumn("related_actors", F.coalesce("related_actors", none))


def ioc_links(iocs: DataFrame, actors: DataFrame, ttps: DataFrame, key: str = "doc") -> DataFrame:
    """(key, type, value, related_actors, related_ttps): each different
    indicator of a document with the actors whose name it contains (C5 read the
    other way) and the techniques of the sentences it is mentioned in, sorted."""
    none = F.array().cast("array<string>")
    near = _of_sentence(ttps, key, "technique", "t")
    told = iocs.filter("src_rank = 0").select(key, "sent", *INDICATOR).distinct().join(near, [key, "sent"]) \
        .select(key, *INDICATOR, F.explode("t").alias("t"), F.lit(None).cast("string").alias("a"))
    named = actor_related_iocs(actors, iocs, key).select(
        key, *INDICATOR, F.lit(None).cast("string").alias("t"), F.col("actor_key").alias("a"))
    alone = iocs.select(key, *INDICATOR).distinct().select(
        "*", F.lit(None).cast("string").alias("t"), F.lit(None).cast("string").alias("a"))
    return told.unionByName(named).unionByName(alone).groupBy(key, *INDICATOR).agg(
        F.coalesce(F.sort_array(F.collect_set("a")), none).alias("related_actors"),
        F.coalesce(F.sort_array(F.collect_set("t")), none).alias("related_ttps"))
