"""Article records: construction with URL check (B6, B7), dedup by URL
keeping the first in order (E2), required-field validation (B8) and the
risk-score range rule (B9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ioclake.functions.urls import with_normalized_url


def build_articles(texts: DataFrame, pos: str = "pos") -> DataFrame:
    """(pos, url, title, text, reject) from extracted pages.

    A record needs a string title and text and an http(s) URL; rows that
    fail are kept with ``reject`` set so callers can route them to the
    rejects table.  ``url`` is the normalised URL (the dedup key)."""
    df = with_normalized_url(texts.withColumnRenamed("url", "raw_url"), "raw_url",
                             out="url", reason="_url_reject")
    reject = (F.when(F.col("title").isNull(), F.lit("null_title"))
              .when(F.col("text").isNull(), F.lit("null_text"))
              .when(F.col("_url_reject").isNotNull(), F.concat(F.lit("url_"), F.col("_url_reject"))))
    return df.select(F.col(pos).alias("pos"), "raw_url", "url", "title", "text",
                     reject.alias("reject"))


def build_narrow(texts: DataFrame, pos: str = "pos") -> DataFrame:
    """(pos, raw_url, url, reject, invalid): ``build_articles`` and the reason
    of ``validation_rejects`` for pages that have a text, from (pos, url,
    has_title).  What follows can sort and move records without their texts."""
    df = with_normalized_url(texts.withColumnRenamed("url", "raw_url"), "raw_url", out="url", reason="_url_reject")
    return df.select(F.col(pos).alias("pos"), "raw_url", "url",
                     F.when(F.col("_url_reject").isNotNull(), F.concat(F.lit("url_"), F.col("_url_reject"))).alias("reject"),
                     F.when(~F.col("has_title"), F.lit("empty_title")).when(F.col("url") == "", F.lit("empty_url")).alias("invalid"))


def accepted(articles: DataFrame) -> DataFrame:
    return articles.filter(F.col("reject").isNull()).drop("reject")


def dedup_by_url(articles: DataFrame, key: str = "url", order="pos") -> DataFrame:
    """Keep the first row per key by ``order``.

    ``row_number() = 1`` becomes a partial WindowGroupLimit before the
    shuffle: each map task ships at most one row per key, so a key that
    holds a third of all rows costs one row per task, not a hot partition."""
    w = Window.partitionBy(key).orderBy(*([order] if isinstance(order, str) else order))
    return (articles.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") == 1).drop("_rn"))


def _valid() -> F.Column:
    # truthiness of str: non-empty passes, a blank-only title passes
    return ((F.col("title") != "") & (F.col("text") != "") & (F.col("url") != "")).eqNullSafe(True)


def validate(articles: DataFrame) -> DataFrame:
    """Articles with non-empty title, text and url."""
    return articles.filter(_valid())


def validation_rejects(articles: DataFrame) -> DataFrame:
    """Complement of ``validate`` as reject rows with a reason."""
    reason = (F.when(F.coalesce(F.col("title"), F.lit("")) == "", F.lit("empty_title"))
              .when(F.coalesce(F.col("text"), F.lit("")) == "", F.lit("empty_text"))
              .otherwise(F.lit("empty_url")))
    return (articles.filter(~_valid())
            .select(F.lit("validate").alias("stage"), F.col("url").alias("key"),
                    reason.alias("reason"), "pos"))


def risk_in_range(df: DataFrame, col: str = "risk_score") -> DataFrame:
    """Rows whose score is null or within [0, 100]."""
    c = F.col(col)
    return df.filter(c.isNull() | c.between(0, 100))
