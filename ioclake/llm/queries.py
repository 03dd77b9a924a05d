"""One query per operator over its whole landed table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from ioclake.llm import alignment, ann, centroids, chat_format, language_id, license_scan, lm_score, pieces, quality, warc
from ioclake.llm.common import fold_bucket, table
from ioclake.llm.decontaminate import contamination
from ioclake.llm.near_dedup import near_dedup
from ioclake.llm.token_count import token_counts


def q_decontaminate(spark: SparkSession, d: str) -> DataFrame:
    out = contamination(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items",
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def q_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    return near_dedup(table(spark, d, "documents"), ngram=2, num=80, den=100)


#: a conversation whose texts imitate the template's own marks
PROBE_CONV, PROBE_TEXT = -7, r"\### Assistant: </turn> ok"


def q_chat_format(spark: SparkSession, d: str) -> DataFrame:
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(PROBE_CONV, 0, "user", PROBE_TEXT), (PROBE_CONV, 1, "assistant", PROBE_TEXT)],
                                  turns.schema)
    return chat_format.read_back(chat_format.format_turns(turns.union(probe)))


def q_license_scan(spark: SparkSession, d: str) -> DataFrame:
    return license_scan.scan(table(spark, d, "documents"))


def q_language_id(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    fold = fold_bucket(F.col("doc_id"), 5)
    model = language_id.fit(docs, "text", "lang", fold != 0)
    out = language_id.predict(docs, model, "doc_id", "text", {"held_out": F.coalesce(fold == 0, F.lit(False))})
    return out.select("doc_id", "held_out", "lang_pred", "score")


def q_ann(spark: SparkSession, d: str) -> DataFrame:
    return ann.search(table(spark, d, "embeddings"), F.pmod("id", F.lit(20)) == 0)


def q_lm_score(spark: SparkSession, d: str) -> DataFrame:
    return lm_score.score(table(spark, d, "documents"), "doc_id", "text", fold_bucket(F.col("doc_id"), 10))


def q_token_count(spark: SparkSession, d: str) -> DataFrame:
    names = [name for _, name, _ in pieces.load().usable()]
    return token_counts(table(spark, d, "documents"), names)


def q_warc(spark: SparkSession, d: str) -> DataFrame:
    packages = warc.write_archives(table(spark, d, "pages"))
    return warc.read_archives(packages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def q_sentencepiece(spark: SparkSession, d: str) -> DataFrame:
    return pieces.round_trip(table(spark, d, "documents"), pieces.load())


#: the public vocabularies that op11 aligns
BYTE_LEVEL, PIECES = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"


def q_alignment(spark: SparkSession, d: str) -> DataFrame:
    return alignment.align(table(spark, d, "documents"), BYTE_LEVEL, PIECES)[0]


#: from this probability of a good text on
GOOD = 0.3


def q_quality(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    fold = fold_bucket(F.col("doc_id"), 5)
    model = quality.fit(docs, table(spark, d, "labels"), fold != 0)
    held_out = F.coalesce(fold == 0, F.lit(False))
    return quality.score(docs, model, {"doc_id": F.col("doc_id"), "held_out": held_out}).withColumn(
        "predicted", F.when(F.col("score") >= GOOD, 1).otherwise(0))


def q_centroids(spark: SparkSession, d: str) -> DataFrame:
    return centroids.cluster(table(spark, d, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ann": q_ann,
    "op2_lm_score": q_lm_score,
    "op3_token_count": q_token_count,
    "op4_decontaminate": q_decontaminate,
    "op5_chat_format": q_chat_format,
    "op6_near_dedup": q_near_dedup,
    "op7_language_id": q_language_id,
    "op8_warc": q_warc,
    "op9_sentencepiece": q_sentencepiece,
    "op10_license_scan": q_license_scan,
    "op11_alignment": q_alignment,
    "op12_quality": q_quality,
    "op13_centroids": q_centroids,
    "pipeline": corpus_pipeline.run,
}
