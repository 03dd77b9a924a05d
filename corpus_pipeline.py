"""From raw documents to token ids: language, near duplicates, benchmark
passages, SentencePiece.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read back as the next one's ``docs``.  All stages but the last
return the columns of ``documents``.  Documents go where the language stage
answers ``und`` or is less sure than ``MIN_SCORE`` (a text of two languages is
about 0.5 and stays), where another document of their group of near duplicates
has a smaller id, and where a window of a benchmark item occurs in them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ioclake.llm import decontaminate, language_id, near_dedup, pieces
from ioclake.llm.common import fold_bucket, table, written

MIN_SCORE = 0.3
NGRAM, NUM, DEN = 5, 80, 100


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in a recognised language; the model learns from four of five
    documents, by id hash."""
    model = language_id.fit(docs, "text", "lang", F.coalesce(fold_bucket(F.col("doc_id"), 5) != 0, F.lit(False)))
    return language_id.with_language(docs, model, "text") \
        .filter((F.col("__lang_pred") != "und") & (F.col("__score") >= MIN_SCORE)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group over five-word shingles at 0.8."""
    return near_dedup.keep_one(docs, "doc_id", text_col="text", ngram=NGRAM, num=NUM, den=DEN)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, pieces, round_trip of what is left."""
    return pieces.round_trip(docs, pieces.load())


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_benchmark),
    ("sentencepiece", encode),
]

#: trained and iterative stages are beyond SQL; tests hold run() against a
#: brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
