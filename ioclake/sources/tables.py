"""Readers for landed tables (A2) and the seed list (A1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ioclake import config

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: session setting: partitions that text scans are dealt over (unset: as scanned)
SCAN_PARTITIONS = "spark.ioclake.scan.partitions"


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt over the partitions that the caller set for text scans;
    a landed table of few row groups scans as few tasks otherwise."""
    n = df.sparkSession.conf.get(SCAN_PARTITIONS, None)
    return df.repartition(int(n)) if n else df


def read_text_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(read_table(spark, sf_dir, name))


def page_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages (A2).  A fetch that returned an HTTP error leaves no
    usable row: when the table records a status, only status < 400 is kept
    (the filter reaches the parquet scan)."""
    pages = read_table(spark, sf_dir, "pages")
    if "status" in pages.columns:
        pages = pages.filter(F.col("status") < 400)
    return spread(pages)


def seed_table(spark: SparkSession, sites=None) -> DataFrame:
    """(site_pos, url): the index pages that a run starts from, in order (A1)."""
    sites = config.SEED_SITES if sites is None else sites
    return spark.createDataFrame(list(enumerate(sites)), "site_pos long, url string")


def seeds_from_pages(pages: DataFrame) -> DataFrame:
    """Landed index pages as the seed table: site position = page_id."""
    return pages.select(F.col("page_id").alias("site_pos"), "url")
