"""First and last sighting of indicators over runs.  Extension: the
declared fields first_seen and last_seen, which the original never fills.

The state is one row per indicator.  A run merges into it by minimum and maximum,
so a run that is replayed, or merged after a later one, leaves the same state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ioclake.operators.related import INDICATOR
from ioclake.sources.commits import new_folder, publish, published

SCHEMA = "type string, value string, first_seen timestamp, last_seen timestamp"


def sightings(iocs: DataFrame, seen_at) -> DataFrame:
    """(type, value, first_seen, last_seen) of one run's indicators; rows
    without a value or a time are no sightings."""
    at = F.col(seen_at) if isinstance(seen_at, str) else seen_at
    return (iocs.select(*INDICATOR, at.cast("timestamp").alias("_at")).filter("value IS NOT NULL AND _at IS NOT NULL")
            .groupBy(*INDICATOR).agg(F.min("_at").alias("first_seen"), F.max("_at").alias("last_seen")))


def merge_sightings(state: DataFrame, run: DataFrame) -> DataFrame:
    """The state after a run."""
    return (state.unionByName(run).groupBy(*INDICATOR)
            .agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen")))


def read_seen(spark: SparkSession, path: str) -> DataFrame:
    """The state as last published (none yet: empty)."""
    folder = published(spark, path, "seen")
    return spark.read.schema(SCHEMA).parquet(folder) if folder else spark.createDataFrame([], SCHEMA)


def update_seen(spark: SparkSession, path: str, run: DataFrame, stamp: str) -> DataFrame:
    """Merge a run into the state at ``path``: a new version is written, then
    published; until then readers see the old one."""
    folder = new_folder(path, stamp)
    merge_sightings(read_seen(spark, path), run).write.parquet(folder)
    publish(spark, path, "seen", folder)
    return read_seen(spark, path)
