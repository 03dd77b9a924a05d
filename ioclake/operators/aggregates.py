"""Order-aware aggregates shared by the analysis and report stages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Values gathered by one group in the first level of an ordered concat.
CONCAT_FANOUT = 1024


def first_seen(df: DataFrame, value: str, order: list[str]) -> DataFrame:
    """Distinct ``value`` with the smallest ``order`` tuple it occurs at
    (partial aggregation: one row per value and task crosses the shuffle)."""
    return (df.groupBy(value).agg(F.min(F.struct(*order)).alias("_first"))
            .select(value, "_first.*"))
