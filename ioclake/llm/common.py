"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ioclake.functions.bitmap import Bitmap  # noqa: F401
from ioclake.functions.joins import join_counted  # noqa: F401
from ioclake.sources.staging import shared_dir, written  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else.  ``lower`` does the same on a pure ASCII
    text and is much faster there."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(
        F.translate(c, string.ascii_uppercase, string.ascii_lowercase))


def fold_bucket(c: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n`` (null id: null)."""
    return F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(n))
