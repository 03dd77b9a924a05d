"""A join that a few frequent keys do not slow down."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: a key with more than this part of all rows is joined by broadcast
HOT_KEYS = 1024


def join_counted(rows: DataFrame, per_key: DataFrame, key, held: str, total) -> DataFrame:
    """``rows`` JOIN ``per_key`` on ``key``, where ``per_key`` has one row per
    key and in ``held`` its number of rows, ``total`` (a number or a scalar
    subquery) in all at most.  Fewer than HOT_KEYS keys hold more than one part
    in HOT_KEYS: those are broadcast, so their rows stay where they are; the
    others are shuffled."""
    hot = F.col(held) * HOT_KEYS > total
    few = F.broadcast(per_key.filter(hot).drop(held).withColumn("__hot", F.lit(True)))
    met = rows.join(few, key, "left")
    rest = met.filter("__hot IS NULL").select(*rows.columns).join(per_key.filter(~hot).drop(held), key)
    return met.filter("__hot").drop("__hot").unionByName(rest)
