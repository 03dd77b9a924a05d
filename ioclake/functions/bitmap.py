"""A fixed-size set sketch of long values as one array of longs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Bitmap:
    """Made by Spark and sent to all tasks as one array of ``bits / 64``
    longs: what it rules out is surely not among the values; the rest still has
    to be joined."""

    def __init__(self, values: DataFrame, col: str, bits: int):
        self.bits = bits
        slot = values.select(F.col(col).bitwiseAND(bits - 1).alias("s"))
        words = slot.select(F.shiftright("s", 6).alias("w"), F.expr("shiftleft(1L, cast(s & 63 as int))").alias("b")) \
            .groupBy("w").agg(F.bit_or("b").alias("b"))
        every = values.sparkSession.range(bits // 64).select(F.col("id").alias("w"))
        self.array = every.join(words, "w", "left").agg(F.transform(
            F.array_sort(F.collect_list(F.struct("w", F.coalesce("b", F.lit(0).cast("long")).alias("b")))),
            lambda x: x.b).alias("bits")).scalar()

    def may_hold(self, value: Column | str) -> Column:
        """Whether the value may be in the set (null: not)."""
        v = F.col(value) if isinstance(value, str) else value
        at = F.shiftright(v.bitwiseAND(self.bits - 1), 6).cast("int") + 1
        mask = F.call_function("shiftleft", F.lit(1).cast("long"), v.bitwiseAND(63).cast("int"))
        return F.coalesce(F.element_at(self.array, at).bitwiseAND(mask) != 0, F.lit(False))
