"""Connected components of a link table by alternating large-star and
small-star steps; every step is a shuffle join on node ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ioclake.llm.common import join_counted, written


def _star(edges: DataFrame, large: bool, n: int) -> DataFrame:
    """One step: each node's larger (smaller) neighbours are linked to the
    smallest node among itself and its neighbours.  ``n``: links at least as
    many as a node may have; centres of many links do not meet in one task."""
    e = edges.toDF("u", "v")
    if large:
        e = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        e = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = e.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("held"))
    j = join_counted(e, low, "u", "held", n)
    if large:
        out = j.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = j.select(F.col("v").alias("a"), F.col("m").alias("b")) \
            .union(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.filter("a <> b") if large else out.filter("a <> b").distinct()


def _sum(edges: DataFrame):
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(r)


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, comp) for every node of ``edges`` (a, b): comp is the smallest
    node reachable.  Nodes without a link are not listed.  The number of steps
    is logarithmic in the largest component; only a count and a checksum of
    the links reach the driver."""
    cur = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .filter("a <> b").distinct(), "links")
    before = _sum(cur)
    while before[0]:
        star = written(_star(cur, True, 2 * before[0]), "stars")
        cur = written(_star(star, False, 2 * before[0]), "links")
        after = _sum(cur)
        if after == before:
            break
        before = after
    roots = cur.select(F.col("b").alias("id"), F.col("b").alias("comp")).distinct()
    return cur.select(F.col("a").alias("id"), F.col("b").alias("comp")).union(roots)
