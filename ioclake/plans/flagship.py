"""The flagship query: the whole article side in one plan.

pages -> (title, text) -> http(s) URL check -> dedup by URL (first in
order) -> validation -> indicators from patterns, URL/e-mail tokens and
gazetteer mentions -> rows per indicator type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ioclake.operators import iocs as io
from ioclake.operators import mentions as mn
from ioclake.plans.run import Run


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    arts = Run(spark, sf, keep={"parsed"}).validated.select("doc", "text")
    ments = mn.find_mentions(arts, mn.gazetteer_table(spark), key="doc")
    iocs = io.all_iocs(io.mention_iocs(ments), io.token_iocs(arts, "doc"))
    return (iocs.groupBy("type")
            .agg(F.count(F.lit(1)).alias("n_iocs"), F.countDistinct("doc").alias("n_articles"))
            .orderBy("type"))
