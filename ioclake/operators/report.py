"""Corpus-level report tables (D4-D9) and the report document (A4, A5).

The report tables are the product: summary strings, actor landscape,
emerging threats and recommendations, each built with partial
aggregation.  The JSON document is written as JSON lines (one header line
and one line per article), so no single row or task holds the corpus.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ioclake import config
from ioclake.operators.aggregates import first_seen
from ioclake.sources.commits import new_folder, publish, published

LINE = "report_id string, run_ts string, section string, pos long, json string"


def report_summary(analysed: DataFrame) -> DataFrame:
    """(pos, executive_summary, global_impact): one row per article in
    article order.  The report's summary is the executive summaries joined by
    a blank (D4) and the impacts joined by a blank and stripped (D8); it is kept
    as ordered lines, so no row holds the corpus."""
    return analysed.select("pos", F.coalesce("Executive_Summary", F.lit("")).alias("executive_summary"),
                           F.coalesce("Global_Impact", F.lit("")).alias("global_impact"))


def _first_seen_items(analysed: DataFrame, field: str, out: str) -> DataFrame:
    items = analysed.select("pos", F.explode(field).alias(out))
    return first_seen(items, out, ["pos"]).withColumnRenamed("pos", "first_pos")


def report_landscape(analysed: DataFrame) -> DataFrame:
    """(actor, description, first_pos): distinct actors; order = first
    article, then name (D5)."""
    return _first_seen_items(analysed, "Threat_Actors", "actor").select(
        "actor", F.lit("").alias("description"), "first_pos")


def report_threats(analysed: DataFrame) -> DataFrame:
    """(description, severity, first_pos): distinct TTP texts."""
    return _first_seen_items(analysed, "TTPs", "description").select(
        "description", F.lit(None).cast("string").alias("severity"), "first_pos")


def report_recommendations(analysed: DataFrame) -> DataFrame:
    """(description, priority, first_pos): distinct recommendations."""
    return _first_seen_items(analysed, "Recommendations", "description").select(
        "description", F.lit(None).cast("string").alias("priority"), "first_pos")


def report_lines(articles: DataFrame, analysed: DataFrame, report_id: str | None = None,
                 run_ts: datetime | None = None,
                 generated_by: str = config.REPORT_GENERATOR) -> DataFrame:
    """(report_id, run_ts, section, pos, json): the report document as JSON
    lines (D9, A4, A5).

    Every line is wrapped in ``threat_intelligence`` (A5).  Sections:
    'header' (id, timestamp, version, generated_by), one 'summary' line per
    analysed article (summary, impact), one 'landscape' line per actor, one
    'threat' line per emerging threat, one 'recommendation' line per
    recommendation, one 'article' line per validated article (analysed or
    not) with its actors, TTPs and IOCs.  ``pos`` orders lines inside a section.  Every section is built
    in parallel; the id and run time are two constants."""
    spark = analysed.sparkSession
    report_id = report_id or str(uuid.uuid4())
    run_ts = run_ts or datetime.now(timezone.utc).replace(tzinfo=None)
    ts = F.lit(run_ts).cast("timestamp")
    stamp = run_ts.strftime("%Y%m%d_%H%M%S")

    def line(df, section, pos, payload):
        return df.select(F.lit(report_id).alias("report_id"), F.lit(stamp).alias("run_ts"),
                         F.lit(section).alias("section"), pos.cast("long").alias("pos"),
                         F.concat(F.lit('{"threat_intelligence":'), payload, F.lit("}")).alias("json"))

    def obj(*cols):
        return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})

    header = line(spark.range(1), "header", F.lit(0), obj(
        F.lit(report_id).alias("id"), ts.cast("string").alias("timestamp"),
        F.lit(config.REPORT_VERSION).alias("version"), F.lit(generated_by).alias("generated_by")))
    summary = line(report_summary(analysed), "summary", F.col("pos"), obj(
        "executive_summary", "global_impact"))
    land = line(report_landscape(analysed), "landscape", F.col("first_pos"), obj(
        "actor", F.create_map(F.lit("description"), F.col("description")).alias("entry")))
    thr = line(report_threats(analysed), "threat", F.col("first_pos"), obj("description", "severity"))
    rec = line(report_recommendations(analysed), "recommendation", F.col("first_pos"),
               obj("description", "priority"))
    # the entity columns hold JSON already
    own = F.to_json(F.struct("pos", "title", "url", "text"), {"ignoreNullFields": "false"})
    art = line(articles.withColumn("_own", own), "article", F.col("pos"), F.concat(
        F.expr("left(_own, length(_own) - 1)"), F.lit(',"threat_actors":'), "threat_actors",
        F.lit(',"ttps":'), "ttps", F.lit(',"iocs":'), "iocs", F.lit("}")))
    return (header.unionByName(summary).unionByName(land).unionByName(thr)
            .unionByName(rec).unionByName(art))


SECTIONS = ["header", "summary", "landscape", "threat", "recommendation", "article"]


def write_report(lines: DataFrame, path: str, run_ts: str) -> str:
    """Sink: the report of one run as JSON lines under ``path`` (A4), in order:
    files read by name give header, summaries, landscape, threats,
    recommendations and articles, each by position.  Readers see it whole, once
    the manifest of ``run_ts`` names its folder; a run with the same stamp
    replaces its own report and no other.  Returns the folder."""
    folder = new_folder(path, run_ts)
    rank = F.array_position(F.array(*map(F.lit, SECTIONS)), F.col("section"))
    order = ["_rank", "pos", "json"]
    placed = lines.withColumn("_rank", rank).repartitionByRange(*order).sortWithinPartitions(*order)
    placed.drop("_rank").write.json(folder)
    publish(lines.sparkSession, path, run_ts, folder)
    return folder


def read_report(spark: SparkSession, path: str, run_ts: str) -> DataFrame | None:
    """The lines of a published report, None if there is none."""
    folder = published(spark, path, run_ts)
    return None if folder is None else spark.read.schema(LINE).json(folder)


def reports(spark: SparkSession, path: str) -> DataFrame:
    """(run_ts, folder): the collection of reports under ``path``."""
    held = spark.read.schema("name string, folder string").json(f"{path.rstrip('/')}/commits/*.json")
    return held.select(F.col("name").alias("run_ts"), "folder")
