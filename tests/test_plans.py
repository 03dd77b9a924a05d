import pytest

from ioclake.plans import bindings as b
from ioclake.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_n_and_dedup_use_window_group_limit(spark):
    for name in ["links_first_n", "dedup_by_url"]:
        df = QUERIES[name](spark, SF)
        assert "WindowGroupLimit" in df._jdf.queryExecution().optimizedPlan().toString() or \
            "WindowGroupLimit" in plan(df), name


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_or_python(spark, name):
    p = plan(QUERIES[name](spark, SF))
    for bad in ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                "FlatMapGroupsInPandas", "MapInPandas"]:
        assert bad not in p, (name, bad)


def test_scan_prunes_columns(spark):
    p = plan(QUERIES["risk_range_check"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,n_chars:bigint>" in p


@pytest.mark.parametrize("name", ["ttps", "indicator_classes"])
def test_texts_of_one_row_group_keep_all_cores_busy(spark, name):
    assert b.dealt_documents(spark, SF).rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism
    p = plan(QUERIES[name](spark, SF))
    assert "REPARTITION_BY_NUM" in p
    assert "hashpartitioning(n_tokens" not in p and "hashpartitioning(doc#" in p


def test_sightings_are_found_by_many_tasks(spark, monkeypatch):
    from ioclake.plans import catalog
    seen = []
    monkeypatch.setattr(catalog, "written", lambda df, name: seen.append(plan(df)) or df)
    QUERIES["ioc_seen"](spark, SF)
    assert len(seen) == 1 and "REPARTITION_BY_NUM" in seen[0]


@pytest.mark.parametrize("name", ["ioc_links", "articles_enriched", "actor_related_iocs", "actor_motivation", "actor_targets",
                                  "actor_tactics", "actor_techniques", "actor_summary", "ttp_links"])
def test_mentions_are_found_once(spark, name):
    p = plan(QUERIES[name](spark, SF))
    assert "xxhash64" not in p  # of tokens, where mentions may begin: written before
    if name in ("ioc_links", "actor_related_iocs"):
        assert "documents.parquet" not in p
