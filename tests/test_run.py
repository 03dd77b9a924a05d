"""The staged run: one parse of a page, texts outside the dedup, counts from
the writes, and the folder that holds its tables."""

import os

import pytest

from conftest import rows

from ioclake.plans.run import COUNTS, Run
from ioclake.sources import staging

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def run(spark):
    r = Run(spark, SF)
    r.counts(), r.analysed
    return r


def test_a_page_is_parsed_once(run):
    readers = [n for n, p in run.stages.plans.items() if "html:string" in p]
    assert readers == ["parsed"]
    assert set(run.stages.plans) == {"parsed", "links", "first_links", "built", "deduped", "articles", "chunks",
                                     "classified", "chosen", "combined"}


def test_the_dedup_moves_no_text(run):
    assert "WindowGroupLimit" in run.stages.plans["deduped"]
    for stage in ("built", "deduped"):
        assert "ReadSchema" in run.stages.plans[stage] and ",text:string" not in run.stages.plans[stage]
    assert ",text:string" in run.stages.plans["articles"]


def test_counts_are_those_of_the_tables(run):
    seen = run.stages.counts
    assert set(COUNTS) <= set(seen)
    assert seen["pages"] == run.parsed.count() and seen["page_text"] == run.parsed.filter("text <> ''").count()
    assert seen["links"] == run.links.count() and seen["kept_links"] == run.first_links.count()
    assert seen["deduped"] == run.deduped.count() and seen["validated"] == run.validated.count()
    assert seen["chunks"] == run.chunks.count() and seen["chunk_analysis"] == run.chosen.filter("reply_class < 'd'").count()
    assert seen["analysed_articles"] == run.combined.count() == run.analysed.count()
    assert seen["build_rejects"] + seen["articles_built"] == seen["page_text"]


def test_stages_that_are_not_kept_stay_plans(spark):
    r = Run(spark, SF, keep={"parsed"})
    assert r.deduped.count() > 0 and set(r.stages.plans) == {"parsed"}


def test_odd_pages_end_in_rejects_or_nowhere(spark, tmp_path):
    long = "<a " + "x" * 50_000 + "<script>"
    pages = [(1, "https://e.com/a", "<title>T</title><article>one</article>"), (2, "https://e.com/a", "<title>U</title>two"),
             (3, "ftp://e.com/b", "<title>T</title>three"), (4, "https://e.com/c", "no title"), (5, None, "<title>T</title>x"),
             (6, "https://e.com/d", None), (7, "https://e.com/e", long), (8, "https://e.com/f", ""),
             (9, "https://e.com/g", "<title>T</title>x <a href='http://[bad'>y</a>")]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    r = Run(spark, str(tmp_path))
    r.counts()
    assert sorted(rows(r.validated, "pos", "title", "text")) == [(1, "T", "one"), (9, "T", "x y")]
    assert sorted(rows(r.rejects(), "stage", "reason")) == [
        ("build", "url_null_url"), ("build", "url_scheme"), ("link_resolve", "invalid_ipv6"), ("validate", "empty_title")]


def test_shared_folder_is_the_sessions(spark):
    folder = staging.shared_dir(spark)
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir")) and spark.sparkContext.applicationId in folder


def test_tables_go_at_the_end(spark, tmp_path):
    folder = f"file://{tmp_path}/gone"
    spark.range(3).write.parquet(folder + "/t")
    staging._remove(spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), folder)
    assert not os.path.exists(f"{tmp_path}/gone")


def test_a_cluster_must_name_its_folder(spark, monkeypatch):
    class Context:
        master, applicationId = "spark://host:7077", "app"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.shared_dir(Session)


def test_seed_sites_in_order(spark):
    from ioclake import config
    from ioclake.sources.tables import seed_table
    assert rows(seed_table(spark), "url") == [(u,) for u in config.SEED_SITES]
    assert rows(seed_table(spark, ["u"])) == [(0, "u")]
