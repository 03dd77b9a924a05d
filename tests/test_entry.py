"""The driver's front door: the flagship query and the bench on small tables."""

import json

import __spark_entry__
import bench
from ioclake.plans.catalog import QUERIES


def test_entry_gives_rows(spark):
    got = __spark_entry__.entry(spark)
    assert got.columns == ["type", "n_iocs", "n_articles"]
    assert got.count() > 0


def test_bench_runs(spark, monkeypatch, capsys):
    assert set(bench.HEADLINE) <= set(QUERIES)  # each of them runs in test_oracle
    monkeypatch.setattr(bench, "HEADLINE", ["links_first_n", "gazetteer_mentions"])
    monkeypatch.setenv("BENCH_SF_DIR", "/root/testdata/sf0.001")
    monkeypatch.setenv("BENCH_REPS", "1")
    bench.main()
    line = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert set(line["queries"]) == {"flagship", *bench.HEADLINE}
    assert line["value"] > 0
