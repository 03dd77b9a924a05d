"""Related entities, sightings over runs, published folders, the ledger."""

import glob
import json

import pytest
from pyspark.sql import functions as F

from conftest import rows

from ioclake.functions import joins
from ioclake.operators import ledger as lg
from ioclake.operators import related as rel
from ioclake.operators import report as rp
from ioclake.operators import seen
from ioclake.sources import commits

IOC = "doc string, src_rank int, sent long, pos long, pat_rank int, type string, value string"


def iocs(spark, data):
    return spark.createDataFrame([(d, s, n, p, 0, t, v) for d, s, n, p, t, v in data], IOC)


@pytest.mark.parametrize("hot", [1024, 2])
def test_classes_and_members_without_pairs(spark, monkeypatch, hot):
    monkeypatch.setattr(joins, "HOT_KEYS", hot)
    third = [(f"d{n:03}", 1, 0, 0, "URL", "common.example") for n in range(100)] * 2
    data = third + [("d001", 1, 0, 1, "CVE", "CVE-1"), ("d002", 1, 0, 2, "CVE", "CVE-1"), ("d003", 1, 0, 2, "URL", "alone")]
    df = iocs(spark, data)
    assert sorted(rows(rel.indicator_classes(df))) == [("CVE", "CVE-1", 2, "d001"), ("URL", "common.example", 100, "d000")]
    got = rows(rel.related_articles(df), "doc", "value", "n_links")
    assert len(got) == 102
    assert sorted(g for g in got if g[1] != "common.example") == [("d001", "CVE-1", 1), ("d002", "CVE-1", 1)]
    assert rows(rel.related_articles(iocs(spark, []))) == []


def test_links_go_both_ways(spark):
    m = spark.createDataFrame([("d", 0, 0, 1, "ACME", "ORG"), ("d", 0, 3, 1, "Acme", "ORG"), ("d", 0, 5, 1, "worm", "EVENT"),
                               ("d", 0, 6, 1, "acme-tool", "PRODUCT"), ("d", 1, 0, 1, "law", "LAW"), ("d", 1, 2, 1, "acme-tool", "PRODUCT")],
                              "doc string, sent long, pos long, n_tokens int, text string, label string")
    from ioclake.operators import actors as ac
    from ioclake.operators import mentions as mn
    t = mn.ttps(m)
    assert sorted(rows(rel.ttp_links(t, m), "technique", "related_actors")) == [("law", []), ("worm", ["acme"])]
    df = iocs(spark, [("d", 0, 0, 6, "PRODUCT", "acme-tool"), ("d", 0, 1, 2, "PRODUCT", "acme-tool"), ("d", 1, 0, 9, "URL", "x.io")])
    assert sorted(rows(rel.ioc_links(df, ac.merge_actors(m), t), "value", "related_actors", "related_ttps")) == [
        ("acme-tool", ["acme"], ["law", "worm"]), ("x.io", [], [])]


def test_replayed_runs_leave_the_state(spark, tmp_path):
    def run(day, *values):
        df = spark.createDataFrame([("URL", v, f"2024-01-0{day} 00:00:00") for v in values] + [("URL", None, "2024-01-01 00:00:00"),
                                   ("URL", "never", None)], "type string, value string, at string")
        return seen.sightings(df, "at")

    path = f"file://{tmp_path}/seen"
    assert rows(seen.read_seen(spark, path)) == []
    for day, values in ((2, "ab"), (3, "bc"), (1, "a"), (2, "ab"), (3, "bc")):
        state = seen.update_seen(spark, path, run(day, *values), f"run{day}")
    assert sorted((v, a.day, b.day) for _, v, a, b in rows(state)) == [("a", 1, 2), ("b", 2, 3), ("c", 3, 3)]


def report(spark, n, text="t"):
    arts = spark.createDataFrame([(i, f"T{i}", f"u{i}", text, "[]", "[]", "[]") for i in range(n)],
                                 "pos long, title string, url string, text string, threat_actors string, ttps string, iocs string")
    done = spark.createDataFrame([(i, f"s{i}", "g", ["A"], [], ["R"]) for i in range(n)],
                                 "pos long, Executive_Summary string, Global_Impact string, Threat_Actors array<string>, "
                                 "TTPs array<string>, Recommendations array<string>")
    return rp.report_lines(arts.repartition(3), done.repartition(2), "id", __import__("datetime").datetime(2024, 1, 2))


def test_files_in_name_order_are_the_report(spark, tmp_path):
    path = f"file://{tmp_path}/r"
    folder = rp.write_report(report(spark, 40), path, "20240102_000000")
    lines = [json.loads(x) for f in sorted(glob.glob(folder.removeprefix("file://") + "/part-*")) for x in open(f)]
    place = [(rp.SECTIONS.index(x["section"]), x["pos"]) for x in lines]
    assert place == sorted(place) and len(lines) == 1 + 40 + 1 + 0 + 1 + 40
    back = rp.read_report(spark, path, "20240102_000000")
    assert sorted(rows(back)) == sorted(rows(report(spark, 40)))
    assert rp.read_report(spark, path, "20990101_000000") is None


def test_readers_see_a_whole_report_or_the_old_one(spark, tmp_path, monkeypatch):
    path, stamp = f"file://{tmp_path}/r", "20240102_000000"
    rp.write_report(report(spark, 3, "old"), path, stamp)
    before = sorted(rows(rp.read_report(spark, path, stamp)))

    def dies(*_):
        raise RuntimeError("between the two writes")

    with monkeypatch.context() as m:
        m.setattr(rp, "publish", dies)
        with pytest.raises(RuntimeError):
            rp.write_report(report(spark, 5, "new"), path, stamp)
    assert sorted(rows(rp.read_report(spark, path, stamp))) == before
    rp.write_report(report(spark, 5, "new"), path, stamp)
    rp.write_report(report(spark, 1), path, "20240103_000000")
    assert rp.read_report(spark, path, stamp).filter("section = 'article'").count() == 5
    assert sorted(r[0] for r in rows(rp.reports(spark, path))) == [stamp, "20240103_000000"]


def test_publish_replaces_what_a_name_stands_for(spark, tmp_path):
    path = f"file://{tmp_path}/p"
    assert commits.published(spark, path, "x") is None
    for folder in ("one", "two"):
        commits.publish(spark, path, "x", folder)
        assert commits.published(spark, path, "x") == folder


REQUESTS = [("a", 0), ("a", 1), ("b", 0), ("c", 0)]


def answers(todo):
    """a0 at once; a1 at the second time; b0 never; c0 by an error, then by broken JSON, which counts."""
    good = F.lit('{"Executive_Summary": "x"}')
    k = F.concat("doc", F.col("chunk_no").cast("string"))
    content = (F.when(k == "a0", good).when((k == "a1") & (F.col("attempt") > 1), good)
               .when((k == "c0") & (F.col("attempt") > 1), F.lit("not json")).when(k == "b0", F.lit("[1]")))
    return todo.select("doc", "chunk_no", "attempt", F.when(content.isNull(), "error").otherwise("ok").alias("status"), content.alias("content"))


def test_rounds_ask_what_is_left(spark):
    req = spark.createDataFrame(REQUESTS, "doc string, chunk_no int")
    asked = []

    def ask(todo):
        asked.append(sorted(rows(todo, "doc", "chunk_no", "attempt")))
        return answers(todo)

    done = lg.ask_all(req, ask)
    assert asked == [[("a", 0, 1), ("a", 1, 1), ("b", 0, 1), ("c", 0, 1)], [("a", 1, 2), ("b", 0, 2), ("c", 0, 2)], [("b", 0, 3)]]
    assert sorted(rows(done, "doc", "chunk_no", "attempt", "reply_class")) == [
        ("a", 0, 1, "b"), ("a", 1, 1, "failed"), ("a", 1, 2, "b"), ("b", 0, 1, "d"), ("b", 0, 2, "d"), ("b", 0, 3, "d"),
        ("c", 0, 1, "failed"), ("c", 0, 2, "c")]
    assert rows(lg.due(req, done)) == []
    again = lg.ask_all(req, ask, done)  # started again: nothing is asked twice
    assert len(asked) == 3 and sorted(rows(again)) == sorted(rows(done))


def test_recording_twice_changes_nothing(spark):
    old = spark.createDataFrame([("a", 0, 1, "d", 5)], lg.SCHEMA)
    new = spark.createDataFrame([("a", 0, 1, "a", 9), ("a", 0, 2, "a", 9), ("a", 0, 2, "c", 7)], lg.SCHEMA)
    once = lg.record(old, new)
    assert sorted(rows(once)) == [("a", 0, 1, "d", 5), ("a", 0, 2, "c", 7)]
    assert sorted(rows(lg.record(once, new))) == sorted(rows(once))


def test_waits_are_fixed_and_bounded(spark):
    df = spark.range(200).select(F.col("id").cast("string").alias("doc"), F.lit(0).alias("chunk_no"), (F.col("id") % 10 + 1).alias("attempt"))
    got = df.select("attempt", lg.wait_ms(["doc", "chunk_no"], F.col("attempt")).alias("w")).collect()
    assert all(r.w == 0 if r.attempt == 1 else 1000 <= r.w <= min(60_000, 1000 * 2 ** (r.attempt - 1)) for r in got)
    assert len({r.w for r in got}) > 100
