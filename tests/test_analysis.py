import json
import tempfile
from datetime import datetime

from conftest import rows

from ioclake.operators import analysis as an
from ioclake.operators import report as rp

RSCHEMA = "doc string, chunk_no int, attempt int, status string, content string"


def replies(spark, data):
    return spark.createDataFrame(data, RSCHEMA)


def classify_one(spark, content, status="ok"):
    (r,) = rows(an.classify_replies(replies(spark, [("d", 0, 1, status, content)])))
    return dict(zip(an.classify_replies(replies(spark, [("d", 0, 1, status, content)])).columns, r))


def test_reply_a_object_of_strings(spark):
    c = json.dumps({"Executive_Summary": "S", "Threat_Actors": "A, B", "TTPs": "T", "IOCs": "",
                    "Global_Impact": "G", "Recommendations": "R1, R2"})
    r = classify_one(spark, c)
    assert r["reply_class"] == "a" and r["Threat_Actors"] == ["A", "B"] and r["IOCs"] == [""]


def test_reply_b_missing_keys(spark):
    r = classify_one(spark, "{}")
    assert r["reply_class"] == "b" and r["Executive_Summary"] == "" and r["TTPs"] == [""]


def test_reply_c_not_json(spark):
    for c in ["not json", '{"a":1} x']:
        r = classify_one(spark, c)
        assert r["reply_class"] == "c" and r["Executive_Summary"] == c and r["TTPs"] == []


def test_reply_d_and_e(spark):
    for c in ["[1]", '{"TTPs":null}', '{"TTPs":["x"]}', '{"TTPs":5}']:
        assert classify_one(spark, c)["reply_class"] == "d", c
    assert classify_one(spark, '{"Executive_Summary":5}')["reply_class"] == "e"
    assert classify_one(spark, "{}", status="error")["reply_class"] == "failed"


def test_first_good_attempt(spark):
    good = json.dumps({"Executive_Summary": "two"})
    r = replies(spark, [("d", 0, 1, "error", None), ("d", 0, 2, "ok", good), ("d", 0, 3, "ok", '{"Executive_Summary":"three"}'),
                        ("d", 1, 1, "ok", "[1]"), ("d", 1, 2, "ok", "[1]"), ("d", 1, 3, "ok", "[1]")])
    cl = an.classify_replies(r)
    chosen = an.choose_attempt(cl)
    assert rows(chosen, "chunk_no", "attempt", "Executive_Summary") == [(0, 2, "two")]
    assert rows(an.reply_rejects(cl), "key", "reason") == [("d#1", "no_usable_reply")]
    e = an.classify_replies(replies(spark, [("d", 5, 1, "ok", '{"Executive_Summary":5}'),
                                            ("d", 5, 2, "ok", '{"Executive_Summary":"x"}')]))
    assert rows(an.reply_rejects(e), "key", "reason") == [("d#5", "non_string_text")]


def test_salvage(spark):
    r = replies(spark, [("d", 0, 1, "ok", '{"TTPs": "x, y", oops'), ("d", 1, 1, "ok", '"IOCs":""'),
                        ("d", 2, 1, "ok", "zz")])
    got = {c: (s, t, i) for c, s, t, i in rows(an.salvage_replies(r), "chunk_no", "salvaged", "TTPs", "IOCs")}
    assert got == {0: (True, ["x", "y"], []), 1: (True, [], [""]), 2: (False, [], [])}


def test_combine_blanks_and_lists(spark):
    a = spark.createDataFrame(
        [("d", 0, "a", ["x", "y"], [], [""], "i", []), ("d", 1, "", ["y", "z"], [], [], "", []),
         ("d", 2, "b", [], ["t"], [], "j", ["r"])],
        "doc string, chunk_no int, Executive_Summary string, Threat_Actors array<string>, TTPs array<string>, "
        "IOCs array<string>, Global_Impact string, Recommendations array<string>")
    (r,) = rows(an.combine_articles(a, fanout=2))
    assert r == ("d", "a  b", ["x", "y", "z"], ["t"], [], "i  j", ["r"])


def test_unanalysed_article_and_report(spark):
    arts = spark.createDataFrame(
        [("d1", 1, "T1", "u1", "x", "[]", "[]", '[{"a":1}]'), ("d2", 2, "T2", "u2", None, "[]", "[]", "[]")],
        "doc string, pos long, title string, url string, text string, threat_actors string, ttps string, iocs string")
    comb = spark.createDataFrame(
        [("d1", "s1", ["x", "y"], ["y", "z"], [], "g1", ["r"])],
        "doc string, Executive_Summary string, Threat_Actors array<string>, TTPs array<string>, "
        "IOCs array<string>, Global_Impact string, Recommendations array<string>")
    assert rows(an.unanalysed_articles(arts, comb), "doc") == [("d2",)]
    analysed = an.analysed_articles(arts.select("doc", "pos", "title"), comb)
    assert sorted(rows(rp.report_threats(analysed), "description")) == [("y",), ("z",)]
    assert rows(rp.report_summary(analysed)) == [(1, "s1", "g1")]
    lines = rp.report_lines(arts, analysed, report_id="r1", run_ts=datetime(2024, 1, 2))
    got = sorted(rows(lines, "section", "pos"))
    assert got == sorted([("header", 0), ("summary", 1), ("landscape", 1), ("landscape", 1), ("threat", 1),
                          ("threat", 1), ("recommendation", 1), ("article", 1), ("article", 2)])
    body = {(r.section, r.pos): json.loads(r.json)["threat_intelligence"] for r in lines.collect()}
    assert body["article", 1]["iocs"] == [{"a": 1}] and body["article", 2]["text"] is None
    out = tempfile.mkdtemp(prefix="ioclake-report-")
    for _ in range(2):  # the same stamp replaces its own lines
        rp.write_report(lines, out, "20240102_000000")
    assert rp.read_report(spark, out, "20240102_000000").count() == len(got)


def test_report_summary_keeps_empties(spark):
    a = spark.createDataFrame([(1, "a", "x"), (2, "", ""), (3, "b", "y")],
                              "pos long, Executive_Summary string, Global_Impact string")
    a = a.withColumn("pos", a.pos * 10**12)  # far apart positions need no common row
    assert sorted(rows(rp.report_summary(a))) == [(10**12, "a", "x"), (2 * 10**12, "", ""), (3 * 10**12, "b", "y")]
