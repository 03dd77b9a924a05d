from conftest import rows

from ioclake.operators import articles as art


def build(spark, data):
    df = spark.createDataFrame(data, "page_id long, title string, url string, text string")
    return art.build_articles(df, pos="page_id")


def flow(spark, data):
    return art.validate(art.dedup_by_url(art.accepted(build(spark, data))))


def test_dedup_before_validate(spark):
    u = "https://e.com/a"
    assert rows(flow(spark, [(1, "", u, "t"), (2, "T", u, "t")])) == []


def test_null_title_drops_before_dedup(spark):
    u = "https://e.com/a"
    assert rows(flow(spark, [(1, None, u, "t"), (2, "T", u, "t")]), "pos") == [(2,)]


def test_blank_title_kept(spark):
    assert rows(flow(spark, [(1, " ", "https://e.com/a", "t")]), "pos") == [(1,)]


def test_url_key_normalised(spark):
    got = rows(flow(spark, [(1, "A", "http://EX.com", "t"), (2, "B", "http://ex.com/", "t")]), "pos", "url")
    assert got == [(1, "http://ex.com/")]


def test_fragment_differs(spark):
    got = rows(flow(spark, [(1, "A", "http://e.com/a#1", "t"), (2, "B", "http://e.com/a#2", "t")]), "pos")
    assert sorted(got) == [(1,), (2,)]


def test_scheme_rejects(spark):
    b = build(spark, [(1, "A", "mailto:a@b.c", "t"), (2, "B", "ftp://x.y/z", "t")])
    assert sorted(rows(b, "reject")) == [("url_scheme",), ("url_scheme",)]
    assert rows(art.accepted(b)) == []


def test_validation_rejects_reason(spark):
    df = art.dedup_by_url(art.accepted(build(spark, [(1, "", "https://e.com/a", "t")])))
    assert rows(art.validation_rejects(df), "reason") == [("empty_title",)]


def test_risk_range(spark):
    df = spark.createDataFrame([(1, None), (2, 0.0), (3, 100.0), (4, 100.5), (5, -1.0)], "id int, risk_score double")
    assert sorted(rows(art.risk_in_range(df), "id")) == [(1,), (2,), (3,)]
