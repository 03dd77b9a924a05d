from urllib.parse import urljoin

from hypothesis import given, settings
from hypothesis import strategies as st

from ioclake.functions.urls import with_normalized_url, with_resolved_url

BASES = ["https://h/blog/x", "http://a/b/c/d;p?q", "https://www.x.com/blog/", "http://a",
         "http://a/b?q#f", "https://h/a/b", "http://a/b//c/d"]
SEGMENT = st.sampled_from(["a", "b", "..", ".", "", "g", "blog", "x y", "é"])


@st.composite
def hrefs(draw):
    kind = draw(st.sampled_from(["rel", "abs", "frag", "query", "net", "scheme", "blank"]))
    path = "/".join(draw(st.lists(SEGMENT, min_size=1, max_size=5)))
    q = draw(st.sampled_from(["", "?y", "?a=1&b=2", "?"]))
    f = draw(st.sampled_from(["", "#s", "#"]))
    if kind == "rel":
        return path + q + f
    if kind == "abs":
        return "/" + path + q + f
    if kind == "frag":
        return "#" + draw(st.sampled_from(["top", "", "x"]))
    if kind == "query":
        return "?" + draw(st.sampled_from(["q", "", "z=1"])) + f
    if kind == "net":
        return "//host2/" + path + q
    if kind == "scheme":
        return draw(st.sampled_from(["mailto:x@y", "javascript:void(0)", "HTTP://Ex.com/A", "http:g",
                                     "ftp://f/x"]))
    return draw(st.sampled_from([" /x", "  ", "\t/t\n"]))


def resolve_all(spark, pairs):
    df = spark.createDataFrame(pairs, "base string, href string")
    return {(r.base, r.href): (r.abs_url, r.resolve_error)
            for r in with_resolved_url(df, "base", "href").collect()}


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(BASES), hrefs()), min_size=20, max_size=40))
def test_resolution_matches_urljoin(spark, pairs):
    got = resolve_all(spark, pairs)
    for base, href in pairs:
        assert got[(base, href)][0] == urljoin(base, href), (base, href)


def test_resolution_golden(spark):
    got = resolve_all(spark, [("https://h/blog/x", "#top"), ("https://h/a/b", "../../../x"),
                              ("http://a/b", "http://[bad"), ("http://a/b", "/good")])
    assert got[("https://h/blog/x", "#top")][0] == "https://h/blog/x#top"
    assert got[("https://h/a/b", "../../../x")][0] == "https://h/x"
    assert got[("http://a/b", "http://[bad")] == (None, "invalid_ipv6")
    assert got[("http://a/b", "/good")][0] == "http://a/good"


def test_normalization_golden(spark):
    cases = {
        "http://EX.com": ("http://ex.com/", None),
        "http://ex.com/": ("http://ex.com/", None),
        "https://Example.com:443/a/../b?x=1#F": ("https://example.com/b?x=1#F", None),
        "http://e.com/a#1": ("http://e.com/a#1", None),
        "http://e.com/a#2": ("http://e.com/a#2", None),
        "http://e.com/a b": ("http://e.com/a%20b", None),
        "http://e.com:8080/x/./y/..": ("http://e.com:8080/x/", None),
        "mailto:a@b.c": (None, "scheme"),
        "ftp://x.y/z": (None, "scheme"),
        "javascript:void(0)": (None, "scheme"),
        "http://h:99999/": (None, "port"),
    }
    df = spark.createDataFrame([(u,) for u in cases], "u string")
    got = {r.u: (r.url_norm, r.url_reject) for r in with_normalized_url(df, "u").collect()}
    assert got == cases
