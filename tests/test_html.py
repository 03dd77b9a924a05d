"""The page tokenizer: lossless, linear, and like a parser on odd markup."""

import time
from html.parser import HTMLParser

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows

from ioclake.functions import html as H
from ioclake.operators import links as lk
from ioclake.operators import pages as pg


def parsed(spark, *pages):
    df = spark.createDataFrame([(i, "https://h/", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    return df


def hrefs(spark, html):
    return [h for _, h in sorted(rows(lk.extract_links(parsed(spark, html)), "link_pos", "href"))]


def text(spark, html):
    return rows(parsed(spark, html).select(H.html_main_text(F.col("html"))))[0][0]


class Anchors(HTMLParser):
    """First href of each <a> start tag, by the standard library."""

    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            h = next((v for k, v in attrs if k == "href"), None)
            if h:
                self.found.append(h)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.sampled_from(list("<>/!-\"'= \n") + ["a", "href", "x", "<a ", "</a>", "<!--", "-->", "<script>",
       "</script>", "<title>", "</title", "<article>", "</article>", "<nav>", "</nav>", "<body>", "&amp;", "é", "\x00"]),
       max_size=25).map("".join), min_size=1, max_size=12))
def test_tokens_join_to_the_page(spark, pages):
    t = F.col("tokens")
    got = rows(pg.tokenize_pages(parsed(spark, *pages), ("page_id", "html")).select(
        "html", F.array_join(t, "").alias("back"), H.token_parts(t).alias("parts"), F.size(t).alias("n")))
    for html, back, parts, n in got:
        assert back == html
        assert parts[0]["at"] == 0 and parts[-1]["upto"] == n
        assert all(x["upto"] == y["at"] for x, y in zip(parts, parts[1:]))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.sampled_from(['<a href="/a">', "<a href='/b' x>", "<a title=it's href=/c>", "<a x=1 HREF = /d >", "<a/href=/e>",
       "<b href=/no>", "<a data-href=/no>", "text > ' \" ", "<!-- <a href=/no> -->", "<a>", "<a href>", '<a href="">',
       "<script>'<a href=/no>'</script>", "<style><a href=/no></style>", '<a t="a>b" href="/f">', "</a>", "<p class='x'>"]), max_size=12))
def test_links_are_those_of_a_parser(spark, parts):
    html = "".join(parts)
    p = Anchors()
    p.feed(html)
    assert hrefs(spark, html) == p.found


def test_quotes_open_values_only_after_an_equals_sign(spark):
    assert hrefs(spark, "<a title=it's href=/b>x</a>") == ["/b"]
    assert hrefs(spark, "<a x='y'href=\"/q\">z</a>") == ["/q"]
    assert hrefs(spark, "<a href href=/second>") == []
    assert hrefs(spark, "<a \"odd\" href=/r>") == ["/r"]


def test_raw_text_holds_no_links(spark):
    assert hrefs(spark, "<script><a href=/no>") == []
    assert hrefs(spark, "<textarea><a href=/no></textarea><a href=/yes>") == ["/yes"]
    assert hrefs(spark, "<title><a href=/no></title><a href=/yes>") == ["/yes"]
    assert hrefs(spark, "<a href='/never closed") == []


def test_unclosed_boilerplate_ends_with_what_is_around_it(spark):
    assert text(spark, "<body><article>a<nav>menu</article>b</body>") == "a"
    assert text(spark, "<body>x<nav>menu</body>") == "x"
    assert text(spark, "<article>a<aside>x<aside>y</aside>z</aside>b</article>") == "a\nb"
    assert text(spark, "<article>a<aside><article>related</article></aside>b</article>") == "a\nb"
    assert text(spark, "<p>AT&am<b>p; T") == "AT&amp; T"


PARAGRAPH = "Twenty plain words of an article that goes on and on about one and the same thing without any link at all. "


def test_content_is_found_without_an_article(spark):
    menu = "".join(f"<li><a href=/{n}>Menu entry {n}</a>" for n in range(12))
    page = (f"<body><div><ul>{menu}</ul></div><h1>Head</h1><p>{PARAGRAPH * 2}<p>See <a href=/x>this note</a>. {PARAGRAPH}"
            f"<p>{PARAGRAPH * 3}<div><a href=/a>About us</a> <a href=/c>Contact</a> <a href=/t>Terms of use</a></div><ul>{menu}</ul></body>")
    got = text(spark, page)
    assert got.startswith("Head\nTwenty") or got.startswith("Twenty")
    assert "See this note." in got and "Menu" not in got and "Terms" not in got
    assert text(spark, "<body><p>Short.<p>Lines.</body>") == "Short.\nLines."
    blocks, first, last, body = rows(pg.page_content(parsed(spark, page)), "blocks", "first", "last", "text")[0]
    assert (blocks, first, last) == (29, 12, 15) and body == got


def test_best_run_equals_all_runs(spark):
    @settings(max_examples=40, deadline=None)
    @given(st.lists(st.integers(-5, 5), max_size=12))
    def check(ws):
        df = spark.createDataFrame([(ws,)], "w array<int>").select(H.best_run(F.col("w")).alias("r"))
        runs = [(-sum(ws[a:b + 1]), b, -a) for a in range(len(ws)) for b in range(a, len(ws)) if sum(ws[a:b + 1]) > 0]
        first, last, total = df.first().r
        assert (first, last, total) == ((-min(runs)[2], min(runs)[1], -min(runs)[0]) if runs else (-1, -1, 0))
    check()


HOSTILE = {
    "long tag": "<a " + "x" * 100_000 + " href='/b'>t",
    "many attributes": "<a " + " ".join(f'a{i}="v{i}"' for i in range(50_000)) + " href='/b'>t",
    "unclosed quotes": "<a href='/b'>t" + '<a href="x ' * 20_000,
    "unclosed menus": "<a href='/b'>t" + "<nav>" * 100_000,
    "closed menus": "<a href='/b'>t" + "<nav>x</nav>" * 40_000,
    "comments": "<a href='/b'>t" + "<!-- " * 100_000,
    "angles": "<a href='/b'>t" + "< " * 200_000,
    "long text": "<a href='/b'>t" + "word <b>w</b> <br>" * 60_000,
}


@pytest.mark.parametrize("name", sorted(HOSTILE))
def test_hostile_pages_take_seconds(spark, name):
    rows(pg.parse_pages(parsed(spark, "<p>warm")))
    began = time.time()
    got = rows(pg.parse_pages(parsed(spark, HOSTILE[name])), "text", "hrefs")
    assert got[0][1] == ["'/b'"] and got[0][0].startswith("t")
    assert time.time() - began < 20
