from conftest import rows

from ioclake.operators import links as lk
from ioclake.operators import pages as pg


def page(spark, html, url="https://h/blog/x", page_id=1):
    return spark.createDataFrame([(page_id, url, html)], "page_id long, url string, html string")


def test_first_five_counts_duplicates_and_self_links(spark):
    anchors = "".join(f'<a href="{h}">x</a>' for h in
                      ["/blog/a", "/blog/a", "/blog/a", "/other", "#top", "/blog/b", "/research/c", "/blog/d"])
    links = lk.resolve_links(lk.extract_links(page(spark, f"<html><body>{anchors}</body></html>")))
    first = lk.first_n_links(lk.filter_article_links(links))
    got = sorted(rows(first, "link_pos", "abs_url"))
    assert got == [(0, "https://h/blog/a"), (1, "https://h/blog/a"), (2, "https://h/blog/a"),
                   (4, "https://h/blog/x#top"), (5, "https://h/blog/b")]


def test_anchors_in_script_or_comment_are_not_links(spark):
    html = ('<!-- <a href="/blog/z"> --><script>var a = \'<a href="/blog/s">\';</script>'
            '<style>a{}</style><a href=\'/blog/ok\'>k</a><a href=/blog/bare>b</a><a href="">e</a>')
    got = rows(lk.extract_links(page(spark, html)), "href")
    assert sorted(got) == [("/blog/bare",), ("/blog/ok",)]


def test_entities_in_href_are_decoded(spark):
    got = rows(lk.extract_links(page(spark, '<a href="/blog/a?x=1&amp;y=2">x</a>')), "href")
    assert got == [("/blog/a?x=1&y=2",)]


def test_bad_href_goes_to_rejects_and_others_stay(spark):
    html = '<a href="http://[bad">x</a><a href="/blog/good">y</a>'
    links = lk.resolve_links(lk.extract_links(page(spark, html)))
    assert rows(lk.filter_article_links(links), "abs_url") == [("https://h/blog/good",)]
    assert rows(lk.link_rejects(links), "reason") == [("invalid_ipv6",)]


def test_only_the_href_attribute_of_an_anchor_counts(spark):
    html = ('<a data-href="/blog/wrong" href="/blog/right">1</a><a title="a>b" href="/blog/gt">2</a>'
            '<a-card href="/blog/card">3</a-card><abbr href="/blog/abbr">4</abbr><a\nclass=x\nHREF = \'/blog/up\'>5</a>'
            '<a title="href=/blog/no">6</a>')
    got = sorted(rows(lk.extract_links(page(spark, html)), "link_pos", "href"))
    assert got == [(0, "/blog/right"), (1, "/blog/gt"), (2, "/blog/up")]


def test_page_lookup_ignores_fragments_and_second_copies(spark):
    pages = spark.createDataFrame([(7, "https://h/a", "<p>7"), (3, "https://h/a#x", "<p>3"), (9, None, "<p>9")],
                                  "page_id long, url string, html string")
    links = spark.createDataFrame([(1, 0, "https://h/a#top"), (1, 1, "https://h/b")],
                                  "site_pos long, link_pos int, abs_url string")
    assert rows(pg.join_links_to_pages(links, pages), "abs_url", "page_id", "html") == [("https://h/a#top", 3, "<p>3")]
    assert rows(pg.links_without_page(links, pages), "abs_url") == [("https://h/b",)]
    assert sorted(rows(pg.fetch_frontier(links, pages))) == [("https://h/a", True), ("https://h/b", False)]
