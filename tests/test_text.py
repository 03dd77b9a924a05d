import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows

from ioclake.functions.html import html_main_text, html_title
from ioclake.functions.text import decode_entities
from ioclake.operators.pages import page_text
from ioclake.operators.text import chunk_tokens, split_sentences, tokenize


def py_tokens(text):
    out = []
    for t in re.split(r"[ \t\n\x0b\f\r]+", text):
        while t and not t[0].isalnum():
            t = t[1:]
        while t and not (t[-1].isalnum() or t[-1] == "/"):
            t = t[:-1]
        if t:
            out.append(t)
    return out


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc long, text string")


def test_token_rule(spark):
    got = [t for (t,) in rows(tokenize(docs(spark, ["###a*** b/ //c %%% d.e, x@y.z."]), "doc"), "token")]
    assert got == ["a", "b/", "c", "d.e", "x@y.z"]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="ab é1./#*&_ \n\t", max_size=40), min_size=1, max_size=10))
def test_tokens_match_per_token_definition(spark, texts):
    got = {}
    for d, p, t in rows(tokenize(docs(spark, texts), "doc"), "doc", "pos", "token"):
        got.setdefault(d, []).append((p, t))
    for i, text in enumerate(texts):
        assert [t for _, t in sorted(got.get(i, []))] == py_tokens(text)


def test_chunk_edges(spark):
    n = 4
    texts = ["", " ".join(["w"] * n), " ".join(["w"] * (n + 1))]
    got = rows(chunk_tokens(docs(spark, texts), "doc", max_tokens=n), "doc", "chunk_no", "n_tokens")
    assert sorted(got) == [(1, 0, 4), (2, 0, 4), (2, 1, 1)]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet='ab,".$ \n\té', max_size=30), min_size=1, max_size=8), st.integers(1, 5))
def test_chunks_join_to_the_text(spark, texts, n):
    got = {}
    for d, c, chunk, k in rows(chunk_tokens(docs(spark, texts), "doc", max_tokens=n)):
        assert 1 <= k <= n
        got.setdefault(d, []).append((c, chunk))
    for i, text in enumerate(texts):
        joined = "".join(ch for _, ch in sorted(got.get(i, [])))
        assert joined == (text if text.strip(" \n\t") else "")


def test_sentences_keep_punctuation(spark):
    got = rows(split_sentences(docs(spark, ["A b. C d!  E?\nF"]), "doc"), "sent", "sent_text")
    assert got == [(0, "A b."), (1, "C d!"), (2, "E?"), (3, "F")]


def test_page_text_extraction(spark):
    html = ("<html><head><title>T &amp; U</title><script>var t=\"</p>\";</script></head><body>"
            "<nav><a href='/x'>menu</a></nav><!-- c --><article><h1>Head</h1><p>One &lt;b&gt; "
            "<b>two</b>.<br><p>Three&#233;&#x41;</article><footer>f</footer></body></html>")
    pages = spark.createDataFrame([(1, "https://e.com/a", html)], "page_id long, url string, html string")
    (t,) = rows(page_text(pages), "title", "text")
    assert t == ("T & U", "Head\nOne <b> two.\nThreeéA")


def test_page_without_text_dropped(spark):
    pages = spark.createDataFrame([(1, "u", "<html><body><script>x</script></body></html>")],
                                  "page_id long, url string, html string")
    assert rows(page_text(pages)) == []
    df = pages.select(html_title(F.col("html")).alias("t"), html_main_text(F.col("html")).alias("x"))
    assert rows(df) == [("", "")]


def test_punctuation_stays_in_chunks(spark):
    text = 'The "Lazarus Group", a.k.a. APT-38 (DPRK). It paid $5M;'
    assert rows(chunk_tokens(docs(spark, [text]), "doc"), "chunk") == [(text,)]


def decoded(spark, *texts):
    return [t for (t,) in rows(docs(spark, texts).select(decode_entities("text").alias("t")))]


def test_references_decode_once_and_never_fail(spark):
    got = decoded(spark, "&#x24;1 &#36;", "&#x5c;n", "&#9999999; &#99999999999999999999;", "&#55357;&#56832;", "&#38;amp;",
                  "&amp;lt;", "caf&eacute; &Eacute; &euro;", "&nosuch; & &; &#; &#x; &#0;", "&#00000000065;&#x0000041;", "a&b")
    assert got == ["$1 $", "\\n", "\ufffd \ufffd", "\ufffd\ufffd", "&amp;", "&lt;", "caf\u00e9 \u00c9 \u20ac",
                   "&nosuch; & &; &#; &#x; \ufffd", "AA", "a&b"]


def main_text(spark, html):
    df = spark.createDataFrame([(html,)], "html string")
    return rows(df.select(html_main_text(F.col("html")).alias("t")))[0][0]


def test_all_articles_nested_ones_and_their_headers(spark):
    assert main_text(spark, "<body>out<article>a<article>quote</article>b</article>mid<article>c</article>out</body>") \
        == "a\nquote\nb\nc"
    assert main_text(spark, "<header>top</header><article><header><h1>Head</h1></header>x</article>") == "Head\nx"
    assert main_text(spark, "<body><header>top</header>text</body>") == "text"
    assert main_text(spark, "</article>x<article>never closed") == "never closed"
